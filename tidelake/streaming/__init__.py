"""Following a table: the files that each new snapshot adds.

The tables read here are bounded; `new_rows` is the step of a loop or of foreachBatch that reads what was
added after one snapshot up to another, under the later one's schema.
"""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tidelake.operators.scan import read_group
from tidelake.plans import layout
from tidelake.sources import paths
from tidelake.sources.catalog import Catalog


def new_rows(
    spark: SparkSession, catalog: Any, table: str, after: int, up_to: int | None = None, *, schema: str | None = None, data_path: str | None = None, storage_options: dict[str, str] | None = None
) -> DataFrame:
    """Rows in files that became visible after snapshot `after`, as they are at `up_to` (the latest).

    Files merged by compaction after `after` hold older rows too and are refused.
    """
    with Catalog(catalog) as c:
        identity = layout.identify(c, table, schema, up_to, None)
        files, exact = layout.candidates(c, identity, [])
        base = data_path if data_path is not None else c.data_path()
    files = [f for f in files if f.begin > after]
    if any(f.partial_max is not None for f in files):
        raise NotImplementedError("a file added since then was merged from older ones")
    exact, account = {f.file_id: exact.get(f.file_id, ()) for f in files}, paths.account(storage_options)
    resolve = lambda path, relative: layout.full_path(identity, base, path, relative, account)
    parts = [part for g in layout.groups(identity, files, exact) for part in read_group(spark, identity, g, resolve, paths.reader_options(storage_options))]
    return reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], identity.struct)
