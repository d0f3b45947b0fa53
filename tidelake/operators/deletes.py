"""Positional deletes: rows whose place in their file is listed are left out."""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

if TYPE_CHECKING:
    from tidelake.plans.layout import Group

#: Deleted rows up to which their places are broadcast, by the counts in the catalog: 16 bytes each, and a path.
MOST_BROADCAST = 500_000
#: Scans that files with deletes are cut into at most, each with places that can be broadcast.
MOST_PARTS = 32
#: Delete files up to which their link to data files is broadcast.
MOST_LINKS = 10_000


def shown(spark: SparkSession, rows: DataFrame) -> Callable[[str], str]:
    """How Spark's file metadata shows the path of a file that `rows` reads."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()

    def qualified(path: str) -> str:
        p = hadoop(path)
        # a path with its scheme needs no file system, whose credentials only the reader's options hold
        return (p if p.toUri().getScheme() else p.getFileSystem(conf).makeQualified(p)).toUri().toString()

    plain = lambda uri: re.sub(r"^([A-Za-z0-9+.-]+):/+", r"\1:/", uri)
    by = {plain(f): f for f in rows.inputFiles()}

    def find(path: str) -> str:
        found = by[plain(qualified(path))]
        return re.sub(r"^([A-Za-z0-9+.-]+):///", r"\1:/", found)  # where there is no host, metadata have one slash

    return find


def parts_to_broadcast(files: list) -> list[list]:
    """Files in runs whose listed places can be broadcast; all in one where that takes too many runs or counts are missing."""
    counts = [[d.count for d in f.deletes] for f in files]
    if any(n is None for c in counts for n in c) or sum(map(sum, counts)) <= MOST_BROADCAST:
        return [files]
    parts, held = [[]], 0
    for f, c in zip(files, counts):
        if parts[-1] and held + sum(c) > MOST_BROADCAST:
            parts.append([])
            held = 0
        parts[-1].append(f)
        held += sum(c)
    return parts if len(parts) <= MOST_PARTS else [files]


def without_deleted(rows: DataFrame, group: Group, resolve: Callable[[str, bool], str], options: dict[str, str]) -> DataFrame:
    """An anti-join on (file, row number); the catalog, not the delete file, says which data file is meant.

    Row numbers come from the reader and hold under splits and skipped row groups, so later filters may
    be pushed below the join.
    """
    spark = rows.sparkSession
    pairs = [(resolve(d.path, d.relative), resolve(f.path, f.relative)) for f in group.files for d in f.deletes]
    counts = [d.count for f in group.files for d in f.deletes]
    deleted = spark.read.options(**options).option("recursiveFileLookup", "true").schema("file_path string, pos long").parquet(*dict.fromkeys(d for d, _ in pairs))
    delete_file, data_file = shown(spark, deleted), shown(spark, rows)
    links = [(delete_file(d), data_file(f)) for d, f in pairs]
    deleted = deleted.select(F.col("_metadata.file_path").alias("__delete_file"), "pos")
    link = spark.createDataFrame(links, "__delete_file string, __file string")
    if len(links) <= MOST_LINKS:
        link = F.broadcast(link)
    deleted = deleted.join(link, "__delete_file").select("__file", F.col("pos").alias("__row"))
    if None not in counts and sum(counts) <= MOST_BROADCAST:
        deleted = F.broadcast(deleted)
    names = rows.columns
    numbered = rows.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    return numbered.join(deleted, ["__file", "__row"], "left_anti").select(*[f"`{n}`" for n in names])
