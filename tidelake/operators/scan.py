"""A table at a snapshot as a DataFrame."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.functions.convert import convert, null_of, physical
from tidelake.operators.deletes import parts_to_broadcast, without_deleted
from tidelake.plans import layout
from tidelake.plans.layout import Group, Identity
from tidelake.sources import paths
from tidelake.sources.catalog import Catalog
from tidelake.sources.types import contains, spark_type

log = logging.getLogger(__name__)


def scan(
    spark: SparkSession,
    catalog: Any,
    table: str,
    *,
    schema: str | None = None,
    snapshot_id: int | None = None,
    as_of: Any = None,
    storage_options: dict[str, str] | None = None,
    data_path: str | None = None,
    where: Column | str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Exactly the rows of `table` visible at a snapshot, under that snapshot's schema.

    catalog: a connection string, or a factory of DB-API connections.
    table: ``name`` (in ``main``) or ``schema.name``.
    snapshot_id, as_of: one of them pins the snapshot; as_of takes the latest at or before a time (UTC
        where it has no zone). Without them the latest snapshot is pinned now; later commits are not seen.
    storage_options: passed to every Parquet read.
    data_path: replaces the catalog's own.
    where: a condition on the result. Files that statistics or partition values rule out are not opened.
        Conditions added to the result later still prune partitions, columns and row groups.
    limit: at most so many rows. Without a condition only as many files are opened as hold them by the
        catalog's counts.
    """
    if limit is not None and limit < 0:
        raise ValueError("limit is negative")
    if snapshot_id is not None and as_of is not None:
        raise ValueError("snapshot_id and as_of are mutually exclusive")
    layout.split_name(table, schema)
    with Catalog(catalog) as c:
        identity = layout.identify(c, table, schema, snapshot_id, as_of)
        files, exact = layout.candidates(c, identity, layout.conjuncts(spark, identity, where))
        if limit is not None and where is None:
            files = layout.first_files(identity, files, limit)
        base = data_path if data_path is not None else c.data_path() if files else None
    options = paths.reader_options(storage_options)
    account = paths.account(storage_options)
    resolve = lambda path, relative: layout.full_path(identity, base, path, relative, account)
    exact = {f.file_id: exact.get(f.file_id, ()) for f in files}
    parts = [part for g in layout.groups(identity, files, exact) for part in read_group(spark, identity, g, resolve, options)]
    out = reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], identity.struct)
    out = out if where is None else out.where(where)
    return out if limit is None else out.limit(limit)


def _reader(spark: SparkSession, schema: T.StructType | None, options: dict[str, str]):
    reader = spark.read.options(**options).option("recursiveFileLookup", "true")
    return reader.schema(schema) if schema is not None else reader


def _maps_as_lists(spark: SparkSession, group: Group, files: list[str], options: dict[str, str]) -> list[bool]:
    """By file, whether maps lie as lists of entries. One job reads all footers; only where they differ each is asked."""
    maps = [c.name for c in group.file_columns if contains(c, "map")]
    if not maps:
        return [False] * len(files)

    def lists(paths: list[str]) -> set[bool]:
        found = {f.name: f.dataType.simpleString() for f in _reader(spark, None, options).option("mergeSchema", "true").parquet(*paths).schema}
        return {"map<" not in found.get(n, "") for n in maps}

    try:
        found = lists(files)
        if len(found) == 1:
            return [found.pop()] * len(files)
    except Exception as e:  # forms that do not merge, or a column that Spark cannot infer
        log.info("the files of a group differ: %s", e)
    out = []
    for f in files:
        try:
            out.append(lists([f]) == {True})
        except Exception as e:
            log.info("no schema can be inferred from %s: %s", f, e)
            out.append(False)
    return out


def read_group(spark: SparkSession, identity: Identity, group: Group, resolve: Callable[[str, bool], str], options: dict[str, str]) -> list[DataFrame]:
    """Parquet scans, deletes and row snapshots applied, in the table's columns.

    One scan, but where maps lie in either of two forms, one for each form met, and where many rows are
    deleted, one for each run of files whose deleted places can be broadcast.
    """
    by_form: dict[bool, list] = {}
    for f, form in zip(group.files, _maps_as_lists(spark, group, [resolve(f.path, f.relative) for f in group.files], options)):
        by_form.setdefault(form, []).append(f)
    return [
        _read_alike(spark, identity, replace(group, files=tuple(part)), form, resolve, options)
        for form, files in by_form.items()
        for part in (parts_to_broadcast(files) if group.deletes else [files])
    ]


def _read_alike(spark: SparkSession, identity: Identity, group: Group, maps_as_lists: bool, resolve: Callable[[str, bool], str], options: dict[str, str]) -> DataFrame:
    files = [resolve(f.path, f.relative) for f in group.files]
    literal = dict(group.literals)
    fields = [T.StructField(c.name, physical(c, maps_as_lists)) for c in group.file_columns if c.column_id not in literal]
    if group.partial:
        fields.append(T.StructField(layout.ROW_SNAPSHOT, T.LongType()))
    rows = _reader(spark, T.StructType(fields), options).parquet(*files)
    if group.deletes:
        rows = without_deleted(rows, group, resolve, options)
    if group.partial:
        rows = rows.where(F.col(layout.ROW_SNAPSHOT) <= identity.snapshot)
    by_id = {c.column_id: c for c in group.file_columns}
    columns = []
    for c in identity.columns:
        if c.column_id in literal:
            column = _literal(literal[c.column_id], spark_type(c))
        elif c.column_id in by_id:
            source = by_id[c.column_id]
            column = convert(F.col(f"`{source.name.replace('`', '``')}`"), source, c, maps_as_lists)
        else:
            column = null_of(c)
        columns.append(column.alias(c.name))
    rows = rows.select(*columns)
    if group.within:
        column, low, high = group.within
        node = next(c for c in identity.columns if c.column_id == column)
        value, bound = F.col(f"`{node.name.replace('`', '``')}`"), lambda text: _literal(text, spark_type(node))
        # true of all rows here: with it a later condition on another value leaves the scan out
        rows = rows.where((value >= bound(low)) & (value <= bound(high)))
    return rows


def _literal(text: str, kind: T.DataType) -> Column:
    if isinstance(kind, T.BooleanType):
        text = {"0": "false", "1": "true"}.get(text, text)
    return F.lit(text).cast(kind)
