"""Hand-built lakes for tests, queries and benchmarks: a catalog in SQLite or DuckDB, data in Parquet.

This follows the format's description and is independent of any writer. Data are written by Spark into the
folder that the cluster shares; the catalog is a file on the driver, which alone reads it.
"""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid
from dataclasses import dataclass, field
from typing import Any
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.sources.catalog import P

#: Relations and their columns. Fixed values of the format.
RELATIONS = {
    "snapshot": "snapshot_id BIGINT, snapshot_time TIMESTAMP, schema_version BIGINT, next_catalog_id BIGINT, next_file_id BIGINT",
    "schema": "schema_id BIGINT, schema_uuid VARCHAR, begin_snapshot BIGINT, end_snapshot BIGINT, schema_name VARCHAR, path VARCHAR, path_is_relative BOOLEAN",
    "table": "table_id BIGINT, table_uuid VARCHAR, begin_snapshot BIGINT, end_snapshot BIGINT, schema_id BIGINT, table_name VARCHAR, path VARCHAR, path_is_relative BOOLEAN",
    "column": "column_id BIGINT, begin_snapshot BIGINT, end_snapshot BIGINT, table_id BIGINT, column_order BIGINT, column_name VARCHAR, column_type VARCHAR, initial_default VARCHAR, default_value VARCHAR, nulls_allowed BOOLEAN, parent_column BIGINT",
    "data_file": "data_file_id BIGINT, table_id BIGINT, begin_snapshot BIGINT, end_snapshot BIGINT, file_order BIGINT, path VARCHAR, path_is_relative BOOLEAN, file_format VARCHAR, record_count BIGINT, file_size_bytes BIGINT, footer_size BIGINT, row_id_start BIGINT, partition_id BIGINT, encryption_key VARCHAR, mapping_id BIGINT, partial_max BIGINT",
    "delete_file": "delete_file_id BIGINT, table_id BIGINT, begin_snapshot BIGINT, end_snapshot BIGINT, data_file_id BIGINT, path VARCHAR, path_is_relative BOOLEAN, format VARCHAR, delete_count BIGINT, file_size_bytes BIGINT, footer_size BIGINT, encryption_key VARCHAR, partial_max BIGINT",
    "file_column_stats": "data_file_id BIGINT, table_id BIGINT, column_id BIGINT, column_size_bytes BIGINT, value_count BIGINT, null_count BIGINT, min_value VARCHAR, max_value VARCHAR, contains_nan BIGINT, extra_stats VARCHAR",
    "partition_info": "partition_id BIGINT, table_id BIGINT, begin_snapshot BIGINT, end_snapshot BIGINT",
    "partition_column": "partition_id BIGINT, partition_key_index BIGINT, column_id BIGINT, transform VARCHAR",
    "file_partition_value": "data_file_id BIGINT, table_id BIGINT, partition_key_index BIGINT, partition_value VARCHAR",
    "metadata": "\"key\" VARCHAR, value VARCHAR, scope VARCHAR, scope_id BIGINT",
}


def stat_text(value: Any) -> str | None:
    if value is None:
        return None
    if isinstance(value, bool):
        return "1" if value else "0"
    if isinstance(value, dt.datetime):
        return value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return str(value)


@dataclass
class Lake:
    """A lake under construction; ids are handed out in order."""

    spark: SparkSession
    backend: str = "sqlite"
    folder: str = ""
    path: str = ""
    snapshot: int = 0
    _ids: int = 0
    _files: dict[int, tuple[str, DataFrame]] = field(default_factory=dict)

    def __post_init__(self):
        self.folder = self.folder or f"{shared(self.spark)}/tidelake-lakes/{uuid.uuid4().hex}"
        self.path = f"{tempfile.mkdtemp(prefix='tidelake-')}/catalog.{self.backend}"
        for name, columns in RELATIONS.items():
            self.sql(f'CREATE TABLE "{P}{name}" ({columns})')
        self.insert("metadata", key="data_path", value=self.folder + "/")
        self.take_snapshot()
        self.add_schema("main")

    @property
    def catalog(self) -> str:
        return f"ducklake:{self.backend}:{self.path}"

    def sql(self, text: str, *values: Any) -> list[tuple]:
        if self.backend == "sqlite":
            import sqlite3

            connection = sqlite3.connect(self.path)
        else:
            import duckdb

            connection = duckdb.connect(self.path)
        cursor = connection.cursor()
        cursor.execute(text, [str(v) if isinstance(v, dt.datetime) else v for v in values])
        rows = cursor.fetchall() if text.lstrip().upper().startswith("SELECT") else []
        connection.commit()
        cursor.close()
        connection.close()
        return rows

    def insert(self, relation: str, **row: Any) -> None:
        names = ", ".join(f'"{k}"' for k in row)
        self.sql(f'INSERT INTO "{P}{relation}" ({names}) VALUES ({", ".join("?" * len(row))})', *row.values())

    def id(self) -> int:
        self._ids += 1
        return self._ids

    def take_snapshot(self, time: dt.datetime | None = None) -> int:
        self.snapshot += 1
        time = time or dt.datetime(2026, 1, 1) + dt.timedelta(days=self.snapshot - 1)
        self.insert("snapshot", snapshot_id=self.snapshot, snapshot_time=time, schema_version=self.snapshot)
        return self.snapshot

    def add_schema(self, name: str, path: str | None = None, relative: bool = True) -> int:
        i = self.id()
        self.insert("schema", schema_id=i, begin_snapshot=self.snapshot, schema_name=name, path=path, path_is_relative=relative)
        return i

    def add_table(self, name: str, columns: list[tuple], schema: str = "main", path: str | None = None, relative: bool = True) -> int:
        """columns: (name, type) or (name, type, children)."""
        t = self.id()
        s = self.sql(f"SELECT schema_id FROM {P}schema WHERE schema_name = ?", schema)[0][0]
        self.insert("table", table_id=t, begin_snapshot=self.snapshot, schema_id=s, table_name=name, path=path, path_is_relative=relative)
        for c in columns:
            self.add_column(t, *c)
        return t

    def add_column(self, table: int, name: str, kind: str, children: list[tuple] = (), parent: int | None = None, default: str | None = None) -> int:
        order = self.sql(f"SELECT count(*) FROM {P}column WHERE table_id = ?", table)[0][0] + 1
        i = self.id()
        self.insert("column", column_id=i, begin_snapshot=self.snapshot, table_id=table, column_order=order, column_name=name, column_type=kind, initial_default=default, nulls_allowed=True, parent_column=parent)
        for c in children:
            self.add_column(table, *c, parent=i)
        return i

    def column_id(self, table: int, name: str) -> int:
        return self.sql(f"SELECT column_id FROM {P}column WHERE table_id = ? AND column_name = ? AND end_snapshot IS NULL", table, name)[0][0]

    def drop_column(self, table: int, name: str) -> None:
        self.sql(f"UPDATE {P}column SET end_snapshot = ? WHERE table_id = ? AND column_name = ? AND end_snapshot IS NULL", self.snapshot, table, name)

    def change_column(self, table: int, name: str, new_name: str | None = None, kind: str | None = None) -> None:
        """Rename or retype: the id stays, a new version of the row begins."""
        row = self.sql(f"SELECT column_id, column_order, column_type, initial_default, parent_column FROM {P}column WHERE table_id = ? AND column_name = ? AND end_snapshot IS NULL", table, name)[0]
        self.drop_column(table, name)
        self.insert("column", column_id=row[0], begin_snapshot=self.snapshot, table_id=table, column_order=row[1], column_name=new_name or name, column_type=kind or row[2], initial_default=row[3], nulls_allowed=True, parent_column=row[4])

    def add_partition(self, table: int, *fields: tuple[str, str]) -> int:
        """fields: (column, transform). Ends the partitioning in force."""
        self.sql(f"UPDATE {P}partition_info SET end_snapshot = ? WHERE table_id = ? AND end_snapshot IS NULL", self.snapshot, table)
        p = self.id()
        self.insert("partition_info", partition_id=p, table_id=table, begin_snapshot=self.snapshot)
        for k, (name, transform) in enumerate(fields):
            self.insert("partition_column", partition_id=p, partition_key_index=k, column_id=self.column_id(table, name), transform=transform)
        return p

    def write(self, df: DataFrame, place: str = "") -> str:
        """One Parquet file of the rows, in the shared folder; returns its full path."""
        target = f"{self.folder}/{place or uuid.uuid4().hex}"
        df.coalesce(1).write.mode("append").parquet(target)
        found = self.spark.read.option("recursiveFileLookup", "true").schema(df.schema).parquet(target).inputFiles()[0]
        return unquote(found)

    def add_file(
        self, table: int, df: DataFrame, *, stats: list[str] = (), partition: tuple[int, list[str | None]] | None = None,
        path: str | None = None, relative: bool = False, partial_max: int | None = None,
    ) -> int:
        """Register a file of df's rows: written now, or an existing one (path)."""
        i = self.id()
        if path is None:
            path = self.write(df)
        order = self.sql(f"SELECT count(*) FROM {P}data_file WHERE table_id = ?", table)[0][0]
        names = {n: self.column_id(table, n) for n in stats}
        aggregates = [F.count(F.lit(1)).alias("n")]
        for k, n in enumerate(stats):
            floating = isinstance(df.schema[n].dataType, T.FloatType | T.DoubleType)
            aggregates += [F.min(n).alias(f"a{k}"), F.max(n).alias(f"b{k}"), F.count(n).alias(f"c{k}")]
            aggregates.append((F.max(F.isnan(n).cast("int")) if floating else F.lit(0)).alias(f"d{k}"))
        row = df.agg(*aggregates).first()
        self.insert(
            "data_file", data_file_id=i, table_id=table, begin_snapshot=self.snapshot, file_order=order, path=path, path_is_relative=relative,
            file_format="parquet", record_count=row["n"], partition_id=partition[0] if partition else None, partial_max=partial_max,
        )
        for k, n in enumerate(stats):
            self.insert(
                "file_column_stats", data_file_id=i, table_id=table, column_id=names[n], value_count=row["n"], null_count=row["n"] - row[f"c{k}"],
                min_value=stat_text(row[f"a{k}"]), max_value=stat_text(row[f"b{k}"]), contains_nan=int(row[f"d{k}"] or 0),
            )
        for k, v in enumerate(partition[1] if partition else ()):
            self.insert("file_partition_value", data_file_id=i, table_id=table, partition_key_index=k, partition_value=v)
        return i

    def file_path(self, file: int) -> str:
        return self.sql(f"SELECT path FROM {P}data_file WHERE data_file_id = ?", file)[0][0]

    def expire(self, relation: str, file: int) -> None:
        self.sql(f"UPDATE {P}{relation} SET end_snapshot = ? WHERE {relation}_id = ?", self.snapshot, file)

    def add_deletes(self, table: int, file: int, positions: DataFrame | list[int]) -> int:
        """positions: numbers, or a DataFrame with a column pos."""
        i = self.id()
        if isinstance(positions, list):
            positions = self.spark.createDataFrame([(p,) for p in positions], "pos long")
        n = positions.count()
        path = self.write(positions.select(F.lit(self.file_path(file)).alias("file_path"), F.col("pos").cast("long")))
        self.insert("delete_file", delete_file_id=i, table_id=table, begin_snapshot=self.snapshot, data_file_id=file, path=path, path_is_relative=False, format="parquet", delete_count=n)
        return i

    def positions(self, file: int, where: Any, schema: T.StructType) -> DataFrame:
        """Row numbers of a file's rows that meet a condition."""
        rows = self.spark.read.option("recursiveFileLookup", "true").schema(schema).parquet(self.file_path(file))
        return rows.where(where).select(F.col("_metadata.row_index").alias("pos"))


def shared(spark: SparkSession) -> str:
    """The folder that the cluster shares (spark.checkpoint.dir); on a local master, without one, a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors see")
        found = "file://" + tempfile.mkdtemp(prefix="tidelake-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Spark types by catalog names, to declare tables from DataFrames.
_NAMES = {"tinyint": "int8", "smallint": "int16", "int": "int32", "bigint": "int64", "float": "float32", "double": "float64", "string": "varchar", "boolean": "boolean", "date": "date", "timestamp_ntz": "timestamp", "timestamp": "timestamptz", "binary": "blob"}


def columns_of(schema: T.StructType) -> list[tuple]:
    """(name, type, children) of a schema's columns, to declare a table."""

    def one(name: str, t: T.DataType) -> tuple:
        if isinstance(t, T.ArrayType):
            return (name, "list", [one("element", t.elementType)])
        if isinstance(t, T.StructType):
            return (name, "struct", [one(f.name, f.dataType) for f in t])
        if isinstance(t, T.MapType):
            return (name, "map", [one("key", t.keyType), one("value", t.valueType)])
        if isinstance(t, T.DecimalType):
            return (name, f"decimal({t.precision},{t.scale})")
        return (name, _NAMES[t.simpleString()])

    return [one(f.name, f.dataType) for f in schema]
