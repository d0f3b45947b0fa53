"""Reads of the metadata catalog. One query per relation; versions are resolved in memory."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace
from typing import Any

from tidelake.sources.connect import resolve
from tidelake.sources.types import Node

#: Names of the catalog's relations. Fixed values of the format.
P = "ducklake_"


@dataclass(frozen=True)
class Schema:
    schema_id: int
    path: str | None
    relative: bool


@dataclass(frozen=True)
class Table:
    table_id: int
    path: str | None
    relative: bool


@dataclass(frozen=True)
class ColumnRow:
    column_id: int
    begin: int
    end: int | None
    order: int
    name: str
    type: str
    parent: int | None
    default: str | None


@dataclass(frozen=True)
class DeleteFile:
    path: str
    relative: bool
    count: int | None


@dataclass(frozen=True)
class DataFile:
    file_id: int
    path: str
    relative: bool
    records: int | None
    begin: int
    partial_max: int | None
    partition_id: int | None
    deletes: tuple[DeleteFile, ...] = ()


@dataclass(frozen=True)
class Stats:
    nulls: int | None
    low: str | None
    high: str | None
    nan: bool


@dataclass(frozen=True)
class PartitionField:
    key: int
    column_id: int
    transform: str


def visible(begin: int, end: int | None, snapshot: int) -> bool:
    """Whether a catalog row's range of snapshots holds `snapshot`."""
    return begin <= snapshot and (end is None or snapshot < end)


def utc(value: Any) -> dt.datetime:
    """A time from the catalog or a caller, as UTC without zone; times without zone are UTC."""
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value.strip())
    elif isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    return value.astimezone(dt.UTC).replace(tzinfo=None) if value.tzinfo else value


#: The names of a relation's columns, by kind of database.
_COLUMNS_OF = {
    "sqlite": "SELECT name FROM pragma_table_info(?)",
    "duckdb": "SELECT column_name FROM information_schema.columns WHERE table_name = ?",
    "postgres": "SELECT column_name FROM information_schema.columns WHERE table_schema = ANY(current_schemas(false)) AND table_name = ?",
    "mysql": "SELECT column_name FROM information_schema.columns WHERE table_schema = database() AND table_name = ?",
}


class Catalog:
    """A short-lived connection to a metadata catalog; use it in a `with` statement, again if need be."""

    def __init__(self, source: Any):
        self.spec = resolve(source)
        self._connection = None

    def __enter__(self) -> Catalog:
        self._connection = self.spec.connect()
        self.spec = self.spec.of(self._connection)
        return self

    def __exit__(self, *_: object) -> None:
        connection, self._connection = self._connection, None
        if self.spec.owned:
            connection.close()

    def rows(self, sql: str, *values: Any) -> list[tuple]:
        if self._connection is None:
            raise RuntimeError("the catalog is not open: use it in a with statement")
        cursor = self._connection.cursor()
        try:
            cursor.execute(sql.replace("?", self.spec.mark), list(values) if values else [])
            return [tuple(r) for r in cursor.fetchall()]
        finally:
            cursor.close()

    def has(self, relation: str, column: str | None = None) -> bool:
        """Whether a relation, and a column of it, exists, by the database's own list; any failure is raised."""
        found = {str(r[0]).lower() for r in self.rows(_COLUMNS_OF.get(self.spec.kind, _COLUMNS_OF["duckdb"]), relation)}
        return column.lower() in found if column else bool(found)

    def q(self, name: str) -> str:
        mark = self.spec.quote
        return mark + name.replace(mark, mark * 2) + mark

    _VISIBLE = "begin_snapshot <= ? AND (end_snapshot IS NULL OR ? < end_snapshot)"
    _OF_VISIBLE = f"data_file_id IN (SELECT data_file_id FROM {P}data_file WHERE table_id = ? AND {_VISIBLE})"

    def snapshot(self, snapshot_id: int | None = None, as_of: Any = None) -> int:
        """The latest snapshot, the one given, or the latest at or before a time."""
        if snapshot_id is not None and as_of is not None:
            raise ValueError("snapshot_id and as_of are mutually exclusive")
        if snapshot_id is not None:
            if not self.rows(f"SELECT snapshot_id FROM {P}snapshot WHERE snapshot_id = ?", snapshot_id):
                raise LookupError(f"no snapshot with snapshot_id={snapshot_id}")
            return snapshot_id
        if as_of is None:
            found = self.rows(f"SELECT max(snapshot_id) FROM {P}snapshot")[0][0]
            if found is None:
                raise LookupError("the catalog has no snapshots")
            return found
        limit = utc(as_of)
        found = max((i for i, t in self.rows(f"SELECT snapshot_id, snapshot_time FROM {P}snapshot") if utc(t) <= limit), default=None)
        if found is None:
            raise LookupError(f"no snapshot at or before {as_of}")
        return found

    def schema(self, name: str, snapshot: int) -> Schema:
        rows = self.rows(f"SELECT schema_id, path, path_is_relative FROM {P}schema WHERE schema_name = ? AND {self._VISIBLE}", name, snapshot, snapshot)
        if not rows:
            raise LookupError(f"schema {name!r} does not exist at snapshot {snapshot}")
        return Schema(rows[0][0], rows[0][1], bool(rows[0][2]))

    def table(self, schema: Schema, name: str, snapshot: int) -> Table:
        rows = self.rows(f"SELECT table_id, path, path_is_relative FROM {P}table WHERE schema_id = ? AND table_name = ? AND {self._VISIBLE}", schema.schema_id, name, snapshot, snapshot)
        if not rows:
            raise LookupError(f"table {name!r} does not exist at snapshot {snapshot}")
        return Table(rows[0][0], rows[0][1], bool(rows[0][2]))

    def history(self, table: Table) -> list[ColumnRow]:
        """Every column the table ever had, nested ones too, in order."""
        default = "initial_default" if self.has(f"{P}column", "initial_default") else "NULL"  # of later versions of the format
        sql = f"SELECT column_id, begin_snapshot, end_snapshot, column_order, column_name, column_type, parent_column, {default} FROM {P}column WHERE table_id = ? ORDER BY column_order, column_id"
        return [ColumnRow(*r) for r in self.rows(sql, table.table_id)]

    def data_path(self) -> str | None:
        rows = self.rows(f"SELECT value, scope FROM {P}metadata WHERE {self.q('key')} = ?", "data_path")
        return next((v for v, scope in rows if scope in (None, "", "global")), None)

    def has_inlined_rows(self, table: Table) -> bool:
        registry = f"{P}inlined_data_tables"
        if not self.has(registry):
            return False
        names = [r[0] for r in self.rows(f"SELECT table_name FROM {registry} WHERE table_id = ?", table.table_id)]
        return any(self.has(n) and self.rows(f"SELECT 1 FROM {self.q(n)} LIMIT 1") for n in names)

    def data_files(self, table: Table, snapshot: int) -> list[DataFile]:
        """Files visible at the snapshot, in order, each with the delete files visible there."""
        rows = self.rows(
            f"SELECT data_file_id, path, path_is_relative, record_count, begin_snapshot, partial_max, partition_id, file_format, encryption_key, mapping_id"
            f" FROM {P}data_file WHERE table_id = ? AND {self._VISIBLE} ORDER BY file_order, data_file_id",
            table.table_id, snapshot, snapshot,
        )
        for r in rows:
            _refuse(r[7], r[8], f"data file {r[1]!r}")
            if r[9] is not None:
                raise NotImplementedError(f"data file {r[1]!r} has a name mapping")
        files = {r[0]: DataFile(r[0], r[1], bool(r[2]), r[3], r[4], r[5], r[6]) for r in rows}
        found: dict[int, list[DeleteFile]] = {}
        for data_file, path, relative, count, kind, key, partial in self.rows(
            f"SELECT data_file_id, path, path_is_relative, delete_count, format, encryption_key, partial_max FROM {P}delete_file WHERE table_id = ? AND {self._VISIBLE} ORDER BY path",
            table.table_id, snapshot, snapshot,
        ):
            _refuse(kind, key, f"delete file {path!r}")
            if partial is not None and snapshot < partial:
                raise NotImplementedError(f"delete file {path!r} holds deletes of later snapshots")
            found.setdefault(data_file, []).append(DeleteFile(path, bool(relative), count))
        return [replace(f, deletes=tuple(found.get(i, ()))) for i, f in files.items()]

    def stats(self, table: Table, columns: list[int], snapshot: int) -> dict[tuple[int, int], Stats]:
        """Statistics by (file, column), of the files visible at the snapshot."""
        if not columns:
            return {}
        marks = ", ".join("?" * len(columns))
        sql = f"SELECT data_file_id, column_id, null_count, min_value, max_value, contains_nan FROM {P}file_column_stats WHERE table_id = ? AND column_id IN ({marks}) AND {self._OF_VISIBLE}"
        return {(f, c): Stats(n, low, high, nan not in (None, 0, False, "0", "false")) for f, c, n, low, high, nan in self.rows(sql, table.table_id, *columns, table.table_id, snapshot, snapshot)}

    def partition_spec(self, table: Table, snapshot: int) -> tuple[int | None, list[PartitionField]]:
        """The partitioning in force at the snapshot; columns are those of this table."""
        info = self.rows(f"SELECT partition_id FROM {P}partition_info WHERE table_id = ? AND {self._VISIBLE}", table.table_id, snapshot, snapshot)
        if not info:
            return None, []
        rows = self.rows(f"SELECT partition_key_index, column_id, transform FROM {P}partition_column WHERE partition_id = ? ORDER BY partition_key_index", info[0][0])
        return info[0][0], [PartitionField(*r) for r in rows]

    def partition_values(self, table: Table, snapshot: int) -> dict[tuple[int, int], str | None]:
        """Values by (file, key index), of the files visible at the snapshot."""
        rows = self.rows(f"SELECT data_file_id, partition_key_index, partition_value FROM {P}file_partition_value WHERE table_id = ? AND {self._OF_VISIBLE}", table.table_id, table.table_id, snapshot, snapshot)
        return {(f, k): v for f, k, v in rows}


def _refuse(kind: str | None, key: str | None, what: str) -> None:
    if kind is not None and kind.lower() != "parquet":
        raise NotImplementedError(f"{what} is not Parquet but {kind!r}")
    if key is not None:
        raise NotImplementedError(f"{what} is encrypted")


def columns_at(history: list[ColumnRow], snapshot: int) -> list[Node]:
    """The table's columns at a snapshot as trees, in order."""
    rows = [r for r in history if visible(r.begin, r.end, snapshot)]

    def below(parent: int | None) -> tuple[Node, ...]:
        return tuple(Node(r.column_id, r.name, r.type, below(r.column_id), r.default) for r in sorted((r for r in rows if r.parent == parent), key=lambda r: (r.order, r.column_id)))

    return list(below(None))
