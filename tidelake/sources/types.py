"""Catalog types as Spark types, and the tree of a table's columns."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

#: Catalog type names by Spark types. Fixed values; unsigned types take the next wider signed one.
SCALARS: dict[str, T.DataType] = {
    "boolean": T.BooleanType(), "bool": T.BooleanType(),
    "int8": T.ByteType(), "tinyint": T.ByteType(),
    "int16": T.ShortType(), "smallint": T.ShortType(),
    "int32": T.IntegerType(), "integer": T.IntegerType(), "int": T.IntegerType(),
    "int64": T.LongType(), "bigint": T.LongType(),
    "uint8": T.ShortType(), "utinyint": T.ShortType(),
    "uint16": T.IntegerType(), "usmallint": T.IntegerType(),
    "uint32": T.LongType(), "uinteger": T.LongType(),
    "uint64": T.DecimalType(20, 0), "ubigint": T.DecimalType(20, 0),
    "float32": T.FloatType(), "float": T.FloatType(), "real": T.FloatType(),
    "float64": T.DoubleType(), "double": T.DoubleType(),
    "varchar": T.StringType(), "string": T.StringType(), "text": T.StringType(), "json": T.StringType(), "uuid": T.StringType(),
    "blob": T.BinaryType(), "binary": T.BinaryType(), "bytea": T.BinaryType(),
    "date": T.DateType(),
    "time": T.LongType(), "timetz": T.LongType(),
    "timestamp": T.TimestampNTZType(), "timestamp_s": T.TimestampNTZType(), "timestamp_ms": T.TimestampNTZType(), "timestamp_ns": T.TimestampNTZType(),
    "timestamptz": T.TimestampType(),
}
#: Types whose Parquet form is declared otherwise than the result: nanoseconds are read as a number.
PHYSICAL: dict[str, T.DataType] = {"timestamp_ns": T.LongType()}
NESTED = ("list", "struct", "map")
_DECIMAL = re.compile(r"(?:decimal|numeric)\s*\(\s*(\d+)\s*,\s*(\d+)\s*\)")


@dataclass(frozen=True)
class Node:
    """A column at some snapshot, with its children in order."""

    column_id: int
    name: str
    type: str
    children: tuple[Node, ...] = field(default=())
    default: str | None = None


def normal(name: str) -> str:
    return name.strip().lower()


def is_nested(name: str) -> bool:
    return re.match(r"(list|struct|map)\b", normal(name)) is not None


def scalar(name: str, column: str = "?") -> T.DataType:
    n = normal(name)
    if n in SCALARS:
        return SCALARS[n]
    if m := _DECIMAL.fullmatch(n):
        return T.DecimalType(int(m[1]), int(m[2]))
    raise ValueError(f"column {column!r}: unrecognised catalog type {name!r}")


def check(node: Node) -> None:
    """Raise ValueError unless the node's shape is right for its type."""
    kind = normal(node.type)
    if not is_nested(kind):
        scalar(kind, node.name)
        return
    if kind not in NESTED:
        raise ValueError(f"column {node.name!r}: unrecognised nested type {node.type!r}")
    names = sorted(c.name for c in node.children)
    if kind == "list" and len(names) != 1:
        raise ValueError(f"column {node.name!r}: a list has exactly one child, not {len(names)}")
    if kind == "struct" and not names:
        raise ValueError(f"column {node.name!r}: a struct has at least one child")
    if kind == "map" and names != ["key", "value"]:
        raise ValueError(f"column {node.name!r}: a map has the children key and value, not {names}")
    for c in node.children:
        check(c)


def spark_type(node: Node, physical: bool = False, maps_as_lists: bool = False) -> T.DataType:
    """The Spark type of a column: as a result, or (physical) as it is declared to the Parquet reader."""
    kind = normal(node.type)
    if kind not in NESTED:
        return PHYSICAL.get(kind) or scalar(kind, node.name) if physical else scalar(kind, node.name)
    of = lambda c: spark_type(c, physical, maps_as_lists)
    if kind == "list":
        return T.ArrayType(of(node.children[0]))
    if kind == "struct":
        return T.StructType([T.StructField(c.name, of(c)) for c in node.children])
    by = {c.name: c for c in node.children}
    if physical and maps_as_lists:
        return T.ArrayType(T.StructType([T.StructField("key", of(by["key"])), T.StructField("value", of(by["value"]))]))
    return T.MapType(of(by["key"]), of(by["value"]))


def contains(node: Node, *kinds: str) -> bool:
    return normal(node.type) in kinds or any(contains(c, *kinds) for c in node.children)
