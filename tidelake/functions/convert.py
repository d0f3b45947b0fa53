"""From a file's column to the table's: casts, rebuilt structs, and types Parquet stores otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.sources.types import Node, normal, spark_type


def uuid_text(column: Column) -> Column:
    """16 bytes as 8-4-4-4-12 hexadecimal digits; files may hold the digits themselves."""
    digits = F.regexp_replace(F.lower(F.hex(column)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.when(F.octet_length(column) == 16, digits).otherwise(column.cast("string"))


def from_nanoseconds(column: Column) -> Column:
    """Nanoseconds since the epoch as a timestamp without zone; digits below a microsecond are lost."""
    micros = F.floor(column / F.lit(1000).cast("decimal(20,0)")).cast("decimal(20,0)")
    seconds = (micros / F.lit(1_000_000)).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)


def null_of(node: Node) -> Column:
    if node.default is not None:
        return F.lit(node.default).cast(spark_type(node))
    return F.lit(None).cast(spark_type(node))


def convert(column: Column, file: Node, table: Node, maps_as_lists: bool = False) -> Column:
    """A column written as `file`, in the shape of `table`; fields are matched by id, whatever their names."""
    kind, wanted = normal(file.type), normal(table.type)
    if kind not in ("list", "struct", "map"):
        if kind == "uuid":
            column = uuid_text(column)
        if kind == "timestamp_ns":
            column = from_nanoseconds(column)
        have, want = spark_type(file), spark_type(table)
        return column if have == want else column.cast(want)
    again = lambda c, a, b: convert(c, a, b, maps_as_lists)
    if kind == "map" and maps_as_lists:
        key, value = (next(c for c in file.children if c.name == n) for n in ("key", "value"))
        tkey, tvalue = (next(c for c in table.children if c.name == n) for n in ("key", "value"))
        return F.map_from_entries(F.transform(column, lambda e: F.struct(again(e.getField("key"), key, tkey).alias("key"), again(e.getField("value"), value, tvalue).alias("value"))))
    if wanted == kind and unchanged(file, table):
        return column
    if kind == "list":
        return F.transform(column, lambda e: again(e, file.children[0], table.children[0]))
    if kind == "map":
        key, value = (next(c for c in file.children if c.name == n) for n in ("key", "value"))
        tkey, tvalue = (next(c for c in table.children if c.name == n) for n in ("key", "value"))
        return F.transform_values(F.transform_keys(column, lambda k, _: again(k, key, tkey)), lambda _, v: again(v, value, tvalue))
    by = {c.column_id: c for c in file.children}
    fields = [(again(column.getField(by[c.column_id].name), by[c.column_id], c) if c.column_id in by else null_of(c)).alias(c.name) for c in table.children]
    return F.when(column.isNull(), F.lit(None).cast(spark_type(table))).otherwise(F.struct(*fields))


def unchanged(file: Node, table: Node) -> bool:
    """Whether the file's value can be handed on as it is."""
    if normal(file.type) in ("list", "struct", "map"):
        pairs = list(zip(file.children, table.children))
        if normal(file.type) == "struct":
            same = [(a.column_id, a.name) for a in file.children] == [(b.column_id, b.name) for b in table.children]
        else:
            same = len(file.children) == len(table.children)
        return normal(file.type) == normal(table.type) and same and all(unchanged(a, b) for a, b in pairs)
    kind = normal(file.type)
    return kind not in ("timestamp_ns", "uuid") and spark_type(file) == spark_type(table)


def physical(node: Node, maps_as_lists: bool = False) -> T.DataType:
    """What to declare to the Parquet reader for a file's column."""
    if normal(node.type) == "uuid":
        return T.BinaryType()  # of 16 bytes or of digits
    of = lambda c: physical(c, maps_as_lists)
    kind = normal(node.type)
    if kind == "list":
        return T.ArrayType(of(node.children[0]))
    if kind == "struct":
        return T.StructType([T.StructField(c.name, of(c)) for c in node.children])
    if kind == "map":
        key, value = (of(next(c for c in node.children if c.name == n)) for n in ("key", "value"))
        if maps_as_lists:
            return T.ArrayType(T.StructType([T.StructField("key", key), T.StructField("value", value)]))
        return T.MapType(key, value)
    return spark_type(node, physical=True)
