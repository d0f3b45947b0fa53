"""From a file's column to the table's, for Arrow arrays: what `convert` does for Spark's columns."""

from __future__ import annotations

from typing import Any

import pyarrow as pa
import pyarrow.compute as pc

from tidelake.sources.types import Node, normal


def _child(node: Node, name: str) -> Node:
    return next(c for c in node.children if c.name == name)


def _nulls(array: pa.Array) -> pa.Array:
    return pc.is_null(array)


def default_of(node: Node, n: int, kind: pa.DataType) -> pa.Array:
    """A column that older files lack: its default, or null."""
    return pa.nulls(n, kind) if node.default is None else pa.array([node.default] * n, pa.string()).cast(kind)


def convert(array: pa.Array, file: Node, table: Node, kind: pa.DataType) -> pa.Array:
    """An array written as `file`, in the shape of `table` and of Arrow type `kind`; fields are matched by id."""
    have, want = normal(file.type), normal(table.type)
    if isinstance(array, pa.ExtensionArray):
        array = array.storage
    if have == "uuid":
        return pa.array([None if x is None else _uuid(x) for x in array.to_pylist()], pa.string()).cast(kind)
    if have == "timestamp_ns":
        nanos = array.cast(pa.int64()) if not pa.types.is_timestamp(array.type) else array.cast(pa.timestamp("ns")).view(pa.int64())
        return pc.floor(pc.divide(pc.subtract(nanos, _rest(nanos)), 1000)).cast(pa.int64()).cast(pa.timestamp("us")).cast(kind)
    if have not in ("list", "struct", "map") or have != want:
        return array.cast(kind)
    if have == "list":
        values = convert(array.flatten(), file.children[0], table.children[0], kind.value_type)
        return _listed(array, values, kind)
    if have == "map":
        entries = array.flatten() if not pa.types.is_map(array.type) else None
        keys, items = (entries.field("key"), entries.field("value")) if entries is not None else _entries(array)
        keys = convert(keys, _child(file, "key"), _child(table, "key"), kind.key_type)
        items = convert(items, _child(file, "value"), _child(table, "value"), kind.item_type)
        return pa.MapArray.from_arrays(_offsets(array), keys, items, kind)
    by = {c.column_id: c for c in file.children}
    names = [array.type.field(i).name for i in range(array.type.num_fields)]
    fields = []
    for k, c in enumerate(table.children):
        wanted = kind.field(k).type
        if c.column_id in by and by[c.column_id].name in names:
            fields.append(convert(array.field(by[c.column_id].name), by[c.column_id], c, wanted))
        else:
            fields.append(default_of(c, len(array), wanted))
    return pa.StructArray.from_arrays(fields, fields=[kind.field(k) for k in range(kind.num_fields)], mask=_nulls(array))


def _uuid(value: Any) -> str:
    import uuid

    if isinstance(value, uuid.UUID):
        return str(value)
    return str(uuid.UUID(bytes=value)) if isinstance(value, bytes) and len(value) == 16 else value.decode() if isinstance(value, bytes) else value


def _rest(nanos: pa.Array) -> pa.Array:
    """What of each value lies below a microsecond, counted upwards, so that the difference is the next lower one."""
    import numpy as np

    values = nanos.fill_null(0).to_numpy(zero_copy_only=False)
    return pa.array(np.mod(values, 1000))


def _offsets(array: pa.Array) -> pa.Array:
    """Offsets into the flattened values; a null entry has none, and keeps its null."""
    import numpy as np

    lengths = pc.list_value_length(array) if not pa.types.is_map(array.type) else pc.list_value_length(array.cast(pa.list_(pa.struct([("key", array.type.key_type), ("value", array.type.item_type)]))))
    ends = np.cumsum(lengths.fill_null(0).to_numpy(zero_copy_only=False))
    offsets = pa.array(np.append(0, ends), pa.int32())
    if not array.null_count:
        return offsets
    return pc.if_else(pa.concat_arrays([pc.is_valid(array), pa.array([True])]), offsets, pa.scalar(None, pa.int32()))


def _listed(array: pa.Array, values: pa.Array, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(_offsets(array), values).cast(kind)


def _entries(array: pa.MapArray) -> tuple[pa.Array, pa.Array]:
    """Keys and values of all entries of a map array that is not a slice, without those under nulls."""
    entries = array.cast(pa.list_(pa.struct([("key", array.type.key_type), ("value", array.type.item_type)]))).flatten()
    return entries.field("key"), entries.field("value")
