"""``spark.read.format("tidelake")``: the lazy surface.

Options: catalog, table, and as wanted schema, snapshot_id, as_of, data_path, prune, and storage options by
their names with ``storage.`` before them. The snapshot is resolved once, when the frame is loaded. Rows come
through Arrow, so `tidelake.scan` is the faster way; Spark does not tell such a source which columns are
wanted, so all are read. A registered path may be a folder of files, each of which is then read by a task of
its own; paths must be such as Arrow opens. With ``prune`` set to true, filters that Spark pushes rule out files
(``spark.sql.python.filterPushdown.enabled`` is needed too); Spark keeps a source's pushed filters for
all uses of one loaded frame, so set it only where a frame is used with one condition.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from tidelake.plans import layout
from tidelake.sources import paths
from tidelake.sources.catalog import Catalog
from tidelake.sources.types import Node


class FilePart(InputPartition):
    """A data file; file_columns: the file's columns; up_to: the last visible row snapshot."""

    def __init__(self, path: str, deletes: tuple[str, ...], file_columns: tuple[Node, ...], up_to: int | None):
        super().__init__(path)
        self.path, self.deletes, self.file_columns, self.up_to = path, deletes, file_columns, up_to


class LakeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidelake"

    @property
    def storage(self) -> dict[str, str]:
        return {k[len("storage.") :]: v for k, v in self.options.items() if k.lower().startswith("storage.")}

    def _identity(self) -> tuple[layout.Identity, str | None]:
        """Resolved at the first call and kept: Spark hands this object on from the schema to the reader."""
        if "_pinned" not in self.__dict__:
            o = self.options
            snapshot = int(o["snapshot_id"]) if "snapshot_id" in o else None
            with Catalog(o["catalog"]) as c:
                identity = layout.identify(c, o["table"], o.get("schema"), snapshot, o.get("as_of"))
                self.__dict__["_pinned"] = identity, o.get("data_path") or c.data_path()
        return self.__dict__["_pinned"]

    def schema(self) -> StructType:
        return self._identity()[0].struct

    def reader(self, schema: StructType) -> DataSourceReader:
        identity, base = self._identity()
        kind = PruningReader if self.options.get("prune", "").lower() == "true" else LakeReader
        return kind(self.options["catalog"], identity, base, schema, self.storage)


_NAMES = {"EqualTo": "eq", "LessThan": "lt", "LessThanOrEqual": "le", "GreaterThan": "gt", "GreaterThanOrEqual": "ge", "In": "in", "IsNull": "null", "IsNotNull": "notnull", "StringStartsWith": "starts"}


def _clause(f: Any) -> tuple | None:
    kind = type(f).__name__
    if kind == "Not":
        return ("not", _clause(f.child))
    if kind not in _NAMES or len(f.attribute) != 1:
        return None
    column = f.attribute[0]
    return (_NAMES[kind], column) if kind in ("IsNull", "IsNotNull") else (_NAMES[kind], column, list(f.value) if kind == "In" else f.value)


class LakeReader(DataSourceReader):
    def __init__(self, catalog: str, identity: layout.Identity, base: str | None, schema: StructType, storage: dict[str, str]):
        self.catalog, self.identity, self.base, self.table_schema, self.storage = catalog, identity, base, schema, storage
        self.clauses: list[tuple | None] = []

    def partitions(self) -> list[InputPartition]:
        with Catalog(self.catalog) as c:
            files, _ = layout.candidates(c, self.identity, self.clauses)
        full = lambda x: layout.full_path(self.identity, self.base, x.path, x.relative, paths.account(self.storage))
        below = _files([full(f) for f in files], self.storage)
        parts = []
        for g in layout.groups(self.identity, files, {}):
            for f in g.files:
                found = below[full(f)]
                if f.deletes and len(found) > 1:
                    raise ValueError(f"deleted places in {full(f)!r}, which is a folder of several files: its rows have no order")
                parts += [FilePart(x, tuple(full(d) for d in f.deletes), g.file_columns, self.identity.snapshot if g.partial else None) for x in found]
        return parts

    def read(self, partition: FilePart) -> Iterator[Any]:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        from tidelake.functions.arrow import convert, default_of

        if partition is None or not hasattr(partition, "path"):
            return
        wanted = to_arrow_schema(self.table_schema)
        gone = np.zeros(0, np.int64)
        for d in partition.deletes:
            gone = np.concatenate([gone, _open(pq, d, self.storage).read(columns=["pos"]).column("pos").to_numpy()])
        gone = np.unique(gone)
        by_id = {c.column_id: c for c in partition.file_columns}
        columns = [(by_id.get(c.column_id), c) for c in self.identity.columns]
        names = [f.name for f, _ in columns if f is not None] + ([layout.ROW_SNAPSHOT] if partition.up_to is not None else [])
        at = 0
        for batch in _open(pq, partition.path, self.storage).iter_batches(columns=names):
            keep = np.ones(batch.num_rows, bool)
            lo, hi = np.searchsorted(gone, [at, at + batch.num_rows])
            keep[gone[lo:hi] - at] = False
            at += batch.num_rows
            if partition.up_to is not None:
                keep &= pc.less_equal(batch.column(layout.ROW_SNAPSHOT), partition.up_to).fill_null(False).to_numpy(zero_copy_only=False)
            if not keep.all():
                batch = batch.filter(pa.array(keep))
            arrays = [default_of(c, batch.num_rows, k.type) if f is None else convert(batch.column(f.name), f, c, k.type) for (f, c), k in zip(columns, wanted)]
            yield pa.RecordBatch.from_arrays(arrays, schema=wanted)


class PruningReader(LakeReader):
    def pushFilters(self, filters: list) -> list:
        self.clauses = [_clause(f) for f in filters]
        return filters  # all are applied to rows again


def _place(path: str, storage: dict[str, str]) -> tuple[Any, str]:
    """The file system of a path, and the path in it."""
    from pyarrow import fs

    if path.startswith(("s3a://", "s3://")) and storage:
        low = {k.lower(): v for k, v in storage.items()}
        given = {a: low[k] for k, a in _S3_OPTIONS.items() if k in low}
        if "aws_allow_http" in low:
            given["scheme"] = "http" if low["aws_allow_http"].lower() in ("true", "1") else "https"
        return fs.S3FileSystem(**given), path.partition("://")[2]
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path.replace("s3a://", "s3://"))
    return fs.LocalFileSystem(), path


def _files(registered: list[str], storage: dict[str, str]) -> dict[str, list[str]]:
    """The data files of each registered path: the path itself, or what lies below a folder, by name.

    As Spark's readers do, names that begin with a dot or an underscore are passed over.
    """
    from pyarrow import fs

    by_root: dict[str, list[str]] = {}
    for path in dict.fromkeys(registered):
        by_root.setdefault("/".join(path.split("/")[:3]) if "://" in path else path.partition("/")[0], []).append(path)
    out = {}
    for held in by_root.values():
        store, inner = _place(held[0], storage)[0], [_place(p, storage)[1] for p in held]
        for path, info in zip(held, store.get_file_info(inner)):
            if info.type != fs.FileType.Directory:
                out[path] = [path]
                continue
            root = info.path.rstrip("/")
            names = sorted(x.path[len(root) :] for x in store.get_file_info(fs.FileSelector(root, recursive=True)) if x.type == fs.FileType.File)
            shown = [n for n in names if not any(p.startswith(".") or (p.startswith("_") and "=" not in p) for p in n.split("/"))]
            out[path] = [(root if isinstance(store, fs.LocalFileSystem) else path.rstrip("/")) + n for n in shown]
    return out


def _open(pq: Any, path: str, storage: dict[str, str]) -> Any:
    store, inner = _place(path, storage)
    return pq.ParquetFile(store.open_input_file(inner))


#: Storage options by what Arrow's reader calls them. Fixed values.
_S3_OPTIONS = {"aws_access_key_id": "access_key", "aws_secret_access_key": "secret_key", "aws_session_token": "session_token", "aws_region": "region", "aws_endpoint_url": "endpoint_override", "aws_endpoint": "endpoint_override"}


def register(spark) -> None:
    spark.dataSource.register(LakeSource)
