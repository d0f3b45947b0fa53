"""What the operators of this subpackage share: the shared folder, partitions, Arrow columns, row keys."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where the vocabulary files of public tokenizers lie; every function that needs one takes a path.
WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"


def tokenizer_path(name: str) -> str:
    """The place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see (spark.checkpoint.dir).

    Where the session names none, a temporary folder is taken on a local master (tests on one machine) and
    set on the session so that later calls agree; a cluster has no folder that could be guessed.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors see")
        found = "file://" + tempfile.mkdtemp(prefix="tidelake-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40, "p": 1 << 50}


def size_in_bytes(text: str) -> int:
    """A size as Spark writes it: ``4194304``, ``64m``, ``64MB``; -1 for none."""
    found = re.fullmatch(r"\s*(-?\d+)\s*([bkmgtp]?)(?:i?b)?\s*", text.lower())
    if not found:
        raise ValueError(f"not a size: {text!r}")
    return int(found[1]) * _UNITS[found[2]]


def bounded_batches(spark: SparkSession, limit: int = 4 << 20) -> None:
    """Have Spark cut what it hands to Python by bytes, so that long texts do not pile up in a batch.

    Spark takes this setting from the session when a query is run, not where it is written down, so it
    stays lowered for the session; a lower one is left as it is.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = size_in_bytes(spark.conf.get(name))
    if now > limit or now <= 0:
        spark.conf.set(name, str(limit))


def new_folder(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/tidelake/{uuid.uuid4().hex}/{tag}"


def planned_bytes(df: DataFrame) -> int | None:
    """Bytes that the planner expects a frame to read or hold; None where it does not say."""
    plan = getattr(df, "_jdf", None)  # a client may have no JVM at hand
    return None if plan is None else int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fewer(df: DataFrame, source: DataFrame, each: int = 16 << 20) -> DataFrame:
    """df in no more partitions than `source` has runs of `each` bytes, and the cluster has cores.

    Many small partitions make many small files, and starting a file costs more than filling it. No rows
    are shuffled: neighbouring partitions are read one after the other. Partition numbers that go into a
    result must come from `spark_partition_id` of the frame before this.
    """
    size = planned_bytes(source)
    return df if size is None else df.coalesce(min(max(df.sparkSession.sparkContext.defaultParallelism, -(-size // each)), (1 << 31) - 1))


def materialise(df: DataFrame, tag: str, *partition_by: str) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, tag)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    schema = df.schema
    for f in schema.fields:
        f.nullable = True
    return spark.read.schema(schema).parquet(path)


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """A string column as UTF-8 bytes, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def in_blocks(batches: Iterable[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a block's texts hold about `limit` bytes at most (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        col = batch.column(column)
        if col.nbytes <= limit:
            yield batch
            continue
        sizes = [len(x) for x in as_bytes(col)]
        start = held = 0
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        yield batch.slice(start)


def gathered(batches: Iterable[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Join batches until their texts hold about `size` bytes, and cut larger ones."""
    held: list[pa.RecordBatch] = []
    for batch in in_blocks(batches, column, size):
        held.append(batch)
        if sum(b.column(column).nbytes for b in held) >= size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def row_key(text: str = "text", doc_id: str = "doc_id") -> list:
    """Two columns k1, k2: 128 bits of hash over a row's id and text; only rows equal in both share them."""
    of = [F.col(doc_id).cast("long"), F.coalesce(F.col(text).cast("string"), F.lit(""))]
    return [F.xxhash64(F.lit(seed), *of).alias(name) for seed, name in enumerate(("k1", "k2"), 1)]


def crc_bucket(doc_id: str, modulus: int):
    """crc32 of the id written as text, modulo `modulus` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus
