"""Operator 2: packing by Karmarkar-Karp multiway differencing.

Every document is encoded, gets its end id, and is cut into whole windows of `capacity` ids plus a
rest. Rests are cut into pieces of at most `grain` ids and gathered, in the order of the partition,
into groups that fill about `group` windows. Within a group the pieces are dealt to windows by
multiway differencing: every piece starts as a partial partition of its own; the two partial
partitions of the widest spread are merged with opposing imbalances (the fullest windows of the one
meet the emptiest of the other) until one is left. If its fullest window exceeds the capacity, the
window count rises and the group is dealt again.

Nothing is shuffled: a task packs the rows of its partition, holds the piece lengths of one group at a
time, and numbers its sequences from ``partition << 32``.

Defined results: a null or empty text is the end id alone; repeated rows are packed once each; an
empty table gives no pieces; other columns are ignored, whatever their names; a text of any length is
cut, never shortened.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm._common import WORD_BPE, as_bytes, bounded_batches, in_blocks, tokenizer_path
from tidelake.llm.tokenize import encoder

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def differencing(lengths: list[int], k: int) -> list[list[int]]:
    """Deal items to k windows of near-equal sums; returns item numbers by window."""
    if not lengths:
        return [[] for _ in range(k)]
    # A partial partition holds its non-empty windows as (sum less the smallest window, items), fullest first.
    heap = [(-n, i, [(n, [i])]) for i, n in enumerate(lengths)]
    heapq.heapify(heap)
    serial = len(heap)
    while len(heap) > 1:
        a = heapq.heappop(heap)[2]
        b = heapq.heappop(heap)[2]
        over = len(a) + len(b) - k
        if over <= 0:
            merged = a + b
        else:
            if len(b) > len(a):
                a, b = b, a
            # the windows of b that meet a non-empty window of a: b's smallest with a's largest
            free = k - len(a)
            merged = a[: len(a) - over] + b[:free]
            tail = a[len(a) - over :]
            merged += [(x[0] + y[0], x[1] + y[1]) for x, y in zip(tail, reversed(b[free:]))]
        merged.sort(key=lambda x: -x[0])
        low = merged[-1][0] if len(merged) == k else 0
        if low:
            merged = [(s - low, items) for s, items in merged]
        heapq.heappush(heap, (-merged[0][0], serial, merged))
        serial += 1
    windows = [items for _, items in heap[0][2]]
    return windows + [[] for _ in range(k - len(windows))]


def deal(lengths: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most `capacity`: the fewest by sum, and more whenever one is exceeded."""
    k = max(1, -(-sum(lengths) // capacity))
    while True:
        windows = differencing(lengths, k)
        if all(sum(lengths[i] for i in w) <= capacity for w in windows):
            return [w for w in windows if w]
        k += 1


class _Packer:
    def __init__(self, capacity: int, grain: int, group: int, slack: int, first: int):
        self.capacity, self.grain, self.target = capacity, grain, group * (capacity - slack)
        self.next, self.rests, self.held, self.out = first, [], 0, []

    def piece(self, doc, start, ids, doc_tokens, sequence, offset):
        self.out.append((doc, start, len(ids) // 4, zlib.crc32(ids), doc_tokens, sequence, offset))

    def add(self, doc: int | None, ids: bytes) -> None:
        n, at = len(ids) // 4, 0
        view = memoryview(ids)
        while n - at >= self.capacity:
            self.piece(doc, at, view[4 * at : 4 * (at + self.capacity)], n, self.next, 0)
            self.next += 1
            at += self.capacity
        parts = -(-(n - at) // self.grain)
        for i in range(parts):
            m = (n - at) // (parts - i)
            while m:
                take = min(m, self.target - self.held)
                chunk = view[4 * at : 4 * (at + take)]
                self.rests.append((doc, at, take, zlib.crc32(chunk), n))
                self.held += take
                at, m = at + take, m - take
                if self.held == self.target:
                    self.flush()

    def flush(self) -> None:
        rests = self.rests
        for window in deal([r[2] for r in rests], self.capacity):
            offset = 0
            for i in sorted(window):
                doc, start, length, crc, n = rests[i]
                self.out.append((doc, start, length, crc, n, self.next, offset))
                offset += length
            self.next += 1
        self.rests, self.held = [], 0

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.out)) or [[]] * 7
        self.out = []
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    end_id: int = 1,
    capacity: int = 2048,
    grain: int = 512,
    group: int = 256,
    slack: int = 10,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    tokenizer: a vocabulary file for the ``tokenizers`` library whose units are cut at white space.
    slack: ids left free per window on average, so that differencing seldom exceeds the capacity.
    """
    path = tokenizer or tokenizer_path(WORD_BPE)
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path, spaces=False, keep=250_000)
        end = int(end_id).to_bytes(4, "little")
        packer = None
        for batch in in_blocks(batches, "text", 8 << 20):
            packer = packer or _Packer(capacity, grain, group, slack, batch.column("part")[0].as_py() << 32)
            for doc, text in zip(batch.column("doc_id").to_pylist(), as_bytes(batch.column("text"))):
                packer.add(doc, words.encode(text) + end)
                if len(packer.out) >= 50_000:
                    yield packer.take()
        if packer and packer.rests:
            packer.flush()
        if packer and packer.out:
            yield packer.take()

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return text.withColumn("part", F.spark_partition_id()).mapInArrow(run, SCHEMA)
