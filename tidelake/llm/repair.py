"""Operator 9: token ids in Re-Pair compressed shards.

`write_shards` range-partitions the documents by id, encodes each text whole, appends the end id and
cuts each partition's run of ids into shards. In a shard frequent id pairs are replaced by new
nonterminals until no pair has `least` uses; no pair crosses a document's end. A shard stores its rules,
their expansion lengths, and for every document the place of its first symbol and first id, so that any
document, or any range of its ids, is decoded without touching the rest.

File format, little-endian. Header: magic ``RPSH``, version (uint16), bytes of a symbol (uint16), the
writer's part (uint32), documents, distinct ids, rules, symbols (uint32 each), ids in the part before the
shard, ids in the shard (uint64 each). Then the distinct ids, ascending (uint32), document ids (int64) and their null flags
(uint8), first symbols (uint32, one more than documents), first ids (uint64, likewise), rules (pairs of
uint32), expansion lengths (uint32), symbols (uint16 or uint32). Symbol 0 ends a document and stands for
the end id (the last uint32 of the header), symbol s + 1 is the distinct id number s, rules follow.

Shards are rows of a Parquet table in the shared folder, so that Spark's commit protocol covers lost
and repeated tasks; `export_shards` turns the rows into plain files.

Defined results: a null or empty text is its end id alone; ids ascend, nulls first, and rows of equal
id go by their text's hash; an empty table gives no shard; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm._common import BYTE_BPE, as_bytes, bounded_batches, in_blocks, materialise, tokenizer_path
from tidelake.llm.tokenize import encoder

_HEADER = struct.Struct("<4sHHIIIIIQQI")
SHARD_SCHEMA = "part int, shard int, n_docs long, n_tokens long, n_symbols long, payload binary"
SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _grouped(left: np.ndarray, right: np.ndarray, at: np.ndarray, half: int, low: int) -> tuple[np.ndarray, np.ndarray]:
    """Pair codes in order, and the places they stand at, ascending within a pair. half, low: bits of a symbol and of a place.

    Where a pair and its place fit in 64 bits they are sorted as one number, which is many times as fast as
    sorting places by pairs.
    """
    codes = left.astype(np.uint64)
    codes <<= np.uint64(half)
    codes |= right
    if 2 * half + low > 64:
        order = np.argsort(codes, kind="stable")
        return codes[order], at[order]
    codes <<= np.uint64(low)
    codes |= at.view(np.uint64)
    codes.sort()
    at = (codes & np.uint64((1 << low) - 1)).view(np.int64)
    codes >>= np.uint64(low)
    return codes, at


def replace_pairs(symbols: np.ndarray, first_rule: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair: replaces pairs by new symbols until none has `least` uses.

    Each round gives a new symbol to every frequent pair, and where two of them overlap the one with more
    uses goes first. The uses of a pair can only grow in the round that makes one of its symbols; so a
    round looks at the places next to the last round's new symbols and at those of pairs that were
    frequent already, and every use of a pair that may be frequent is among them. What ends a document
    (symbol 0, and rules that close with it) is never the left part of a pair.
    Returns the symbols left, the rules, and by symbol whether it ends a document.
    """
    n = len(symbols)
    sym = np.append(symbols, 0).astype(np.uint32)
    after, before = np.arange(1, n + 2), np.arange(-1, n)  # the symbols left are a list; place n is past its end
    live, mark, weight = np.ones(n, bool), np.zeros(n + 1, bool), np.zeros(n + 1, np.int32)
    closes = np.zeros(first_rule, bool)
    closes[0] = True
    rules: list[np.ndarray] = []
    made = first_rule
    at = np.flatnonzero(sym[: max(0, n - 1)])
    while len(at):
        half = made.bit_length()
        codes, at = _grouped(sym.take(at), sym.take(after.take(at)), at, half, n.bit_length())
        starts = np.append(0, np.flatnonzero(codes[1:] != codes[:-1]) + 1)
        uses = np.diff(np.append(starts, len(codes)))
        frequent = np.flatnonzero(uses >= least)
        if not len(frequent):
            break
        frequent = frequent[np.argsort(uses[frequent], kind="stable")]
        rank = np.zeros(len(starts), np.int32)
        rank[frequent] = np.arange(1, len(frequent) + 1)
        rank = np.repeat(rank, uses)
        weight[at] = rank
        # from here on in the order of places: neighbours lie close together
        at = np.flatnonzero(weight) if len(at) > n >> 4 else np.sort(at[rank > 0])
        rank, left, right = weight.take(at), before.take(at), after.take(at)
        # a symbol repeated in a row is a run of overlapping uses of one pair: every second one is taken
        joined = np.append(False, (left[1:] == at[:-1]) & (rank[1:] == rank[:-1]))
        follows = np.append(joined[1:], False)
        chosen = (joined | (weight.take(left) < rank)) & (follows | (weight.take(right) < rank))
        run = np.flatnonzero(joined)
        if len(run):
            begins = np.maximum.accumulate(np.where(np.append(True, np.diff(run) != 1), run, 0))
            chosen[run] &= (run - begins) & 1 == 1
        weight.fill(0)
        mark[at] = True
        chosen = np.flatnonzero(chosen)
        at, rank, second = at.take(chosen), rank.take(chosen), right.take(chosen)
        is_used = np.zeros(len(frequent) + 1, bool)
        is_used[rank] = True
        number = np.cumsum(is_used)
        pairs = codes[starts[frequent[is_used[1:]]]]
        pairs = np.stack([pairs >> np.uint64(half), pairs & np.uint64((1 << half) - 1)], 1).astype(np.uint32)
        rules.append(pairs)
        closes = np.append(closes, closes[pairs[:, 1]])
        sym[at] = made - 1 + number.take(rank)
        made += len(pairs)
        third = after.take(second)
        after[at], before[third] = third, at
        live[second] = False
        mark[at] = mark[before[at]] = True
        mark[second] = mark[n] = False
        at = np.flatnonzero(mark)
        mark[at] = False
        at = at.take(np.flatnonzero(~closes.take(sym.take(at)) & (after.take(at) < n)))
    return sym[:n][live], np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32), closes


def write_shard(doc_ids: list, ids: list[bytes], end_id: int, least: int = 12, part: int = 0, before: int = 0) -> bytes:
    """The bytes of one shard; ids: each document's ids without the end id, as little-endian uint32."""
    lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    flat = np.frombuffer(b"".join(ids), "<u4")
    present = np.flatnonzero(np.bincount(flat)) if len(flat) else np.zeros(0, np.int64)
    number = np.zeros(int(present[-1]) + 1 if len(present) else 1, np.uint32)
    number[present] = np.arange(1, len(present) + 1)
    first_id = np.append(0, np.cumsum(lengths + 1)).astype("<u8")
    symbols = np.zeros(len(flat) + len(ids), np.uint32)
    inside = np.ones(len(symbols), bool)
    inside[first_id[1:].astype(np.int64) - 1] = False
    symbols[inside] = number[flat]
    first_rule = len(present) + 1
    symbols, rules, closes = replace_pairs(symbols, first_rule, least)
    sizes = [1] * first_rule
    for a, b in rules.tolist():
        sizes.append(sizes[a] + sizes[b])
    expanded = np.array(sizes, np.uint32)
    first_symbol = np.append(0, np.flatnonzero(closes[symbols]) + 1).astype("<u4")
    width = 2 if len(expanded) <= 1 << 16 else 4
    head = _HEADER.pack(b"RPSH", 2, width, part, len(ids), len(present), len(rules), len(symbols), before, int(first_id[-1]), end_id)
    parts = [
        present.astype("<u4"),
        np.array([0 if d is None else d for d in doc_ids], "<i8"),
        np.array([d is None for d in doc_ids], "u1"),
        first_symbol,
        first_id,
        rules.astype("<u4"),
        expanded[first_rule:].astype("<u4"),
        symbols.astype(f"<u{width}"),
    ]
    return head + b"".join(p.tobytes() for p in parts)


class Header:
    """What a shard's first bytes say."""

    size = _HEADER.size

    def __init__(self, payload: bytes):
        magic, version, self.width, self.part, self.n_docs, self.n_ids, self.n_rules, self.n_symbols, self.before, self.n_tokens, self.end_id = _HEADER.unpack_from(payload)
        if magic != b"RPSH" or version != 2:
            raise ValueError("not a Re-Pair shard of version 2")


class Shard:
    """Random access to a shard's documents."""

    def __init__(self, payload: bytes):
        self.header = h = Header(payload)
        at = h.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, count, at)
            at += out.nbytes
            return out

        self.words = np.append(np.array([h.end_id], "<u4"), take("<u4", h.n_ids))
        ids, nulls = take("<i8", h.n_docs), take("u1", h.n_docs)
        self.doc_ids = [None if x else int(d) for d, x in zip(ids, nulls)]
        self.first_symbol, self.first_id = take("<u4", h.n_docs + 1), take("<u8", h.n_docs + 1)
        self.rules = take("<u4", 2 * h.n_rules).reshape(-1, 2)
        self.lengths = np.append(np.ones(len(self.words), np.int64), take("<u4", h.n_rules))
        self.symbols = take(f"<u{h.width}", h.n_symbols)
        # the ids of every symbol in a row: a rule's are those of its two parts
        texts = [x.tobytes() for x in self.words]
        for a, b in self.rules.tolist():
            texts.append(texts[a] + texts[b])
        self.flat = np.frombuffer(b"".join(texts), "<u4")
        self.at = np.cumsum(self.lengths) - self.lengths

    def expand(self, first: int, last: int) -> np.ndarray:
        """The ids of the symbols first to last."""
        symbols = self.symbols[first:last]
        n = self.lengths[symbols]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.arange(total) + np.repeat(self.at[symbols] - ends + n, n)]

    def document(self, i: int) -> bytes:
        """All ids of document i with its end id, as little-endian uint32."""
        return self.expand(int(self.first_symbol[i]), int(self.first_symbol[i + 1])).tobytes()

    def documents(self) -> Iterator[memoryview]:
        """The ids of each document in turn, as `document` gives them; whole runs of documents are expanded at once."""
        step, i, n = 1 << 18, 0, len(self.doc_ids)
        while i < n:
            j = max(i + 1, int(np.searchsorted(self.first_symbol, self.first_symbol[i] + step, "right")) - 1)
            run = memoryview(self.expand(int(self.first_symbol[i]), int(self.first_symbol[j])).tobytes())
            cuts = (4 * (self.first_id[i : j + 1] - self.first_id[i])).tolist()
            for a, b in zip(cuts, cuts[1:]):
                yield run[a:b]
            i = j

    def ids(self, i: int, start: int, stop: int) -> np.ndarray:
        """Ids start to stop of document i: finds the first symbol by the expansion lengths."""
        first, last = int(self.first_symbol[i]), int(self.first_symbol[i + 1])
        ends = np.cumsum(self.lengths[self.symbols[first:last]])
        a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left")
        skipped = int(ends[a - 1]) if a else 0
        return self.expand(first + a, min(first + b + 1, last))[start - skipped : stop - skipped]


def write_shards(docs: DataFrame, tokenizer: str | None = None, end_id: int = 0, shard_tokens: int = 1 << 20, least: int = 12) -> DataFrame:
    """Encode and write; returns the shard table as read back from the shared folder.

    least: a pair is frequent from so many uses in a shard; a rule takes 12 bytes and saves two a use.
    """
    path = tokenizer or tokenizer_path(BYTE_BPE)
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path, spaces=True, keep=750_000)
        part, doc_ids, ids, held, shard, before = 0, [], [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            payload = write_shard(doc_ids, ids, end_id, least, part, before)
            row = [part, shard, len(ids), held, Header(payload).n_symbols, payload]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = [x.split()[0] for x in SHARD_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

        for batch in in_blocks(batches, "text", 8 << 20):
            part = batch.column("part")[0].as_py()  # the same in all rows
            for doc, got in zip(batch.column("doc_id").to_pylist(), words.encode_all(as_bytes(batch.column("text")))):
                doc_ids.append(doc)
                ids.append(got)
                held += len(got) // 4 + 1
                if held >= shard_tokens:
                    yield flush()
                    doc_ids, ids, held, shard, before = [], [], 0, shard + 1, before + held
        if ids:
            yield flush()

    text = docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string"))
    ordered = text.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    shards = ordered.withColumn("part", F.spark_partition_id()).mapInArrow(run, SHARD_SCHEMA)
    return materialise(shards, "token-shards")


def first_ids(shards: DataFrame) -> dict[int, int]:
    """The number of ids before each part, from the shards' headers.

    Parts ascend with the documents' ids. There are as many as the writer had partitions, so their sums go
    through the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = [Header(x) for x in batch.column("head").to_pylist()]
            columns = [pa.array([h.part for h in heads], pa.int64()), pa.array([h.before + h.n_tokens for h in heads], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "n"])

    heads = shards.select(F.substring("payload", 1, Header.size).alias("head")).mapInArrow(run, "part long, n long")
    totals = {r["part"]: r["n"] for r in heads.groupBy("part").agg(F.max("n").alias("n")).collect()}
    firsts, at = {}, 0
    for part in sorted(totals):
        firsts[part] = at
        at += totals[part]
    return firsts


def read_shards(shards: DataFrame) -> DataFrame:
    """One row per document, decoded from the shards' bytes alone: doc_id, start, n_tokens, ids_crc32."""
    firsts = first_ids(shards)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column("payload"):
                shard = Shard(payload.as_py())
                first = firsts[shard.header.part] + shard.header.before
                sums = [zlib.crc32(t) for t in shard.documents()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard.doc_ids, pa.int64()),
                        pa.array(shard.first_id[:-1].astype(np.int64) + first),
                        pa.array(np.diff(shard.first_id).astype(np.int64)),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return shards.select("payload").mapInArrow(run, SCHEMA)


def export_shards(shards: DataFrame, folder: str) -> None:
    """Write each shard as a plain file ``part-shard.rps`` into a folder that the executors see."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        for batch in batches:
            for part, shard, payload in zip(*(batch.column(c).to_pylist() for c in ("part", "shard", "payload"))):
                path = f"{base}/{part:06d}-{shard:06d}.rps"
                own = f"{path}.{os.getpid()}.{TaskContext.get().taskAttemptId()}"
                with store.open_output_stream(own) as out:
                    out.write(payload)
                store.move(own, path)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    shards.select("part", "shard", "payload").mapInArrow(run, "n long").agg(F.sum("n")).collect()
