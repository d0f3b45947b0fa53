"""Operator 7: language-model scores from a probabilistic suffix tree over words.

Root: the training words' relative frequencies, with the share of words met once (Good-Turing) set aside
for words not met. States: contexts of up to `ORDER` words. All n-grams of the training text that are met
`least` times or more make the tree, however large the corpus. A context is kept if its next-word distribution diverges from its
shorter context's (count times Kullback-Leibler divergence of at least `divergence`). Distributions are
smoothed by absolute discounting: what the discount frees goes to the longest kept suffix. A token is
scored in the longest suffix state, falling back state by state.

Flow: texts are read in blocks of bounded size; a block is one row that holds its texts as numbers of its own
words. Whatever must be counted over all blocks goes the same way: a block sends what it has met, packed by
range of hash, a range's task adds up what all blocks sent, and each block gets back what it asked for.
That is done for words (by the words themselves), then order by order for the n-grams whose two parts are
frequent, then for contexts: the block that owns an n-gram (the first that sent it) knows all counts its
probability and its shorter one's need, and sends its part of the context's divergence. In the end a
block holds every count and every kept context that its texts need, and is scored where it lies. Nothing
is broadcast, nothing but three sums comes to the driver, and an n-gram has one entry per block
at most, so common ones weigh no more than others.

Defined results: a null text is empty and scored as its end alone; repeated rows are learned and scored
once each; a null id counts as empty text for the fold; without training rows every score is 0; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm._common import as_bytes, bounded_batches, crc_bucket, fewer, in_blocks, materialise

ORDER = 3
SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
#: The end of a text; no word is empty.
END = b""
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]


def word_hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word, 42)


def joined(context: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """The hash of an n-gram from those of its two parts: without its last word, and without its first."""
    mixed = context * _A
    mixed ^= mixed >> np.uint64(29)
    return ((mixed + shorter) * _B) | np.uint64(1)


def gram_hashes(words: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
    """Hashes of the n-grams that end at each token, n from 1; zero where the text has no such n-gram.

    words: hashes of the tokens of texts in a row; place: each token's number in its text.
    """
    out = [words | np.uint64(1)]
    for n in range(2, ORDER + 2):
        h = np.zeros_like(words)
        h[1:] = joined(out[-1][:-1], out[-1][1:])
        h[place < n - 1] = 0
        out.append(h)
    return out


def places(lengths: np.ndarray) -> np.ndarray:
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


_PARTS = "block long, data binary, words binary, counts binary"
_SENT = "block long, part int, data binary"
_ANSWER = "block long, step int, part int, data binary"
_CONTEXTS = ORDER + 2  # the step after those of the n-grams, which go by their order


def packed(values: np.ndarray) -> bytes:
    """Numbers from 0, in as few bytes as the largest needs, byte by byte and compressed."""
    values = np.ascontiguousarray(values, "<i8")
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + zlib.compress(values.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes(), 1)


def numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data[1:]), np.uint8).reshape(data[0], -1)
    return widened(planes).view(np.int64)


def widened(planes: np.ndarray) -> np.ndarray:
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : len(planes)] = planes.T
    return out.reshape(-1).view("<u8")


def packed_hashes(h: np.ndarray) -> bytes:
    """Ascending hashes, by their differences; those are as good as random and not compressed."""
    if not len(h):
        return b""
    steps = np.diff(h)
    width = max(1, (int(steps.max(initial=0)).bit_length() + 7) // 8)
    return int(h[0]).to_bytes(8, "little") + bytes([width]) + steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def hashes(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    first = np.frombuffer(data, "<u8", 1)
    steps = widened(np.frombuffer(data, np.uint8, offset=9).reshape(data[8], -1))
    return np.cumsum(np.append(first, steps), dtype=np.uint64)


def bound(*pieces: bytes) -> bytes:
    return struct.pack(f"<B{len(pieces)}q", len(pieces), *map(len, pieces)) + b"".join(pieces)


def unbound(data: bytes) -> list[bytes]:
    n = data[0]
    out, at = [], 1 + 8 * n
    for size in struct.unpack_from(f"<{n}q", data, 1):
        out.append(data[at : at + size])
        at += size
    return out


def distinct(h: np.ndarray) -> np.ndarray:
    """Ascending, each once (np.unique would hash them, at many times the cost)."""
    h = np.sort(h)
    return h[np.append(True, h[1:] != h[:-1])] if len(h) else h


def ranges(h: np.ndarray, parts: int) -> np.ndarray:
    """The range of each hash; ascends with the hash."""
    return (((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def slices(h: np.ndarray, parts: int) -> Iterator[tuple[int, slice]]:
    """The ranges that ascending hashes fall in, and which."""
    of = ranges(h, parts)
    for lo, hi in runs_of(of) if len(of) else ():
        yield int(of[lo]), slice(lo, hi)


def table_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    names = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(names)], names=[n for n, _ in names])


class Numbered(dict):
    """A number for every word, in the order of their coming."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def read_blocks(docs: DataFrame, block_bytes: int, parts: int) -> DataFrame:
    """A row per block: its texts as numbers of its words, the words' ranges; the words and their training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held_bytes, words = None, 0, Numbered()
        ids, docs_of, flags = [], [], []

        def flush() -> pa.RecordBatch:
            flat = np.concatenate(ids)
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            of = np.array(flags, np.uint8)
            met = np.bincount(flat[np.repeat(of & 1 == 0, lengths)], minlength=len(words))
            part = ranges(np.fromiter(map(word_hash, words), np.uint64, len(words)), parts)
            data = bound(np.array(docs_of, "<i8").tobytes(), of.tobytes(), packed(lengths), packed(flat), packed(part))
            return table_of([(block, data, b" ".join(words), packed(met))], _PARTS)

        for batch in in_blocks(batches, "text", min(block_bytes, 8 << 20)):
            block = block or (batch.column("part")[0].as_py() << 24) + 1
            texts = as_bytes(batch.column("text"))
            size = sum(map(len, texts))
            if ids and held_bytes + size > block_bytes:
                yield flush()
                words, held_bytes, block, ids, docs_of, flags = Numbered(), 0, block + 1, [], [], []
            held_bytes += size
            for text, held, doc in zip(texts, batch.column("held").to_pylist(), batch.column("doc_id").to_pylist()):
                found = tokens(text)
                mine = [words[x] for x in found]
                ids.append(np.array(mine, np.int32))
                docs_of.append(doc or 0)
                flags.append(held | 2 * (doc is None))
        if ids:
            yield flush()

    bounded_batches(docs.sparkSession)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), (crc_bucket("doc_id", 10) == 0).alias("held"))
    return materialise(fewer(text, docs, 32 << 20).withColumn("part", F.spark_partition_id()).mapInArrow(run, _PARTS), "lm-blocks")


def unpacked(data: bytes, width: int) -> np.ndarray:
    """Numbers of `width` bytes each."""
    packed = np.frombuffer(data, np.uint8).reshape(-1, width)
    ids = packed[:, 0].astype(np.int32)
    for k in range(1, width):
        ids |= packed[:, k].astype(np.int32) << (8 * k)
    return ids


def runs_of(values: np.ndarray) -> list[tuple[int, int]]:
    """Where runs of equal values begin and end."""
    edges = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
    return list(zip(edges, edges[1:]))


def written(df: DataFrame, tag: str) -> DataFrame:
    """Materialised; Spark is told to delete the shuffle files of the query as soon as it is written."""
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name, None)
    conf.set(name, "true")
    try:
        return materialise(df, tag)
    finally:
        conf.unset(name) if before is None else conf.set(name, before)


@dataclass
class Tree:
    """Kept contexts (hash, share left to the shorter state) and their next words (hash, probability)."""

    total: int
    distinct: int
    unseen: float
    contexts: np.ndarray
    left: np.ndarray
    grams: np.ndarray
    given: np.ndarray
    flags: np.ndarray

    def place(self, table: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in h an entry of table stands, and which."""
        at = np.flatnonzero(self.flags[(h >> np.uint64(20)).astype(np.int64) & (len(self.flags) - 1)] & (h != 0))
        i = np.searchsorted(table, h[at])
        i[i == len(table)] = 0
        good = table[i] == h[at] if len(table) else np.zeros(0, bool)
        return at[good], i[good]

    def score(self, words: np.ndarray, place: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each token: of the base, and of the tree."""
        base = np.log10((counts + 0.1) / (self.total + 0.1 * (self.distinct + 1)))
        p = np.where(counts > 0, (1 - self.unseen) * counts / max(1, self.total), self.unseen)
        grams = gram_hashes(words, place)
        for n in range(ORDER):
            context = np.append(np.uint64(0), grams[n][:-1])
            context[place == 0] = 0
            at, which = self.place(self.contexts, context)
            if not len(at):
                break
            given = np.zeros(len(at))
            hit, gram = self.place(self.grams, grams[n + 1][at])
            given[hit] = self.given[gram]
            p[at] = given + self.left[which] * p[at]
        return base, np.log10(p)


def flags_of(*tables: np.ndarray) -> np.ndarray:
    flags = np.zeros(1 << 22, bool)
    for t in tables:
        flags[(t >> np.uint64(20)).astype(np.int64) & (len(flags) - 1)] = True
    return flags


def set_aside(total: int, once: int) -> float:
    """The share of words not met (Good-Turing)."""
    return 1.0 if not total else float(np.clip((once + 0.5) / (total + 1), 1e-9, 0.5))


def grow(grams: dict[str, np.ndarray], total: int, distinct: int, once: int, divergence: float, discount: float = 0.75) -> Tree:
    """Keep contexts that diverge from their shorter ones: the tree of a table that fits in memory."""
    order = np.argsort(grams["h"])
    h, n, context, shorter, count = (grams[k][order] for k in ("h", "order", "context", "shorter", "n"))

    def find(x: np.ndarray) -> np.ndarray:
        i = np.searchsorted(h, x)
        i[i == len(h)] = 0
        return np.where(h[i] == x, i, -1) if len(h) else np.full(len(x), -1)

    up, down = find(context), find(shorter)
    rows = np.flatnonzero((n > 1) & (up >= 0) & (down >= 0))
    up, down = up[rows], down[rows]
    p = count[rows] / count[up]
    above = find(context[down])
    low = np.where(n[rows] == 2, count[down] / max(1, total), count[down] / np.where(above >= 0, count[above], total))
    contexts, which = np.unique(up, return_inverse=True)
    sums = lambda x: np.bincount(which, x, len(contexts))
    rest, rest_low = np.maximum(1 - sums(p), 0), np.maximum(1 - sums(low), 1e-12)
    gain = count[contexts] * (sums(p * np.log(p / np.maximum(low, 1e-12))) + np.where(rest > 0, rest * np.log(np.maximum(rest, 1e-12) / rest_low), 0))
    kept = gain >= divergence
    mine = kept[which]
    given = (count[rows] - discount) / count[up]
    left = 1 - sums(given)
    grams_kept, order2 = h[rows[mine]], np.argsort(h[rows[mine]])
    tables = h[contexts[kept]], grams_kept[order2]
    flags = flags_of(*tables)
    return Tree(total, distinct, set_aside(total, once), tables[0], left[kept], tables[1], given[mine][order2], flags)


def found_in(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are in an ascending table, and where there."""
    if not len(table):
        return (np.zeros(0, np.int64),) * 2
    flags = flags_of(table)
    at = np.flatnonzero(flags[(keys >> np.uint64(20)).astype(np.int64) & (len(flags) - 1)])
    i = np.searchsorted(table, keys[at])
    i[i == len(table)] = 0
    good = table[i] == keys[at]
    return at[good], i[good]


class Block:
    """A block's texts with the answers so far. grams[k], n[k]: by token, the n-gram of order k + 1 that ends there and how often
    it was met in training; both zero where the n-gram, or one of its parts, is not frequent."""

    def __init__(self, answers: dict[int, list[bytes]], orders: int, least: int, parts: int):
        self.answers, self.parts = answers, parts
        docs, flags, lengths, ids, part = unbound(answers[0][0])
        self.docs, self.flags = np.frombuffer(docs, "<i8"), np.frombuffer(flags, np.uint8)
        self.lengths, self.ids = numbers(lengths), numbers(ids)
        self.place = places(self.lengths)
        order = np.argsort(numbers(part), kind="stable")
        pieces = [unbound(x) for x in answers[1]]
        c, h = np.zeros(len(order), np.int64), np.zeros(len(order), np.uint64)
        c[order] = counts = np.concatenate([numbers(x) for x, _ in pieces])
        h[order[counts >= least]] = np.concatenate([np.frombuffer(x, "<u8") for _, x in pieces])
        self.known = c[self.ids]
        self.grams, self.n = [(h | np.uint64(1))[self.ids]], [np.where(self.known >= least, self.known, 0)]
        self.owned: list[np.ndarray] = []
        for order in range(2, orders + 1):
            # an answer has a number for everything that was sent, in its order, so that no hash goes back
            at, keys = self.candidates(order)
            by = np.argsort(keys)
            at, keys = at[by], keys[by]
            new = np.append(True, keys[1:] != keys[:-1])[: len(keys)]
            met = np.concatenate([np.zeros(0, np.int64), *map(numbers, answers.get(order, ()))])
            mine = met[np.cumsum(new) - 1]
            grams, n = np.zeros(len(self.ids), np.uint64), np.zeros(len(self.ids), np.int64)
            grams[at], n[at] = np.where(mine > 0, keys, 0), mine >> 1
            self.grams.append(grams)
            self.n.append(n)
            self.owned.append(at[new][met & 1 == 1])  # a place of each

    def candidates(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Where n-grams of an order end whose two parts are frequent, and their hashes."""
        part, good = self.grams[order - 2], self.n[order - 2] > 0
        at = np.flatnonzero(good & np.append(False, good[:-1]) & (self.place >= order - 1))
        return at, joined(part[at - 1], part[at])

    def send_grams(self, order: int) -> Iterator[tuple[int, bytes]]:
        at, keys = self.candidates(order)
        trained, counts = np.unique(keys[np.repeat(self.flags & 1 == 0, self.lengths)[at]], return_counts=True)
        keys = distinct(keys)
        n = np.zeros(len(keys), np.int64)
        n[np.searchsorted(keys, trained)] = counts
        for part, some in slices(keys, self.parts):
            yield part, bound(packed_hashes(keys[some]), packed(n[some]))

    def contexts(self) -> np.ndarray:
        return distinct(np.concatenate([g[n > 0] for g, n in zip(self.grams[:ORDER], self.n)]))

    def send_contexts(self, total: int) -> Iterator[tuple[int, bytes]]:
        """All contexts of the texts, and what the block's own n-grams add to each: counts, shares in the shorter context, divergence."""
        rows = []
        for k, owned in enumerate(self.owned):
            n, up = self.n[k + 1][owned], self.n[k][owned - 1]
            low = self.n[k][owned] / (self.n[k - 1][owned - 1] if k else max(1, total))
            p = n / up
            rows.append((self.grams[k][owned - 1], n, np.ones(len(n), np.int64), up, low, p * np.log(p / np.maximum(low, 1e-12))))
        context, n, one, up, low, gain = (np.concatenate(x) for x in zip(*rows))
        keys = self.contexts()
        where = np.searchsorted(keys, context)
        sums = [np.bincount(where, x, len(keys)) for x in (n, one, low, gain)]
        counts = np.zeros(len(keys), np.int64)
        counts[where] = up
        for part, some in slices(keys, self.parts):
            yield part, bound(packed_hashes(keys[some]), *(packed(x[some].astype(np.int64)) for x in (*sums[:2], counts)), *(zlib.compress(x[some].astype("<f8").tobytes(), 1) for x in sums[2:]))

    def score(self, total: int, distinct: int, unseen: float, discount: float) -> pa.RecordBatch:
        known = self.known
        base = np.log10((known + 0.1) / (total + 0.1 * (distinct + 1)))
        p = np.where(known > 0, (1 - unseen) * known / max(1, total), unseen)
        pieces = [unbound(x) for x in self.answers.get(_CONTEXTS, ())]
        kept, left = (np.concatenate([np.zeros(0), *x]) for x in ([numbers(x) for x, _ in pieces], [np.frombuffer(x, "<f8") for _, x in pieces]))
        table = self.contexts()[kept > 0] if len(left) else np.zeros(0, np.uint64)
        for k in range(ORDER if len(table) else 0):
            at = np.flatnonzero((self.place > k) & np.append(False, self.n[k][:-1] > 0))
            hit, which = found_in(table, self.grams[k][at - 1])
            at = at[hit]
            n = self.n[k + 1][at]
            p[at] = np.where(n > 0, n - discount, 0) / self.n[k][at - 1] + left[which] * p[at]
        starts = np.cumsum(self.lengths) - self.lengths
        sums = [np.add.reduceat(x, starts) for x in ((known > 0).astype(np.int64), base, np.log10(p))]
        columns = [pa.array(self.docs, mask=self.flags > 1), pa.array(self.flags & 1 == 1), pa.array(self.lengths), pa.array(sums[0]), pa.array(np.full(len(self.docs), total)), pa.array(sums[1]), pa.array(sums[2])]
        return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in SCHEMA.split(", ")])


def send_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, data, words, counts in zip(*(c.to_pylist() for c in batch.columns)):
            of = numbers(unbound(data)[4])
            order, words, counts = np.argsort(of, kind="stable"), words.split(b" "), numbers(counts)
            rows = []
            for lo, hi in runs_of(of[order]):
                some = order[lo:hi]
                rows.append((block, int(of[some[0]]), bound(b" ".join([words[i] for i in some.tolist()]), packed(counts[some]))))
            yield table_of(rows, _SENT)


def add_words(sent: list[tuple[int, bytes]], least: int) -> Iterator[tuple[int, bytes]]:
    """Training counts of a range's words and the hashes of the frequent ones; under block -1 their sum, and how many were met, and met once."""
    total: dict[bytes, int] = {}
    rows = []
    for block, data in sent:
        words, counts = unbound(data)
        words = words.split(b" ")
        rows.append((block, words))
        for w, n in zip(words, numbers(counts).tolist()):
            total[w] = total.get(w, 0) + n
    known = {w: word_hash(w) for w, n in total.items() if n >= least}
    for block, words in rows:
        yield block, bound(packed(np.array([total[w] for w in words])), np.array([known[w] for w in words if w in known], "<u8").tobytes())
    c = np.fromiter(total.values(), np.int64, len(total))
    yield -1, struct.pack("<3q", c.sum(), (c > 0).sum(), (c == 1).sum())


def add_grams(sent: list[tuple[int, bytes]], least: int) -> Iterator[tuple[int, bytes]]:
    """For each n-gram that a block sent, how often it was met: times two, one more for the owner; 0 if it is not frequent."""
    rows = [(block, hashes(h), numbers(n)) for block, (h, n) in ((b, unbound(d)) for b, d in sent)]
    keys = distinct(np.concatenate([h for _, h, _ in rows]))
    n, where = np.zeros(len(keys), np.int64), []
    for _, h, counts in rows:
        where.append(np.searchsorted(keys, h))
        n[where[-1]] += counts
    free = np.ones(len(keys), np.int64)
    for (block, h, counts), at in zip(rows, where):
        met = n[at]
        mine = free[at] & (counts > 0)
        free[at] -= mine
        yield block, packed(np.where(met >= least, 2 * met + mine, 0))


def add_contexts(sent: list[tuple[int, bytes]], divergence: float, discount: float) -> Iterator[tuple[int, bytes]]:
    """Which contexts that a block sent diverge enough from their shorter ones, and the share that those leave to the shorter one."""
    rows = []
    for block, data in sent:
        h, *counts, low, gain = unbound(data)
        rows.append((block, hashes(h), [*map(numbers, counts), *(np.frombuffer(zlib.decompress(x), "<f8") for x in (low, gain))]))
    keys = distinct(np.concatenate([h for _, h, _ in rows]))
    met, followers, up, low, gain = (np.zeros(len(keys)) for _ in range(5))
    for _, h, (n, one, counts, shares, gains) in rows:
        at = np.searchsorted(keys, h)
        up[at] = np.maximum(up[at], counts)
        for out, x in ((met, n), (followers, one), (low, shares), (gain, gains)):
            out[at] += x
    up = np.maximum(up, 1)
    rest = np.maximum(up - met, 0) / up
    more = np.where(rest > 0, rest * np.log(np.maximum(rest, 1e-12) / np.maximum(1 - low, 1e-12)), 0)
    kept = (followers > 0) & (up * (gain + more) >= divergence)
    left = 1 - (met - discount * followers) / up
    for block, h, _ in rows:
        at = np.searchsorted(keys, h)
        good = kept[at]
        yield block, bound(packed(good.astype(np.int64)), left[at[good]].astype("<f8").tobytes())


def score_texts(docs: DataFrame, least: int = 4, divergence: float = 8.0, block_bytes: int = 14 << 20, discount: float = 0.75) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    least: n-grams met fewer times are not in the tree.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = read_blocks(docs, block_bytes, parts)
    answers: list[DataFrame] = []

    def meet(run: Callable[[Block], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
        """run on every block with all answers so far."""
        orders = min(len(answers), ORDER + 1)
        rows = blocks.select("block", F.lit(0).alias("step"), F.lit(0).alias("part"), "data")
        for a in answers:
            rows = rows.unionAll(a.where("block >= 0"))
        # blocks are numbered from the reading task's number << 24
        to = F.pmod(3 * F.shiftright("block", 24) + F.col("block").bitwiseAND(F.lit((1 << 24) - 1)), F.lit(parts)).cast("int")

        def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block, found = None, {}
            for batch in batches:
                for b, step, data in zip(*(batch.column(c).to_pylist() for c in ("block", "step", "data"))):
                    if b != block:
                        if found:
                            yield from run(block, Block(found, orders, least, parts))
                        block, found = b, {}
                    found.setdefault(step, []).append(data)
            if found:
                yield from run(block, Block(found, orders, least, parts))

        return rows.repartitionById(parts, to).sortWithinPartitions("block", "step", "part").mapInArrow(every, schema)

    def ask(step: int, sent: DataFrame, add: Callable[[list[tuple[int, bytes]]], Iterator[tuple[int, bytes]]]) -> DataFrame:
        """The answers to what blocks sent to each range."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, held = None, []
            for batch in batches:
                for b, p, data in zip(*(batch.column(c).to_pylist() for c in ("block", "part", "data"))):
                    part = p
                    held.append((b, data))
            for b, data in add(held) if held else ():
                yield table_of([(b, step, part, data)], _ANSWER)

        answers.append(written(sent.repartitionById(parts, "part").sortWithinPartitions("block").mapInArrow(run, _ANSWER), f"lm-answers-{step}"))
        return answers[-1]

    def sender(send: Callable[[Block], Iterator[tuple[int, bytes]]]):
        def run(number: int, block: Block) -> Iterator[pa.RecordBatch]:
            yield table_of([(number, part, data) for part, data in send(block)], _SENT)

        return run

    first = ask(1, blocks.mapInArrow(send_words, _SENT), lambda sent: add_words(sent, least))
    sums = [struct.unpack("<3q", r["data"]) for r in first.where("block < 0").select("data").toLocalIterator()]
    total, distinct, once = (sum(x) for x in zip(*sums)) if sums else (0, 0, 0)
    for order in range(2, ORDER + 2):
        ask(order, meet(sender(lambda block, order=order: block.send_grams(order)), _SENT), lambda sent: add_grams(sent, least))
    ask(_CONTEXTS, meet(sender(lambda block: block.send_contexts(total)), _SENT), lambda sent: add_contexts(sent, divergence, discount))
    unseen = set_aside(total, once)

    def scored(_: int, block: Block) -> Iterator[pa.RecordBatch]:
        yield block.score(total, distinct, unseen, discount)

    return meet(scored, SCHEMA)
