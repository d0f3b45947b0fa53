"""Operator 4: SimHash near-duplicates by bit-sliced comparison.

Fingerprints: A-Z lower-cased, words split at ASCII white space, four-word shingles joined by one space
(repeats included; a shorter text is one shingle, a text without words has fingerprint zero); a bit is 1
if it is set in over half of the shingles' XXH64 (seed 42).

Linking: only distinct fingerprints are compared. Two within 4 bits agree in all but four of any bit
groups, so with six groups each fingerprint is dealt under the fifteen pairs of them; with very many fingerprints
there are more groups, and longer keys, so that buckets stay small. In a task the fingerprints,
sorted by those keys, are laid out in blocks of vertical bit planes; a block's distances to a batch of
fingerprints are counted for 64 lanes at a time in carry-save bitwise counters that stick once past the
radius, and a comparison is abandoned once every lane of the block has. A link found is true whatever
keys it was found under, so blocks need not follow the buckets. A bucket larger than a block goes on
to a second stage, which compares its parts two by two in tasks of their own. Each block passes on a
spanning set of links, never all pairs.

Defined results: a null text has no words; equal ids keep a row each and belong together only if their
fingerprints link; a null id counts as larger than any when the smallest id of a component is taken (and
is it only where no other is); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm._common import as_bytes, bounded_batches, in_blocks, materialise, row_key
from tidelake.llm.components import connected_components

_BATCH = 1 << 16


def fingerprint(text: bytes, shingle: int = 4) -> int:
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for k in range(0, n, _BATCH):
        hashes = np.array([digest(flat[a:b], 42) for a, b in zip(starts[k : k + _BATCH], stops[k : k + _BATCH])], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4, keyed: bool = False) -> DataFrame:
    """doc_id and fp (the fingerprint's bits as a signed long) of every row; keyed: its `row_key` too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_blocks(batches, "text", 8 << 20):
            found = np.array([fingerprint(x, shingle) for x in as_bytes(batch.column("text"))], np.uint64)
            kept = [batch.column(c) for c in names[:-1]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found.view(np.int64))], names=names)

    bounded_batches(docs.sparkSession)
    names = ["doc_id", *(("k1", "k2") if keyed else ()), "fp"]
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *(row_key() if keyed else ()))
    return text.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """Plane k holds bit k of every fingerprint, 64 lanes a word; lanes past the end are copies of the last."""
    padded = np.concatenate([fps, np.repeat(fps[-1:], -len(fps) % 64)])
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)


def within(queries: np.ndarray, planes: np.ndarray, lanes: int, radius: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """(query, lane) numbers of all pairs at most `radius` (up to 6) bits apart."""
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    rows = np.arange(len(queries))
    one = np.zeros((len(rows), planes.shape[1]), np.uint64)
    two, four, past = one.copy(), one.copy(), one.copy()
    limit = radius + 1
    for k in range(64):
        mask = np.where((queries[rows] >> np.uint64(k)) & np.uint64(1), full, np.uint64(0))
        x = planes[k] ^ mask[:, None]
        carry = one & x
        one ^= x
        more = two & carry
        two ^= carry
        four ^= more
        # the counter has just reached the limit: from here on the lane is past the radius
        hit = (one if limit & 1 else ~one) & (two if limit & 2 else ~two) & (four if limit & 4 else ~four)
        past |= hit
        if k % 8 == 7 and k >= 15:
            live = ~(past == full).all(1)
            if not live.any():
                return np.zeros(0, np.int64), np.zeros(0, np.int64)
            if live.mean() < 0.7:
                rows, one, two, four, past = rows[live], one[live], two[live], four[live], past[live]
    hits = np.unpackbits((~past).view(np.uint8).reshape(len(rows), -1), axis=1, bitorder="little")[:, :lanes]
    q, lane = np.nonzero(hits)
    return rows[q], lane


def _spanning(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links of the same components as (a, b), one less than nodes each."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        if x != y:
            p, q = find(x), find(y)
            if p != q:
                parent[max(p, q)] = min(p, q)
                out.append((x, y))
    return out


def compare(left: np.ndarray, right: np.ndarray, radius: int, batch: int = 128) -> list[tuple[int, int]]:
    """Spanning links between two blocks of fingerprints (unsigned)."""
    planes, found = bit_planes(right), []
    for k in range(0, len(left), batch):
        q, lane = within(left[k : k + batch], planes, len(right), radius)
        keep = left[k + q] != right[lane]
        found.append((left[k + q[keep]], right[lane[keep]]))
    if not found:
        return []
    return _spanning(np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found]))


def groups_for(n: int, radius: int, block: int) -> int:
    """The least number of bit groups with which keys part `n` even fingerprints into buckets of at most a block."""
    g = radius + 2
    while n >> (64 * (g - radius) // g) > block and g < 2 * radius + 2:
        g += 1
    return g


def group_keys(fps: np.ndarray, radius: int = 4, groups: int = 6) -> Iterator[tuple[int, np.ndarray]]:
    """(number, key) for each choice of all but `radius` bit groups; a key is unique across numbers."""
    edges = [64 * i // groups for i in range(groups + 1)]
    widths = [b - a for a, b in zip(edges, edges[1:])]
    parts = [(fps >> np.uint64(a)) & np.uint64((1 << w) - 1) for a, w in zip(edges, widths)]
    for number, chosen in enumerate(itertools.combinations(range(groups), groups - radius)):
        key = np.full(len(fps), number, np.uint64)
        for i in chosen:
            key = (key << np.uint64(widths[i])) | parts[i]
        yield number, key.view(np.int64)


def _links_of(batches: Iterator[pa.RecordBatch], radius: int, block: int) -> Iterator[pa.RecordBatch]:
    """First stage: rows (key, fp) sorted by key -> links (a, b), and rows of larger buckets (key, a, part)."""
    names = ["key", "a", "b", "part"]

    def out(key, a, b, part) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (key, a, b, part)], names=names)

    keys, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hot: int | None = None
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            keys = np.concatenate([keys, batch.column("key").to_numpy()])
            fps = np.concatenate([fps, batch.column("fp").to_numpy().view(np.uint64)])
        while len(keys) and (batch is None or len(keys) >= 4 * block):
            if keys[0] == hot:  # the rest of a bucket that is already too large
                n = int(np.searchsorted(keys, hot, "right"))
                yield out(keys[:n], fps[:n].view(np.int64), [None] * n, [None] * n)
                keys, fps = keys[n:], fps[n:]
                continue
            n = min(block, len(keys))
            if n < len(keys) and keys[n] == keys[n - 1]:
                cut = int(np.searchsorted(keys, keys[n], "left"))
                if cut == 0:  # the first bucket alone does not fit a block
                    hot = int(keys[0])
                    continue
                n = cut
            links = compare(fps[:n], fps[:n], radius) if n > 1 and (np.diff(keys[:n]) == 0).any() else []
            if links:
                a = np.array(links, np.uint64).view(np.int64)
                yield out([None] * len(a), a[:, 0], a[:, 1], [None] * len(a))
            keys, fps = keys[n:], fps[n:]


def _links_between(batches: Iterator[pa.RecordBatch], radius: int, block: int) -> Iterator[pa.RecordBatch]:
    """Second stage: rows (key, i, j, side, fp) sorted so; compares side 0 with side 1 of each (key, i, j)."""
    now, sides = None, ([], [])

    def done() -> Iterator[pa.RecordBatch]:
        left, right = (np.concatenate(s) if s else np.zeros(0, np.uint64) for s in sides)
        right = right if len(right) else left
        for k in range(0, len(left), block):
            for m in range(0, len(right), block):
                links = compare(left[k : k + block], right[m : m + block], radius)
                if links:
                    a = np.array(links, np.uint64).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], names=["a", "b"])

    for batch in batches:
        key, i, j, side = (batch.column(c).to_numpy() for c in ("key", "i", "j", "side"))
        fp = batch.column("fp").to_numpy().view(np.uint64)
        edges = np.flatnonzero((np.diff(key) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0) | (np.diff(side) != 0)) + 1
        for lo, hi in itertools.pairwise([0, *edges.tolist(), len(key)]):
            if lo == hi:
                continue
            group = (key[lo], i[lo], j[lo])
            if group != now:
                yield from done()
                now, sides = group, ([], [])
            sides[int(side[lo])].append(fp[lo:hi])
    yield from done()


def links(fps: DataFrame, radius: int = 4, block: int = 512, groups: int | None = None) -> DataFrame:
    """Links (a, b) that connect all fingerprints (column fp, distinct) within `radius` bits.

    groups: bit groups that keys are made of, by default as many as the number of fingerprints asks for.
    """
    groups = groups or groups_for(fps.count(), radius, block)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            for _, key in group_keys(fp, radius, groups):
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp.view(np.int64))], names=["key", "fp"])

    if radius > 6:
        raise ValueError("the counters hold distances up to 6")
    dealt = fps.select("fp").mapInArrow(deal, "key long, fp long").repartition("key").sortWithinPartitions("key")
    found = dealt.mapInArrow(lambda b: _links_of(b, radius, block), "key long, a long, b long, part long")
    found = materialise(found, "simhash-links")
    plain = found.where("b is not null").select("a", "b")
    # buckets larger than a block: members are hashed to parts, and every two parts meet in a task of their own
    rest = found.where("b is null").select("key", F.col("a").alias("fp"))
    sizes = rest.groupBy("key").agg(F.ceil(F.count("*") / block).alias("parts"))
    parted = rest.join(sizes, "key").withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")))
    met = parted.select("key", "fp", "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other"))
    met = met.select("key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), F.when(F.col("part") <= F.col("other"), 0).otherwise(1).cast("long").alias("side"), "fp")
    met = met.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side")
    between = met.mapInArrow(lambda b: _links_between(b, radius, block), "a long, b long")
    return plain.unionAll(between)


def _roots(classes: DataFrame, radius: int) -> DataFrame:
    """The columns of classes (column fp, distinct) and `root`, the smallest fingerprint that each one reaches."""
    linked = connected_components(links(classes, radius), "simhash-components")
    named = classes.join(linked, F.col("fp") == F.col("node"), "left").select(*classes.columns, F.coalesce("root", "fp").alias("root"))
    return materialise(named, "simhash-classes")


def near_duplicates(docs: DataFrame, radius: int = 4, shingle: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row."""
    rows = materialise(fingerprints(docs, shingle), "simhash")
    named = _roots(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), radius)
    groups = named.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("n").alias("size"))
    # a fingerprint that one row has alone needs no join
    members = named.join(groups, "root").where("size > 1").select("fp", "component_id")
    out = rows.join(members, "fp", "left")
    out = out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.coalesce("component_id", "doc_id").alias("component_id"))
    return out


def keep_one(docs: DataFrame, radius: int = 4, shingle: int = 4) -> DataFrame:
    """One row of each component, unchanged: that with the smallest id (null ids last), of equal ids that with the smallest hash of its text.

    Of rows equal in id and text one stays, whatever their other columns say. Rows are told apart by 128
    bits over id and text, so repeated and null ids neither join nor part components.
    """
    rows = materialise(fingerprints(docs, shingle, keyed=True), "simhash")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")
    named = _roots(rows.groupBy("fp").agg(F.min(first).alias("first")), radius)
    kept = named.groupBy("root").agg(F.min("first").alias("first")).select("first.k1", "first.k2")
    whole = docs.select(F.struct("*").alias("row"), *row_key())
    return whole.join(kept, ["k1", "k2"]).dropDuplicates(["k1", "k2"]).select("row.*")
