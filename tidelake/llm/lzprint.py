"""Operator 6: Lempel-Ziv phrase fingerprints.

A text is parsed into the phrases of an LZ78 dictionary: each phrase is the longest one met before plus
one character. The set of phrases is hashed, and a one-permutation minimum hash over `BINS` bins, eight
bits kept of each, is the fingerprint. The share of equal bins, less what chance makes equal, is the
likeness of two texts: it follows how far one text's dictionary would serve the other.

`with_neighbours` fingerprints each text, the text with its last quarter replaced by the start of the
next document, and the next document. Documents are dealt to parts by ranges of their id; the first
document of a part is sent to the part before it too, so every document meets its successor without a
second pass over the texts. An edited text shares the parse of its first three quarters.

A dictionary is begun anew after `RENEW` phrases, so memory does not grow with a text's length.

Defined results: a null text is empty; an empty text has the fingerprint of zeros, like only to itself;
a null id sorts first; rows of equal id follow their text's hash; a single document is its own
successor; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm._common import bounded_batches, in_blocks

BINS = 128
RENEW = 1 << 20
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_EDGES = (np.arange(BINS, dtype=np.uint64)) << np.uint64(57)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


class Parse:
    """The state of an LZ78 parse: phrase hashes so far, and the dictionary as nested tables."""

    def __init__(self):
        self.root: dict = {0: 1}
        self.node, self.size = self.root, 0
        self.phrases: list[int] = []
        self.least = np.full(BINS, _NONE)

    def feed(self, text: str, undo: list | None = None) -> None:
        node, root, phrases, size = self.node, self.root, self.phrases, self.size
        for c in text:
            below = node.get(c)
            if below is not None:
                node = below
                continue
            code = (node[0] * 0x9E3779B97F4A7C15 + ord(c)) & 0xFFFFFFFFFFFFFFFF
            node[c] = {0: code}
            phrases.append(code)
            if undo is not None:
                undo.append((node, c))
            size += 1
            if size % RENEW == 0:
                root = {0: 1}
                self.root, self.phrases = root, phrases
                if undo is None:
                    self.fold()
                    phrases = self.phrases
            node = root
        self.node, self.root, self.size, self.phrases = node, root, size, phrases

    def fold(self) -> None:
        self.least = fold(self.least, self.phrases)
        self.phrases = []


def fold(least: np.ndarray, phrases: list[int]) -> np.ndarray:
    """Smallest mixed hash of each bin, phrases added."""
    if not phrases:
        return least
    x = np.array(phrases, np.uint64)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x.sort()
    at = np.searchsorted(x, _EDGES)
    first = x[np.minimum(at, len(x) - 1)]
    first[(at == len(x)) | (first >> np.uint64(57) != _EDGES >> np.uint64(57))] = _NONE
    return np.minimum(least, first)


def signature(least: np.ndarray) -> bytes:
    """Eight bits of each bin; an empty bin takes those of the next full one, changed by the distance."""
    full = np.flatnonzero(least != _NONE)
    if not len(full):
        return bytes(BINS)
    places = np.arange(BINS)
    follows = np.searchsorted(full, places) % len(full)
    away = (full[follows] - places) % BINS
    low = (least[full[follows]] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return ((low * (2 * away + 1) >> 13) & 255).astype(np.uint8).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    if a == b:
        return 1.0
    if not any(a) or not any(b):
        return 0.0
    same = float((np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8)).mean())
    return max(0.0, (same - 1 / 256) / (1 - 1 / 256))


def both_prints(text: str, other: str) -> tuple[str, bytes, bytes]:
    """The edited text, and the signatures of the text and of the edited text."""
    q = len(text) // 4
    head, tail, new = text[: len(text) - q], text[len(text) - q :], other[:q]
    parse = Parse()
    parse.feed(head)
    parse.fold()
    node, root, size, least = parse.node, parse.root, parse.size, parse.least
    added: list = []
    parse.feed(tail, added)
    own = fold(least, parse.phrases)
    for at, c in reversed(added):
        del at[c]
    parse.node, parse.root, parse.size, parse.phrases = node, root, size, []
    parse.feed(new, [])
    return head + new, signature(own), signature(fold(least, parse.phrases))


def _longs(values: list[int]):
    """A constant array; written as one text, so that very many values are one literal and not one each."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _cuts_below(cuts: list[int], key):
    """How many of the ascending cuts are less than key, by bisection."""
    if not cuts:
        return F.lit(0)
    array = _longs(cuts)
    steps = F.sequence(F.lit(1), F.lit(len(cuts).bit_length()))

    def step(at, _):
        middle = F.floor((at["lo"] + at["hi"]) / 2).cast("int")
        less = F.get(array, middle) < key
        done = at["lo"] >= at["hi"]
        return F.struct(F.when(~done & less, middle + 1).otherwise(at["lo"]).alias("lo"), F.when(~done & ~less, middle).otherwise(at["hi"]).alias("hi"))

    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi")), step, lambda at: at["lo"])


def with_neighbours(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprints of every row, of its edited text, and their likeness (see the module's text)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), key.alias("key"))
    ids = rows.select("key")
    cuts = ids.agg(F.percentile_approx("key", [i / n for i in range(1, n)] or [1.0], max(10_000, 4 * n))).first()[0] or []
    cuts = sorted(set(cuts)) if n > 1 else []
    rows = rows.withColumn("part", _cuts_below(cuts, F.col("key")).cast("int"))
    # by part, its smallest key, and the part before it that has any; before the first comes the last
    least = {r[0]: r[1] for r in ids.withColumn("part", _cuts_below(cuts, F.col("key")).cast("int")).groupBy("part").agg(F.min("key")).collect()}
    order = sorted(least)
    before = {k: order[i - 1] for i, k in enumerate(order)}
    heads = F.get(_longs([least.get(k, 0) for k in range(len(cuts) + 1)]), F.col("part"))
    ahead = F.get(_longs([before.get(k, 0) for k in range(len(cuts) + 1)]), F.col("part")).cast("int")
    here = F.struct(F.col("part"), F.lit(0).alias("look"))
    places = F.when(heads == F.col("key"), F.array(here, F.struct(ahead.alias("part"), F.lit(1).alias("look")))).otherwise(F.array(here))
    dealt = rows.withColumn("places", places).select("doc_id", "text", "key", F.explode("places").alias("place")).select("doc_id", "text", "key", "place.part", "place.look")
    dealt = dealt.repartitionById(max(n, 1), F.col("part")).sortWithinPartitions("part", "look", "key", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        held = None  # (part, look, id, text) and what is known of it once its successor is there
        pending = None  # a row that lacks its successor's signature
        out: list[tuple] = []

        def ready(own: bytes) -> None:
            doc, n_chars, sha, sig, edited = pending
            out.append((doc, n_chars, sha, sig.hex(), edited.hex(), likeness(sig, edited), likeness(sig, own)))

        for batch in in_blocks(batches, "text", 8 << 20):
            for row in zip(*(batch.column(c).to_pylist() for c in ("part", "look", "doc_id", "text"))):
                if held is not None and held[0] == row[0] and not held[1]:
                    edited_text, own, edited = both_prints(held[3], row[3])
                    if pending:
                        ready(own)
                    pending = (held[2], len(held[3]), hashlib.sha256(edited_text.encode()).hexdigest(), own, edited)
                    if row[1]:
                        ready(both_prints(row[3], "")[1])
                        pending = None
                held = row
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                out.clear()

    return dealt.select("part", "look", "doc_id", "text").mapInArrow(run, SCHEMA)
