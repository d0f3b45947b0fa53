"""Operator 5: benchmark decontamination by latent semantic retrieval.

1. Document frequencies of the benchmark's words are counted over all documents.
2. A randomised SVD of TF-IDF passages (all benchmark items, and the windows of all documents) gives the
   latent space: each task multiplies its passages with a random test matrix and back, the products are
   summed, and the eigenvectors follow from the sum (Nystroem).
3. Every document's windows, in lengths that fit the items, are projected. Where a window's cosine to an
   item is at least `least_cosine`, the item is a candidate. Pairs of a window and an item are left out only
   where the surroundings hold fewer of the item's rarer words than step 4 needs; they could not pass it.
4. A candidate stands if the longest common subsequence of item and surroundings holds most of the
   item's words, or fewer of them together with nearly all of its answer (its last sentence). All
   candidate windows of a document are compared, most alike first, until the item is found.

The benchmark is the query set: it is taken in blocks of at most `block_bytes`, so what is broadcast (items, and
a latent vector of every distinct word) is bounded whatever its size. Documents are searched in runs of a
bounded number of words, in which windows are summed from blocks and compared with tiles of items; very long
texts are cut into words slice by slice, and their windows summed part by part.

Defined results: words are runs of letters and digits, A-Z lower-cased (bytes outside ASCII are letters);
null texts and items without words match nothing; items shorter than `short` words must occur whole;
repeated rows and items are reported once each; empty tables give no rows; other columns are ignored
(and kept by `remove`).
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm._common import as_bytes, bounded_batches, in_blocks

#: ASCII letters in lower case, digits and all other bytes stay; the rest separates words.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
_SENTENCE = (b".", b"?", b"!", b"\n")
#: Bytes of a text cut into words at a time; words searched at a time, about; blocks summed at a time.
_SLICE, _RUN, _BLOCKS = 1 << 20, 1 << 17, 1 << 13
SCHEMA = "doc_id long, item_id long, common double, cosine double"


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


def answer_words(text: bytes) -> int:
    """Words of the last sentence that has at least three."""
    found = 0
    for part in reversed(text.replace(b"?", b".").replace(b"!", b".").replace(b"\n", b".").split(b".")):
        found += len(words(part))
        if found >= 3:
            return found
    return found


def common(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, a bit per element of a."""
    at: dict[int, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for y in b:
        u = s & at.get(y, 0)
        s = ((s + u) | (s - u)) & full
    return len(a) - s.bit_count()


@dataclass
class Index:
    """A block of items and the latent space they are searched in."""

    vocabulary: dict[bytes, int]
    items: list[tuple[int | None, list[int], int]]  # id, words, words of the answer
    idf: np.ndarray
    space: np.ndarray
    latent: np.ndarray
    sizes: tuple[int, ...]  # of windows, multiples of four
    least_cosine: float
    share: float
    share_with_answer: float
    short: int
    tile: int = 256  # items compared with a run of windows at a time

    def __post_init__(self):
        self.lengths = np.array([len(x[1]) for x in self.items])
        self.needs = np.array([self.need(n) for n in self.lengths.tolist()])
        found = [self.rare_words(i) for i in range(len(self.items))]
        self.rare = [x for x, _ in found]
        self.needs_rare = np.array([n for _, n in found])

    def need(self, length: int) -> int:
        """Words in common without which an item of `length` words cannot stand."""
        return length if length < self.short else int(np.ceil(min(self.share, self.share_with_answer) * length - 1e-9))

    def rare_words(self, i: int) -> tuple[np.ndarray, int]:
        """The item's rarer words, and how many words of a text must be among them for the item to stand.

        A common subsequence has at most the item's other words besides those: an exact bound, whatever
        words are taken. The commonest are left out as long as a third of what is needed stays.
        """
        need = int(self.needs[i])
        words, uses = np.unique(self.items[i][1], return_counts=True)
        order = np.argsort(self.idf[words], kind="stable")
        past = np.cumsum(uses[order])
        n = int(np.searchsorted(past, need - -(-need // 3), "right"))
        return words[order[n:]], need - (int(past[n - 1]) if n else 0)

    def ids(self, text: bytes) -> np.ndarray:
        """Word numbers, -1 for words that no item has; a very long text is cut between words on the way."""
        parts, at = [], 0
        while True:
            part = text[at : at + _SLICE]
            if at + len(part) < len(text):
                cut = part.translate(_WORDS).rfind(b" ")
                if cut <= 0:  # a word longer than a slice: no item has it, but its end must be found
                    end = text.translate(_WORDS).find(b" ", at + 1)
                    cut = (len(text) if end < 0 else end) - at
                part = text[at : at + cut]
            found = words(part)
            parts.append(np.fromiter(map(self.vocabulary.get, found, itertools.repeat(-1)), np.int32, len(found)))
            at += len(part)
            if at >= len(text):
                return np.concatenate(parts)

    def search(self, texts: list[bytes]) -> list[tuple[int, int | None, float, float]]:
        """(number of the text, item, share of its words in common, cosine) for every item that a text holds."""
        out, held, n = [], [], 0
        for number, text in enumerate(texts):
            ids = self.ids(text)
            if len(ids):
                held.append((number, ids))
                n += len(ids)
            if n >= _RUN or (held and number == len(texts) - 1):
                out += self._search([x for _, x in held], [i for i, _ in held])
                held, n = [], 0
        if held:
            out += self._search([x for _, x in held], [i for i, _ in held])
        return out

    def _search(self, runs: list[np.ndarray], numbers: list[int]) -> list[tuple[int, int | None, float, float]]:
        ids = np.concatenate(runs)
        stops = np.cumsum([len(x) for x in runs])
        starts = stops - [len(x) for x in runs]
        present = np.unique(ids)
        present = present[present >= 0]
        if not len(present):
            return []
        place = np.full(len(self.vocabulary) + 1, len(present), np.int32)  # the last place is that of unknown words
        place[present] = np.arange(len(present), dtype=np.int32)
        local = np.append(place[ids], np.int32(len(present)))
        weighted = np.zeros((len(present) + 1, self.space.shape[1]), np.float32)
        weighted[:-1] = self.space[present] * self.idf[present, None]
        best: dict[tuple[int, int], tuple[float, float]] = {}
        for below, size in itertools.pairwise((0, *self.sizes)):
            fit = np.flatnonzero((self.lengths > below) & (self.lengths <= size))
            found = self._candidates(local, starts, stops, size, fit, place, weighted) if len(fit) else ()
            if not len(found):
                continue
            run, begin, item, cosine = found
            # most alike first; all are compared until the item is found
            for k in np.lexsort((-cosine, item, run)).tolist():
                r, i = int(run[k]), int(item[k])
                if (r, i) in best:
                    continue
                near = ids[max(starts[r], begin[k] - size // 2) : min(stops[r], begin[k] + size + size // 2)]
                n = self.holds(i, near[near >= 0].tolist())
                if n:
                    best[r, i] = (n, float(cosine[k]))
        return [(numbers[r], self.items[i][0], n, c) for (r, i), (n, c) in sorted(best.items())]

    def holds(self, i: int, near: list[int]) -> float:
        """The share of item i's words that `near` has in the same order, 0 if it is not enough."""
        item, answer = self.items[i][1], self.items[i][2]
        n = common(item, near) / len(item)
        if len(item) < self.short:
            return n if n >= 1 else 0.0
        held = n >= self.share or (n >= self.share_with_answer and answer and common(item[-answer:], near) >= 0.8 * answer)
        return n if held else 0.0

    def _candidates(self, local, starts, stops, size, fit, place, weighted):
        """(run, first word, item, cosine) of the windows of `size` words that are near an item of `fit` and could hold it.

        Words are summed by blocks of a quarter window, so a window is four blocks in a row and its
        surroundings, half a window on either side, are eight; blocks of no words stand between two texts.
        """
        step = size // 4
        blocks = -(-(stops - starts) // step)
        windows = -(-np.maximum(1, stops - starts - size + step) // step)
        rows = blocks + 5
        run = np.repeat(np.arange(len(starts)), rows)
        within = np.arange(len(run)) - np.repeat(np.cumsum(rows) - rows, rows)
        begin = starts[run] + step * within
        end = np.minimum(begin + step, stops[run])
        is_window = within < windows[run]
        unknown = len(weighted) - 1
        kind = np.uint8 if 2 * size < 256 else np.uint16
        tiles = []
        for k in range(0, len(fit), self.tile):
            part = fit[k : k + self.tile]
            table = np.zeros((unknown + 1, len(part)), kind)
            at = place[np.concatenate([self.rare[i] for i in part])]
            table[at, np.repeat(np.arange(len(part)), [len(self.rare[i]) for i in part])] = 1
            table[unknown] = 0
            tiles.append((part, table, self.latent[part].T.copy(), self.needs_rare[part].astype(kind)))
        out = []
        for a in range(0, len(run), _BLOCKS):
            b = min(a + _BLOCKS, len(run))
            mine = np.flatnonzero(is_window[a:b])
            if not len(mine):
                continue
            lo, hi = max(0, a - 2), min(len(run), b + 6)
            before = 2 - (a - lo)  # rows that the first text lacks before it
            n = b - a + 8
            words = np.full((step, n), unknown, np.int32)
            for k in range(step):
                at = begin[lo:hi] + k
                words[k, before : before + hi - lo] = local[np.where(at < end[lo:hi], at, -1)]
            x = weighted[words[0]]
            for k in range(1, step):
                x += weighted[words[k]]
            two = x[:-1] + x[1:]
            four = (two[:-2] + two[2:])[2 : 2 + b - a][mine]
            four /= np.maximum(np.linalg.norm(four, axis=1, keepdims=True), 1e-9)
            for part, table, latent, needs in tiles:
                y = table[words[0]]
                for k in range(1, step):
                    y += table[words[k]]
                y = y[:-1] + y[1:]
                y = y[:-2] + y[2:]
                y = (y[:-4] + y[4:])[: b - a][mine]
                cosine = four @ latent
                w, j = np.nonzero((cosine >= self.least_cosine) & (y >= needs))
                if len(w):
                    at = a + mine[w]
                    out.append((run[at], begin[at], part[j], cosine[w, j]))
        return [np.concatenate(c) for c in zip(*out)] if out else ()


def _frequencies(docs: DataFrame, vocabulary: dict[bytes, int]) -> tuple[np.ndarray, int]:
    """Documents that hold each word, and all documents."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, counts, n = known.value, np.zeros(len(known.value) + 1, np.int64), 0
        for batch in in_blocks(batches, "text", 16 << 20):
            for text in as_bytes(batch.column("text")):
                counts[list({of[w] for w in set(words(text)) if w in of})] += 1
                n += 1
        counts[-1] = n
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["term", "n"])

    got = docs.select(docs["text"].cast("string")).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(len(vocabulary) + 1, np.int64)
    for r in got:
        out[r["term"]] = r["n"]
    return out[:-1], int(out[-1])


def latent_space(docs: DataFrame, index: Index, n_docs: int, rank: int, seed: int = 20) -> np.ndarray:
    """Word vectors of the latent space: randomised SVD of the TF-IDF rows of items and documents."""
    v = len(index.vocabulary)
    r = min(rank + 16, v)
    test = np.random.default_rng(seed).standard_normal((v, r)).astype(np.float32)
    shared = docs.sparkSession.sparkContext.broadcast(index)
    size = index.sizes[-1]

    def product(rows: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
        """(X' X test) for passages given as word numbers, columns that occur only."""
        out = np.zeros((v, r), np.float32)
        for k in range(0, len(rows), 256):
            part = rows[k : k + 256]
            lengths = np.fromiter(map(len, part), np.int64, len(part))
            flat = np.concatenate(part)
            used, column = np.unique(flat, return_inverse=True)
            x = np.zeros((len(part), len(used)), np.float32)
            np.add.at(x, (np.repeat(np.arange(len(part)), lengths), column), idf[flat].astype(np.float32))
            x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-6)
            out[used] += x.T @ (x @ test[used])
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix, total, seen = shared.value, np.zeros((v, r), np.float32), False
        for batch in in_blocks(batches, "text", 4 << 20):
            rows = []
            for text in as_bytes(batch.column("text")):
                ids = ix.ids(text)
                for a in range(0, len(ids), size):
                    part = ids[a : a + size]
                    part = part[part >= 0]
                    if len(part):
                        rows.append(part)
            if rows:
                total += product(rows, ix.idf)
                seen = True
        if seen:
            met = np.flatnonzero(np.abs(total).sum(1))
            for k in range(0, len(met), 1 << 13):
                at = met[k : k + (1 << 13)]
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(list(total[at]), pa.list_(pa.float32()))], names=["term", "row"])

    sums = docs.select(docs["text"].cast("string").alias("text")).mapInArrow(run, "term long, row array<float>").groupBy("term").agg(F.array(*[F.sum(F.col("row")[i]) for i in range(r)]).alias("row"))
    items = [np.array(x[1]) for x in index.items if x[1]]
    y = product(items, index.idf).astype(float) if items else np.zeros((v, r))
    scale = max(1.0, n_docs / max(1, len(items)) / 4)  # the items weigh as much as a part of the documents
    y *= scale
    for row in sums.toLocalIterator():
        y[row["term"]] += row["row"]
    core = test.T.astype(float) @ y
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > 1e-6 * max(values.max(), 1e-12)
    q, s, _ = np.linalg.svd(y @ (vectors[:, good] / np.sqrt(values[good])), full_matrices=False)
    return q[:, :rank]


def indexes(
    docs: DataFrame, benchmark: DataFrame, rank: int = 64, block_bytes: int = 2 << 20,
    least_cosine: float = 0.35, share: float = 0.7, share_with_answer: float = 0.6, short: int = 8,
) -> Iterator[Index]:
    """An index per block of the benchmark."""
    bounded_batches(docs.sparkSession)
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    for b in range(blocks):
        block = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        texts = sorted({(r["item_id"] is None, r["item_id"] or 0, r["text"]) for r in block.toLocalIterator()})
        vocabulary: dict[bytes, int] = {}
        items = []
        for null, item_id, text in texts:
            raw = text.encode()
            ids = [vocabulary.setdefault(w, len(vocabulary)) for w in words(raw)]
            if ids:
                items.append((None if null else item_id, ids, min(answer_words(raw), len(ids))))
        if not items:
            continue
        df, n = _frequencies(docs, vocabulary)
        idf = np.log((n + 1) / (df + 1)) + 0.1
        longest = max(len(x[1]) for x in items)
        sizes = [8, 20, 32]
        while sizes[-1] < longest:
            sizes.append(sizes[-1] * 3 // 8 * 4)
        sizes = [s for below, s in itertools.pairwise([0, *sizes]) if any(below < len(x[1]) <= s for x in items)]
        index = Index(vocabulary, items, idf, np.zeros((0, 0)), np.zeros((0, 0)), tuple(sizes), least_cosine, share, share_with_answer, short)
        space = latent_space(docs, index, n, rank)
        index.space = space.astype(np.float32)
        latent = np.stack([(space[ids] * idf[ids][:, None]).sum(0) for _, ids, _ in items])
        index.latent = (latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)).astype(np.float32)
        yield index


def leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document and benchmark item that it holds: doc_id, item_id, common, cosine."""
    spark = docs.sparkSession
    text = docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string"))
    out = spark.createDataFrame([], SCHEMA)
    for index in indexes(docs, benchmark, **options):
        out = out.unionAll(text.mapInArrow(_searcher(spark.sparkContext.broadcast(index)), SCHEMA))
    return out


def _searcher(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_blocks(batches, "text", 4 << 20):
            docs = batch.column("doc_id")
            rows = [(docs[k].as_py(), *hit) for k, *hit in shared.value.search(as_bytes(batch.column("text")))]
            kinds, names = [pa.int64(), pa.int64(), pa.float64(), pa.float64()], ["doc_id", "item_id", "common", "cosine"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return run


def remove(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of docs that hold no benchmark item, unchanged."""
    spark, out = docs.sparkSession, docs
    for index in indexes(docs, benchmark, **options):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in in_blocks(batches, "text", 4 << 20):
                clean = np.ones(batch.num_rows, bool)
                clean[[hit[0] for hit in shared.value.search(as_bytes(batch.column("text")))]] = False
                yield batch.filter(pa.array(clean))

        out = out.mapInArrow(run, docs.schema)
    return out
