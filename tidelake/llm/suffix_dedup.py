"""Operator 3: removal of repeated substrings by a column-wise suffix structure.

A byte goes if a string of `WINDOW` bytes that covers it also starts anywhere else in the collection.

Construction. Inserting one symbol of every document per round takes as many rounds as the longest
document has bytes, and each round rewrites all files; so the construction is applied where it decides
anything, and to short strings:

1. Every window is given to the smallest k-gram hash in it (the leftmost of equal ones). Consecutive
   windows with the same k-gram form a segment of at most 2 * WINDOW - K bytes. Equal windows have
   equal k-grams at equal offsets, so only segments of the same k-gram can share a window. Rows of
   (k-gram hash, segment hash, place) are combined within a task, dealt by k-gram hash and sorted:
   segments met twice are repeats as a whole, k-grams met once are done.
2. One copy of every distinct segment is fetched where a k-gram has several. These form a collection
   of short strings lined up at their k-grams. The columns are inserted one by one, one symbol of every
   segment each: the order of the segments by their reversed prefixes (the positional Burrows-Wheeler
   transform) is updated by a stable sort on the new column, and the lengths of the common parts of
   neighbours by range maxima. Where neighbours agree on the last WINDOW columns, that window repeats.
   The method's sequential external files are replaced by columns in memory: the shuffle sorts the segments
   by k-gram, and all columns of a chunk of bounded size are one array; no column or BWT file is written.
3. A k-gram with more than `hot` distinct segments is not gathered: its segments are dealt anew, by the same
   steps, with longer k-grams (`GRAMS`), up to whole windows. Two equal windows agree on those too.

Defined results: a null text is empty; texts shorter than WINDOW stay; repeated rows repeat each other,
so all that is long enough in them goes; rows are told apart by 128 bits over id and text, so a repeated or
null id is no key; an empty table gives no rows; other columns are ignored (and kept by `remove`).
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm._common import as_bytes, bounded_batches, gathered, in_blocks, materialise, row_key

WINDOW = 200
#: Bytes of the k-grams that windows are dealt by; the longer ones where a shorter one is too common.
GRAMS = (64, 160, WINDOW)
_BUFFER = 1 << 20
_TABLE = np.random.default_rng(0x5EED).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIXERS = np.random.default_rng(0xFEED).integers(0, 1 << 63, 9, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOW = np.uint64((1 << 24) - 1)
FOUND = "kind int, kh long, sh long, k1 long, k2 long, place long"


def pack_place(start, length, anchor, several):
    """start (up to 2^40), length (9 bits), anchor's offset in the segment (8 bits), met twice (1 bit)."""
    return (start << 18) | (length << 9) | (anchor << 1) | several


def unpack_place(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return place >> 18, (place >> 9) & 511, (place >> 1) & 255, place & 1


def in_window(gram: int) -> int:
    """k-grams in a window."""
    return WINDOW - gram + 1


def segments(buffer: bytes, starts: np.ndarray, stops: np.ndarray, gram: int) -> tuple[np.ndarray, ...]:
    """Segments of the texts that lie at [starts, stops) of buffer: text number, start, stop, anchor, k-gram hash."""
    n, grams = len(buffer), in_window(gram)
    if n < WINDOW:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    h = _TABLE[np.frombuffer(buffer, np.uint8)]
    step = 1
    for mixer in _MIXERS[: gram.bit_length() - 1]:
        h = h[:-step] * mixer + h[step:]
        step *= 2
    if step < gram:
        h = h[: len(h) - (gram - step)] * _MIXERS[8] + h[gram - step :]
    h ^= h >> np.uint64(32)
    h *= _MIXERS[7]
    h ^= h >> np.uint64(29)
    low = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
    step = 1
    while 2 * step <= grams:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if step < grams:
        low = np.minimum(low[: len(low) - (grams - step)], low[grams - step :])
    windows = len(low)
    change = np.zeros(windows + 1, bool)
    change[1:windows] = low[1:] != low[:-1]
    change[0] = True
    last = np.maximum(stops - WINDOW + 1, starts)  # past a text's last window
    for cut in (starts, last):
        change[cut[cut < windows]] = True
    first = np.flatnonzero(change[:windows])
    past = np.append(first[1:], windows)
    text = np.searchsorted(starts, first, "right") - 1
    # empty texts share a start: take the one that holds the run
    good = (text >= 0) & (first < last[text])
    first, past, text = first[good], past[good], text[good]
    anchor = (low[first] & _LOW).astype(np.int64)
    return text, first, past + WINDOW - 1, anchor, h[anchor]


def find(docs: DataFrame, gram: int) -> DataFrame:
    """Kind 0: places known to repeat; kind 1: one row per distinct segment and task. Columns: FOUND.

    docs: k1, k2, text, and where only some ranges of the texts are meant, their places in `within`.
    """
    some = "within" in docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text", 12 << 20):  # the rows of one batch are combined before the shuffle
            found = find_in(as_bytes(batch.column("text")), gram, batch.column("within").to_pylist() if some else None)
            if found is None:
                continue
            kind, kh, sh, text, place = found
            at = pa.array(text)
            k1, k2 = batch.column("k1").take(at), batch.column("k2").take(at)
            columns = [pa.array(kind), pa.array(kh.view(np.int64)), pa.array(sh.view(np.int64)), k1, k2, pa.array(place)]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "kh", "sh", "k1", "k2", "place"])

    bounded_batches(docs.sparkSession)
    return docs.select("k1", "k2", "text", *(("within",) if some else ())).mapInArrow(run, FOUND)


def find_in(texts: list[bytes], gram: int = GRAMS[0], within: list[list[int]] | None = None) -> tuple[np.ndarray, ...] | None:
    """The rows of `find` for some texts, or for the ranges of them that `within` packs."""
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    parts: list[tuple] = []

    def take(buffer: bytes, numbers: list[int], starts: list[int], stops: list[int], bases: list[int]) -> None:
        text, first, past, anchor, kh = segments(buffer, np.array(starts), np.array(stops), gram)
        view = memoryview(buffer)
        sh = np.array([digest(view[a:b]) for a, b in zip(first.tolist(), past.tolist())], np.uint64)
        origin = (np.array(starts) - np.array(bases))[text]
        parts.append((kh, sh, np.array(numbers)[text], first - origin, past - first, anchor - first))

    def ranges() -> Iterator[tuple[int, int, bytes]]:
        """Number of the text, place in it, and bytes of every piece; long ones overlap so that each window lies in one."""
        step = _BUFFER - WINDOW + 1
        for i, text in enumerate(texts):
            for start, length in [(0, len(text))] if within is None else [(x >> 18, (x >> 9) & 511) for x in within[i]]:
                for at in range(start, start + length - WINDOW + 1, step):
                    yield i, at, text[at : min(at + _BUFFER, start + length)]

    pieces, numbers, starts, stops, bases, held = [], [], [], [], [], 0
    for i, at, piece in ranges():
        if held and held + len(piece) > _BUFFER:
            take(b"".join(pieces), numbers, starts, stops, bases)
            pieces, numbers, starts, stops, bases, held = [], [], [], [], [], 0
        pieces.append(piece)
        numbers.append(i)
        bases.append(at)
        starts.append(held)
        held += len(piece)
        stops.append(held)
    if pieces:
        take(b"".join(pieces), numbers, starts, stops, bases)
    if not parts:
        return None
    kh, sh, text, start, length, anchor = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((sh, kh))
    kh, sh, text, start, length, anchor = (x[order] for x in (kh, sh, text, start, length, anchor))
    new = np.ones(len(kh), bool)
    new[1:] = (kh[1:] != kh[:-1]) | (sh[1:] != sh[:-1])
    again = ~new
    several = again | np.append(again[1:], False)
    # every member of a group of two or more is a repeat; its first row also stands for it elsewhere
    a, b = np.flatnonzero(several), np.flatnonzero(new)
    rows = np.concatenate([a, b])
    kind = np.repeat(np.array([0, 1], np.int32), [len(a), len(b)])
    place = pack_place(start[rows], length[rows], anchor[rows], several[rows].astype(np.int64))
    return kind, kh[rows], sh[rows], text[rows], place


def settle(found: DataFrame) -> DataFrame:
    """Kind 0: further places that repeat; kind 1: one row per distinct segment of a k-gram that has several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "kh", "sh", "k1", "k2", "place"]
        held: list[pa.RecordBatch] = []
        open_several = False  # the k-gram held has been seen with other segments already

        def out(table: pa.Table, rest: bool) -> Iterator[pa.RecordBatch]:
            """Decide on all rows of a sorted table. rest: its last k-gram goes on, with rows of other segments."""
            kh, sh, place = (table.column(c).to_numpy() for c in ("kh", "sh", "place"))
            new_k = np.ones(len(kh), bool)
            new_k[1:] = kh[1:] != kh[:-1]
            new_s = new_k.copy()
            new_s[1:] |= sh[1:] != sh[:-1]
            group = np.cumsum(new_k) - 1
            distinct = np.bincount(group, new_s)
            if open_several and len(distinct):
                distinct[0] += 1
            if rest and len(distinct):
                distinct[-1] += 1
            again = ~new_s
            repeat = (again | np.append(again[1:], False)) & (place & 1 == 0)
            stands = new_s & (distinct[group] > 1)
            for kind, rows in ((0, repeat), (1, stands)):
                at = pa.array(np.flatnonzero(rows))
                if len(at):
                    got = table.take(at).set_column(0, "kind", pa.array(np.full(len(at), kind, np.int32)))
                    yield from got.select(names).to_batches()

        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                if batch.num_rows:
                    held.append(batch)
                if sum(b.num_rows for b in held) < 1 << 16:
                    continue
            if not held:
                continue
            table = pa.Table.from_batches(held)
            kh, sh = table.column("kh").to_numpy(), table.column("sh").to_numpy()
            if batch is None:
                yield from out(table, False)
                return
            cut = int(np.flatnonzero(kh == kh[-1])[0])
            if cut:
                yield from out(table.slice(0, cut), False)
                held, open_several = table.slice(cut).to_batches(), False
                continue
            # one k-gram fills the buffer: let go of all but its last segment, or of that one's repeats
            cut = int(np.flatnonzero(sh == sh[-1])[0])
            if cut:
                yield from out(table.slice(0, cut), True)
                held, open_several = table.slice(cut).to_batches(), True
            else:
                first = table.slice(0, 1)
                for kind_rows in (table.take(pa.array(np.flatnonzero(table.column("place").to_numpy() & 1 == 0))),):
                    yield from kind_rows.set_column(0, "kind", pa.array(np.zeros(kind_rows.num_rows, np.int32))).select(names).to_batches()
                marked = first.column("place").to_numpy() | 1
                held = first.set_column(first.column_names.index("place"), "place", pa.array(marked)).to_batches()

    rows = found.where("kind = 1").select("kind", "kh", "sh", "k1", "k2", "place")
    return rows.repartition("kh").sortWithinPartitions("kh", "sh").mapInArrow(run, FOUND)


def repeated_windows(texts: list[bytes], anchors: np.ndarray, gram: int = GRAMS[0]) -> np.ndarray:
    """Which windows of segments, lined up at their anchors, occur in another segment too.

    Returns a table by segment and window; window w of a segment starts at column w, its first byte is
    in column in_window(gram) - 1 - anchor.
    """
    m, width = len(texts), 2 * in_window(gram) + gram - 2
    first = in_window(gram) - 1 - anchors
    last = first + np.fromiter(map(len, texts), np.int64, m) - 1
    columns = np.full((m, width), 256, np.int16)
    for i, (text, at) in enumerate(zip(texts, first.tolist())):
        columns[i, at : at + len(text)] = np.frombuffer(text, np.uint8)
    columns = np.ascontiguousarray(columns.T)
    repeated = np.zeros((m, width - WINDOW + 1), bool)
    order, since = np.arange(m), np.zeros(m + 1, np.int32)  # since: first column from which a segment agrees with the one before it
    for k in range(width):
        symbols = columns[k][order]
        to = np.argsort(symbols, kind="stable")
        symbols = symbols[to]
        same = symbols[1:] == symbols[:-1]
        agree = since[to]
        agree[0] = k + 1
        agree[1:][~same] = k + 1
        far = np.flatnonzero(same & (to[1:] - to[:-1] > 1))
        if len(far):
            edges = np.stack([to[far] + 1, to[far + 1] + 1], 1).ravel()
            agree[far + 1] = np.maximum.reduceat(since, edges)[::2]
        order = order[to]
        w = k - WINDOW + 1
        if w >= 0:
            like = agree <= w
            like |= np.append(like[1:], False)
            hit = order[like]
            hit = hit[(first[hit] <= w) & (last[hit] >= k)]
            repeated[hit, w] = True
        since[:m] = agree
    return repeated


def _columns_of(batches: Iterator[pa.RecordBatch], chunk: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Rows (kh, k1, k2, place, seg) sorted by kh -> spans (k1, k2, start, stop)."""
    held: list[pa.RecordBatch] = []

    def out(table: pa.Table) -> pa.RecordBatch:
        place = table.column("place").to_numpy()
        start, _, anchor, _ = unpack_place(place)
        texts = table.column("seg").to_pylist()
        table_of = repeated_windows(texts, anchor, gram)
        edge = np.diff(np.pad(table_of.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        row, begin = np.nonzero(edge == 1)
        _, end = np.nonzero(edge == -1)
        origin = start[row] - (in_window(gram) - 1 - anchor[row])
        at = pa.array(row)
        columns = [table.column("k1").take(at).combine_chunks(), table.column("k2").take(at).combine_chunks(), pa.array(origin + begin), pa.array(origin + end - 1 + WINDOW)]
        return pa.RecordBatch.from_arrays(columns, names=["k1", "k2", "start", "stop"])

    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) < 2 * chunk:
                continue
        if not held:
            continue
        table = pa.Table.from_batches(held)
        kh = table.column("kh").to_numpy()
        edges = np.append(np.flatnonzero(np.diff(kh)) + 1, len(kh) if batch is None else 0)
        begin = 0
        while begin < len(kh):
            ends = edges[edges > begin]
            near = ends[ends <= begin + chunk]
            if not len(ends) or (batch is not None and not len(near) and len(kh) - begin < 2 * chunk):
                break
            end = int(near[-1] if len(near) else ends[0])
            yield out(table.slice(begin, end - begin))
            begin = end
        held = table.slice(begin).to_batches()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with the k-grams and places that are needed of them -> (kh, k1, k2, place, seg)."""
    kinds, names = [*[pa.int64()] * 4, pa.binary()], ["kh", "k1", "k2", "place", "seg"]
    for batch in in_blocks(batches, "text", 8 << 20):
        out: list[tuple] = []
        for k1, k2, text, needed in zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), as_bytes(batch.column("text")), batch.column("needs").to_pylist()):
            for need in needed:
                place = need["place"]
                start = place >> 18
                out.append((need["kh"], k1, k2, place, text[start : start + ((place >> 9) & 511)]))
                if len(out) >= 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


def repeated_spans(docs: DataFrame, chunk: int = 4096, hot: int = 16_384) -> DataFrame:
    """(k1, k2, spans): for each text that has any, the byte ranges (start, stop) that repeat; they may overlap.

    docs: k1, k2 (the key of a row), text. Rows equal in both have the same spans, once.
    hot: distinct segments of a k-gram up to which they are gathered; those of commoner ones are dealt by longer k-grams.
    """
    spans, source = [], docs
    begin, length = F.shiftright("place", 18), F.shiftright("place", 9).bitwiseAND(F.lit(511))
    # of rows with one key each has the same segments: they are taken from one
    one_of = lambda places: docs.join(places, ["k1", "k2"]).dropDuplicates(["k1", "k2"])
    for gram in GRAMS:
        found = materialise(find(source, gram), f"repeats-found-{gram}")
        settled = materialise(settle(found), f"repeats-settled-{gram}")
        for known in (found, settled):
            spans.append(known.where("kind = 0").select("k1", "k2", begin.alias("start"), (begin + length).alias("stop")))
        open_ = settled.where("kind = 1")
        common = open_.groupBy("kh").count().where(F.col("count") > hot).select("kh")
        common = materialise(common.coalesce(1), f"repeats-common-{gram}") if gram < WINDOW else None
        last = common is None or common.isEmpty()
        few = open_ if last else open_.join(common, "kh", "left_anti")
        needs = few.groupBy("k1", "k2").agg(F.collect_set(F.struct("kh", "place")).alias("needs"))
        pieces = one_of(needs).select("k1", "k2", "text", "needs").mapInArrow(_cut, "kh long, k1 long, k2 long, place long, seg binary")
        lined = materialise(pieces, f"repeats-segments-{gram}").repartition("kh").sortWithinPartitions("kh")
        spans.append(lined.mapInArrow(lambda b, gram=gram: _columns_of(b, chunk, gram), "k1 long, k2 long, start long, stop long"))
        if last:
            break
        many = open_.join(common, "kh", "left_semi").groupBy("k1", "k2").agg(F.collect_set("place").alias("within"))
        source = one_of(many).select("k1", "k2", "text", "within")
    every = functools.reduce(DataFrame.unionAll, spans)
    return every.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(*row_key(), F.col("doc_id").cast("long").alias("doc"), text.alias("text"), *more)


def kept_parts(text: bytes, spans: list[dict] | None) -> tuple[list[memoryview], int, int]:
    """What stays of a text, the bytes removed, and the number of maximal removed runs."""
    view, parts, removed, runs, at, end = memoryview(text), [], 0, 0, 0, -1
    for start, stop in sorted((s["start"], s["stop"]) for s in spans or ()):
        if start > end:
            parts.append(view[at:start])
            runs += 1
            removed += stop - start
            at = end = stop
        elif stop > end:
            removed += stop - end
            at = end = stop
    parts.append(view[at:])
    return parts, removed, runs


def _with_spans(docs: DataFrame, *more: str, **options) -> DataFrame:
    rows = keyed(docs, *more)
    spans = repeated_spans(keyed(docs).drop("doc"), **options)
    return rows.join(spans, ["k1", "k2"], "left").select("doc", "text", *more, "spans")


def measure(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_blocks(batches, "text", 8 << 20):
            rows = []
            for text, spans in zip(as_bytes(batch.column("text")), batch.column("spans").to_pylist()):
                parts, removed, runs = kept_parts(text, spans)
                sha = hashlib.sha256()
                for part in parts:
                    sha.update(part)
                rows.append((len(text), removed, runs, sha.hexdigest()))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), *columns], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    measured = _with_spans(docs, **options).mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return measured


def remove(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs with what repeats cut out of their texts.

    A character that loses some of its bytes loses all. A text that is left without repeats is as it was
    (a null stays null); n_chars, where there is one, follows the text.
    """
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_blocks(batches, "text", 8 << 20):
            out = []
            for text, spans in zip(as_bytes(batch.column("text")), batch.column("spans").to_pylist()):
                out.append(b"".join(kept_parts(text, spans)[0]).decode("utf-8", "ignore") if spans else text.decode())
            yield batch.drop_columns(["text", "spans"]).append_column("kept", pa.array(out, pa.string()))

    packed = docs.select("doc_id", "text", F.struct(*names).alias("row"))
    joined = _with_spans(packed, "row", **options).select("row", "text", "spans")
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("kept", T.StringType())])
    cut = joined.mapInArrow(run, schema)
    text = F.when(F.col("row.text").isNull(), F.lit(None)).otherwise(F.col("kept"))
    changed = {"text": text} | ({"n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)} if "n_chars" in names else {})
    return cut.select(*(changed[c].alias(c) if c in changed else F.col("row").getField(c).alias(c) for c in names))
