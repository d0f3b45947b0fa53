"""Repeated substrings against brute force."""

import random

import numpy as np
import pytest
from helpers import edge_docs, empty_docs, repeats

from tidelake.llm import suffix_dedup


def made(seed):
    rng = random.Random(seed)
    words = lambda n: " ".join(rng.choice(["the", "of", "foo", "barbaz", "éx", "quux", "lorem", "z" * rng.randint(1, 9)]) for _ in range(n))
    passages, lines, texts = [words(rng.randint(20, 120)) for _ in range(15)], [words(14) + "." for _ in range(3)], []
    for _ in range(120):
        parts = []
        for _ in range(rng.randint(1, 8)):
            r = rng.random()
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            parts.append(p[a : rng.randint(a, len(p))] if r < 0.35 else rng.choice(lines) if r < 0.6 else words(rng.randint(1, 60)))
        texts.append(" ".join(parts))
    return [*texts, "a" * 1500, "ab" * 700, "", "x" * 199, "y" * 200, "z" * 200 + "q" + "z" * 200, texts[3], texts[3], "é" * 400]


@pytest.mark.parametrize(("seed", "options"), [(0, {"chunk": 40}), (1, {"hot": 3, "chunk": 64}), (3, {"hot": 0})])
def test_measure(spark, seed, options):
    texts = made(seed)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.measure(df, **options).collect()}
    assert [got[i] for i in range(len(texts))] == repeats([t.encode() for t in texts])


@pytest.mark.parametrize("gram", suffix_dedup.GRAMS)
def test_buffers_and_pieces(monkeypatch, gram):
    """However texts are cut to buffers, each window lies in one segment."""
    texts = [t.encode() for t in made(4)]
    for size in (500, 700, 1 << 20):
        monkeypatch.setattr(suffix_dedup, "_BUFFER", size)
        kind, _, _, text, place = suffix_dedup.find_in(texts, gram)
        start, length, _, several = suffix_dedup.unpack_place(place)
        counts = [np.zeros(max(0, len(t) - 199), int) for t in texts]
        for t, a, n in zip(*(x[(kind == 0) | (several == 0)] for x in (text, start, length))):
            counts[t][a : a + n - 199] += 1
        assert all((c == 1).all() for c in counts)


@pytest.mark.parametrize("gram", suffix_dedup.GRAMS)
def test_columns_find_aligned_windows(gram):
    rng = np.random.default_rng(0)
    grams = suffix_dedup.in_window(gram)
    width = 2 * grams + gram - 2
    base = rng.integers(97, 100, width).astype(np.uint8)
    texts, anchors = [], []
    for _ in range(40):
        x = base.copy()
        x[rng.integers(0, width)] = 120
        a = rng.integers(0, grams)
        b = rng.integers(max(a + 200, grams - 1 + gram), width + 1)
        texts.append(x[a:b].tobytes())
        anchors.append(grams - 1 - a)
    got = suffix_dedup.repeated_windows(texts, np.array(anchors), gram)
    for i, (t, at) in enumerate(zip(texts, anchors)):
        first = grams - 1 - at
        for w in range(got.shape[1]):
            here = t[w - first : w - first + 200] if w >= first and w - first + 200 <= len(t) else None
            others = [u[w - f : w - f + 200] for j, (u, c) in enumerate(zip(texts, anchors)) if j != i for f in [grams - 1 - c] if w >= f and w - f + 200 <= len(u)]
            assert got[i, w] == (here is not None and here in others)


def test_edges(spark):
    edge = edge_docs(spark, long_words=3000)
    rows = suffix_dedup.measure(edge).collect()
    assert len(rows) == edge.count()
    by = {r.doc_id: r for r in rows if r.doc_id in (2, 3, 4, 5)}
    assert by[4].n_removed == by[4].n_bytes == by[5].n_removed and by[4].n_spans == 1 and by[2].n_bytes == by[3].n_bytes == 0
    kept = suffix_dedup.remove(edge)
    assert kept.columns == edge.columns and kept.count() == edge.count()
    long = [r for r in kept.collect() if r.doc_id in (4, 5)]
    assert [r.text for r in long] == ["", ""] and [r.n_chars for r in long] == [0, 0]
    assert sum(r.text is None for r in kept.collect()) == 2
    assert suffix_dedup.measure(empty_docs(spark)).count() == 0 and suffix_dedup.remove(empty_docs(spark)).count() == 0


def test_remove_keeps_whole_characters(spark):
    same = "é" * 150
    df = spark.createDataFrame([(1, "a" + same + "ü"), (2, "b" + same + "ö")], "doc_id long, text string")
    assert sorted(r.text for r in suffix_dedup.remove(df).collect()) == ["a", "b"]  # the last letters begin with a byte that repeats too
