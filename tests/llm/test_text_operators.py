"""Quality, packing, fingerprints, decontamination, language model, shards: against plain versions."""

import math
import random
import zlib

import numpy as np
import pytest
from helpers import components, crc_mod, edge_docs, empty_docs, phrases, simhash
from pyspark.sql import functions as F

from tidelake.llm import decontam, lm, lzprint, packing, quality, repair, simhash as sim
from tidelake.llm._common import BYTE_BPE, WORD_BPE, tokenizer_path
from tidelake.llm.tokenize import Encoder


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.collect()}


# -- encoding -------------------------------------------------------------------------------------


@pytest.mark.parametrize(("name", "spaces"), [(WORD_BPE, False), (BYTE_BPE, True)])
def test_encoding_is_the_library_s(name, spaces, texts):
    e = Encoder(tokenizer_path(name), spaces, keep=500)
    hard = ["a,'s -, don't x!'re  \n\n end \n", "—,a 1,2.3 ﬁ,x ×,÷ é,è é, x. !́ ≮a , a. b, c", " lead", "tail  ", "", "\t\n", "日本,語。a ³,² _a_ '", "'S'T don'ts' we'll,'ll", "a\n b", "a \nb", "<|endoftext|> x", "x\x01, y", ", a", "a .b. C, D"]
    rng = random.Random(4)
    for alphabet in ("ab é,.'!- 12\n—×É", "aB, .\n", "Ii̇ ,́Σσ"):
        hard += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    for t in hard + list(texts.values())[:60]:
        assert e.encode(t.encode()) == e.whole(t.encode()), t


# -- 1 quality ------------------------------------------------------------------------------------


def test_quality_held_out(spark, sf_dir, docs):
    big = sf_dir.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{big}/labels.parquet")
    got = quality.classify(spark.read.parquet(f"{big}/documents.parquet"), labels)
    rows = got.join(labels, "doc_id").collect()
    assert all(r.held_out == (crc_mod(r.doc_id, 5) == 0) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    held = [(r.score, r.quality) for r in rows if r.held_out]
    pairs = [(a > b) + 0.5 * (a == b) for a, x in held for b, y in held if x == 1 and y == 0]
    assert sum(pairs) / len(pairs) > 0.97
    assert sum((s >= 0.3) == q for s, q in held) / len(held) > 0.95


def test_scores_are_sums_of_table_entries(spark, sf_dir, docs, texts):
    """The registered query against the tables, looked up one entry at a time."""
    from bisect import bisect_right

    from tidelake.llm.queries import queries

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    m = quality.train(docs, labels)
    for r in queries()["op1_quality"](spark, sf_dir).collect():
        x = [float(np.float32(v)) for v in quality.features(texts[r.doc_id].encode())]
        total = m.base + sum(t[bisect_right(e.tolist(), v)] for t, e, v in zip(m.tables, m.edges, x))
        total += sum(t[bisect_right(a.tolist(), x[i]), bisect_right(b.tolist(), x[j])] for (i, j), (a, b), t in zip(m.pairs, m.pair_edges, m.pair_tables))
        assert r.score == pytest.approx(1 / (1 + math.exp(-total)), rel=1e-6)


def test_quality_edges(spark):
    labels = spark.createDataFrame([(1, 1, None), (1, 0, None), (4, 0, None), (5, None, None), (None, 1, None), (6, 1, 0)], "doc_id long, quality int, toxic int")
    edge = edge_docs(spark)
    got = quality.classify(edge, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == edge.count()
    kept = quality.keep_good(edge, labels, threshold=0.0)
    assert kept.schema == edge.schema and kept.count() == edge.count()
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.classify(edge, none).collect()} == {0.5}
    assert quality.classify(empty_docs(spark), labels).count() == 0 and quality.keep_good(empty_docs(spark), labels).count() == 0


def test_quality_model_is_fitted_on_every_labelled_row(spark):
    """More labels than the 40,000 of an earlier sample: the model is that of all rows."""
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choices(["an", "apple,", "Is", "red.", "#7", "http"], k=rng.randint(1, 6)))) for i in range(56_000)]
    marks = [(i, int("apple" in t) ^ int(rng.random() < 0.1)) for i, t in rows]
    mine = [i for i, _ in rows if crc_mod(i, 5)]
    assert len(mine) > 44_000
    x, y = np.array([quality.features(rows[i][1].encode()) for i in mine], np.float32), np.array([marks[i][1] for i in mine], float)
    order = np.lexsort((y, *x.T[::-1]))
    want = quality.fit(x[order], y[order])
    got = quality.train(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int"))
    assert got.base == want.base and all((a == b).all() for a, b in zip(got.tables + got.pair_tables, want.tables + want.pair_tables))


def test_quality_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 4)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9 and (1, 0) in model.pairs


# -- 2 packing ------------------------------------------------------------------------------------


def test_differencing():
    rng = random.Random(0)
    for _ in range(50):
        items, k = [rng.randint(1, 500) for _ in range(rng.randint(0, 60))], rng.randint(1, 9)
        windows = packing.differencing(items, k)
        assert len(windows) == k and sorted(i for w in windows for i in w) == list(range(len(items)))
    items = [rng.randint(1, 500) for _ in range(200)]
    sums = [sum(items[i] for i in w) for w in packing.differencing(items, 10)]
    assert max(sums) - min(sums) < 60
    assert all(sum([9, 9, 9][i] for i in w) <= 10 for w in packing.deal([9, 9, 9], 10)) and len(packing.deal([9, 9, 9], 10)) == 3


def check_packing(pieces, texts):
    e = Encoder(tokenizer_path(WORD_BPE), False)
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for i, text in texts.items():
        ids = e.whole(text.encode()) + b"\1\0\0\0"
        at = 0
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) // 4 and p.ids_crc32 == zlib.crc32(ids[4 * at : 4 * (at + p.length)])
            at += p.length
        assert 4 * at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
    return 1 - sum(p.length for ps in by_sequence.values() for p in ps) / (2048 * len(by_sequence))


def test_packing(docs, texts):
    assert check_packing(packing.pack(docs.coalesce(1)).collect(), texts) < 0.03


def test_packing_edges(spark):
    edge = edge_docs(spark)
    pieces = packing.pack(edge).collect()
    tokens = {(p.doc_id, p.doc_tokens) for p in pieces}
    assert (2, 1) in tokens and (3, 1) in tokens and (-7, 1) in tokens and (None, 1) in tokens
    assert sum(p.length for p in pieces if p.doc_id == 4) == sum(p.length for p in pieces if p.doc_id == 5) == next(p.doc_tokens for p in pieces if p.doc_id == 4)
    assert packing.pack(empty_docs(spark)).count() == 0


# -- 4 SimHash ------------------------------------------------------------------------------------


def test_fingerprints():
    rng = random.Random(0)
    for _ in range(200):
        t = " ".join(rng.choice(["The", "a", "É x", "b\x1fc", "\t", "x" * rng.randint(1, 60)]) for _ in range(rng.randint(0, 12))).encode()
        assert sim.fingerprint(t) == simhash(t)


def test_bit_sliced_distances():
    rng = np.random.default_rng(1)
    f = rng.integers(0, 2**64, 700, dtype=np.uint64)
    f[350:] = f[:350]
    for i in range(350, 700):
        for b in rng.choice(64, rng.integers(0, 8), replace=False):
            f[i] ^= np.uint64(1) << np.uint64(b)
    for radius in (0, 1, 3, 4, 6):
        q, lane = sim.within(f[:100], sim.bit_planes(f), len(f), radius)
        assert set(zip(q.tolist(), lane.tolist())) == {(i, j) for i in range(100) for j in range(700) if int(f[i] ^ f[j]).bit_count() <= radius}


def links_of(spark, fps, **options):
    df = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in set(fps)], "fp long")
    from tidelake.llm.components import connected_components

    found = {r.node: r.root for r in connected_components(sim.links(df, **options)).collect()}
    return found


def test_group_keys():
    """Fingerprints within the radius share a key, and keys of different choices are different."""
    rng = np.random.default_rng(5)
    f = rng.integers(0, 2**64, 400, dtype=np.uint64)
    near = f.copy()
    for i in range(400):
        for b in rng.choice(64, 4, replace=False):
            near[i] ^= np.uint64(1) << np.uint64(b)
    for groups in (6, 7, 8, 10):
        a, b = ([key for _, key in sim.group_keys(x, 4, groups)] for x in (f, near))
        assert np.any([x == y for x, y in zip(a, b)], axis=0).all() and len(a) == math.comb(groups, 4)
        assert len(np.unique([int(x[0]) for x in a])) == len(a)
    assert [sim.groups_for(n, 4, 512) for n in (0, 10**9, 10**10, 10**12)] == [6, 6, 7, 8]


@pytest.mark.parametrize(("block", "groups"), [(8, None), (64, 8), (512, 6)])
def test_links_lose_nothing(spark, block, groups):
    """Groups around common centres, far larger than a block."""
    rng = random.Random(block)
    centres = [rng.getrandbits(64) for _ in range(4)]
    fps = list({c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for c in centres for _ in range(150)} | {rng.getrandbits(64) for _ in range(150)})
    found = links_of(spark, fps, block=block, groups=groups)
    signed = [int(np.uint64(x).view(np.int64)) for x in fps]
    first = components(fps)
    groups = {}
    for i, g in enumerate(first):
        groups.setdefault(g, []).append(signed[i])
    for members in groups.values():
        if len(members) > 1:
            assert {found[m] for m in members} == {min(members)}
        else:
            assert members[0] not in found


def test_near_duplicates(docs, texts):
    got = {r.doc_id: r for r in sim.near_duplicates(docs).collect()}
    ids = sorted(texts)
    fps = [simhash(texts[i].encode()) for i in ids]
    assert [int(got[i].fingerprint, 16) for i in ids] == fps
    assert [got[i].component_id for i in ids] == [ids[k] for k in components(fps)]
    kept = sim.keep_one(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r.component_id for r in got.values()}) and kept.columns == docs.columns


def test_near_duplicates_edges(spark):
    edge = edge_docs(spark)
    rows = sim.near_duplicates(edge).collect()
    assert len(rows) == edge.count()
    empty = [r.component_id for r in rows if r.fingerprint == "0" * 16]
    assert len(empty) == 4 and set(empty) == {-7}
    assert {r.component_id for r in rows if r.doc_id in (4, 5)} == {4}
    kept = sim.keep_one(edge)
    # two unlike texts share the number 1, two the null one; each component keeps one row
    ids = [r.doc_id for r in kept.collect()]
    assert kept.schema == edge.schema and ids.count(1) == 2 and ids.count(None) == 1 and len(ids) == len({r.fingerprint for r in rows})
    assert sim.near_duplicates(empty_docs(spark)).count() == 0 and sim.keep_one(empty_docs(spark)).count() == 0


def test_one_row_of_each_component_stays_whatever_its_id(spark):
    """Unlike texts under one id or none all stay; copies under other ids go; of equal rows one stays."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [(5, a, "1"), (5, b, "2"), (None, c, "3"), (None, d, "4"), (7, a, "5"), (None, b, "6"), (9, c, "7"), (5, a, "8")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = sorted(((r.doc_id, r.text) for r in sim.keep_one(docs).collect()), key=lambda x: x[1])
    assert kept == [(5, a), (5, b), (9, c), (None, d)]


# -- 5 decontamination ----------------------------------------------------------------------------


def test_leaks(spark, sf_dir, docs, texts):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = {r.item_id: decontam.words(r.text.encode()) for r in benchmark.collect()}
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(docs, benchmark).collect()}
    flat = {i: b" " + b" ".join(decontam.words(t.encode())) + b" " for i, t in texts.items()}
    want = {(d, i) for d, t in flat.items() for i, w in items.items() if b" " + b" ".join(w) + b" " in t}
    assert want and want <= got and len(got - want) <= 1
    kept = decontam.remove(docs, benchmark)
    assert {r.doc_id for r in kept.collect()} == set(texts) - {d for d, _ in got} and kept.schema == docs.schema


def test_paraphrases_and_shuffles(spark, sf_dir, docs):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rng, rows = random.Random(1), []
    for r in benchmark.collect():
        w = [x.decode() for x in decontam.words(r.text.encode())]
        rows.append((r.item_id, "Some words first " + " ".join(x for x in w if rng.random() > 0.12) + " and some after"))
        rows.append((1000 + r.item_id, " ".join(rng.sample(w, len(w)))))
    both = spark.createDataFrame(rows, "doc_id long, text string").unionByName(docs.select(F.col("doc_id") + 10_000, "text").toDF("doc_id", "text"))
    got = decontam.leaks(both, benchmark).where("doc_id < 10000").collect()
    n = benchmark.count()
    assert sum(r.doc_id == r.item_id for r in got) >= 0.9 * n and not [r for r in got if r.doc_id >= 1000]


def test_common_subsequence():
    rng = random.Random(0)
    for _ in range(100):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(1, 20))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert decontam.common(a, b) == t[-1][-1]


def test_leaks_edges(spark):
    edge = edge_docs(spark)
    items = spark.createDataFrame([(1, "brown fox jumps over the lazy dog today"), (1, "brown fox jumps over the lazy dog today"), (2, None), (3, " . "), (None, "quick brown fox")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(edge, items).collect()}
    assert (1, None) in got and (1, 1) in got and {d for d, _ in got} == {1}
    assert decontam.remove(edge, items).count() == edge.count() - 2
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.leaks(edge, none).count() == 0 and decontam.remove(edge, none).count() == edge.count()
    assert decontam.leaks(empty_docs(spark), items).count() == 0
    assert {(r.doc_id, r.item_id) for r in decontam.leaks(edge, items, block_bytes=30).collect()} == got


def test_leaks_among_words_outside_the_benchmark(spark):
    """An item of common words stands wherever it lies word for word, however rare the words around it are."""
    rng = random.Random(3)
    item = "the of and a to in is it that was for on are as with his they at be this from".split()
    rows = []
    for i in range(80):
        around = [f"x{i}y{k}" for k in range(90)]
        middle = item if i < 5 else rng.sample(item, len(item))
        rows.append((i, " ".join(around[:44] + middle + around[44:])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = decontam.leaks(docs, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).collect()
    assert {r.doc_id for r in got} == set(range(5))


def plain_leaks(texts, items, share=0.7, share_with_answer=0.6):
    """Every window of every size against every item, by common subsequence alone."""
    found = set()
    for d, text in texts.items():
        w = decontam.words(text.encode())
        for i, item in items.items():
            words = decontam.words(item.encode())
            n, answer = len(words), min(decontam.answer_words(item.encode()), len(words))
            for k in range(0, max(1, len(w) - n // 2), max(1, n // 4)):
                near = w[k : k + 2 * n]
                got = decontam.common(words, near) / n
                if got >= share or (got >= share_with_answer and decontam.common(words[-answer:], near) >= 0.8 * answer):
                    found.add((d, i))
                    break
    return found


def test_recall_against_all_pairs(spark, sf_dir, docs, texts):
    """Items with words dropped, replaced and moved, put into real documents: nearly all that all-pairs comparison finds."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = {r.item_id: r.text for r in benchmark.collect() if len(decontam.words(r.text.encode())) >= 8}
    rng, rows = random.Random(8), {}
    hosts = [t for t in texts.values() if 40 < len(t.split()) < 400]
    for k in range(160):
        i = rng.choice(sorted(items))
        w = [x.decode() for x in decontam.words(items[i].encode())]
        if k % 4 == 1:
            w = [x for x in w if rng.random() > 0.15]
        elif k % 4 == 2:
            w = [f"z{rng.randint(0, 9999)}" if rng.random() < 0.2 else x for x in w]
        elif k % 4 == 3:
            at = rng.randrange(len(w))
            w = w[at:] + w[:at]
        host = rng.choice(hosts).split()
        at = rng.randrange(len(host))
        rows[k] = " ".join(host[:at] + w + host[at:])
    want = plain_leaks(rows, items)
    both = spark.createDataFrame(list(rows.items()), "doc_id long, text string").unionByName(docs.select((F.col("doc_id") + 10_000).alias("doc_id"), "text"))
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(both, benchmark).collect() if r.doc_id < 10_000}
    assert len(want) > 100 and len(want & got) >= 0.95 * len(want)


def test_long_texts_are_cut_between_words(monkeypatch):
    item = [b"w%d" % i for i in range(30)]
    vocabulary = {w: i for i, w in enumerate(item)}
    index = decontam.Index(vocabulary, [(1, list(range(30)), 5)], np.ones(30), np.eye(30, 8, dtype=np.float32), np.ones((1, 8), np.float32), (32,), -2.0, 0.7, 0.6, 8)
    text = b" ".join([b"x" * 70, *[b"y%d" % i for i in range(200)], *item, b"z" * 300, *[b"y"] * 500, *item[:20], b"v"])
    whole = index.ids(text)
    hits = index.search([b"", text, b"x", b" ".join(item)])
    monkeypatch.setattr(decontam, "_SLICE", 64)
    monkeypatch.setattr(decontam, "_BLOCKS", 16)
    monkeypatch.setattr(decontam, "_RUN", 1)
    assert (index.ids(text) == whole).all() and len(whole) == len(decontam.words(text))
    assert [h[:2] for h in hits] == [(1, 1), (3, 1)] == [h[:2] for h in index.search([b"", text, b"x", b" ".join(item)])]


@pytest.mark.parametrize("decoys", [20, 200])
def test_leaks_behind_many_shuffled_copies(spark, sf_dir, decoys):
    """Documents that hold an item word for word behind shuffled copies of it: all are found."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rng, rows = random.Random(2), []
    for r in benchmark.collect():
        w = [x.decode() for x in decontam.words(r.text.encode())]
        rows.append((r.item_id, " ".join(x for _ in range(decoys) for x in rng.sample(w, len(w))) + " " + " ".join(w)))
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(spark.createDataFrame(rows, "doc_id long, text string"), benchmark).collect()}
    assert all((i, i) in got for i, _ in rows)


def test_a_leak_behind_decoys(spark):
    """A long document with shuffled copies of an item first; the passage itself, with words replaced, comes later."""
    rng = random.Random(5)
    item = [f"w{i}" for i in range(30)]
    passage = [f"other{i}" if i % 5 == 2 else w for i, w in enumerate(item)]
    filler = lambda n: [f"x{rng.randint(0, 500)}" for _ in range(n)]
    decoys = [w for _ in range(12) for w in [*rng.sample(item, len(item)), *filler(80)]]
    rows = [(1, decoys + passage + filler(200)), (2, decoys), *((k, filler(200)) for k in range(3, 40))]
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in rows], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(item)), *((k, " ".join(filler(30))) for k in range(2, 6))], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontam.leaks(docs, items).collect()] == [(1, 1)]


def test_all_documents_shape_the_latent_space(spark):
    """More documents than a sample of 20,000 had: the space is that of a plain decomposition of all rows."""
    rng = random.Random(4)
    words, weights = ["a", "b", "c", "d", "e"], [9, 7, 5, 3, 2]
    texts = [" ".join([f"u{i}", *rng.choices(words, weights, k=rng.randint(2, 6))]) for i in range(40_000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    items = spark.createDataFrame([(1, " ".join(words)), (2, "a a b")], "item_id long, text string")
    (index,) = decontam.indexes(docs, items)
    rows = np.zeros((len(texts) + 2, len(words)))
    for x, t in zip(rows, [*texts, " ".join(words), "a a b"]):
        for w in t.split():
            if w.encode() in index.vocabulary:
                x[index.vocabulary[w.encode()]] += index.idf[index.vocabulary[w.encode()]]
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    weight = np.array([1.0] * len(texts) + [len(texts) / 2 / 4] * 2)
    _, axes = np.linalg.eigh(rows.T @ (rows * weight[:, None]))
    assert np.abs(index.space.T @ axes[:, ::-1]) == pytest.approx(np.eye(len(words)), abs=1e-3)


# -- 6 phrase fingerprints ------------------------------------------------------------------------


def test_phrase_fingerprints(docs, texts, monkeypatch):
    ids = sorted(texts)
    got = {r.doc_id: r for r in lzprint.with_neighbours(docs).collect()}
    import hashlib

    for i, d in enumerate(ids):
        t, following = texts[d], texts[ids[(i + 1) % len(ids)]]
        q = len(t) // 4
        edited = t[: len(t) - q] + following[:q]
        assert got[d].n_chars == len(t) and got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[d].near_next == lzprint.likeness(bytes.fromhex(got[d].fingerprint), bytes.fromhex(got[ids[(i + 1) % len(ids)]].fingerprint))
        assert 0 <= got[d].near_edited <= 1
    assert sum(r.near_edited > r.near_next for r in got.values()) > 0.97 * len(ids)


def test_likeness_is_that_of_the_phrase_sets(spark, sf_dir, texts):
    """near_edited and near_next of the registered query against the true share of common phrases."""
    from tidelake.llm.queries import queries

    def share(a, b):
        x, y = phrases(a), phrases(b)
        return len(x & y) / len(x | y) if x or y else 1.0

    ids, off = sorted(texts), []
    for r in queries()["op6_lz_fingerprint"](spark, sf_dir).collect():
        t, following = texts[r.doc_id], texts[ids[(ids.index(r.doc_id) + 1) % len(ids)]]
        q = len(t) // 4
        off += [(r.near_edited - share(t, t[: len(t) - q] + following[:q]), len(t)), (r.near_next - share(t, following), min(len(t), len(following)))]
    # 128 bins estimate a share within some hundredths, short texts with few phrases less well
    assert np.mean([abs(d) for d, _ in off]) < 0.05 and np.mean([abs(d) < 0.15 for d, n in off if n > 400]) > 0.97


@pytest.mark.parametrize("n", [1, 2, 7, 64])
def test_parts_by_bisection(spark, n):
    rng = random.Random(n)
    cuts = sorted(rng.sample(range(-1000, 1000), n - 1))
    keys = [rng.randint(-1100, 1100) for _ in range(200)] + cuts
    got = spark.createDataFrame([(k,) for k in keys], "key long").select("key", lzprint._cuts_below(cuts, F.col("key")).alias("part")).collect()
    assert all(r.part == sum(c < r.key for c in cuts) for r in got)


@pytest.mark.parametrize("renew", [1 << 20, 7])
def test_phrases_are_a_parse(monkeypatch, renew):
    monkeypatch.setattr(lzprint, "RENEW", renew)
    rng = random.Random(0)
    for _ in range(150):
        a, b = ("".join(rng.choice("abé ") for _ in range(rng.randint(0, 300))) for _ in range(2))
        edited, own, new = lzprint.both_prints(a, b)
        # the same texts parsed alone
        assert own == lzprint.both_prints(a, "zz")[1]
        assert new == lzprint.both_prints(edited, "")[1]
        if renew > 300:
            parse = lzprint.Parse()
            parse.feed(a)
            assert len(set(parse.phrases)) == len(phrases(a))


def test_phrase_fingerprint_edges(spark):
    edge = edge_docs(spark)
    rows = lzprint.with_neighbours(edge).collect()
    assert len(rows) == edge.count()
    assert len({r.fingerprint for r in rows if r.doc_id in (4, 5)}) == 1 and {r.fingerprint for r in rows if r.n_chars == 0} == {"00" * lzprint.BINS}
    assert lzprint.with_neighbours(empty_docs(spark)).count() == 0
    one = lzprint.with_neighbours(spark.createDataFrame([(3, "abc")], "doc_id long, text string")).first()
    assert one.near_next == 1.0 and one.near_edited == 1.0


# -- 7 language model -----------------------------------------------------------------------------


def plain_base(rows):
    counts = {}
    for i, t in rows:
        if crc_mod(i, 10):
            for w in lm.tokens((t or "").encode()):
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    return counts, n, v


def test_base_scores(docs, texts):
    counts, n, v = plain_base(texts.items())
    for r in lm.score_texts(docs).collect():
        t = lm.tokens(texts[r.doc_id].encode())
        base = sum(math.log10((counts.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(w in counts for w in t), n) and r.base_score == pytest.approx(base, rel=1e-9)
        assert r.held_out == (crc_mod(r.doc_id, 10) == 0)


def test_tree_beats_the_base_and_sums_to_one(spark):
    rng = random.Random(0)
    words = [f"w{i}" for i in range(30)]
    rows = []
    for i in range(600):
        t = []
        for _ in range(40):
            t += ["one", "two", "three"] if rng.random() < 0.3 else [rng.choice(words)]
        rows.append((i, " ".join(t)))
    got = lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > 0.85 * sum(r.base_score for r in held)
    # a tree of its own: probabilities of all next words after any history sum to one
    hashes = {w: lm.word_hash(w) for w in [b"a", b"b", b"c", lm.END]}
    text = [rng.choice([b"a", b"b", b"b", b"c"]) for _ in range(50)] + [b"a", b"b", b"a", b"b"] * 200
    seq = np.array([hashes[w] for w in text], np.uint64)
    place = np.arange(len(seq))
    grams = lm.gram_hashes(seq, place)
    table = {"h": [], "order": [], "context": [], "shorter": [], "n": []}
    for n, h in enumerate(grams):
        keys, first, counts = np.unique(h[h != 0], return_index=True, return_counts=True)
        at = np.flatnonzero(h)[first]
        table["h"].append(keys)
        table["order"].append(np.full(len(keys), n + 1))
        table["context"].append(grams[n - 1][at - 1] if n else np.zeros(len(at), np.uint64))
        table["shorter"].append(grams[n - 1][at] if n else np.zeros(len(at), np.uint64))
        table["n"].append(counts)
    counts = {w: text.count(w) for w in hashes}
    tree = lm.grow({k: np.concatenate(v) for k, v in table.items()}, len(text), sum(c > 0 for c in counts.values()), 0, divergence=2.0)
    assert len(tree.contexts)
    for history in ([b"a"], [b"a", b"b"], [b"b", b"a", b"b"], [b"c", b"c"]):
        total = 0.0
        for w in (b"a", b"b", b"c", b"unseen"):
            x = np.array([hashes.get(v, lm.word_hash(v)) for v in [*history, w]], np.uint64)
            c = np.array([counts.get(v, 0) for v in [*history, w]])
            total += 10 ** tree.score(x, np.arange(len(x)), c)[1][-1]
        assert total == pytest.approx(1, abs=1e-9)


def test_lm_edges(spark):
    edge = edge_docs(spark)
    rows = lm.score_texts(edge).collect()
    assert len(rows) == edge.count() and all(math.isfinite(r.score) and r.score <= 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3, -7)} == {1}
    assert lm.score_texts(empty_docs(spark)).count() == 0
    held = next(i for i in range(100) if crc_mod(i, 10) == 0)
    alone = lm.score_texts(spark.createDataFrame([(held, "x y")], "doc_id long, text string")).first()
    assert (alone.train_tokens, alone.n_known, alone.score, alone.base_score) == (0, 0, 0, 0)


def plain_tree(rows, least, divergence=8.0, discount=0.75):
    """A suffix tree over words kept in dictionaries: score of every text."""
    train = [lm.tokens((t or "").encode()) for i, t in rows if crc_mod(i, 10)]
    grams = {}
    for t in train:
        for k in range(len(t)):
            for n in range(1, lm.ORDER + 2):
                if k >= n - 1:
                    g = tuple(t[k - n + 1 : k + 1])
                    grams[g] = grams.get(g, 0) + 1
    words = {g[0]: c for g, c in grams.items() if len(g) == 1}
    total, once = sum(words.values()), sum(c == 1 for c in words.values())
    unseen = min(max((once + 0.5) / (total + 1), 1e-9), 0.5)
    kept_grams = {g: c for g, c in grams.items() if c >= least}
    below = {}
    for g, c in kept_grams.items():
        if len(g) > 1 and g[:-1] in kept_grams and g[1:] in kept_grams:
            below.setdefault(g[:-1], []).append((g, c))
    tree = {}
    for context, found in below.items():
        n = kept_grams[context]
        gain = rest = low_rest = 0.0
        for g, c in found:
            low = kept_grams[g[1:]] / (total if len(g) == 2 else kept_grams.get(g[1:-1], total))
            gain += c / n * math.log(c / n / low)
            rest, low_rest = rest + c / n, low_rest + low
        rest, low_rest = max(1 - rest, 0), max(1 - low_rest, 1e-12)
        gain += rest * math.log(max(rest, 1e-12) / low_rest) if rest > 0 else 0
        if n * gain >= divergence:
            given = {g[-1]: (c - discount) / n for g, c in found}
            tree[context] = given, 1 - sum(given.values())
    scores = {}
    for i, text in rows:
        t, score = lm.tokens((text or "").encode()), 0.0
        for k, w in enumerate(t):
            p = (1 - unseen) * words[w] / total if w in words else unseen
            for n in range(1, lm.ORDER + 1):
                context = tuple(t[k - n : k]) if k >= n else None
                if context in tree:
                    given, left = tree[context]
                    p = given.get(w, 0.0) + left * p
            score += math.log10(p)
        scores[i] = score
    return scores, len(tree)


@pytest.mark.parametrize("partitions", [1, 5, 40])
def test_scores_are_those_of_a_plain_tree(spark, docs, texts, partitions, monkeypatch):
    """The registered query's operator, whatever the partitions and blocks, against dictionaries."""
    want, states = plain_tree(list(texts.items()), 4)
    got = lm.score_texts(docs.repartition(partitions), block_bytes=(14 << 20) // partitions**2)
    assert states > 20
    for r in got.collect():
        assert r.score == pytest.approx(want[r.doc_id], rel=1e-9)


def test_lm_numbers_of_any_width():
    ids = np.array([0, 1, 255, 256, 70_000, 2**24 - 1], np.int32)
    for width in (3, 4):
        assert (lm.unpacked(ids.view(np.uint8).reshape(-1, 4)[:, :width].tobytes(), width) == ids).all()
    assert lm.runs_of(np.array([3, 3, 4, 3])) == [(0, 2), (2, 3), (3, 4)] and lm.unpacked(np.array([2**30], "<i4").tobytes(), 4)[0] == 2**30


def test_lm_counts_go_packed_and_come_back_without_hashes():
    """What fills the disk: n-grams as differences of hashes, answers as a number for each that was sent."""
    rng = np.random.default_rng(1)
    keys = lm.distinct(rng.integers(0, 1 << 63, 20_000).astype(np.uint64) << np.uint64(1))
    assert (lm.hashes(lm.packed_hashes(keys)) == keys).all() and len(lm.packed_hashes(keys)) < 8 * len(keys)
    assert (lm.hashes(lm.packed_hashes(keys[:1])) == keys[:1]).all() and len(lm.hashes(lm.packed_hashes(keys[:0]))) == 0
    counts = rng.integers(0, 3, len(keys))
    assert (lm.numbers(lm.packed(counts)) == counts).all()
    sent = [(b, lm.bound(lm.packed_hashes(k), lm.packed(n))) for b, k, n in ((1, keys, counts), (2, keys[::2], 2 * counts[::2]))]
    one, two = (lm.numbers(x) for _, x in lm.add_grams(sent, 4))
    total = counts + 2 * np.where(np.arange(len(keys)) % 2 == 0, counts, 0)
    assert (one >> 1 == np.where(total >= 4, total, 0)).all() and (two >> 1 == (one >> 1)[::2]).all()
    assert ((one & 1) == (one > 0)).all() and not (two & 1).any()  # the first that met an n-gram owns it
    assert sum(map(len, (lm.packed(one), lm.packed(two)))) < 2 * len(keys)


def test_lm_candidates_met_once_in_each_block(spark):
    """A phrase that no block holds twice is in the tree all the same."""
    rng = random.Random(2)
    rows = [(i, " ".join(["left", "right", "up"] + rng.sample([f"w{k}" for k in range(40)], 20))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one = {r.doc_id: r.score for r in lm.score_texts(docs.coalesce(1)).collect()}
    many = {r.doc_id: r.score for r in lm.score_texts(docs.repartition(4), block_bytes=1).collect()}
    assert all(many[k] == pytest.approx(v, rel=1e-9) for k, v in one.items())


def test_rare_phrases_of_a_large_text_are_in_the_tree(spark):
    """Over 1.5 million tokens a phrase met a few times is in the tree, as among few."""
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices("a b c d e f g h i j".split(), k=60_000))) for i in range(30)]
    rows += [(i, "red green blue sky over the sea") for i in [i for i in range(100, 200) if crc_mod(i, 10)][:5]]
    want, _ = plain_tree(rows, 4)
    got = lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert got[0].train_tokens > 1_300_000
    for r in got:
        assert r.score == pytest.approx(want[r.doc_id], rel=1e-9)


# -- 9 shards -------------------------------------------------------------------------------------


def test_texts_encoded_together_and_byte_one():
    """A batch gives what the library gives for each text; byte 1, which marks units inside, is text like any other."""
    texts = [b"", b"a \x01b", b"\x01", b"one, two.\nthree", b"  loose", b"one", b"a \x01, b", "d\u00e9j\u00e0 vu, (486)\nA.".encode(), b", b", b"tail "]
    for name, spaces in ((BYTE_BPE, True), (WORD_BPE, False)):
        e = Encoder(tokenizer_path(name), spaces)
        assert e.encode_all(texts) == [e.encode(x) for x in texts] == [e.whole(x) for x in texts]


def test_pairs_are_grouped_alike_in_one_number_and_by_sorting_places():
    """Symbols past 16 bits go the fast way too; those that do not fit in 64 bits with their place go the other."""
    rng = np.random.default_rng(3)
    left, right = (rng.integers(0, 100_000, 5000).astype(np.uint32) % 90 + 70_000 for _ in range(2))
    at = np.sort(rng.choice(1 << 20, 5000, replace=False))
    fast, slow = (repair._grouped(left, right, at, half, low) for half, low in ((17, 21), (32, 21)))
    assert (fast[1] == slow[1]).all() and (fast[0] >> np.uint64(17) == slow[0] >> np.uint64(32)).all() and fast[1].tolist() != at.tolist()
    # runs of one symbol: every second place of each is replaced
    symbols = np.array([*[1] * 7, 2, *[1] * 4, 3, *[1] * 5, 0], np.uint32)
    left_over, rules, _ = repair.replace_pairs(symbols, 4, 6)
    assert rules.tolist() == [[1, 1]] and left_over.tolist() == [4, 4, 4, 1, 2, 4, 4, 3, 4, 4, 1, 0]


def test_shards_round_trip(docs, texts, tmp_path):
    e = Encoder(tokenizer_path(BYTE_BPE), True)
    shards = repair.write_shards(docs, shard_tokens=20_000)
    got = {r.doc_id: r for r in repair.read_shards(shards).collect()}
    at = 0
    for i in sorted(texts):
        ids = e.whole(texts[i].encode()) + b"\0\0\0\0"
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids) // 4, zlib.crc32(ids))
        at += len(ids) // 4
    repair.export_shards(shards, f"file://{tmp_path}/out")
    files = sorted((tmp_path / "out").glob("*.rps"))
    assert len(files) == shards.count() > 1
    assert [d for f in files for d in repair.Shard(f.read_bytes()).doc_ids] == sorted(texts)


@pytest.mark.parametrize("small", [True, False])
def test_random_access(small, monkeypatch):
    if not small:  # the way for more symbols than 16 bits hold
        grouped = repair._grouped
        monkeypatch.setattr(repair, "_grouped", lambda left, right, at, small: grouped(left, right, at, False))
    rng = random.Random(0)
    ids = [np.array([rng.choice([1, 2, 3, 0, 50_256, 100_000]) for _ in range(rng.randint(0, 400))], "<u4") for _ in range(60)]
    payload = repair.write_shard(list(range(60)), [x.tobytes() for x in ids], 0, least=2, part=3, before=70)
    s = repair.Shard(payload)
    assert len(s.rules) and len(s.symbols) < sum(map(len, ids)) and (s.header.part, s.header.before, s.header.n_symbols) == (3, 70, len(s.symbols))
    assert [bytes(x) for x in s.documents()] == [s.document(i) for i in range(60)]
    for i, x in enumerate(ids):
        whole = np.append(x, 0)
        assert s.document(i) == whole.astype("<u4").tobytes()
        for _ in range(20):
            a = rng.randint(0, len(whole))
            b = rng.randint(a, len(whole))
            assert (s.ids(i, a, b) == whole[a:b]).all()
    with pytest.raises(ValueError):
        repair.Shard(b"XXXX" + payload[4:])


def most_uses(s):
    """Uses of the commonest pair left within documents."""
    document = np.repeat(np.arange(len(s.doc_ids)), np.diff(s.first_symbol.astype(int)))
    pairs = np.stack([s.symbols[:-1], s.symbols[1:]], 1)[(document[1:] == document[:-1]) & (s.symbols[1:] != 0)]
    return np.unique(pairs, axis=0, return_counts=True)[1].max() if len(pairs) else 0


def test_pairs_are_replaced_until_none_is_frequent(texts):
    """Copies of long documents, runs of one id, and real texts: rules go on until no pair has `least` uses left."""
    rng = random.Random(1)
    copies = [np.array([rng.randint(1, 50_000) for _ in range(300)], "<u4").tobytes()] * 100
    runs = [np.full(rng.randint(0, 3000), 7, "<u4").tobytes() for _ in range(40)]
    e = Encoder(tokenizer_path(BYTE_BPE), True)
    for ids in (copies, runs, [e.encode(t.encode()) for t in texts.values()]):
        for least in (2, 12):
            s = repair.Shard(repair.write_shard(list(range(len(ids))), ids, 0, least))
            assert most_uses(s) < least and len(s.rules)
            assert [bytes(x) for x in s.documents()] == [x + b"\0\0\0\0" for x in ids]


def test_starts_come_from_the_files(spark, docs):
    """The other columns of the shard table may be wrong: only the shards' bytes are read."""
    shards = repair.write_shards(docs, shard_tokens=20_000)
    bytes_alone = shards.select("payload")
    assert sorted(repair.read_shards(bytes_alone).collect()) == sorted(repair.read_shards(shards).collect())


def test_shard_edges(spark):
    edge = edge_docs(spark)
    rows = repair.read_shards(repair.write_shards(edge)).collect()
    assert len(rows) == edge.count() and sorted(r.start for r in rows)[0] == 0
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3)} == {1}
    assert repair.read_shards(repair.write_shards(empty_docs(spark))).count() == 0
