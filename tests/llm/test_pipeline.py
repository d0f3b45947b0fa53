"""The pipeline's stages on their own inputs."""

from helpers import components, edge_docs, empty_docs, repeats, simhash

import corpus_pipeline as cp
from tidelake.llm import decontam


def test_stages_in_order(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = [docs]
    for name, stage in cp.STAGES[:-1]:
        seen.append(spark.createDataFrame(stage(spark, seen[-1], sf_dir).collect(), docs.schema))
        assert seen[-1].columns == docs.columns, name
    texts = [{r.doc_id: r for r in d.collect()} for d in seen]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    gone = set(texts[0]) - set(texts[1])
    assert gone and sum(labels.get(i, 0) == 0 for i in gone) >= 0.9 * len(gone)
    ids = sorted(texts[1])
    first = components([simhash(texts[1][i].text.encode()) for i in ids])
    assert set(texts[2]) == {ids[k] for k in first}
    ids = sorted(texts[2])
    for i, (_, removed, _, _) in zip(ids, repeats([texts[2][i].text.encode() for i in ids])):
        assert texts[3][i].n_chars == len(texts[3][i].text)
        if not removed:
            assert texts[3][i] == texts[2][i]
        else:
            assert len(texts[3][i].text.encode()) <= len(texts[2][i].text.encode()) - removed
    items = [b" " + b" ".join(decontam.words(r.text.encode())) + b" " for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    for i, r in texts[4].items():
        flat = b" " + b" ".join(decontam.words(r.text.encode())) + b" "
        assert not any(x in flat for x in items), i
    assert len(texts[3]) - len(texts[4]) <= 0.1 * len(texts[3])
    pieces = cp.STAGES[-1][1](spark, seen[-1], sf_dir)
    assert {r.doc_id for r in pieces.collect()} == set(texts[4])


def test_run(spark, sf_dir):
    assert cp.run(spark, sf_dir).columns[:3] == ["doc_id", "start", "length"] and [n for n, _ in cp.STAGES][-1] == "sequence_packing"


def test_stages_on_hard_and_empty_rows(spark, sf_dir):
    edge = edge_docs(spark, long_words=3000)
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, edge, sf_dir)
        assert out.columns == edge.columns, name
        out.collect()
        assert stage(spark, empty_docs(spark), sf_dir).count() == 0
    assert cp.STAGES[-1][1](spark, empty_docs(spark), sf_dir).count() == 0
