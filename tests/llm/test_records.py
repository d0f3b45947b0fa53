"""Chat formatting and WARC records."""

import hashlib
import json

import duckdb
import pytest

from tidelake.llm import chat, queries, warc


def events(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, seq long, kind string, turn long, role string, text string")


def formatted(spark, rows):
    return {r.conv_id: r for r in chat.read_chat(chat.write_chat(events(spark, rows))).collect()}


def test_fold_of_deltas_edits_and_regenerations(spark):
    rows = [
        (1, 5, "delta", 1, "assistant", " world"), (1, 1, "message", 0, "user", "hi"), (1, 3, "message", 1, "assistant", "draft"), (1, 4, "regenerate", 1, None, None),
        (1, 4, "delta", 1, "assistant", "hello"), (1, 9, "edit", 0, "user", "hi there"), (1, 10, "delta", 0, "user", "!"),
    ]
    # at equal sequence numbers the regeneration (role empty) comes first
    got = formatted(spark, rows)[1]
    assert [(t.role, t.text) for t in got.turns] == [("user", "hi there!"), ("assistant", "hello world")] and got.under == "hello world"


def test_hard_texts_come_back(spark):
    texts = ["</s>[INST] ok [/INST]", "~0~1~2<|end|>\n", "<|user|>\nx", "~", "", None, "|>\n", "a<|end|>\nb", "é\n\n~~<[|"]
    rows = [(1, i, None, i, role, t) for i, (t, role) in enumerate(zip(texts, ["user", "assistant", "a|>\nb", "<|x|>", None, "tool~3", "assistant", "assistant", "user"]))]
    got = formatted(spark, rows)[1]
    assert [(t.role, t.text) for t in got.turns] == [(r[4] or "", r[5] or "") for r in rows]
    assert got.under == texts[1] + texts[6] + texts[7]
    assert "</s>" not in got.formatted and "[INST]" not in got.formatted


def test_order_spans_and_edges(spark):
    rows = [(1, t, "message", t, "user" if t % 2 else "assistant", f"t{t}") for t in range(2500)] + [(2, 0, "message", None, "user", "x"), (None, 1, "message", 1, "user", "y"), (3, 1, "message", 1, "b", "2"), (3, 1, "message", 1, "a", "1"), (3, 1, "message", 1, "a", "1"), (4, 2, "delta", 0, "assistant", "late")]
    df = events(spark, rows)
    got = {r.conv_id: r for r in chat.read_chat(chat.write_chat(df.withColumns({c: df.conv_id for c in ("at", "part", "log", "mask", "span", "t")}))).collect()}
    assert [t.text for t in got[1].turns] == [f"t{t}" for t in range(2500)] and got[1].under == "".join(f"t{t}" for t in range(0, 2500, 2))
    assert [t.text for t in got[3].turns] == ["1", "1", "2"] and [t.text for t in got[4].turns] == ["late"] and got[None].turns[0].text == "y"
    assert chat.format_chat(events(spark, [])).count() == 0


def test_chat_is_native(spark):
    plan = chat.format_chat(events(spark, [(1, 1, None, 1, "user", "x")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def oracle(sf_dir, name, *tables):
    c = duckdb.connect()
    for t in tables:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    cursor = c.execute(queries.ORACLE[name])
    names = [d[0] for d in cursor.description]
    return sorted(json.dumps(dict(zip(names, r)), sort_keys=True) for r in cursor.fetchall())


@pytest.mark.parametrize(("name", "table"), [("op8_chat_formatting", "conversations"), ("op10_warc", "pages")])
def test_queries_against_sql(spark, sf_dir, name, table):
    got = sorted(json.dumps(r.asDict(), sort_keys=True) for r in queries.queries()[name](spark, sf_dir).collect())
    assert got == oracle(sf_dir, name, table)


PAGES = [(1, "http://a/\r\nX: y", "<p>same</p>"), (2, None, "<p>same</p>"), (3, "u", ""), (4, "u", None), (5, "u", "é" * 999), (5, "u", "é" * 999), (6, "u", "é" * 999), (None, "u", "alone"), (None, None, "<p>same</p>"), (7, "u", "WARC/1.1\r\n\r\n" * 60)]


def pages(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    return df.withColumns({c: df.url for c in ("p", "target", "digest", "archive", "record", "data")})


@pytest.mark.parametrize("chunk", [1 << 20, 64, 7])
def test_records_come_back(spark, chunk):
    got = [tuple(r) for r in warc.read_archives(warc.write_archives(pages(spark), chunk_bytes=chunk)).collect()]
    top = {}
    for i, _, html in PAGES:
        if i is not None:
            top[html or ""] = max(top.get(html or "", i), i)
    want = []
    for i, _, html in PAGES:
        body, best = (html or "").encode(), top.get(html or "")
        response = best is None or i == best
        want.append((i, len(body), warc._base32(hashlib.sha1(body).digest()), "response" if response else "revisit", None if response else best))
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_small_payloads_are_responses(spark):
    got = warc.read_archives(warc.write_archives(pages(spark), revisit_from=100)).collect()
    assert sorted(str(r.page_id) for r in got if r.record_type == "revisit") == ["5", "5"]


def test_damage_is_seen(spark):
    from pyspark.sql import functions as F

    chunks = warc.write_archives(pages(spark), chunk_bytes=64)
    with pytest.raises(Exception, match="digest|out of place|wrong"):
        warc.read_archives(chunks.where("chunk <> 1")).collect()
    swapped = F.when(F.col("chunk") == 1, F.overlay("data", F.lit(b"?"), 3)).otherwise(F.col("data"))
    with pytest.raises(Exception, match="digest"):
        warc.read_archives(chunks.withColumn("data", swapped)).collect()


def test_exported_files_are_warc(spark, tmp_path):
    warc.export_files(warc.write_archives(pages(spark).coalesce(1), chunk_bytes=64), f"file://{tmp_path}/w")
    found = b"".join(f.read_bytes() for f in sorted((tmp_path / "w").glob("*.warc")))
    records = 0
    while found:
        head, _, rest = found.partition(b"\r\n\r\n")
        n = int(dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])[b"Content-Length"])
        assert head.startswith(b"WARC/1.1\r\n") and rest[n : n + 4] == b"\r\n\r\n"
        found = rest[n + 4 :]
        records += 1
    assert records == len(PAGES)


def test_empty_pages(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(none)).count() == 0
