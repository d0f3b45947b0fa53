"""The operators applied to their whole tables, with production parameters, and SQL for what SQL can say."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm import chat, decontam, lm, lzprint, packing, quality, repair, simhash, suffix_dedup, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.measure(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lzprint.with_neighbours(table(spark, sf_dir, "documents"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(table(spark, sf_dir, "documents"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text")
    )
    events = rows.unionByName(extra).withColumns({"seq": F.col("turn"), "kind": F.lit("message")})
    back = chat.read_chat(chat.write_chat(events))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("under").cast("long").alias("loss_chars"),
        F.sha2("under", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.read_shards(repair.write_shards(table(spark, sf_dir, "documents")))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_archives(warc.write_archives(table(spark, sf_dir, "pages")))


_ESCAPED = "length({0}) + length(regexp_replace({0}, '[^{1}]', '', 'g'))"

ORACLE: dict[str, str] = {
    "op8_chat_formatting": f"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        g AS (
            SELECT conv_id, count(*) AS n_turns,
                string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
                coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS under,
                sum(2 + {_ESCAPED.format("role", "~<[|").replace("[^~<[|]", "[^~<\\[|]")} + 3 + {_ESCAPED.format("text", "~<[").replace("[^~<[]", "[^~<\\[]")} + 8)::BIGINT AS formatted_chars
            FROM t GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(under) AS loss_chars,
            sha256(under) AS loss_sha256, formatted_chars FROM g""",
    "op10_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
        g AS (SELECT hex, max(page_id) AS top FROM p GROUP BY hex),
        d AS (
            SELECT hex, top, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
                (list_sum(list_transform(range(5), lambda j: (strpos('0123456789abcdef', substr(hex, (i // 4) * 5 + j + 1, 1)) - 1) * CAST(power(16, 4 - j) AS BIGINT)))
                >> (15 - 5 * (i % 4))) & 31 AS BIGINT) + 1, 1)), '') AS b32
            FROM g)
        SELECT page_id, strlen(html) AS payload_bytes, b32 AS payload_digest,
            CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
        FROM p JOIN d USING (hex)""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality": op1_quality,
        "op2_packing": op2_packing,
        "op3_suffix_dedup": op3_suffix_dedup,
        "op4_simhash": op4_simhash,
        "op5_decontamination": op5_decontamination,
        "op6_lz_fingerprint": op6_lz_fingerprint,
        "op7_lm_scoring": op7_lm_scoring,
        "op8_chat_formatting": op8_chat_formatting,
        "op9_token_output": op9_token_output,
        "op10_warc": op10_warc,
    }
