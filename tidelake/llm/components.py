"""Connected components of a graph of 64-bit nodes, as joins and aggregations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm._common import materialise


def files(links: int, each: int = 250_000) -> int:
    """Files to write so many links to; few links in many files cost more than the links."""
    return 1 + links // each


def connected_components(links: DataFrame, tag: str = "components", most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of links (a, b); root is the smallest node it reaches.

    Alternates two steps until nothing moves: hang every larger neighbour of a node on the node's
    smallest neighbour, then hang the node and its smaller neighbours on the smallest. Each round is
    written to the shared folder. Neighbourhoods are aggregated to a minimum and joined back, never
    gathered, so a node with very many links costs rows, not memory.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    edges = materialise(edges, tag)
    before, n = None, edges.count()
    for _ in range(most_rounds):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        large = materialise(large.coalesce(files(n)), tag)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = materialise(small.where("u != v").distinct().coalesce(files(n)), tag)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before, n = now, now[0]
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
