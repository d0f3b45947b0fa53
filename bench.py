"""Timings of the headline queries: prints one JSON line.

A lake is built from lineitem in $BENCH_SF_DIR: three chunks, partitioned by l_returnflag from the second
on, a time-travel point after the second, and a sibling table that gained a column. Each workload is run
once to warm up and five times; the fastest and the slowest are dropped and the median is kept.
Results go to Spark's noop sink. ``bench.py --compare BEFORE AFTER`` compares two result files.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidelake import queries, scan
from tidelake.lakebuilder import Lake, columns_of

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def build(spark: SparkSession) -> tuple[Lake, int]:
    lk = Lake(spark)
    df = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    point = 0
    for name in ("trades", "trades_evolved"):
        t = lk.add_table(name, columns_of(df.schema))
        lk.add_file(t, df.where("l_orderkey % 3 = 0"), stats=["l_orderkey", "l_quantity", "l_shipdate"])
        lk.take_snapshot()
        p = lk.add_partition(t, ("l_returnflag", "identity"))
        flags = sorted(r[0] for r in df.select("l_returnflag").distinct().collect())
        for k in (1, 2):
            lk.take_snapshot()
            if k == 2 and name == "trades_evolved":
                lk.add_column(t, "venue", "varchar")
            for flag in flags:
                part = df.where((F.col("l_orderkey") % 3 == k) & (F.col("l_returnflag") == flag))
                if k == 2 and name == "trades_evolved":
                    part = part.withColumn("venue", F.concat(F.lit("v"), F.col("l_suppkey") % 7))
                lk.add_file(t, part, stats=["l_orderkey", "l_quantity", "l_shipdate"], partition=(p, [flag]))
            if k == 1 and name == "trades":
                point = lk.snapshot
    return lk, point


def timed(make) -> tuple[float, int]:
    times, files = [], 0
    for i in range(6):
        began = time.perf_counter()
        df = make()
        df.write.format("noop").mode("overwrite").save()
        if i:
            times.append(time.perf_counter() - began)
        else:
            files = len(df.inputFiles())
    return statistics.median(sorted(times)[1:-1]), files


def read_result(path: str) -> dict[str, float]:
    """Seconds by query of a result line, or of a record that holds one under ``parsed``."""
    text = open(path).read().strip()
    try:
        found = json.loads(text)
    except ValueError:  # other lines before it
        found = json.loads(text.splitlines()[-1])
    return (found.get("parsed") or found)["queries"]


def compare(before: str, after: str, threshold: float = 0.05) -> int:
    """Prints the change of every query; 1 if one is slower by more than the threshold or missing."""
    old, new = read_result(before), read_result(after)
    worse = 0
    for name in sorted({*old, *new}):
        if name not in new or name not in old:
            print(f"{name}: only in {before if name in old else after}")
            worse += name not in new
            continue
        change = new[name] / old[name] - 1
        worse += change > threshold
        print(f"{name}: {old[name]:.4f} -> {new[name]:.4f} s ({change:+.1%}){' slower' if change > threshold else ''}")
    return int(bool(worse))


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    lk, point = build(spark)
    c = lk.catalog
    workloads = {
        "tiny_limit": lambda: scan(spark, c, "trades", limit=100),
        "full_scan": lambda: scan(spark, c, "trades"),
        "predicate_partition": lambda: scan(spark, c, "trades", where="l_returnflag = 'R'"),
        "predicate_nonpartition": lambda: scan(spark, c, "trades", where="l_quantity > 45"),
        "time_travel": lambda: scan(spark, c, "trades", snapshot_id=point),
        "schema_evolved": lambda: scan(spark, c, "trades_evolved"),
    }
    for name in ("scan_full", "delete_positions", "partial_time_travel", "evolve_combined", "partition_eq", "compose_join_agg", "compose_window", "compose_full_join"):
        workloads[name] = lambda q=queries.QUERIES[name]: q(spark, SF_DIR)
    seconds, files = {}, {}
    for name, make in workloads.items():
        seconds[name], files[name] = timed(make)
        print(f"{name}: {seconds[name]:.3f} s, {files[name]} files", file=sys.stderr)
    print(json.dumps({"metric": "total of medians", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": {k: round(v, 4) for k, v in seconds.items()}, "files_opened": files, "sf": SF_DIR.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    if sys.argv[1:2] == ["--compare"]:
        sys.exit(compare(*sys.argv[2:4]))
    main()
