"""Queries over lakes built from the given tables, one or more per operator, and the SQL that says what each returns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelake import scan
from tidelake.lakebuilder import Lake, columns_of
from tidelake.sources.datasource import register
from tidelake.streaming import new_rows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
_lakes: dict[tuple, Lake] = {}


def lake(build: Callable[[Lake, Callable[[str], DataFrame]], None]):
    """A lake per session and folder, built at its first use."""

    @wraps(build)
    def get(spark: SparkSession, sf_dir: str) -> Lake:
        key = (spark.sparkContext.applicationId, sf_dir, build.__name__)
        if key not in _lakes:
            made = Lake(spark, backend="duckdb" if "duckdb" in build.__name__ else "sqlite")
            build(made, lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"), sf_dir)
            _lakes[key] = made
        return _lakes[key]

    return get


def query(name: str, sql: str | None):
    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return put


def whole_table(lk: Lake, sf_dir: str, name: str, df: DataFrame, **table) -> int:
    """Declare a table and register the given file by its absolute path."""
    t = lk.add_table(name, columns_of(df.schema), **table)
    lk.add_file(t, df, path=f"{sf_dir}/{name}.parquet")
    return t


# -- whole tables, names, paths ---------------------------------------------------------------------


@lake
def plain(lk: Lake, read, sf_dir: str) -> None:
    for name in ("orders", "lineitem", "customer", "nation", "region", "part"):
        whole_table(lk, sf_dir, name, read(name))
    lk.add_table("empty", columns_of(read("orders").schema))


@lake
def on_duckdb(lk: Lake, read, sf_dir: str) -> None:
    whole_table(lk, sf_dir, "orders", read("orders"))


@lake
def split_lineitem(lk: Lake, read, sf_dir: str) -> None:
    df = read("lineitem")
    t = lk.add_table("lineitem", columns_of(df.schema))
    for k in range(4):
        lk.add_file(t, df.where(F.col("l_orderkey") % 4 == k))


@lake
def chained(lk: Lake, read, sf_dir: str) -> None:
    df = read("events")
    lk.add_schema("analytics", "analytics dir/")
    t = lk.add_table("events", columns_of(df.schema), schema="analytics", path="ev=ents/")
    full = lk.write(df, "analytics dir/ev=ents")
    lk.add_file(t, df, path=full.rsplit("/", 1)[1], relative=True)


@query("scan_full", "SELECT * FROM orders")
def scan_full(spark, sf_dir):
    return scan(spark, plain(spark, sf_dir).catalog, "orders")


@query("scan_duckdb_catalog", "SELECT * FROM orders")
def scan_duckdb_catalog(spark, sf_dir):
    return scan(spark, on_duckdb(spark, sf_dir).catalog, "orders")


@query("scan_multi_file", "SELECT * FROM lineitem")
def scan_multi_file(spark, sf_dir):
    return scan(spark, split_lineitem(spark, sf_dir).catalog, "lineitem")


@query("scan_empty_table", "SELECT * FROM orders WHERE false")
def scan_empty_table(spark, sf_dir):
    return scan(spark, plain(spark, sf_dir).catalog, "empty")


@query("qualified_name", "SELECT * FROM events")
def qualified_name(spark, sf_dir):
    return scan(spark, chained(spark, sf_dir).catalog, "analytics.events")


@query("schema_path_chain", "SELECT event_id, user_id, props FROM events")
def schema_path_chain(spark, sf_dir):
    return scan(spark, chained(spark, sf_dir).catalog, "events", schema="analytics").select("event_id", "user_id", "props")


@query("data_path_override", "SELECT * FROM events")
def data_path_override(spark, sf_dir):
    lk = chained(spark, sf_dir)
    return scan(spark, lk.catalog, "analytics.events", data_path=lk.folder)


# -- snapshots --------------------------------------------------------------------------------------


@lake
def versions(lk: Lake, read, sf_dir: str) -> None:
    df = read("orders")
    t = lk.add_table("orders", columns_of(df.schema))
    ids = []
    for k in range(3):
        if k:
            lk.take_snapshot(dt.datetime(2026, 1 + k, 1))
        ids.append(lk.add_file(t, df.where(F.col("o_orderkey") % 3 == k)))
    lk.take_snapshot(dt.datetime(2026, 4, 1))
    lk.expire("data_file", ids[0])


@query("tt_snapshot_id", "SELECT * FROM orders WHERE o_orderkey % 3 <= 1")
def tt_snapshot_id(spark, sf_dir):
    return scan(spark, versions(spark, sf_dir).catalog, "orders", snapshot_id=2)


@query("tt_as_of", "SELECT * FROM orders WHERE o_orderkey % 3 <= 1")
def tt_as_of(spark, sf_dir):
    return scan(spark, versions(spark, sf_dir).catalog, "orders", as_of=dt.datetime(2026, 2, 14, 12))


@query("tt_as_of_exact", "SELECT * FROM orders")
def tt_as_of_exact(spark, sf_dir):
    return scan(spark, versions(spark, sf_dir).catalog, "orders", as_of="2026-03-01T01:00:00+01:00")


@query("tt_first", "SELECT * FROM orders WHERE o_orderkey % 3 = 0")
def tt_first(spark, sf_dir):
    return scan(spark, versions(spark, sf_dir).catalog, "orders", snapshot_id=1)


@query("expired_file", "SELECT * FROM orders WHERE o_orderkey % 3 <> 0")
def expired_file(spark, sf_dir):
    return scan(spark, versions(spark, sf_dir).catalog, "orders")


@query("tt_difference", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 3 = 0")
def tt_difference(spark, sf_dir):
    catalog = versions(spark, sf_dir).catalog
    keys = lambda **o: scan(spark, catalog, "orders", **o).select("o_orderkey", "o_totalprice")
    return keys(snapshot_id=3).exceptAll(keys())


@query("follow_new_rows", "SELECT * FROM orders WHERE o_orderkey % 3 = 2")
def follow_new_rows(spark, sf_dir):
    return new_rows(spark, versions(spark, sf_dir).catalog, "orders", after=2, up_to=3)


# -- deletes and updates ----------------------------------------------------------------------------


@lake
def deleted(lk: Lake, read, sf_dir: str) -> None:
    df = read("lineitem")
    t = lk.add_table("lineitem", columns_of(df.schema))
    a, b = (lk.add_file(t, df.where(F.col("l_orderkey") % 2 == k)) for k in range(2))
    lk.take_snapshot()
    first = lk.add_deletes(t, a, lk.positions(a, "l_orderkey % 7 = 0", df.schema))
    lk.add_deletes(t, b, lk.positions(b, "l_orderkey % 7 = 0", df.schema))
    lk.add_deletes(t, b, lk.positions(b, "l_orderkey % 5 = 0", df.schema))
    lk.take_snapshot()
    lk.expire("delete_file", first)
    lk.add_deletes(t, a, lk.positions(a, "l_orderkey % 7 = 0 or l_quantity > 40", df.schema))
    lk.take_snapshot()
    lk.add_deletes(t, b, lk.positions(b, "true", df.schema))


@query("delete_before_visible", "SELECT * FROM lineitem")
def delete_before_visible(spark, sf_dir):
    return scan(spark, deleted(spark, sf_dir).catalog, "lineitem", snapshot_id=1)


@query("delete_positions", "SELECT * FROM lineitem WHERE NOT (l_orderkey % 7 = 0) AND NOT (l_orderkey % 2 = 1 AND l_orderkey % 5 = 0)")
def delete_positions(spark, sf_dir):
    return scan(spark, deleted(spark, sf_dir).catalog, "lineitem", snapshot_id=2)


@query("delete_superseded", "SELECT * FROM lineitem WHERE NOT (l_orderkey % 7 = 0) AND NOT (l_orderkey % 2 = 1 AND l_orderkey % 5 = 0) AND NOT (l_orderkey % 2 = 0 AND l_quantity > 40)")
def delete_superseded(spark, sf_dir):
    return scan(spark, deleted(spark, sf_dir).catalog, "lineitem", snapshot_id=3)


@query("delete_all_rows", "SELECT * FROM lineitem WHERE l_orderkey % 2 = 0 AND NOT (l_orderkey % 7 = 0) AND NOT l_quantity > 40")
def delete_all_rows(spark, sf_dir):
    return scan(spark, deleted(spark, sf_dir).catalog, "lineitem")


@query("delete_with_filter", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_shipdate >= TIMESTAMP '1995-06-01' AND NOT (l_orderkey % 7 = 0) AND NOT (l_orderkey % 2 = 1 AND l_orderkey % 5 = 0)")
def delete_with_filter(spark, sf_dir):
    df = scan(spark, deleted(spark, sf_dir).catalog, "lineitem", snapshot_id=2, where="l_shipdate >= timestamp_ntz '1995-06-01 00:00:00'")
    return df.select("l_orderkey", "l_linenumber")


@lake
def updated(lk: Lake, read, sf_dir: str) -> None:
    df = read("orders")
    t = whole_table(lk, sf_dir, "orders", df)
    lk.take_snapshot()
    file = lk.sql("SELECT data_file_id FROM ducklake_data_file")[0][0]
    lk.add_deletes(t, file, lk.positions(file, "o_orderstatus = 'F'", df.schema))
    lk.add_file(t, df.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 1000.0))


@query("update_as_delete_insert", "SELECT * REPLACE (CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1000.0 ELSE o_totalprice END AS o_totalprice) FROM orders")
def update_as_delete_insert(spark, sf_dir):
    return scan(spark, updated(spark, sf_dir).catalog, "orders")


@lake
def compacted(lk: Lake, read, sf_dir: str) -> None:
    df = read("customer")
    t = lk.add_table("customer", columns_of(df.schema))
    merged = df.withColumn("_ducklake_internal_snapshot_id", (F.col("c_custkey") % 3 + 1).cast("long"))
    lk.add_file(t, merged, partial_max=3)
    lk.take_snapshot()
    lk.take_snapshot()


@query("partial_latest", "SELECT * FROM customer")
def partial_latest(spark, sf_dir):
    return scan(spark, compacted(spark, sf_dir).catalog, "customer")


@query("partial_time_travel", "SELECT * FROM customer WHERE c_custkey % 3 + 1 <= 2")
def partial_time_travel(spark, sf_dir):
    return scan(spark, compacted(spark, sf_dir).catalog, "customer", snapshot_id=2)


# -- schema evolution -------------------------------------------------------------------------------


@lake
def evolved(lk: Lake, read, sf_dir: str) -> None:
    df = read("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    t = lk.add_table("customer", columns_of(df.schema))
    old = lk.add_file(t, df.where("c_custkey % 2 = 0"))
    lk.take_snapshot()
    lk.add_column(t, "c_acctbal", "double")
    lk.take_snapshot()
    lk.change_column(t, "c_mktsegment", "segment")
    lk.take_snapshot()
    lk.drop_column(t, "c_name")
    lk.change_column(t, "c_nationkey", kind="int64")
    lk.add_column(t, "tier", "varchar", default="basic")
    new = read("customer").where("c_custkey % 2 = 1").selectExpr("c_custkey", "cast(c_nationkey as bigint) as c_nationkey", "c_mktsegment as segment", "c_acctbal", "concat('t', c_custkey % 5) as tier")
    lk.add_file(t, new)
    lk.take_snapshot()
    lk.add_deletes(t, old, lk.positions(old, "c_custkey % 6 = 0", df.schema))


@query("add_column", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment, CAST(NULL AS DOUBLE) AS c_acctbal FROM customer WHERE c_custkey % 2 = 0")
def add_column(spark, sf_dir):
    return scan(spark, evolved(spark, sf_dir).catalog, "customer", snapshot_id=2)


@query("rename_column", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS c_acctbal FROM customer WHERE c_custkey % 2 = 0")
def rename_column(spark, sf_dir):
    return scan(spark, evolved(spark, sf_dir).catalog, "customer", snapshot_id=3)


@query("tt_pre_rename", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer WHERE c_custkey % 2 = 0")
def tt_pre_rename(spark, sf_dir):
    return scan(spark, evolved(spark, sf_dir).catalog, "customer", snapshot_id=1)


_EVOLVED = """SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment AS segment,
    CASE WHEN c_custkey % 2 = 1 THEN c_acctbal END AS c_acctbal,
    CASE WHEN c_custkey % 2 = 1 THEN 't' || CAST(c_custkey % 5 AS VARCHAR) ELSE 'basic' END AS tier FROM customer"""


@query("evolve_combined", _EVOLVED)
def evolve_combined(spark, sf_dir):
    return scan(spark, evolved(spark, sf_dir).catalog, "customer", snapshot_id=4)


@query("evolve_with_deletes", _EVOLVED + " WHERE c_custkey % 6 <> 0")
def evolve_with_deletes(spark, sf_dir):
    return scan(spark, evolved(spark, sf_dir).catalog, "customer")


@query("drop_column", "SELECT count(*) AS n, count(c_acctbal) AS with_balance FROM (" + _EVOLVED + ")")
def drop_column(spark, sf_dir):
    df = scan(spark, evolved(spark, sf_dir).catalog, "customer", snapshot_id=4)
    assert "c_name" not in df.columns
    return df.agg(F.count("*").alias("n"), F.count("c_acctbal").alias("with_balance"))


@query("type_promotion", "SELECT c_custkey, CAST(c_nationkey AS BIGINT) * 3000000000 AS scaled FROM customer")
def type_promotion(spark, sf_dir):
    df = scan(spark, evolved(spark, sf_dir).catalog, "customer", snapshot_id=4)
    return df.select("c_custkey", (F.col("c_nationkey") * F.lit(3000000000)).alias("scaled"))


# -- pruning ----------------------------------------------------------------------------------------


@lake
def ranged(lk: Lake, read, sf_dir: str) -> None:
    df = read("orders").withColumn("o_flag", F.col("o_orderkey") % 2 == 0).withColumn("o_note", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")))
    df = df.withColumn("o_ratio", F.when(F.col("o_orderkey") % 50 == 1, F.lit(float("nan"))).otherwise(F.col("o_totalprice") / 1000))
    t = lk.add_table("orders", columns_of(df.schema))
    a, b = df.agg(F.expr("percentile_approx(o_orderkey, array(0.33, 0.66))")).first()[0]
    key = F.col("o_orderkey")
    for part in (df.where(key < a), df.where((key >= a) & (key < b)), df.where(key >= b)):
        lk.add_file(t, part, stats=df.columns)
    lk.add_file(t, df.where("false"), stats=["o_orderkey"])
    u = lk.add_table("unknown", columns_of(df.schema))
    lk.add_file(u, df)


_RANGED = """(SELECT *, o_orderkey % 2 = 0 AS o_flag, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS o_note,
    CASE WHEN o_orderkey % 50 = 1 THEN CAST('nan' AS DOUBLE) ELSE o_totalprice / 1000 END AS o_ratio FROM orders)"""
#: name, condition for Spark, condition for DuckDB where it differs
PRUNED = [
    ("prune_eq", "o_orderkey = 100", None),
    ("prune_reversed", "100 = o_orderkey", None),
    ("prune_range", "o_orderkey >= 200 and o_orderkey < 400", None),
    ("prune_ne", "o_orderkey <> 100", None),
    ("prune_and", "o_orderkey > 300 and o_orderstatus = 'F'", None),
    ("prune_or", "o_orderkey < 50 or o_orderkey > 1400", None),
    ("prune_in", "o_orderkey in (1, 2, 3, 700)", None),
    ("prune_is_null", "o_note is null", None),
    ("prune_is_not_null", "o_note is not null", None),
    ("prune_unsupported", "o_orderkey + 1 = 101", None),
    ("prune_lossy_and", "o_orderkey < 300 and o_orderkey % 5 = 0", None),
    ("prune_string", "o_orderpriority = '1-URGENT'", None),
    ("prune_starts_with", "o_orderpriority like '5%'", None),
    ("prune_timestamp", "o_orderdate >= timestamp_ntz '1996-01-01 00:00:00'", "o_orderdate >= TIMESTAMP '1996-01-01 00:00:00'"),
    ("prune_float", "o_totalprice > 150000.0", None),
    ("prune_float_nan", "o_ratio > 200.0", None),
    ("prune_bool", "o_flag = true", None),
    ("prune_never", "o_orderkey < 5 and o_orderkey > 10", None),
]


def _pruned(where: str):
    return lambda spark, sf_dir: scan(spark, ranged(spark, sf_dir).catalog, "orders", where=where).select("o_orderkey", "o_orderdate", "o_note")


for _name, _where, _other in PRUNED:
    query(_name, f"SELECT o_orderkey, o_orderdate, o_note FROM {_RANGED} WHERE {_other or _where}")(_pruned(_where))


@query("prune_missing_stats", f"SELECT o_orderkey FROM {_RANGED} WHERE o_orderkey = 100")
def prune_missing_stats(spark, sf_dir):
    return scan(spark, ranged(spark, sf_dir).catalog, "unknown", where=F.col("o_orderkey") == 100).select("o_orderkey")


@lake
def partitioned(lk: Lake, read, sf_dir: str) -> None:
    df = read("events")
    t = lk.add_table("events", columns_of(df.schema))
    p = lk.add_partition(t, ("event_type", "identity"))
    kinds = sorted(r[0] for r in df.select("event_type").distinct().collect())
    for k in kinds:
        lk.add_file(t, df.where(F.col("event_type") == k), partition=(p, [k]), stats=["user_id"])
    lk.take_snapshot()
    q = lk.add_partition(t, ("user_id", "bucket(4)"))
    odd = df.withColumn("event_id", F.col("event_id") + 1_000_000).withColumn("event_type", F.lit(None).cast("string"))
    lk.add_file(t, odd.where("user_id % 4 = 0"), partition=(q, ["0"]), stats=["user_id"])
    lk.take_snapshot()
    r = lk.add_partition(t, ("event_type", "identity"))
    lk.add_file(t, odd.where("user_id % 4 = 1"), partition=(r, [None]), stats=["user_id"])


@query("partition_eq", "SELECT * FROM events WHERE event_type = 'click'")
def partition_eq(spark, sf_dir):
    return scan(spark, partitioned(spark, sf_dir).catalog, "events", snapshot_id=1, where="event_type = 'click'")


@query("partition_lazy", "SELECT event_type, count(*) AS n FROM events WHERE event_type <> 'click' GROUP BY event_type")
def partition_lazy(spark, sf_dir):
    df = scan(spark, partitioned(spark, sf_dir).catalog, "events", snapshot_id=1)
    return df.where("event_type <> 'click'").groupBy("event_type").agg(F.count("*").alias("n"))


@query("partition_miss", "SELECT * FROM events WHERE event_type = 'no such'")
def partition_miss(spark, sf_dir):
    return scan(spark, partitioned(spark, sf_dir).catalog, "events", snapshot_id=1, where="event_type = 'no such'")


_ODD = "SELECT event_id + 1000000 AS event_id, ts, user_id, CAST(NULL AS VARCHAR) AS event_type, value, props FROM events"


@query("partition_transform", f"SELECT * FROM events WHERE user_id = 8 UNION ALL SELECT * FROM ({_ODD}) WHERE user_id % 4 = 0 AND user_id = 8")
def partition_transform(spark, sf_dir):
    return scan(spark, partitioned(spark, sf_dir).catalog, "events", snapshot_id=2, where="user_id = 8")


@query("partition_respec", f"SELECT * FROM events UNION ALL SELECT * FROM ({_ODD}) WHERE user_id % 4 <= 1")
def partition_respec(spark, sf_dir):
    return scan(spark, partitioned(spark, sf_dir).catalog, "events")


@query("partition_null_value", f"SELECT count(*) AS n FROM ({_ODD}) WHERE user_id % 4 <= 1")
def partition_null_value(spark, sf_dir):
    return scan(spark, partitioned(spark, sf_dir).catalog, "events", where="event_type is null").agg(F.count("*").alias("n"))


@lake
def finely_partitioned(lk: Lake, read, sf_dir: str) -> None:
    """More partition values than branches that a union may cost."""
    df = read("events").withColumn("slot", (F.col("event_id") % 70).cast("int"))
    t = lk.add_table("events", columns_of(df.schema))
    p = lk.add_partition(t, ("slot", "identity"))
    for k in range(70):
        lk.add_file(t, df.where(F.col("slot") == k), partition=(p, [str(k)]))


@query("partition_many_values", "SELECT event_id, event_id % 70 AS slot FROM events WHERE event_id % 70 = 33")
def partition_many_values(spark, sf_dir):
    df = scan(spark, finely_partitioned(spark, sf_dir).catalog, "events").where("slot = 33")
    assert len(df.inputFiles()) <= 2
    return df.select("event_id", F.col("slot").cast("long").alias("slot"))


@lake
def zoned(lk: Lake, read, sf_dir: str) -> None:
    df = read("events").select("event_id", F.col("ts").cast("timestamp").alias("at"))
    t = lk.add_table("moments", columns_of(df.schema))
    low, high = df.agg(F.expr("percentile_approx(event_id, array(0.33, 0.66))")).first()[0]
    for part in (df.where(F.col("event_id") < low), df.where((F.col("event_id") >= low) & (F.col("event_id") < high)), df.where(F.col("event_id") >= high)):
        lk.add_file(t, part, stats=["event_id", "at"])


@query("prune_timestamptz", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-01 12:00:00'")
def prune_timestamptz(spark, sf_dir):
    return scan(spark, zoned(spark, sf_dir).catalog, "moments", where="at >= timestamp'2024-01-01 12:00:00+00:00'").select("event_id")


# -- types ------------------------------------------------------------------------------------------


@lake
def nested(lk: Lake, read, sf_dir: str) -> None:
    e = read("embeddings")
    whole_table(lk, sf_dir, "embeddings", e)
    v = read("events")
    s = v.select("event_id", F.struct("user_id", F.struct(F.col("value").alias("amount"), "event_type").alias("inner")).alias("payload"))
    t = lk.add_table("structs", columns_of(s.schema))
    lk.add_file(t, s.where("event_id % 2 = 0"))
    lk.take_snapshot()
    # a field of a field gets another name, and a new one appears beside it
    inner = lk.column_id(t, "inner")
    lk.change_column(t, "amount", "worth")
    lk.add_column(t, "grade", "varchar", parent=inner)
    s2 = v.select("event_id", F.struct("user_id", F.struct(F.col("value").alias("worth"), "event_type", F.lit("new").alias("grade")).alias("inner")).alias("payload"))
    lk.add_file(t, s2.where("event_id % 2 = 1"))
    m = v.select("event_id", F.create_map(F.col("event_type"), F.col("user_id"), F.lit("one"), F.lit(1).cast("long")).alias("attrs"))
    t = lk.add_table("maps", columns_of(m.schema))
    lk.add_file(t, m.where("event_id % 2 = 0"))
    lk.add_file(t, m.where("event_id % 2 = 1"))
    as_list = m.select("event_id", F.map_entries("attrs").alias("attrs"))
    t = lk.add_table("listmaps", columns_of(m.schema))
    lk.add_file(t, as_list)
    a = v.select("event_id", F.array(F.struct(F.col("user_id").alias("a"), F.col("event_type").alias("b")), F.struct(F.lit(7).cast("long").alias("a"), F.lit("x").alias("b"))).alias("items"))
    t = lk.add_table("listed", columns_of(a.schema))
    lk.add_file(t, a)
    t = lk.add_table("documents", [(n, "json" if n == "props" else k, *c) for n, k, *c in columns_of(v.schema)])
    lk.add_file(t, v, path=f"{sf_dir}/events.parquet")
    n = v.select("event_id", F.expr("cast(unix_micros(cast(ts as timestamp)) * 1000 + 123 as bigint)").alias("at"))
    t = lk.add_table("nanos", [("event_id", "int64"), ("at", "timestamp_ns")])
    lk.add_file(t, n)


@query("nested_list", "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n, CAST(embedding[1] AS DOUBLE) AS first_value FROM embeddings")
def nested_list(spark, sf_dir):
    df = scan(spark, nested(spark, sf_dir).catalog, "embeddings")
    return df.select("vec_id", F.size("embedding").alias("n"), F.col("embedding")[0].cast("double").alias("first_value"))


@query("nested_struct", "SELECT event_id, user_id, value AS amount, event_type FROM events WHERE event_id % 2 = 0")
def nested_struct(spark, sf_dir):
    df = scan(spark, nested(spark, sf_dir).catalog, "structs", snapshot_id=1)
    return df.select("event_id", "payload.user_id", "payload.inner.amount", "payload.inner.event_type")


@query("nested_struct_evolved", "SELECT event_id, value AS worth, CASE WHEN event_id % 2 = 1 THEN 'new' END AS grade FROM events")
def nested_struct_evolved(spark, sf_dir):
    return scan(spark, nested(spark, sf_dir).catalog, "structs").select("event_id", "payload.inner.worth", "payload.inner.grade")


@query("nested_map", "SELECT event_id, user_id AS own, CAST(1 AS BIGINT) AS one FROM events")
def nested_map(spark, sf_dir):
    df = scan(spark, nested(spark, sf_dir).catalog, "maps")
    return df.select("event_id", F.map_values("attrs")[0].alias("own"), F.col("attrs")["one"].alias("one"))


@query("nested_map_as_list", "SELECT event_id, user_id AS own, CAST(1 AS BIGINT) AS one FROM events")
def nested_map_as_list(spark, sf_dir):
    df = scan(spark, nested(spark, sf_dir).catalog, "listmaps")
    return df.select("event_id", F.map_values("attrs")[0].alias("own"), F.col("attrs")["one"].alias("one"))


@query("nested_list_struct", "SELECT event_id, user_id AS a, event_type AS b, CAST(2 AS INTEGER) AS n FROM events")
def nested_list_struct(spark, sf_dir):
    df = scan(spark, nested(spark, sf_dir).catalog, "listed")
    return df.select("event_id", F.col("items")[0].a.alias("a"), F.col("items")[0].b.alias("b"), F.size("items").alias("n"))


@query("json_column", "SELECT event_id, props FROM events")
def json_column(spark, sf_dir):
    return scan(spark, nested(spark, sf_dir).catalog, "documents").select("event_id", "props")


@query("timestamp_ns", "SELECT event_id, ts AS at FROM events")
def timestamp_ns(spark, sf_dir):
    return scan(spark, nested(spark, sf_dir).catalog, "nanos")


@lake
def typed(lk: Lake, read, sf_dir: str) -> None:
    p = read("part")
    df = p.select(
        "p_partkey",
        F.unhex(F.md5("p_name")).alias("code"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("price"),
        F.col("p_size").cast("smallint").alias("small"),
        F.col("p_partkey").cast("decimal(20,0)").alias("large"),
        F.col("p_name").cast("binary").alias("raw"),
        (F.col("p_partkey") * 1000).alias("clock"),
        F.expr("date_add(date'2020-01-01', p_size)").alias("day"),
    )
    kinds = [("p_partkey", "int64"), ("code", "uuid"), ("price", "decimal(12,2)"), ("small", "utinyint"), ("large", "ubigint"), ("raw", "blob"), ("clock", "timetz"), ("day", "date")]
    t = lk.add_table("typed", kinds)
    lk.add_file(t, df.where("p_partkey % 3 = 0"), stats=["price", "day"])
    # another writer keeps uuids as digits
    digits = F.regexp_replace(F.md5("p_name"), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    lk.add_file(t, df.join(p.select("p_partkey", digits.alias("digits")), "p_partkey").where("p_partkey % 3 = 1").withColumn("code", F.col("digits")).drop("digits"), stats=["price", "day"])
    lk.take_snapshot()
    lk.add_column(t, "grade", "int32", default="7")
    lk.add_file(t, df.where("p_partkey % 3 = 2").withColumn("grade", F.lit(1)), stats=["price", "day"])


_TYPED = """SELECT p_partkey, regexp_replace(md5(p_name), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') AS code,
    CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS price, CAST(p_size AS BIGINT) AS small, p_partkey AS large, p_name AS raw,
    p_partkey * 1000 AS clock, CAST(DATE '2020-01-01' + p_size AS VARCHAR) AS day, CASE WHEN p_partkey % 3 = 2 THEN 1 ELSE 7 END AS grade FROM part"""


def _shown(df: DataFrame) -> DataFrame:
    return df.select(
        "p_partkey", "code", F.col("price").cast("double").alias("price"), F.col("small").cast("long").alias("small"), F.col("large").cast("long").alias("large"),
        F.col("raw").cast("string").alias("raw"), "clock", F.col("day").cast("string").alias("day"), "grade",
    )


@query("scalar_types", _TYPED)
def scalar_types(spark, sf_dir):
    return _shown(scan(spark, typed(spark, sf_dir).catalog, "typed"))


@query("prune_decimal", f"SELECT p_partkey FROM ({_TYPED}) WHERE price > 1000.50 AND day < '2020-01-20'")
def prune_decimal(spark, sf_dir):
    return scan(spark, typed(spark, sf_dir).catalog, "typed", where="price > 1000.50BD and day < date'2020-01-20'").select("p_partkey")


# -- pushdown and composition -----------------------------------------------------------------------


@query("projection", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity < 10")
def projection(spark, sf_dir):
    return scan(spark, split_lineitem(spark, sf_dir).catalog, "lineitem").where("l_quantity < 10").select("l_orderkey", "l_quantity")


@query("limit_opens_few_files", "SELECT CAST(17 AS BIGINT) AS n, CAST(1 AS BIGINT) AS files")
def limit_opens_few_files(spark, sf_dir):
    df = scan(spark, split_lineitem(spark, sf_dir).catalog, "lineitem", limit=17)
    return df.agg(F.count("*").alias("n")).withColumn("files", F.lit(len(df.inputFiles())).cast("long"))


@query("limit_count", "SELECT CAST(17 AS BIGINT) AS n")
def limit_count(spark, sf_dir):
    return scan(spark, split_lineitem(spark, sf_dir).catalog, "lineitem").limit(17).agg(F.count("*").alias("n"))


_PRIORITY = """SELECT o_orderpriority, count(*) AS lines, count(DISTINCT o_orderkey) AS orders, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_shipdate >= TIMESTAMP '1995-01-01' GROUP BY o_orderpriority"""


@query("compose_join_agg", _PRIORITY)
def compose_join_agg(spark, sf_dir):
    """The flagship: two scans, a join, an aggregation."""
    catalog = plain(spark, sf_dir).catalog
    orders = scan(spark, catalog, "orders").select("o_orderkey", "o_orderpriority")
    lines = scan(spark, catalog, "lineitem", where="l_shipdate >= timestamp_ntz '1995-01-01 00:00:00'").select("l_orderkey", "l_quantity")
    # line counts per order first: the join then meets one row per order on either side
    per_order = lines.groupBy("l_orderkey").agg(F.count("*").alias("lines"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("quantity"))
    joined = orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("o_orderpriority").agg(F.sum("lines").alias("lines"), F.count("*").alias("orders"), F.sum("quantity").cast("double").alias("quantity"))


@query("compose_window", "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders")
def compose_window(spark, sf_dir):
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return scan(spark, plain(spark, sf_dir).catalog, "orders").select("o_custkey", "o_orderkey", F.row_number().over(w).cast("long").alias("place"))


@query("compose_setop", "SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders")
def compose_setop(spark, sf_dir):
    catalog = plain(spark, sf_dir).catalog
    return scan(spark, catalog, "customer").select(F.col("c_custkey").alias("k")).intersect(scan(spark, catalog, "orders").select("o_custkey"))


@query("compose_full_join", "SELECT coalesce(c_custkey, o_custkey) AS k, count(o_orderkey) AS n FROM customer FULL JOIN orders ON c_custkey = o_custkey GROUP BY 1")
def compose_full_join(spark, sf_dir):
    catalog = plain(spark, sf_dir).catalog
    c, o = scan(spark, catalog, "customer"), scan(spark, catalog, "orders")
    return c.join(o, c.c_custkey == o.o_custkey, "full").groupBy(F.coalesce("c_custkey", "o_custkey").alias("k")).agg(F.count("o_orderkey").alias("n"))


@query("compose_median", "SELECT c_mktsegment, median(c_acctbal) AS middle, count(DISTINCT c_nationkey) AS nations FROM customer GROUP BY c_mktsegment")
def compose_median(spark, sf_dir):
    return scan(spark, plain(spark, sf_dir).catalog, "customer").groupBy("c_mktsegment").agg(F.median("c_acctbal").alias("middle"), F.countDistinct("c_nationkey").alias("nations"))


@query("compose_semi_anti", "SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1) AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def compose_semi_anti(spark, sf_dir):
    catalog = plain(spark, sf_dir).catalog
    near = scan(spark, catalog, "nation").where("n_regionkey = 1")
    c = scan(spark, catalog, "customer")
    c = c.join(near, c.c_nationkey == near.n_nationkey, "left_semi")
    o = scan(spark, catalog, "orders").where("o_orderstatus = 'F'").select("o_custkey")
    return c.join(o, c.c_custkey == o.o_custkey, "left_anti").select("c_custkey")


@query("compose_sql", "SELECT p_brand, count(*) AS n, max(p_size) AS largest FROM part WHERE p_size > 5 GROUP BY p_brand")
def compose_sql(spark, sf_dir):
    return spark.sql(
        "SELECT p_brand, count(*) AS n, max(p_size) AS largest FROM {part} WHERE p_size > 5 GROUP BY p_brand", part=scan(spark, plain(spark, sf_dir).catalog, "part")
    )


@query("compose_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def compose_top_k(spark, sf_dir):
    return scan(spark, plain(spark, sf_dir).catalog, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").select("o_orderkey", "o_totalprice").limit(25)


@query("source_format", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey > 500")
def source_format(spark, sf_dir):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    register(spark)
    df = spark.read.format("tidelake").option("catalog", versions(spark, sf_dir).catalog).options(table="orders", prune="true").load()
    return df.where("o_orderkey > 500").select("o_orderkey", "o_orderstatus")


def _source(spark: SparkSession, catalog: str, **options: str) -> DataFrame:
    register(spark)
    return spark.read.format("tidelake").option("catalog", catalog).options(**options).load()


@query("source_evolved", _EVOLVED + " WHERE c_custkey % 6 <> 0")
def source_evolved(spark, sf_dir):
    return _source(spark, evolved(spark, sf_dir).catalog, table="customer")


@query("source_types", _TYPED)
def source_types(spark, sf_dir):
    return _shown(_source(spark, typed(spark, sf_dir).catalog, table="typed"))


@query("source_nested", "SELECT event_id, value AS worth, CASE WHEN event_id % 2 = 1 THEN 'new' END AS grade FROM events")
def source_nested(spark, sf_dir):
    return _source(spark, nested(spark, sf_dir).catalog, table="structs").select("event_id", "payload.inner.worth", "payload.inner.grade")


@query("source_map_as_list", "SELECT event_id, user_id AS own, CAST(1 AS BIGINT) AS one FROM events")
def source_map_as_list(spark, sf_dir):
    df = _source(spark, nested(spark, sf_dir).catalog, table="listmaps")
    return df.select("event_id", F.map_values("attrs")[0].alias("own"), F.col("attrs")["one"].alias("one"))


@query("source_timestamp_ns", "SELECT event_id, ts AS at FROM events")
def source_timestamp_ns(spark, sf_dir):
    return _source(spark, nested(spark, sf_dir).catalog, table="nanos")


@query("source_projection", "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n FROM embeddings WHERE vec_id % 3 = 0")
def source_projection(spark, sf_dir):
    return _source(spark, nested(spark, sf_dir).catalog, table="embeddings").where("vec_id % 3 = 0").select("vec_id", F.size("embedding").alias("n"))


@query("source_format_deletes", "SELECT * FROM lineitem WHERE NOT (l_orderkey % 7 = 0) AND NOT (l_orderkey % 2 = 1 AND l_orderkey % 5 = 0)")
def source_format_deletes(spark, sf_dir):
    register(spark)
    return spark.read.format("tidelake").options(catalog=deleted(spark, sf_dir).catalog, table="lineitem", snapshot_id="2").load()
