"""Scans of hand-built lakes: rows, files opened, errors, cost."""

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidelake import scan
from tidelake.lakebuilder import Lake
from tidelake.operators import deletes
from tidelake.plans import layout, predicate
from tidelake.sources.catalog import Catalog, Table
from tidelake.sources.connect import Factory
from tidelake.sources.datasource import register


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module", params=["sqlite", "duckdb"])
def three(spark, request):
    lk = Lake(spark, backend=request.param)
    t = lk.add_table("t", [("id", "INTEGER"), ("v", "VARCHAR")])
    for lo, hi in ((1, 100), (150, 200), (300, 500)):
        df = spark.range(lo, hi + 1).select(F.col("id").cast("int"), F.concat(F.lit("v"), "id").alias("v"))
        lk.add_file(t, df, stats=["id", "v"])
    return lk


@pytest.mark.parametrize(("where", "files", "n"), [("id = 170", 1, 1), ("id > 100", 2, 252), ("id < 0", 0, 0), ("id + 1 = 171", 3, 1), ("id = 170 or id = 1", 2, 2), ("id in (5, 600)", 1, 1), ("170 = id", 1, 1), ("id is null", 0, 0), (None, 3, 352), ("id = 1 and id = 2", 0, 0)])
def test_files_opened(spark, three, where, files, n):
    df = scan(spark, three.catalog, "t", where=where)
    assert len(df.inputFiles()) == files and df.count() == n


def test_column_condition_and_pushdown(spark, three):
    df = scan(spark, three.catalog, "t", where=F.col("id") == 170)
    assert len(df.inputFiles()) == 1
    plan = scan(spark, three.catalog, "t").where("id > 3").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,3)]" in plan and "ReadSchema: struct<id:int>" in plan
    assert plan.count("FileScan") == 1


def test_bad_condition_is_told_at_once(spark, three):
    with pytest.raises(Exception, match="nope"):
        scan(spark, three.catalog, "t", where="nope = 1")


def test_pruning_fails_open(spark, three, monkeypatch):
    monkeypatch.setattr(predicate, "_clause", lambda f: 1 / 0)
    assert scan(spark, three.catalog, "t", where="id = 170").count() == 1


def test_errors(spark, three):
    c = three.catalog
    with pytest.raises(ValueError, match="mutually exclusive"):
        scan(spark, c, "t", snapshot_id=1, as_of="2026-01-01")
    with pytest.raises(ValueError):
        scan(spark, c, "main.t", schema="main")
    for bad in ({"snapshot_id": 99}, {"as_of": dt.datetime(2000, 1, 1)}, {"schema": "no"}):
        with pytest.raises(LookupError):
            scan(spark, c, "t", **bad)
    with pytest.raises(LookupError):
        scan(spark, c, "no_such")
    with pytest.raises(TypeError):
        scan(spark, 7, "t")
    with pytest.raises(RuntimeError):
        Catalog(c).snapshot()


def test_reader_opens_again(three):
    c = Catalog(three.catalog)
    for _ in range(2):
        with c:
            assert c.snapshot() == 1


def test_snapshot_is_pinned(spark):
    lk = Lake(spark)
    t = lk.add_table("t", [("id", "int64")])
    lk.add_file(t, spark.range(2))
    df = scan(spark, lk.catalog, "t")
    lk.take_snapshot()
    lk.add_file(t, spark.range(5, 7))
    assert rows(df) == [(0,), (1,)] and rows(scan(spark, lk.catalog, "t")) == [(0,), (1,), (5,), (6,)]
    assert len(scan(spark, lk.catalog, "t")._jdf.queryExecution().executedPlan().toString().split("FileScan")) == 2


def test_inlined_rows_are_refused(spark):
    lk = Lake(spark)
    t = lk.add_table("t", [("id", "int64")])
    lk.add_file(t, spark.range(2))
    lk.sql("CREATE TABLE ducklake_inlined_data_tables (table_id BIGINT, table_name VARCHAR, schema_version BIGINT)")
    lk.sql("INSERT INTO ducklake_inlined_data_tables VALUES (?, 'inlined_1', 1)", t)
    assert scan(spark, lk.catalog, "t").count() == 2  # no tracker
    lk.sql("CREATE TABLE inlined_1 (row_id BIGINT)")
    assert scan(spark, lk.catalog, "t").count() == 2  # flushed
    lk.sql("INSERT INTO inlined_1 VALUES (1)")
    with pytest.raises(NotImplementedError):
        scan(spark, lk.catalog, "t")


@pytest.mark.parametrize("change", ["encryption_key = 'k'", "file_format = 'orc'", "mapping_id = 3"])
def test_unknown_files_are_refused(spark, change):
    lk = Lake(spark)
    lk.add_file(lk.add_table("t", [("id", "int64")]), spark.range(2))
    lk.sql(f"UPDATE ducklake_data_file SET {change}")
    with pytest.raises(NotImplementedError):
        scan(spark, lk.catalog, "t")


def test_deletes_with_odd_paths_and_many_row_groups(spark, tmp_path):
    lk = Lake(spark)
    t = lk.add_table("t", [("id", "int64")], path=f"{tmp_path}/a b=c%d/", relative=False)
    (tmp_path / "a b=c%d").mkdir()
    pq.write_table(pa.table({"id": list(range(5000))}), tmp_path / "a b=c%d" / "f 1.parquet", row_group_size=100)
    lk.sql("INSERT INTO ducklake_data_file (data_file_id, table_id, begin_snapshot, file_order, path, path_is_relative, file_format, record_count) VALUES (77, ?, 1, 0, 'f 1.parquet', 1, 'parquet', 5000)", t)
    i = lk.add_deletes(t, 77, [0, 99, 100, 4999])
    df = scan(spark, lk.catalog, "t")
    assert df.count() == 4996 and rows(df.where("id in (0, 1, 100, 101, 4999)")) == [(1,), (101,)]
    assert "LeftAnti" in df._jdf.queryExecution().executedPlan().toString()
    lk.take_snapshot()
    lk.expire("delete_file", i)
    assert scan(spark, lk.catalog, "t").count() == 5000


def test_uuid_time_and_unsigned(spark, tmp_path):
    import uuid

    lk = Lake(spark)
    t = lk.add_table("t", [("u", "uuid"), ("n", "timestamp_ns"), ("b", "ubigint"), ("d", "decimal(10,2)")])
    u = uuid.UUID(int=0x1234)
    schema = pa.schema([("u", pa.uuid()), ("n", pa.int64()), ("b", pa.decimal128(20, 0)), ("d", pa.decimal128(10, 2))])
    from decimal import Decimal

    pq.write_table(pa.table({"u": pa.array([u.bytes, None], pa.binary(16)).cast(pa.uuid()) if hasattr(pa, "uuid") else [], "n": [1_500_000_000_123_456_789, None], "b": [Decimal(2**64 - 1), None], "d": [Decimal("1.25"), None]}, schema=schema), tmp_path / "f.parquet")
    lk.sql("INSERT INTO ducklake_data_file (data_file_id, table_id, begin_snapshot, file_order, path, path_is_relative, file_format, record_count) VALUES (78, ?, 1, 0, ?, 0, 'parquet', 2)", t, f"{tmp_path}/f.parquet")
    first = scan(spark, lk.catalog, "t").where("u is not null").first()
    assert first.u == str(u) and first.n == dt.datetime(2017, 7, 14, 2, 40, 0, 123456) and first.b == 2**64 - 1


def test_partition_values_of_another_partitioning_do_not_prune(spark):
    lk = Lake(spark)
    t = lk.add_table("t", [("a", "varchar"), ("b", "varchar")])
    p = lk.add_partition(t, ("a", "identity"))
    lk.add_file(t, spark.createDataFrame([("x", "y")], "a string, b string"), partition=(p, ["x"]))
    lk.take_snapshot()
    lk.add_partition(t, ("b", "identity"))
    assert scan(spark, lk.catalog, "t", where="b = 'y'").count() == 1


def test_identity_partitions_prune_later_conditions(spark):
    lk = Lake(spark)
    t = lk.add_table("t", [("id", "int64"), ("region", "varchar")])
    p = lk.add_partition(t, ("region", "identity"))
    for r in ("us", "eu", "apac"):
        lk.add_file(t, spark.range(3).withColumn("region", F.lit(r)), partition=(p, [r]))
    df = scan(spark, lk.catalog, "t")
    assert len(df.where("region = 'eu'").inputFiles()) == 1 and df.where("region = 'eu'").count() == 3
    assert len(df.where("region = 'zz'").inputFiles()) == 0
    assert len(scan(spark, lk.catalog, "t", where="region = 'eu'").inputFiles()) == 1


def test_many_partition_values_share_scans_by_range(spark, monkeypatch):
    monkeypatch.setattr(layout, "MOST_LITERALS", 2)
    lk = Lake(spark)
    t = lk.add_table("t", [("id", "int64"), ("k", "int32")])
    p = lk.add_partition(t, ("k", "identity"))
    for k in (2, 10, 9, 1, 30):
        lk.add_file(t, spark.range(2).withColumn("k", F.lit(k)), partition=(p, [str(k)]))
    df = scan(spark, lk.catalog, "t")
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2 and df.count() == 10
    assert len(df.where("k = 30").inputFiles()) == 2 and df.where("k = 30").count() == 2  # numbers, not texts, make the ranges
    assert len(df.where("k = 99").inputFiles()) == 0


def test_a_limit_opens_few_files(spark, three):
    for n, files in ((0, 0), (10, 1), (100, 1), (101, 2), (5000, 3)):
        df = scan(spark, three.catalog, "t", limit=n)
        assert len(df.inputFiles()) == files and df.count() == min(n, 352)
    df = scan(spark, three.catalog, "t", where="id > 100", limit=5)
    assert len(df.inputFiles()) == 2 and df.count() == 5
    with pytest.raises(ValueError):
        scan(spark, three.catalog, "t", limit=-1)


def test_a_limit_counts_deleted_rows_out(spark):
    lk = Lake(spark)
    t = lk.add_table("t", [("id", "int64")])
    a, _ = (lk.add_file(t, spark.range(k, k + 10)) for k in (0, 10))
    lk.add_deletes(t, a, [0, 1, 2, 3])
    # the delete file is among the files read
    assert len(scan(spark, lk.catalog, "t", limit=6).inputFiles()) == 2 and len(scan(spark, lk.catalog, "t", limit=7).inputFiles()) == 3
    assert scan(spark, lk.catalog, "t", limit=7).count() == 7


def test_many_deletes_are_cut_into_parts_that_can_be_broadcast(spark, monkeypatch):
    lk = Lake(spark)
    t = lk.add_table("t", [("id", "int64")])
    for k in range(4):
        lk.add_deletes(t, lk.add_file(t, spark.range(10 * k, 10 * k + 10)), [0, 5])
    want = [(i,) for i in range(40) if i % 5]
    plans = []
    for most, parts in ((500_000, 32), (4, 32), (2, 32), (4, 1)):
        monkeypatch.setattr(deletes, "MOST_BROADCAST", most)
        monkeypatch.setattr(deletes, "MOST_PARTS", parts)
        df = scan(spark, lk.catalog, "t")
        assert rows(df) == want
        plans.append(df._jdf.queryExecution().optimizedPlan().toString().count("LeftAnti"))
    assert plans == [1, 2, 4, 1]


def test_zoned_literals_prune_by_instant_whatever_the_jvm_s_zone(spark):
    lk = Lake(spark)
    t = lk.add_table("t", [("at", "timestamptz")])
    lk.add_file(t, spark.sql("select timestamp'2024-01-01 10:00:00+00:00' as at"), stats=["at"])
    lk.sql("UPDATE ducklake_file_column_stats SET min_value = '2024-01-01 10:00:00+00', max_value = '2024-01-01 10:00:00+00'")
    zones = spark._jvm.java.util.TimeZone
    before = zones.getDefault()
    try:
        for zone in ("America/Los_Angeles", "Asia/Tokyo", "UTC"):
            zones.setDefault(zones.getTimeZone(zone))
            assert scan(spark, lk.catalog, "t", where="at = timestamp'2024-01-01 10:00:00+00:00'").count() == 1
            assert len(scan(spark, lk.catalog, "t", where="at > timestamp'2024-01-01 10:00:00.5+00:00'").inputFiles()) == 0
    finally:
        zones.setDefault(before)


def test_maps_in_both_forms_within_one_table(spark):
    lk = Lake(spark)
    t = lk.add_table("t", [("id", "int64"), ("m", "map", [("key", "varchar"), ("value", "int64")])])
    df = spark.range(2).select("id", F.create_map(F.lit("a"), F.col("id")).alias("m"))
    for part in (df, df.select("id", F.map_entries("m").alias("m")), df):
        lk.add_file(t, part)
    assert rows(scan(spark, lk.catalog, "t").select("id", F.col("m")["a"])) == [(0, 0)] * 3 + [(1, 1)] * 3


def test_column_ids_of_other_tables_do_not_mix(spark):
    lk = Lake(spark)
    a, b = (lk.add_table(n, [("x", "int64")]) for n in ("a", "b"))
    lk.sql("UPDATE ducklake_column SET column_id = 1")
    p = lk.add_partition(a, ("x", "identity"))
    lk.add_file(a, spark.range(1).select(F.col("id").alias("x")), partition=(p, ["0"]))
    lk.add_file(b, spark.range(4).select(F.col("id").alias("x")))
    assert scan(spark, lk.catalog, "b", where="x = 3").count() == 1


def test_case_clash_is_refused(spark):
    lk = Lake(spark)
    lk.add_table("t", [("id", "int64"), ("ID", "int64")])
    with pytest.raises(ValueError):
        scan(spark, lk.catalog, "t")


class Counting:
    """A DB-API connection that notes its statements."""

    def __init__(self, path, log):
        import sqlite3

        self.inner, self.log = sqlite3.connect(path), log
        log.append("connect")

    def cursor(self):
        cursor, log = self.inner.cursor(), self.log

        class Cursor:
            def execute(self, sql, values=()):
                log.append(sql)
                return cursor.execute(sql, values)

            fetchall, close = staticmethod(cursor.fetchall), staticmethod(cursor.close)

        return Cursor()

    def close(self):
        self.inner.close()


def test_catalog_cost(spark):
    lk = Lake(spark)
    t = lk.add_table("t", [("id", "int64")])
    for k in range(6):
        lk.add_file(t, spark.range(k, k + 1), stats=["id"])
        lk.take_snapshot()
    log = []
    source = Factory(lambda: Counting(lk.path, log), kind="sqlite")
    scan(spark, source, "t").count()
    assert log.count("connect") == 1 and sum("ORDER BY file_order" in x for x in log) == 1
    assert not any("file_column_stats" in x for x in log) and sum("FROM ducklake_column" in x for x in log) == 1
    log.clear()
    scan(spark, source, "t", where="id = 3").count()
    assert log.count("connect") == 1 and sum("file_column_stats" in x for x in log) == 1


def test_source_format(spark, three):
    register(spark)
    df = spark.read.format("tidelake").options(catalog=three.catalog, table="t").load()
    assert df.where("id > 199").count() == 202 and df.schema.names == ["id", "v"]
    assert df.count() == 352
    pruned = spark.read.format("tidelake").options(catalog=three.catalog, table="t", prune="true").load().where("id > 199")
    assert pruned.count() == 202 and pruned.rdd.getNumPartitions() == 2


def test_source_pins_its_snapshot(spark):
    register(spark)
    lk = Lake(spark)
    t = lk.add_table("t", [("id", "int64")])
    lk.add_file(t, spark.range(2))
    df = spark.read.format("tidelake").options(catalog=lk.catalog, table="t").load()
    lk.take_snapshot()
    lk.add_column(t, "more", "varchar", default="x")
    lk.add_file(t, spark.range(5, 7).withColumn("more", F.lit("y")))
    assert df.columns == ["id"] and rows(df) == [(0,), (1,)]
    later = spark.read.format("tidelake").options(catalog=lk.catalog, table="t").load()
    assert rows(later) == [(0, "x"), (1, "x"), (5, "y"), (6, "y")]


def test_source_agrees_with_scan_on_nested_columns(spark):
    register(spark)
    lk = Lake(spark)
    leaf = [("a", "int32"), ("b", "varchar")]
    t = lk.add_table("t", [("id", "int64"), ("s", "struct", leaf), ("l", "list", [("element", "struct", [("x", "int32")])]), ("m", "map", [("key", "varchar"), ("value", "timestamp_ns")])])
    kind = "id long, s struct<a int, b string>, l array<struct<x int>>, m map<string, long>"
    made = [(1, (1, "p"), [(1,), None], {"k": -1}), (2, None, None, None), (3, (None, None), [], {}), (4, (4, "q"), [(4,)], {"k": None, "j": 1_500_000_000_123_456_789})]
    lk.add_file(t, spark.createDataFrame(made, kind))
    lk.take_snapshot()
    lk.change_column(t, "a", "renamed")
    lk.change_column(t, "x", kind="int64")
    lk.add_column(t, "c", "double", parent=lk.column_id(t, "s"))
    source = spark.read.format("tidelake").options(catalog=lk.catalog, table="t").load()
    direct = scan(spark, lk.catalog, "t")
    assert source.schema.simpleString() == direct.schema.simpleString()
    key = lambda r: r.id
    assert sorted(source.collect(), key=key) == sorted(direct.collect(), key=key)


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_source_reads_a_folder_registered_as_a_file(spark, tmp_path, scheme):
    register(spark)
    folder = tmp_path / "several files.parquet"
    df = spark.range(20).select("id", F.array(F.col("id").cast("double")).alias("v"), F.pmod("id", F.lit(2)).alias("side"))
    df.repartition(3).write.partitionBy("side").parquet(str(folder))
    (folder / "_passed_over").write_text("not Parquet")
    lk = Lake(spark)
    t = lk.add_table("t", [("id", "int64"), ("v", "list", [("element", "float64")])])
    f = lk.add_file(t, df, path=str(folder) if not scheme else folder.as_uri())
    source = spark.read.format("tidelake").options(catalog=lk.catalog, table="t")
    got = source.load()
    assert sorted(map(tuple, got.collect())) == [(i, [float(i)]) for i in range(20)] and got.rdd.getNumPartitions() >= 3
    lk.take_snapshot()
    lk.add_deletes(t, f, [0])
    with pytest.raises(Exception, match="a folder of several files"):
        source.load().collect()


def test_a_broken_catalog_is_not_taken_for_a_missing_relation(spark):
    lk = Lake(spark)
    lk.add_file(lk.add_table("t", [("id", "int64")]), spark.range(2))

    class Failing(Counting):
        def cursor(self):
            inner = super().cursor()

            class Cursor:
                def execute(self, sql, values=()):
                    if "ducklake_inlined_data_tables" in (*values, sql):
                        raise OSError("timed out")
                    return inner.execute(sql, values)

                fetchall, close = staticmethod(inner.fetchall), staticmethod(inner.close)

            return Cursor()

    with pytest.raises(OSError):
        scan(spark, Factory(lambda: Failing(lk.path, []), kind="sqlite"), "t")


class ServerConnection(Counting):
    """SQLite behind the ways of another driver: its marks, quotes and list of columns."""

    def cursor(self):
        inner = super().cursor()

        class Cursor:
            def execute(self, sql, values=()):
                assert "?" not in sql and "pragma" not in sql
                sql = sql.replace("%s", "?")
                return inner.execute("SELECT name FROM pragma_table_info(?)" if "information_schema" in sql else sql, values)

            fetchall, close = staticmethod(inner.fetchall), staticmethod(inner.close)

        return Cursor()


@pytest.mark.parametrize(("module", "text"), [("psycopg", "ducklake:postgres:dbname=lake host=db user=u"), ("pymysql", "ducklake:mysql:database=lake port=3307")])
def test_server_catalogs_through_their_drivers(spark, monkeypatch, module, text):
    import sys
    import types

    lk = Lake(spark)
    t = lk.add_table("t", [("id", "int64")])
    lk.add_file(t, spark.range(5), stats=["id"])
    log, driver = [], types.ModuleType(module)
    kind = type("Connection", (ServerConnection,), {"__module__": module})
    driver.paramstyle = "pyformat"
    driver.connect = lambda **given: log.append(given) or kind(lk.path, log)
    monkeypatch.setitem(sys.modules, module, driver)
    assert rows(scan(spark, text, "t", where="id > 2")) == [(3,), (4,)]
    assert log[0]["host"] in ("db", "localhost") and ("port" not in log[0] or log[0]["port"] == 3307)
    assert any("`key`" in x if module == "pymysql" else '"key"' in x for x in log[1:])
    # the same as a prebuilt connection, left open, and as a function
    log.clear()
    open_ = kind(lk.path, log)
    assert rows(scan(spark, open_, "t")) == rows(scan(spark, lambda: kind(lk.path, log), "t")) and open_.inner.execute("SELECT 1").fetchone() == (1,)


def test_connections_of_unknown_drivers_need_a_kind(three):
    class Unknown:
        def cursor(self): ...

        def close(self): ...

    with pytest.raises(ValueError, match="kind"):
        with Catalog(lambda: Unknown()):
            pass


def test_history_of_a_missing_table(three):
    with Catalog(three.catalog) as c:
        assert c.history(Table(999, None, True)) == [] and c.data_files(Table(999, None, True), 1) == []
