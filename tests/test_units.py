"""Connection strings, paths, types, pruning rules: no Spark job."""

import datetime as dt
import sys

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import types as T

from tidelake.plans import layout, pruning
from tidelake.sources import paths
from tidelake.sources.catalog import DataFile, Stats, columns_at, utc, visible
from tidelake.sources.catalog import ColumnRow
from tidelake.sources.connect import CatalogSpec, Factory, parse, resolve
from tidelake.sources.types import Node, check, scalar, spark_type


@pytest.mark.parametrize(
    ("text", "kind", "path"),
    [
        ("ducklake:sqlite:a/b.db", "sqlite", "a/b.db"),
        ("sqlite:////abs/b.db", "sqlite", "/abs/b.db"),
        ("ducklake:duckdb:x.duckdb", "duckdb", "x.duckdb"),
        ("duckdb:///x.duckdb", "duckdb", "x.duckdb"),
        ("ducklake:metadata.ducklake", "duckdb", "metadata.ducklake"),
    ],
)
def test_embedded_catalogs(text, kind, path):
    assert parse(text) == CatalogSpec(kind, path)


def test_server_catalogs():
    a = parse("ducklake:postgres:dbname=lake host=h user=u password='p w@:/' port=5433")
    assert dict(a.params) == {"dbname": "lake", "host": "h", "user": "u", "password": "p w@:/", "port": "5433"} and a.mark == "%s"
    assert dict(parse("ducklake:postgres:database=lake").params) == {"dbname": "lake", "host": "localhost"}
    for key in ("database", "db", "dbname"):
        assert dict(parse(f"ducklake:mysql:{key}=lake user=root").params) == {"database": "lake", "host": "localhost", "user": "root"}
    assert dict(parse("postgresql+psycopg://u:p%40x@h:1/lake").params) == {"dbname": "lake", "host": "h", "user": "u", "password": "p@x", "port": "1"}
    assert parse("mysql+pymysql://root@h/lake").quote == "`"


@pytest.mark.parametrize("text", ["ducklake:", "ducklake:sqlite:", "ducklake:duckdb:", "ducklake:postgres:", "ducklake:postgres:host=h", "ducklake:postgres:junk", "ducklake:mysql:user=u", "ducklake:postgresql:dbname=x", "ftp://x", "nonsense"])
def test_bad_connection_strings(text):
    with pytest.raises(ValueError):
        parse(text)


def test_resolve(monkeypatch):
    assert resolve("ducklake:sqlite:a.db") is resolve("ducklake:sqlite:a.db")
    assert isinstance(resolve(lambda: None), Factory)
    with pytest.raises(TypeError):
        resolve(3)
    for name in ("psycopg", "pymysql"):
        monkeypatch.setitem(sys.modules, name, None)  # as if it were not installed
    with pytest.raises(ImportError):
        parse("ducklake:postgres:dbname=x").connect()
    with pytest.raises(ImportError):
        parse("ducklake:mysql:db=x").connect()


@pytest.mark.parametrize(
    ("file", "table", "schema", "base", "found"),
    [
        (("f.parquet", True), ("t/", True), ("s/", True), "s3://b/p/", "s3://b/p/s/t/f.parquet"),
        (("f.parquet", True), ("t", True), ("s", True), "/p", "/p/s/t/f.parquet"),
        (("f.parquet", True), ("/other/t", False), ("s", True), "/p", "/other/t/f.parquet"),
        (("f.parquet", True), ("t", True), ("gs://x/s/", False), "/p", "gs://x/s/t/f.parquet"),
        (("/abs/f.parquet", False), ("t", True), ("s", True), "/p", "/abs/f.parquet"),
        (("f.parquet", True), (None, True), ("", True), "/p/", "/p/f.parquet"),
        (("f.parquet", True), ("/t", False), (None, True), None, "/t/f.parquet"),
    ],
)
def test_paths(file, table, schema, base, found):
    assert paths.resolve(file, table, schema, base) == found


def test_path_without_base():
    with pytest.raises(ValueError):
        paths.resolve(("f.parquet", True), (None, True), (None, True), None)


def test_object_store_names():
    assert paths.hadoop("s3://b/k") == "s3a://b/k" and paths.hadoop("/a/b") == "/a/b"
    account = paths.account({"AZURE_STORAGE_ACCOUNT_NAME": "acc"})
    assert paths.hadoop("az://box/x/y", account) == "abfs://box@acc.dfs.core.windows.net/x/y" and paths.hadoop("az://box/x") == "abfs://box/x"
    got = paths.reader_options({"aws_access_key_id": "k", "aws_allow_http": "true", "aws_virtual_hosted_style_request": "false", "other": 1})
    assert got == {"fs.s3a.access.key": "k", "fs.s3a.connection.ssl.enabled": "false", "fs.s3a.path.style.access": "true", "other": "1"}


@pytest.mark.parametrize(
    ("name", "kind"),
    [("BIGINT", T.LongType()), (" int32 ", T.IntegerType()), ("utinyint", T.ShortType()), ("uint64", T.DecimalType(20, 0)), ("Decimal(10, 2)", T.DecimalType(10, 2)), ("numeric(38,0)", T.DecimalType(38, 0)), ("json", T.StringType()), ("timestamp_ns", T.TimestampNTZType()), ("timestamptz", T.TimestampType()), ("BLOB", T.BinaryType()), ("uuid", T.StringType())],
)
def test_scalars(name, kind):
    assert scalar(name) == kind


@pytest.mark.parametrize("name", ["interval", "hugeint", "bit", "geometry", "decimal", "timestamp with time zone"])
def test_unknown_types(name):
    with pytest.raises(ValueError, match="unrecognised"):
        check(Node(1, "c", name))


def test_nested_shapes():
    leaf = lambda n: Node(9, n, "int32")
    assert spark_type(Node(1, "l", "list", (leaf("element"),))) == T.ArrayType(T.IntegerType())
    assert spark_type(Node(1, "m", "map", (leaf("value"), leaf("key")))) == T.MapType(T.IntegerType(), T.IntegerType())
    for bad in (Node(1, "l", "list"), Node(1, "s", "struct"), Node(1, "m", "map", (leaf("key"), leaf("other"))), Node(1, "l", "LIST<INT>", (leaf("e"),))):
        with pytest.raises(ValueError):
            check(bad)


def test_table_names():
    assert layout.split_name("t", None) == ("main", "t")
    assert layout.split_name("s.t.u", None) == ("s", "t.u")
    assert layout.split_name("t", "s") == ("s", "t")
    with pytest.raises(ValueError):
        layout.split_name("s.t", "s")


def test_versions():
    assert visible(1, None, 1) and visible(1, 3, 2) and not visible(1, 3, 3) and not visible(2, None, 1)
    assert utc("2026-01-01 02:00:00+02:00") == dt.datetime(2026, 1, 1) == utc(dt.date(2026, 1, 1))
    rows = [ColumnRow(1, 1, 2, 1, "a", "int32", None, None), ColumnRow(1, 2, None, 1, "b", "int64", None, None), ColumnRow(2, 1, None, 0, "z", "struct", None, None), ColumnRow(3, 1, None, 2, "f", "date", 2, None)]
    assert [c.name for c in columns_at(rows, 1)] == ["z", "a"] and [c.name for c in columns_at(rows, 2)] == ["z", "b"]
    assert columns_at(rows, 1)[0].children[0].name == "f"


def facts(kind, low, high, nulls=0, records=10, nan=False):
    return {"c": [pruning.facts(kind, Stats(nulls, low, high, nan), records)]}


def may(clause, known):
    return pruning.may_match(clause, known)


@pytest.mark.parametrize(
    ("clause", "kept"),
    [
        (("eq", "c", 5), True), (("eq", "c", 11), False), (("lt", "c", 1), False), (("le", "c", 1), True), (("gt", "c", 10), False), (("ge", "c", 10), True),
        (("in", "c", [20, 30]), False), (("in", "c", [20, 3]), True), (("null", "c"), False), (("notnull", "c"), True), (("not", ("eq", "c", 5)), True),
        (("or", [("eq", "c", 50), ("eq", "c", 60)]), False), (("or", [("eq", "c", 50), None]), True), (("and", [("gt", "c", 0), ("gt", "c", 100)]), False),
        (None, True), (("never",), False), (("eq", "other", 1), True), (("eq", "c", "text"), True), (("eq", "c", float("nan")), True), (("eq", "c", True), True),
    ],
)
def test_pruning_integers(clause, kept):
    assert may(clause, facts("int32", "1", "10")) is kept


def test_pruning_guards():
    assert may(("eq", "c", 50), facts("float64", "1.0", "10.0", nan=True))
    assert may(("eq", "c", 50), facts("int32", None, None)) and may(("eq", "c", 50), facts("int32", "x", "y"))
    assert may(("eq", "c", 50), {"c": [pruning.facts("int32", None, 10)]})
    assert not may(("notnull", "c"), facts("int32", None, None, nulls=10)) and may(("null", "c"), facts("int32", None, None, nulls=10))
    assert may(("notnull", "c"), facts("int32", None, None, nulls=10, records=None))
    assert not may(("not", ("eq", "c", 5)), facts("int32", "5", "5")) and may(("not", ("eq", "c", 5)), facts("int32", "5", "6"))
    assert not may(("not", ("null", "c")), facts("int32", None, None, nulls=10))


def test_pruning_other_types():
    assert not may(("eq", "c", "b"), facts("varchar", "c", "d")) and may(("eq", "c", "é"), facts("varchar", "a", "ê"))
    assert not may(("eq", "c", True), facts("boolean", "0", "0")) and may(("eq", "c", True), facts("bool", "0", "1"))
    assert not may(("gt", "c", dt.date(2024, 1, 2)), facts("date", "2023-01-01", "2024-01-02"))
    half = facts("timestamp", "2024-01-01 00:00:00.5", "2024-01-01 00:00:00.5")
    assert may(("eq", "c", dt.datetime(2024, 1, 1, 0, 0, 0, 500_000)), half) and not may(("gt", "c", dt.datetime(2024, 1, 1, 0, 0, 1)), half)
    assert may(("eq", "c", dt.datetime(2024, 1, 1)), facts("date", "2024-01-01", "2024-01-01"))
    assert not may(("eq", "c", 2**64 - 1), facts("uint64", "0", str(2**63)))
    assert not may(("starts", "c", "zz"), facts("varchar", "a", "b")) and may(("starts", "c", "ab"), facts("varchar", "aa", "ac"))
    assert not may(("eq", "c", "eu"), {"c": [pruning.of_partition("varchar", "us")]}) and may(("eq", "c", "eu"), {"c": [pruning.of_partition("varchar", None)]})


@given(st.lists(st.integers(-20, 20), min_size=1), st.sampled_from(["eq", "lt", "le", "gt", "ge"]), st.integers(-25, 25), st.booleans())
def test_pruning_never_loses_a_row(values, op, x, negate):
    known = facts("int64", str(min(values)), str(max(values)), records=len(values))
    meets = {"eq": lambda v: v == x, "lt": lambda v: v < x, "le": lambda v: v <= x, "gt": lambda v: v > x, "ge": lambda v: v >= x}[op]
    clause = ("not", (op, "c", x)) if negate else (op, "c", x)
    if any(meets(v) != negate for v in values):
        assert may(clause, known)


def test_keep_nothing_when_never():
    assert pruning.keep([DataFile(1, "f", True, 1, 1, None, None)], ("never",), lambda f: {}) == []


def test_bench_comparison(tmp_path, capsys):
    import bench

    a, b = tmp_path / "a.json", tmp_path / "b.json"
    a.write_text('{"parsed": {"queries": {"x": 1.0, "y": 2.0}}}')
    b.write_text('log line\n{"queries": {"x": 1.04, "y": 1.0}}')
    assert bench.compare(str(a), str(b)) == 0 and bench.compare(str(a), str(b), threshold=0.01) == 1
    b.write_text('{"queries": {"x": 1.0}}')
    assert bench.compare(str(a), str(b)) == 1 and "only in" in capsys.readouterr().out
