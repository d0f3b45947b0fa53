"""Every registered lake query against DuckDB on the same tables."""

import os

import duckdb
import pytest

from tidelake.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def tables(sf_dir):
    c = duckdb.connect()
    for f in os.listdir(sf_dir):
        if f.endswith(".parquet"):
            c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{sf_dir}/{f}')")
    return c


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(round(r[i], 6)) if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, tables, name):
    got = QUERIES[name](spark, sf_dir)
    cursor = tables.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(got.columns) == sorted(names)
    assert plain(got.collect(), got.columns) == plain(cursor.fetchall(), names)


def test_entry_and_registry(spark):
    import __spark_entry__ as e

    assert set(QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
