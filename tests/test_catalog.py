"""Every registered query runs on the smallest driver tables and agrees with
its DuckDB oracle (row count, column names, values)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from adlens.plans.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = lambda v: ("nan" if isinstance(v, float) and math.isnan(v) else v)
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["month_start", "brand", "channel"]
    assert df.count() >= 0


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert canon(df.columns, srows) == canon(dcols, cur.fetchall())
