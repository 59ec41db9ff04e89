"""Every registered query against its DuckDB twin on the sf0.001 tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tramline.plans.oracle_registry import ORACLE
from tramline.plans.queries import REGISTRY as QUERIES
from tramline.sources.testdata import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


def test_every_query_has_an_oracle():
    assert sorted(QUERIES) == sorted(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "median_delay_seconds" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = df.columns
    got = [tuple(r) for r in df.collect()]
    rel = duck.sql(ORACLE[name])
    assert sorted(rel.columns) == sorted(cols)
    order = sorted(cols)
    a = sorted((tuple(norm(r[cols.index(c)]) for c in order) for r in got), key=repr)
    b = sorted((tuple(norm(r[rel.columns.index(c)]) for c in order) for r in rel.fetchall()),
               key=repr)
    assert a == b
