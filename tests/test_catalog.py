"""Every catalog query against its DuckDB oracle on the smallest scale factor."""

import decimal
import math

import duckdb
import pytest

from sensorflow.plans import catalog
from sensorflow.plans.feeds import TABLES

SF = "/root/testdata/sf0.001"
SLOW = {"measurement_stream", "batch_counts"}  # covered by test_streaming and the sf0.01 check


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - SLOW))
def test_query_matches_oracle(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    rel = duck.sql(catalog.ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(rel.columns, rel.fetchall())


def test_entry_runs(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(catalog.QUERIES) <= set(e.queries())
    assert set(catalog.ORACLE) <= set(e.oracle_sql()) <= set(e.queries())
