"""Every registered query equals its DuckDB oracle on sf0.001 (driver contract)."""
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "documents", "labels",
          "pages", "benchmark", "embeddings", "conversations"]


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (2, int(v))
    if isinstance(v, (int, float)):
        return (1, "nan" if isinstance(v, float) and math.isnan(v) else float(f"{v:.9g}"))
    return (3, str(v))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_contract_keys():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["rec_id", "id", "sim", "mc", "zc"]
    df.count()


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    cols = sorted(df.columns, key=str.lower)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    res = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(c.lower() for c in ocols) == [c.lower() for c in cols]
    order = sorted(range(len(ocols)), key=lambda i: ocols[i].lower())
    want = sorted(tuple(_norm(r[i]) for i in order) for r in res.fetchall())
    assert got == want
