"""Driver contract: entry() smoke and every registered job against its oracle (sf0.001)."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from vaultlens.plans.jobs import JOBS

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 6))
    return str(v)


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["part", "n", "bytes", "lo", "hi", "overridden"]


def test_every_job_has_an_oracle():
    assert set(JOBS) <= set(E.queries()) and set(JOBS) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(JOBS))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan   # no row-at-a-time Python anywhere
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(rows, df.columns) == _digest(orows, ocols)
