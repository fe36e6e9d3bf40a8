"""Every registered query against its SQL oracle (DuckDB) on the smallest
tables; queries without an oracle must at least run and return rows."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
QUERIES = {k: v for k, v in E.queries().items() if k.startswith("q_")}
ORACLES = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return c


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def sorted_rows(records, cols):
    return sorted((tuple(norm(r[c]) for c in cols) for r in records), key=repr)


def test_every_query_has_a_name_and_most_have_oracles():
    assert len(QUERIES) >= 70
    assert set(ORACLES) <= set(QUERIES)
    assert len(ORACLES) >= 60


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    rel = con.sql(ORACLES[name])
    assert sorted(rel.columns) == cols
    want = sorted_rows([dict(zip(rel.columns, r)) for r in rel.fetchall()], cols)
    got = sorted_rows([r.asDict() for r in df.collect()], cols)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_runs(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
