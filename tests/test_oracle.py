"""Every registered query with an oracle agrees with DuckDB on the smallest tables,
and the driver contract holds (entry runs, keys line up)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from cupola.sources.tables import TABLES
from tests.conftest import SF001


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}") + 0.0
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    return c


def test_contract(spark):
    assert set(E.oracle_sql()) <= set(E.queries())
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["band", "n_coupons", "n_redeemed", "redeem_rate"]


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SF001)
    cols = sorted(sdf.columns)
    got = sorted(repr(tuple(_norm(r[c]) for c in cols)) for r in sdf.collect())
    rel = con.sql(E.oracle_sql()[key])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    want = sorted(repr(tuple(_norm(r[i]) for i in idx)) for r in rel.fetchall())
    assert got == want
