"""Every registered query equals its DuckDB oracle on sf0.001 (the driver checks sf0.01)."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, norm  # noqa: E402

from helpers import SF001  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["model_quarter_key", "model", "quarter_label"]
    assert df.count() > 0


def test_every_query_has_oracle_or_is_listed():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    s_cols = df.columns
    s_rows = sorted(tuple(norm(v) for v in r) for r in df.collect())
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == sorted(s_cols)
    order = [rel.columns.index(c) for c in s_cols]
    d_rows = sorted(tuple(norm(r[i]) for i in order) for r in rel.fetchall())
    assert s_rows == d_rows
