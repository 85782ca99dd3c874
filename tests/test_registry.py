"""The registry: one oracle per query, names, and every query reading the given tables."""

from __future__ import annotations

import re

import __spark_entry__ as E
from fleetlens.plans.registry import ORACLE, QUERIES


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_query_names():
    for name in QUERIES:
        assert re.fullmatch(r"[a-z][a-z0-9_]*", name)
        assert not re.search(r"op\d+_", name) and "pipeline" not in name


def test_oracles_read_the_given_tables():
    for name, sql in ORACLE.items():
        assert "from lineitem" in sql and "from part" in sql, name


def test_merged_queries_read_the_written_partials(spark):
    from helpers import SF001

    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    for name in ("int_drive_spans", "dim_drive", "dim_model", "mart_model_afr_quarterly", "dim_date"):
        plan = E.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        assert "lineitem.parquet" not in plan  # one scan and one shuffle of the drive-days wrote the partials
        assert "fleetlens-partials-" in plan and "fleetlens-raw-" not in plan
    fct = E.queries()["fct_drive_daily"](spark, SF001)
    assert "lineitem.parquet" in fct._jdf.queryExecution().executedPlan().toString()  # stays lazy
