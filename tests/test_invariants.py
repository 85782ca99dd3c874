"""Invariants of the warehouse on the derived telemetry (facts from FIXTURES.md section 6)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fleetlens.plans.registry import Warehouse
from fleetlens.config import TEST_SCALE_THRESHOLDS
from fleetlens.operators import afr, dims

from helpers import SF001, SF01

# (sf_dir, rows, drives, active, exited, failed, capacity filled from model, data model-quarters)
FACTS = [
    (SF001, 5967, 200, 1, 179, 20, 3, 693),
    (SF01, 59657, 2000, 23, 1777, 200, 21, 700),
]


@pytest.mark.parametrize("sf_dir,rows,drives,active,exited,failed,filled,mq", FACTS)
def test_invariants(spark, sf_dir, rows, drives, active, exited, failed, filled, mq):
    w = Warehouse(spark, sf_dir)
    stg = w.stg.cache()
    raw_n = stg.count()
    assert raw_n == rows
    assert w.fct_drive_daily.count() == raw_n  # no row dropped or duplicated by the fact

    sp = w.spans
    status = {r.censoring_status: r["count"] for r in sp.groupBy("censoring_status").count().collect()}
    assert status == {"active": active, "exited_without_failure": exited, "failed": failed}
    assert sp.agg(F.min("observed_days")).first()[0] >= 1
    assert sp.agg(F.sum("observed_days")).first()[0] == raw_n

    # failures agree across the failure fact, the spans and the fact's flag sum
    n_fail_fact = w.fct_failures.count()
    n_flag = w.fct_drive_daily.agg(F.sum("failure_flag")).first()[0]
    assert n_fail_fact == failed == n_flag

    dd = w.dim_drive
    assert dd.count() == drives
    rep = dims.repair_capacity(stg)
    assert rep.where(F.col("repair_source") == "model").count() == filled
    dm = w.dim_model.cache()
    assert dm.count() == 30
    assert dm.agg(F.sum("fleet_drive_count")).first()[0] == drives
    assert dm.where(F.col("drive_type") == "boot").count() == 5
    assert dm.where(F.col("manufacturer") == "Unknown").count() == 5

    mart = afr.afr_quarterly(w.fct_drive_daily, dd, dm, None)
    assert mart.count() == mq
    # the mart's quarters partition the data drives' drive-days
    data_days = (
        w.fct_drive_daily.join(dd.select("serial_number", "model"), "serial_number")
        .join(dm.where(F.col("drive_type") == "data").select("model"), "model", "left_semi")
        .count()
    )
    assert mart.agg(F.sum("drive_days")).first()[0] == data_days
    cut = afr.afr_quarterly(w.fct_drive_daily, dd, dm, TEST_SCALE_THRESHOLDS)
    assert cut.where((F.col("drive_count") <= 20) | (F.col("drive_days") <= 50)).count() == 0
    stg.unpersist()
    dm.unpersist()
