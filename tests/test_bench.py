"""bench.py's timed run completes on sf0.001 (the driver runs it on sf0.1 every round)."""

from __future__ import annotations

import bench

from helpers import SF001


def test_bench_run_all_smoke(spark, scratch):
    times: dict[str, float] = {}
    landing = bench.land_csv(spark, SF001, f"{scratch}/b")
    result = bench.run_all(spark, landing, f"{scratch}/b", times)
    assert {"csv_ingest", "warehouse_build", "data_checks", "fleet_afr", "trend_anomaly"} <= set(times)
    assert all(isinstance(v, float) and v >= 0 for v in times.values())
    assert bench.COUNTS["data_checks"] == 71 and bench.COUNTS["data_checks_failed"] == 0
    assert result.read(spark, "fct_drive_daily").count() == 5967
