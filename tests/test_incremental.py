"""Partition-keyed incremental refresh equals the full build, in any load order."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.plans.incremental import refresh_quarters
from fleetlens.plans.warehouse import WarehouseBuild, read_raw, write_table
from fleetlens.sources.telemetry import raw_drive_stats

from helpers import SF001


def _rows(spark, path, cols=None):
    df = spark.read.parquet(path)
    if cols:
        df = df.select(*cols)
    return sorted(tuple(r) for r in df.collect())


def test_backward_loads_equal_full_build(spark, scratch):
    raw_root = write_table(raw_drive_stats(spark, SF001), f"{scratch}/raw", partition_by="quarter")
    full = WarehouseBuild(spark, read_raw(spark, raw_root), f"{scratch}/full").run()
    quarters = sorted(r.quarter for r in read_raw(spark, raw_root).select("quarter").distinct().collect())
    newer, older = quarters[len(quarters) // 2:], quarters[: len(quarters) // 2]
    inc = f"{scratch}/inc"
    refresh_quarters(spark, raw_root, inc, newer)
    paths = refresh_quarters(spark, raw_root, inc, older)  # backfill after the newer ones
    paths = refresh_quarters(spark, raw_root, inc, older[:2])  # rerun: no doubling
    for name in ("dim_drive", "dim_model", "dim_date", "int_drive_spans", "mart_model_afr_quarterly", "int_drive_model_partials"):
        assert _rows(spark, paths[name]) == _rows(spark, full.tables[name]), name
    fact_cols = ["drive_day_key", "failure_flag"]
    assert _rows(spark, paths["fct_drive_daily"], fact_cols) == _rows(spark, full.tables["fct_drive_daily"], fact_cols)
    events = ["failure_event_key"]
    assert _rows(spark, paths["fct_failures"], events) == _rows(spark, full.tables["fct_failures"], events)


def test_a_reloaded_quarter_may_lose_its_failures(spark, scratch):
    raw = raw_drive_stats(spark, SF001)
    write_table(raw, f"{scratch}/raw", partition_by="quarter")
    quarters = sorted(r.quarter for r in raw.where("failure = 1").select("quarter").distinct().collect())[:2]
    paths = refresh_quarters(spark, f"{scratch}/raw", f"{scratch}/inc", quarters)
    assert {r.quarter for r in spark.read.parquet(paths["fct_failures"]).select("quarter").distinct().collect()} == set(quarters)
    healthy = raw.where(raw.quarter == quarters[0]).withColumn("failure", F.lit(0).cast("tinyint"))
    write_table(healthy, f"{scratch}/raw", partition_by="quarter", dynamic=True)
    refresh_quarters(spark, f"{scratch}/raw", f"{scratch}/inc", quarters[:1])
    assert {r.quarter for r in spark.read.parquet(paths["fct_failures"]).select("quarter").distinct().collect()} == {quarters[1]}
