"""Options the reference leaves open: modal capacity, grace days, slot-aware drive type,
staged publish, partition-vs-date check, gold export, data-check failures."""

from __future__ import annotations

import os

import pytest

from fleetlens.operators import checks, dims, spans
from fleetlens.plans.export import export_gold
from fleetlens.plans.warehouse import WarehouseBuild, read_raw, write_table
from fleetlens.sources import ingest
from fleetlens.sources.seed import manufacturer_seed
from fleetlens.sources.telemetry import raw_drive_stats

from helpers import SF001
from helpers import staged_rows


def test_modal_capacity_differs_from_max(spark):
    rows = [{"date": f"2026-01-0{i}", "serial": "A", "model": "ST4", "capacity": c}
            for i, c in enumerate([4, 4, 8, -1], start=1)]
    rows += [{"date": "2026-01-01", "serial": "B", "model": "ST4", "capacity": 0}]
    stg = staged_rows(spark, rows)
    mx = {r.serial_number: r.capacity_bytes for r in dims.dim_drive(stg).collect()}
    md = {r.serial_number: r.capacity_bytes for r in dims.dim_drive(stg, capacity_rule="mode").collect()}
    assert mx == {"A": 8, "B": 8} and md == {"A": 4, "B": 4}


def test_grace_days_keep_recently_missing_drive_active(spark):
    rows = [{"date": "2026-01-01", "serial": "A"}, {"date": "2026-01-08", "serial": "A"},
            {"date": "2026-01-10", "serial": "Z"}]
    stg = staged_rows(spark, rows)
    plain = {r.serial_number: r.censoring_status for r in spans.observation_spans(stg).collect()}
    grace = {r.serial_number: r.censoring_status for r in spans.observation_spans(stg, grace_days=3).collect()}
    assert plain["A"] == "exited_without_failure" and grace["A"] == "active"


def test_slot_scope_ignores_quarters_without_slot_column(spark):
    # 2025Q4 was loaded before the slot column existed (all NULL): 3 rows; 2026Q1 has slots on 2 of 2.
    rows = [{"date": f"2025-12-0{i}", "serial": "A", "model": "ST4", "slot": None} for i in (1, 2, 3)]
    rows += [{"date": f"2026-01-0{i}", "serial": "A", "model": "ST4", "slot": 5} for i in (1, 2)]
    stg = staged_rows(spark, rows)
    seed = manufacturer_seed(spark)
    assert dims.dim_model(stg, seed).first().drive_type == "boot"
    assert dims.dim_model(stg, seed, drive_type_scope="slot_quarters").first().drive_type == "data"


def test_quarter_check_and_failing_checks(spark):
    rows = [{"date": "2026-01-01", "serial": "A", "quarter": "2025Q4"},
            {"date": "2026-01-02", "serial": None, "temp": 250}]
    stg = staged_rows(spark, rows)
    suite = [c for c in checks.WAREHOUSE_SUITE if c.table == "stg_drive_stats"]
    res = {r.check_name: r for r in checks.run_checks({"stg_drive_stats": stg}, suite).collect()}
    assert res["quarter_label_matches_partition"].failing_rows == 1
    assert res["quarter_label_matches_partition"].status == "warn"
    assert res["not_null:stg_drive_stats.serial_number"].status == "fail"
    assert res["temperature_within_bounds"].failing_rows == 1
    assert res["not_null:stg_drive_stats.snapshot_date"].status == "pass"


def test_unique_and_relationship_checks_fail_on_bad_frames(spark):
    child = spark.createDataFrame([("A",), ("A",), ("B",), (None,)], "k string")
    parent = spark.createDataFrame([("A",)], "k string")
    suite = [checks.CheckSpec("unique", "c", "k"),
             checks.CheckSpec("relationships", "c", "k", to_table="p", to_column="k")]
    res = {r.kind: r.failing_rows for r in checks.run_checks({"c": child, "p": parent}, suite).collect()}
    assert res == {"unique": 1, "relationships": 1}


def test_a_failed_load_keeps_the_good_partition(spark, scratch):
    pdf = raw_drive_stats(spark, SF001).toPandas()
    q = sorted(pdf.quarter.unique())[2]
    part = pdf[pdf.quarter == q].drop(columns=["quarter", "pod_slot_num", "smart_197_raw", "smart_198_raw"])
    os.makedirs(f"{scratch}/csv")
    part.to_csv(f"{scratch}/csv/a.csv", index=False)
    rep = ingest.ingest_quarter(spark, q, f"{scratch}/csv", f"{scratch}/raw", f"{scratch}/meta")
    assert rep.ok and rep.parquet_rows == len(part) and rep.gb_in > 0 and rep.gb_out > 0
    # a later drop with a ragged row must not replace the good partition
    with open(f"{scratch}/csv/a.csv", "a") as f:
        f.write("1999-01-01,S1\n")
    with pytest.raises(ingest.ReconciliationError, match="1 corrupt"):
        ingest.ingest_quarter(spark, q, f"{scratch}/csv", f"{scratch}/raw", f"{scratch}/meta")
    assert ingest.read_raw_zone(spark, f"{scratch}/raw").count() == len(part)
    results = [r.result for r in spark.read.parquet(f"{scratch}/meta/ingest_log").orderBy("logged_at").collect()]
    assert sorted(results) == ["FAIL", "PASS"]
    assert spark.read.parquet(f"{scratch}/meta/schema_drift_log").count() == 1
    assert spark.read.parquet(f"{scratch}/meta/_staging").count() == 0


def test_export_gold_parquet_and_csv(spark, scratch):
    raw_root = write_table(raw_drive_stats(spark, SF001), f"{scratch}/raw", partition_by="quarter")
    res = WarehouseBuild(spark, read_raw(spark, raw_root), f"{scratch}/wh").run()
    out = export_gold(spark, res.tables, f"{scratch}/gold", "parquet")
    assert set(out) == {"dim_drive", "dim_model", "dim_date", "mart_model_afr_quarterly", "fct_model_daily"}
    n = spark.read.parquet(out["dim_drive"]).count()
    assert n == spark.read.parquet(res.tables["dim_drive"]).count()
    csv = export_gold(spark, res.tables, f"{scratch}/gold_csv", "csv")
    back = spark.read.option("header", True).csv(csv["dim_model"])
    assert back.count() == spark.read.parquet(res.tables["dim_model"]).count()
    daily = spark.read.parquet(out["fct_model_daily"])
    assert daily.groupBy().sum("drive_days").first()[0] > 0
    views = res.register_views(spark, raw_root)
    assert "stg_drive_stats" in views and "mart_model_afr_quarterly" in views
    n_sql = spark.sql("select count(*) from fct_drive_daily f join dim_drive d using (serial_number)").first()[0]
    assert n_sql == spark.sql("select count(*) from stg_drive_stats where serial_number is not null").first()[0]
