"""Hand-made frames, each isolating one rule of the warehouse."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.config import AfrThresholds
from fleetlens.functions.columns import afr_pct, capacity_class, normalize_model, round2
from fleetlens.operators import afr, checks, dims, facts, spans, survival
from fleetlens.sources.seed import manufacturer_seed

from helpers import staged_rows


def _spans(spark, rows):
    return {r.serial_number: r for r in spans.observation_spans(staged_rows(spark, rows)).collect()}


def test_failure_on_dataset_max_date_is_failed_not_active(spark):
    s = _spans(spark, [
        {"date": "2026-01-01", "serial": "A"},
        {"date": "2026-01-05", "serial": "A", "failure": 1},
        {"date": "2026-01-05", "serial": "B"},
        {"date": "2026-01-02", "serial": "C"},
    ])
    assert s["A"].censoring_status == "failed"
    assert s["B"].censoring_status == "active"
    assert s["C"].censoring_status == "exited_without_failure"


def test_two_rows_on_last_day_take_max_flag_and_both_count(spark):
    s = _spans(spark, [
        {"date": "2026-01-01", "serial": "A"},
        {"date": "2026-01-03", "serial": "A", "failure": 0},
        {"date": "2026-01-03", "serial": "A", "failure": 1},
        {"date": "2026-01-04", "serial": "Z"},
    ])
    assert s["A"].final_day_failure_flag == 1
    assert s["A"].observed_days == 3
    assert s["A"].censoring_status == "failed"


def test_flag_on_earlier_day_only(spark):
    rows = [
        {"date": "2026-01-01", "serial": "A", "failure": 1},
        {"date": "2026-01-02", "serial": "A"},
        {"date": "2026-01-09", "serial": "Z"},
    ]
    s = _spans(spark, rows)
    assert s["A"].final_day_failure_flag == 0
    assert s["A"].censoring_status == "exited_without_failure"
    stg = staged_rows(spark, rows)
    bad = checks.failure_only_on_last_seen(stg, spans.observation_spans(stg)).collect()
    assert [(r.serial_number, str(r.snapshot_date)) for r in bad] == [("A", "2026-01-01")]


def test_null_flag_on_last_day_is_zero(spark):
    s = _spans(spark, [
        {"date": "2026-01-01", "serial": "A", "failure": 1},
        {"date": "2026-01-02", "serial": "A", "failure": None},
        {"date": "2026-01-02", "serial": "Z"},
    ])
    assert s["A"].final_day_failure_flag == 0
    assert s["A"].censoring_status == "active"


def test_dates_before_1970_keep_last_day_flag(spark):
    s = _spans(spark, [
        {"date": "1960-01-01", "serial": "A"},
        {"date": "1960-03-01", "serial": "A", "failure": 1},
        {"date": "1961-01-01", "serial": "Z"},
    ])
    assert s["A"].final_day_failure_flag == 1 and s["A"].last_seen.isoformat() == "1960-03-01"


def test_null_serial_model_capacity(spark):
    rows = [
        {"date": "2026-01-01", "serial": None, "model": "ST4"},
        {"date": "2026-01-01", "serial": "B", "model": None},
        {"date": "2026-01-01", "serial": "C", "model": "ST4", "capacity": None},
        {"date": "2026-01-02", "serial": "D", "model": "ST4", "capacity": 4_000_000_000_000},
    ]
    stg = staged_rows(spark, rows)
    sp = {r.serial_number for r in spans.observation_spans(stg).collect()}
    assert None in sp  # kept in spans
    dd = {r.serial_number: r for r in dims.dim_drive(stg).collect()}
    assert None not in dd  # dropped from dim_drive
    assert dd["B"].model is None
    assert dd["C"].capacity_bytes == 4_000_000_000_000  # NULL is neither sentinel nor usable: model fallback
    dm = {r.model for r in dims.dim_model(stg, manufacturer_seed(spark)).collect()}
    assert dm == {"ST4"}  # NULL model absent from dim_model


def test_all_sentinel_drive_gets_model_capacity_or_null(spark):
    rows = [
        {"date": "2026-01-01", "serial": "A", "model": "ST4", "capacity": -1},
        {"date": "2026-01-02", "serial": "A", "model": "ST4", "capacity": 0},
        {"date": "2026-01-01", "serial": "B", "model": "ST4", "capacity": 4_000_000_000_000},
        {"date": "2026-01-01", "serial": "C", "model": "QQ9", "capacity": -1},
    ]
    stg = staged_rows(spark, rows)
    dd = {r.serial_number: r.capacity_bytes for r in dims.dim_drive(stg).collect()}
    assert dd == {"A": 4_000_000_000_000, "B": 4_000_000_000_000, "C": None}
    dm = {r.model: r for r in dims.dim_model(stg, manufacturer_seed(spark)).collect()}
    assert dm["QQ9"].capacity_bytes is None and dm["QQ9"].capacity_class == "Unknown"
    assert dm["QQ9"].manufacturer == "Unknown"
    bad = checks.run_checks({"dim_drive": dims.dim_drive(stg)}, [
        c for c in checks.WAREHOUSE_SUITE if c.name == "dim_drive_capacity_positive"
    ]).collect()
    assert bad[0].failing_rows == 1 and bad[0].status == "fail"


def test_slot_share_exactly_half_is_data(spark):
    rows = [
        {"date": "2026-01-01", "serial": "A", "model": "ST4", "slot": 3},
        {"date": "2026-01-02", "serial": "A", "model": "ST4", "slot": None},
        {"date": "2026-01-01", "serial": "B", "model": "CT1", "slot": None},
        {"date": "2026-01-02", "serial": "B", "model": "CT1", "slot": None},
        {"date": "2026-01-03", "serial": "B", "model": "CT1", "slot": 1},
    ]
    dm = {r.model: r.drive_type for r in dims.dim_model(staged_rows(spark, rows), manufacturer_seed(spark)).collect()}
    assert dm == {"ST4": "data", "CT1": "boot"}


def test_wdc_prefix_normalization(spark):
    df = spark.createDataFrame([("WDC WUH1",), ("WUH1",), ("WDC  X",), ("WDCX",), (None,)], "m string")
    got = [r.n for r in df.select(normalize_model("m").alias("n")).collect()]
    assert got == ["WUH1", "WUH1", " X", "WDCX", None]
    rows = [
        {"date": "2026-01-01", "serial": "A", "model": "WDC WUH1"},
        {"date": "2026-01-01", "serial": "B", "model": "WUH1"},
        {"date": "2026-01-01", "serial": "C", "model": "WDC  X"},
    ]
    dm = {r.model: r for r in dims.dim_model(staged_rows(spark, rows), manufacturer_seed(spark)).collect()}
    assert set(dm) == {"WUH1", " X"}
    assert dm["WUH1"].fleet_drive_count == 2 and dm["WUH1"].manufacturer == "Western Digital"
    assert dm[" X"].manufacturer == "Unknown"


def test_longest_prefix_wins(spark):
    seed = spark.createDataFrame([("WD", "Maker Short"), ("WDC", "Maker Long"), ("X", "Other")],
                                 "model_prefix string, manufacturer string")
    keys = spark.createDataFrame([("WDCX",), ("WDX",), ("Q",), (None,)], "model string")
    got = {r.model: r.manufacturer for r in dims.longest_prefix_match(keys, "model", seed).collect()}
    assert got == {"WDCX": "Maker Long", "WDX": "Maker Short", "Q": "Unknown", None: "Unknown"}


def test_capacity_class_boundary(spark):
    df = spark.createDataFrame([(999_999_999_999,), (1_000_000_000_000,), (250059350016,), (None,)], "b bigint")
    got = [r.c for r in df.select(capacity_class("b").alias("c")).collect()]
    assert got == ["1000GB", "1TB", "250GB", "Unknown"]


def test_rounding_matches_round_half_of_binary_value(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (0.125,)], "x double")
    got = [r.r for r in df.select(round2("x").alias("r")).collect()]
    assert got == [1.0, 2.68, 0.13]
    one = spark.createDataFrame([(1, 365)], "f bigint, d bigint").select(afr_pct("f", "d").alias("a")).first().a
    assert one == 100.0


def test_threshold_is_strict(spark):
    thr = AfrThresholds(1, 3)
    rows = []
    # model ST4: 2 drives x 2 days = 4 drive-days (passes 1 / 3); model ST8: 1 drive x 3 days (fails count)
    for s in ("A", "B"):
        for day in ("2026-01-01", "2026-01-02"):
            rows.append({"date": day, "serial": s, "model": "ST4"})
    for day in ("2026-01-01", "2026-01-02", "2026-01-03"):
        rows.append({"date": day, "serial": "C", "model": "ST8"})
    stg = staged_rows(spark, rows)
    mart = afr.afr_quarterly(facts.fct_drive_daily(stg), dims.dim_drive(stg),
                             dims.dim_model(stg, manufacturer_seed(spark)), thr).collect()
    assert [(r.model, r.drive_count, r.drive_days) for r in mart] == [("ST4", 2, 4)]
    thr_exact = AfrThresholds(2, 4)  # drive_count = 2 and drive_days = 4 are excluded (strict)
    mart2 = afr.afr_quarterly(facts.fct_drive_daily(stg), dims.dim_drive(stg),
                              dims.dim_model(stg, manufacturer_seed(spark)), thr_exact).collect()
    assert mart2 == []


def test_cohort_bucket_where_every_drive_fails(spark):
    dd = spark.createDataFrame(
        [("A", "M", "2026-01-01", "2026-01-10", "failed"), ("B", "M", "2026-01-01", "2026-01-20", "failed")],
        "serial_number string, model string, first_seen string, last_seen string, status string",
    ).select("serial_number", "model", F.col("first_seen").cast("date").alias("first_seen"),
             F.col("last_seen").cast("date").alias("last_seen"), "status")
    rows = survival.cohort_survival(dd).collect()
    assert [(r.age_bucket, r.at_risk, r.failures, r.survival) for r in rows] == [(0, 2, 2, 0.0)]


def test_censored_drives_leave_risk_set(spark):
    dd = spark.createDataFrame(
        [("A", "M", "2026-01-01", "2026-01-10", "exited_without_failure"),
         ("B", "M", "2026-01-01", "2026-05-01", "failed"),
         ("C", "M", "2026-01-01", "2026-06-01", "active")],
        "serial_number string, model string, first_seen string, last_seen string, status string",
    ).select("serial_number", "model", F.col("first_seen").cast("date").alias("first_seen"),
             F.col("last_seen").cast("date").alias("last_seen"), "status")
    rows = {r.age_bucket: r for r in survival.cohort_survival(dd).collect()}
    assert (rows[0].at_risk, rows[0].failures, rows[0].censored, rows[0].survival) == (3, 0, 1, 1.0)
    assert (rows[1].at_risk, rows[1].failures, rows[1].survival) == (2, 1, 0.5)


def test_fact_key_propagates_null(spark):
    stg = staged_rows(spark, [{"date": "2026-01-01", "serial": None}, {"date": "2026-01-01", "serial": "A"}])
    keys = sorted((r.drive_day_key is None, r.drive_day_key) for r in facts.fct_drive_daily(stg).collect())
    assert keys == [(False, "A|2026-01-01"), (True, None)]
