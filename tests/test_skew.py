"""A hot model (a third of all rows) and a hot serial (hundreds of duplicated rows):
results stay exact and every shuffle over drive-day rows is preceded by a partial aggregate."""

from __future__ import annotations

import datetime as dt

import pandas as pd

from fleetlens.operators import dims, fleet, spans
from fleetlens.sources.seed import manufacturer_seed

from helpers import staged_rows


def _skewed(spark):
    rows = []
    base = dt.date(2024, 1, 1)
    # 200 ordinary drives over 5 models, 10 days each (2000 rows)
    for i in range(200):
        for d in range(10):
            rows.append({"date": (base + dt.timedelta(days=d)).isoformat(), "serial": f"N{i}", "model": f"ST{i % 5}",
                         "failure": 1 if (d == 9 and i % 17 == 0) else 0, "slot": i % 3 or None})
    # one hot serial of model HOT with 1000 rows: one row per day (the grain) plus duplicates
    for d in range(1000):
        rows.append({"date": (base + dt.timedelta(days=d % 300)).isoformat(), "serial": "HOT1", "model": "HOT9",
                     "failure": 1 if d == 899 else 0, "slot": 1})  # 899 % 300 = 299, the last day
    return staged_rows(spark, rows), pd.DataFrame(rows)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_exact_results(spark):
    stg, pdf = _skewed(spark)
    sp = {r.serial_number: r for r in spans.observation_spans(stg).collect()}
    hot = pdf[pdf.serial == "HOT1"]
    assert sp["HOT1"].observed_days == len(hot) == 1000
    assert sp["HOT1"].last_seen.isoformat() == max(hot.date)
    # the last day of HOT1 (day 299) has three rows, flags 0, 0 and 1 -> failed
    assert sp["HOT1"].censoring_status == "failed"
    dm = {r.model: r for r in dims.dim_model(stg, manufacturer_seed(spark)).collect()}
    assert dm["HOT9"].fleet_drive_count == 1 and dm["ST0"].fleet_drive_count == 40
    daily = {r.snapshot_date.isoformat(): r for r in fleet.fleet_daily(stg).collect()}
    want = pdf.groupby("date").agg(n=("serial", "size"), d=("serial", "nunique"))
    for day, r in want.iterrows():
        assert (daily[day].drive_days, daily[day].active_drives) == (r.n, r.d)


def test_partial_aggregation_before_every_drive_day_shuffle(spark):
    stg, _ = _skewed(spark)
    for df in (dims.drive_model_partials(stg), dims.model_stats(stg), spans.observation_spans(stg),
               fleet.fleet_daily(stg)):
        plan = _plan(df)
        # the scan side: the first exchange above the scan is fed by a partial aggregate
        lines = [ln.strip() for ln in plan.splitlines()]
        scan_ix = max(i for i, ln in enumerate(lines) if "Scan" in ln)
        first_exchange = max(i for i, ln in enumerate(lines[:scan_ix]) if "Exchange hashpartitioning" in ln)
        between = " ".join(lines[first_exchange:scan_ix])
        assert "HashAggregate" in between and "partial_" in between, plan
    # the pass over drive-day rows is hash-based throughout
    assert "SortAggregate" not in _plan(dims.drive_model_partials(stg))
