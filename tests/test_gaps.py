"""Gaps of drives, outages of the source, samples of a stated size, statistics of files and the joined rolling rate."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetlens.operators import checks, dims, gaps, trend
from fleetlens.plans.export import sample_rows
from fleetlens.sources.files import statistics_session

from helpers import staged_rows


def seen(serial: str, *ranges: tuple[int, int], start: str = "2024-01-01", **more) -> list[dict]:
    day0 = dt.date.fromisoformat(start)
    return [{"date": (day0 + dt.timedelta(days=n)).isoformat(), "serial": serial, **more} for a, b in ranges for n in range(a, b + 1)]


def frames(spark, rows):
    stg = staged_rows(spark, rows)
    partials = dims.drive_quarter_partials(stg)
    return stg, partials


def test_runs_are_decoded_across_words_and_quarters(spark):
    # days 60-70 cross bit 63, days 85-95 cross the quarter's end, day 91 is its first day
    _, partials = frames(spark, seen("A", (0, 0), (60, 70), (85, 95), (200, 200)) + seen("B", (91, 181)) + seen(None, (0, 3)))
    got = gaps.drive_gaps(gaps.observed_runs(partials), gaps.fleet_days(partials, percent=0))
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    assert sorted(tuple(r) for r in got.collect()) == [
        ("A", day(1), day(59), 59, 0), ("A", day(71), day(84), 14, 0), ("A", day(96), day(199), 104, 0),
    ]


def test_an_outage_at_the_end_ends_no_span(spark):
    rows = [r for i in range(10) for r in seen(f"S{i}", (0, 20))] + seen("S0", (21, 21)) + seen("gone", (0, 10))
    _, partials = frames(spark, rows)
    days = gaps.fleet_days(partials)
    assert [r.snapshot_date.day for r in days.where("is_outage").collect()] == [22]
    status = {r.serial_number: r.censoring_status for r in gaps.spans_beside_outages(dims.merge_quarters(partials), days).collect()}
    assert status["gone"] == "exited_without_failure" and status["S5"] == status["S0"] == "active"
    plain = {r.serial_number: r.censoring_status for r in dims.spans_from_partials(dims.merge_quarters(partials)).collect()}
    assert plain["S5"] == "exited_without_failure"  # without the outage they would seem to have left


def test_days_of_an_outage_inside_a_gap(spark):
    rows = [r for i in range(6) for r in seen(f"S{i}", (0, 9), (12, 20))] + seen("T", (0, 5), (13, 20))
    _, partials = frames(spark, rows)
    got = {r.serial_number: (r.missing_days, r.outage_days) for r in gaps.drive_gaps(gaps.observed_runs(partials), gaps.fleet_days(partials)).collect()}
    assert got["S3"] == (2, 2) and got["T"] == (7, 2)


def test_no_rows(spark):
    _, partials = frames(spark, [])
    days = gaps.fleet_days(partials)
    assert days.isEmpty() and gaps.drive_gaps(gaps.observed_runs(partials), days).isEmpty()


@pytest.mark.parametrize("n", [1, 40, 77, 150, 10_000])
def test_a_sample_has_the_stated_size(spark, n):
    rows = [r for i in range(40) for r in seen(f"S{i}", (0, i % 9), model=f"M{i % 3}", failure=0)]
    rows += seen("F", (0, 3), model="M0", failure=0)[:-1] + [dict(seen("F", (3, 3), model="M0")[0], failure=1)]
    stg = staged_rows(spark, rows)
    drives = dims.dim_drive(stg)
    got = sample_rows(stg, drives, n)
    whole = {r.serial_number: r.drive_days for r in drives.collect()}
    kept = {r.serial_number: r["count"] for r in got.groupBy("serial_number").count().collect()}
    assert all(whole[s] == k for s, k in kept.items())  # whole histories
    size, total = sum(kept.values()), sum(whole.values())
    about = {r.serial_number: (r.model, r.status) for r in drives.collect()}
    assert {about[s][0] for s in kept} == {m for m, _ in about.values()} and {about[s][1] for s in kept} == {x for _, x in about.values()}
    if n >= total:
        assert size == total
    elif n >= 40:
        assert n <= size < n + max(whole.values())
    assert got.columns == stg.columns


def test_rolling_rate_by_join_equals_the_window_and_has_no_nested_loop(spark):
    days = [(m, dt.date(2024, 1, 1) + dt.timedelta(days=(i * i) % 400), i % 7 + 1, i % 3) for m in ("a", "b", None) for i in range(60)]
    daily = spark.createDataFrame(days, "model string, snapshot_date date, drive_days bigint, failures bigint")
    daily = daily.groupBy("model", "snapshot_date").agg(F.sum("drive_days").alias("drive_days"), F.sum("failures").alias("failures"))
    for n in (1, 30, 90, 1000):
        a, b = (sorted(map(tuple, trend.rolling_of_daily(daily, n, method=m).collect()), key=str) for m in ("window", "join"))
        assert a == b
    joined = trend.rolling_of_daily(daily, 90, method="join")
    joined.collect()
    assert "NestedLoop" not in joined._jdf.queryExecution().toString() and "Cartesian" not in joined._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        trend.rolling_of_daily(daily, 90, method="other")


def test_bounds_come_from_the_files(spark, scratch):
    rows = seen("A", (0, 400))
    staged_rows(spark, rows).write.partitionBy("quarter").parquet(f"{scratch}/raw")
    raw = statistics_session(spark).read.parquet(f"{scratch}/raw")
    fresh = checks.source_freshness(raw, "snapshot_date", "2025-03-01")
    assert fresh.first().max_date == dt.date(2024, 1, 1) + dt.timedelta(days=400)
    spine = dims.date_spine(raw)
    counts = raw.groupBy("quarter").agg(F.count(F.lit(1)).alias("n"), F.max("snapshot_date").alias("m"))
    assert spine.count() == 401 and counts.agg(F.sum("n")).first()[0] == 401
    for df in (fresh, spine, counts):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PushedAggregation: [M" in plan or "PushedAggregation: [COUNT" in plan, plan
