"""Survival with late entry: hand-made cohorts."""

from __future__ import annotations

import datetime as dt

import pytest

from fleetlens.operators import dims, survival

from helpers import staged_rows


def day(n: int) -> str:
    return (dt.date(2024, 1, 1) + dt.timedelta(days=n)).isoformat()


def life(serial: str, first: int, days: list[int], age0: int | None, fails: bool = False, model: str = "ST4") -> list[dict]:
    """Rows of a drive seen on the given days (offsets from its first one), of age ``age0`` days on the first."""
    return [
        {"date": day(first + n), "serial": serial, "model": model, "failure": int(fails and n == days[-1]),
         "hours": None if age0 is None else (age0 + n) * 24 + 5}
        for n in days
    ]


def table(spark, rows, age="power_on", **options):
    stg = staged_rows(spark, rows)
    got = survival.late_entry_survival(survival.drive_ages(stg, age), dims.dim_drive(stg), **options)
    key = lambda r: tuple((x is not None, x) for x in r[:3])
    return sorted((tuple(r) for r in got.drop("age_start_days").collect()), key=key)


def test_a_drive_that_enters_at_bucket_three_is_at_risk_from_there_only(spark):
    rows = life("A", 0, [0, 100, 200, 300, 400], 0) + life("B", 0, [0, 50, 100], 0, fails=True)
    rows += life("C", 0, [0, 90, 100], 275, fails=True)  # buckets 3 (days 270-359) and 4
    got = table(spark, rows)
    # model, bucket, entered, at_risk, failures, censored, null rows, survival
    assert got == [
        ("ST4", 0, 2, 2, 0, 0, 0, 1.0),
        ("ST4", 1, 0, 2, 1, 0, 0, 0.5),
        ("ST4", 2, 0, 1, 0, 0, 0, 0.5),
        ("ST4", 3, 1, 2, 0, 0, 0, 0.5),
        ("ST4", 4, 0, 2, 1, 1, 0, 0.25),
    ]


def test_by_days_observed_everybody_enters_at_the_start(spark):
    rows = life("A", 0, [0, 100, 200, 300, 400], 0) + life("C", 0, [0, 90, 100], 275, fails=True)
    got = table(spark, rows, "observed")
    assert [r[:5] for r in got[:2]] == [("ST4", 0, 2, 2, 0), ("ST4", 1, 0, 2, 1)]
    plain = survival.cohort_survival(dims.dim_drive(staged_rows(spark, rows)))
    want = sorted((r.model, r.age_bucket, r.at_risk, r.failures, r.censored, r.survival) for r in plain.collect())
    assert [(r[0], r[1], r[3], r[4], r[5], r[7]) for r in got] == want


def test_rows_without_an_age_are_counted(spark):
    rows = life("A", 0, [0, 1, 2], None) + life("A", 3, [0, 10], 30)
    rows += [{"date": day(20), "serial": "A", "hours": -24}]  # a negative reading is no age
    rows += life("X", 0, [0, 1], None, model="none") + [{"date": day(0), "serial": None, "hours": 24}]
    got = table(spark, rows)
    assert got == [("ST4", 0, 1, 1, 0, 1, 4, 1.0), ("none", None, 0, 0, 0, 0, 2, None)]


def test_a_gap_with_nobody_at_risk_keeps_survival(spark):
    rows = life("A", 0, [0, 10, 20], 0) + life("B", 0, [0, 10, 20, 30], 500, fails=True) + life("C", 0, [0, 30], 500)
    got = table(spark, rows)
    assert [(r[1], r[3], r[7]) for r in got] == [(0, 1, 1.0), (1, 0, 1.0), (2, 0, 1.0), (3, 0, 1.0), (4, 0, 1.0), (5, 2, 0.5)]


def test_actuarial_counts_half_of_late_entries_and_of_censored(spark):
    rows = life("A", 0, [0, 10], 5) + life("B", 0, [0, 60], 0, fails=True) + life("C", 0, [0, 89], 0)
    assert table(spark, rows, actuarial=True) == [("ST4", 0, 3, 3, 1, 2, 0, round(1 - 1 / 1.5, 6))]


def test_vintages_are_cohorts_of_their_own(spark):
    rows = life("A", 0, [0, 5], 0) + life("B", 100, [0, 5], 200)
    got = table(spark, rows, by_vintage=True)
    assert [(r[1], r[2], r[4]) for r in got] == [("2024Q1", 0, 1), ("2024Q2", 2, 1)]


def test_edges(spark):
    assert table(spark, []) == []
    with pytest.raises(ValueError):
        survival.drive_ages(staged_rows(spark, []), "wrong")
