"""Property tests: operators against brute-force Python on random small inputs."""

from __future__ import annotations

import datetime as dt
from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetlens.operators import dims, fleet, spans, survival
from fleetlens.operators.trend import rolling_rate_expand, rolling_rate_window

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
BASE = dt.date(1969, 12, 1)  # spans the 1970 epoch so negative day numbers are exercised

day = st.integers(min_value=0, max_value=80)
flag = st.sampled_from([0, 1, None])


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("ABC"), st.one_of(st.none(), day), flag), min_size=1, max_size=30))
def test_last_day_flag_matches_brute_force(spark, rows):
    data = [(s, BASE + dt.timedelta(days=d) if d is not None else None, f) for s, d, f in rows]
    df = spark.createDataFrame(data, "s string, d date, f tinyint")
    got = {r.s: r.v for r in df.groupBy("s").agg(spans.last_day_flag(F.col("d"), F.col("f")).alias("v")).collect()}
    want = {}
    for s in {r[0] for r in data}:
        dated = [(d, f) for ss, d, f in data if ss == s and d is not None]
        if not dated:
            want[s] = None
            continue
        last = max(d for d, _ in dated)
        flags = [f for d, f in dated if d == last and f is not None]
        want[s] = max(flags) if flags else None
    assert got == want


prefix_alpha = st.text(alphabet="ABW", min_size=0, max_size=4)


@SETTINGS
@given(st.lists(prefix_alpha, min_size=1, max_size=8), st.lists(st.tuples(prefix_alpha, st.sampled_from("xyz")), max_size=8))
def test_longest_prefix_matches_brute_force(spark, keys, table):
    kdf = spark.createDataFrame([(k,) for k in keys], "model string")
    tdf = spark.createDataFrame(table, "model_prefix string, manufacturer string")
    got = {r.model: r.manufacturer for r in dims.longest_prefix_match(kdf, "model", tdf).collect()}
    want = {}
    for k in set(keys):
        hits = [(len(p), v) for p, v in table if k.startswith(p)]
        want[k] = max(hits)[1] if hits else "Unknown"
    assert got == want


@SETTINGS
@given(
    st.lists(st.tuples(st.sampled_from(["M1", "M2"]), st.integers(0, 200), st.integers(1, 9), st.integers(0, 2)),
             min_size=1, max_size=40, unique_by=lambda r: (r[0], r[1])),
    st.sampled_from([1, 7, 30]),
)
def test_rolling_window_and_expand_forms_agree(spark, rows, days):
    data = [(m, BASE + dt.timedelta(days=d), n, f) for m, d, n, f in rows]
    daily = spark.createDataFrame(data, "model string, snapshot_date date, drive_days bigint, failures bigint")
    a = sorted(tuple(r) for r in rolling_rate_window(daily, days).collect())
    b = sorted(tuple(r) for r in rolling_rate_expand(daily, days).select(
        "model", "snapshot_date", "window_drive_days", "window_failures", "rolling_afr_pct").collect())
    assert a == b
    # brute force of the sums
    for m, d, wd, wf, _ in a:
        rows_in = [(n, f) for mm, dd, n, f in data if mm == m and d - dt.timedelta(days=days - 1) <= dd <= d]
        assert (wd, wf) == (sum(n for n, _ in rows_in), sum(f for _, f in rows_in))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 400), st.booleans()), min_size=1, max_size=25))
def test_life_table_matches_brute_force(spark, drives):
    start = dt.date(2020, 1, 1)
    data = [(f"S{i}", "M", start, start + dt.timedelta(days=age), "failed" if failed else "active")
            for i, (age, failed) in enumerate(drives)]
    dd = spark.createDataFrame(data, "serial_number string, model string, first_seen date, last_seen date, status string")
    got = {r.age_bucket: (r.at_risk, r.failures, r.censored, r.survival)
           for r in survival.cohort_survival(dd, bucket_days=90).collect()}
    exits = Counter(age // 90 for age, _ in drives)
    fails = Counter(age // 90 for age, f in drives if f)
    surv, want = 1.0, {}
    for b in range(max(exits) + 1):
        at_risk = sum(c for bb, c in exits.items() if bb >= b)
        surv *= 1.0 - fails[b] / at_risk
        want[b] = (at_risk, fails[b], exits[b] - fails[b], round(surv * 1e6) / 1e6)
    assert got.keys() == want.keys()
    for b in want:
        assert got[b][:3] == want[b][:3] and abs(got[b][3] - want[b][3]) < 1e-9


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("AB"), st.integers(0, 3), st.sampled_from([0, 1]),
                          st.sampled_from([-1, 4, 8])), min_size=1, max_size=20))
def test_dedupe_keeps_one_row_per_grain_by_rule(spark, rows):
    from helpers import staged_rows

    recs = [{"date": (BASE + dt.timedelta(days=d)).isoformat(), "serial": s, "failure": f, "capacity": c}
            for s, d, f, c in rows]
    stg = staged_rows(spark, recs)
    out = fleet.dedupe_grain(stg).collect()
    assert len(out) == len({(s, d) for s, d, _, _ in rows})
    by_key = defaultdict(list)
    for s, d, f, c in rows:
        by_key[(s, BASE + dt.timedelta(days=d))].append((f, c))
    for r in out:
        cands = by_key[(r.serial_number, r.snapshot_date)]
        best_f = max(f for f, _ in cands)
        assert r.failure_flag == best_f
        if any(c > 0 for f, c in cands if f == best_f):
            assert r.capacity_bytes > 0


@SETTINGS
@given(st.lists(st.integers(-50_000, 500_000), min_size=1, max_size=40), st.sampled_from([3, 10, 90]))
def test_exact_limits_match_sample_statistics(spark, cents, baseline):
    import statistics

    from fleetlens.operators.trend import exact_limits

    data = [(BASE + dt.timedelta(days=i), c / 100.0) for i, c in enumerate(cents)]
    df = spark.createDataFrame(data, "d date, v double").withColumn("_day", F.unix_date("d"))
    mean, sd, n = exact_limits(F.col("v"), F.col("_day"), [], baseline, 100)
    rows = df.select("d", mean.alias("m"), sd.alias("s"), n.alias("n")).orderBy("d").collect()
    for i, r in enumerate(rows):
        prior = [c / 100.0 for c in cents[max(0, i - baseline):i]]
        assert r.n == len(prior)
        if not prior:
            assert r.m is None
            continue
        assert abs(r.m - statistics.fmean(prior)) < 1e-9 * max(1.0, abs(r.m))
        if len(prior) > 1:
            assert abs(r.s - statistics.stdev(prior)) < 1e-6 * max(1.0, r.s)
        else:
            assert r.s is None
