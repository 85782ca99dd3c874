"""CSV ingest: union by name, type pass, partition overwrite, reconciliation, drift."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from fleetlens.sources import ingest
from fleetlens.sources.telemetry import raw_drive_stats

from helpers import SF001
from helpers import int_columns


@pytest.fixture(scope="module")
def raw_pdf(spark):
    # Tiny (sf0.001) slice of the derived telemetry, used as CSV content.
    return int_columns(raw_drive_stats(spark, SF001).toPandas())


def _write_csv(pdf, path, columns):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pdf[columns].to_csv(path, index=False)


def _quarters(pdf):
    return sorted(pdf["quarter"].unique())


def test_union_by_name_no_shift_and_types(spark, raw_pdf, scratch):
    q = _quarters(raw_pdf)[5]
    part = raw_pdf[raw_pdf.quarter == q].drop(columns=["quarter"]).reset_index(drop=True)
    half = len(part) // 2
    cols = list(part.columns)
    other = list(reversed([c for c in cols if c not in ("pod_slot_num", "smart_198_raw")]))
    _write_csv(part.iloc[:half], f"{scratch}/csv/a.csv", cols)
    _write_csv(part.iloc[half:], f"{scratch}/csv/nested/b.csv", other)
    rep = ingest.ingest_quarter(spark, q, f"{scratch}/csv", f"{scratch}/raw", f"{scratch}/meta")
    assert rep.ok and rep.files == 2 and rep.parquet_rows == len(part)
    assert rep.types["date"] == "date" and rep.types["failure"] == "tinyint"
    assert rep.types["smart_5_raw"] == "bigint" and rep.types["serial_number"] == "string"
    back = ingest.read_raw_zone(spark, f"{scratch}/raw").toPandas()
    assert list(back.columns[:3]) == ["date", "failure", "capacity_bytes"]
    merged = back.set_index(["serial_number", "date"]).sort_index()
    src = part.assign(date=part["date"]).set_index(["serial_number", "date"]).sort_index()
    assert (merged["model"] == src["model"]).all()
    assert (merged["smart_5_raw"].astype("int64") == src["smart_5_raw"].astype("int64")).all()
    # the second file lacked two columns: NULL there, values kept in the first file
    assert merged["pod_slot_num"].isna().sum() >= len(part) - half
    log = spark.read.parquet(f"{scratch}/meta/ingest_log").collect()
    assert [r.result for r in log] == ["PASS"]


def test_rerun_and_backfill_keep_one_copy(spark, raw_pdf, scratch):
    qs = _quarters(raw_pdf)
    newer, older = qs[10], qs[9]
    for q in (newer, older, newer):  # newer, then backfill an older quarter, then rerun newer
        p = raw_pdf[raw_pdf.quarter == q].drop(columns=["quarter"])
        _write_csv(p, f"{scratch}/land/{q}/x.csv", list(p.columns))
        rep = ingest.ingest_quarter(spark, q, f"{scratch}/land/{q}", f"{scratch}/raw", f"{scratch}/meta")
        assert rep.ok
    counts = {r.quarter: r["count"] for r in ingest.read_raw_zone(spark, f"{scratch}/raw").groupBy("quarter").count().collect()}
    assert counts == {q: int((raw_pdf.quarter == q).sum()) for q in (newer, older)}
    drift = [r.quarter for r in spark.read.parquet(f"{scratch}/meta/schema_history").select("quarter").distinct().collect()]
    assert sorted(drift) == sorted([newer, older])
    assert rep.drift["status"] == "unchanged"


def test_drift_added_removed_and_null_then_typed_column(spark, raw_pdf, scratch):
    qs = _quarters(raw_pdf)
    q1, q2 = qs[3], qs[4]
    p1 = raw_pdf[raw_pdf.quarter == q1].drop(columns=["quarter", "smart_9_raw"]).copy()
    p1["smart_200_raw"] = None  # all-NULL in the first quarter
    _write_csv(p1, f"{scratch}/a/{q1}.csv", list(p1.columns))
    r1 = ingest.ingest_quarter(spark, q1, f"{scratch}/a", f"{scratch}/raw", f"{scratch}/meta")
    assert r1.drift["status"] == "baseline" and r1.types["smart_200_raw"] == "void"
    p2 = raw_pdf[raw_pdf.quarter == q2].drop(columns=["quarter", "smart_188_raw"]).copy()
    p2["smart_200_raw"] = 7
    _write_csv(p2, f"{scratch}/b/{q2}.csv", list(p2.columns))
    r2 = ingest.ingest_quarter(spark, q2, f"{scratch}/b", f"{scratch}/raw", f"{scratch}/meta")
    assert r2.drift["status"] == "changed" and r2.drift["prior_quarter"] == q1
    assert r2.drift["added"] == ["smart_9_raw"] and r2.drift["removed"] == ["smart_188_raw"]
    both = ingest.read_raw_zone(spark, f"{scratch}/raw")
    got = {r.quarter: r.s for r in both.groupBy("quarter").agg(F.sum("smart_200_raw").alias("s")).collect()}
    assert got[q1] is None and got[q2] == 7 * len(p2)
    log = {r.quarter: r for r in spark.read.parquet(f"{scratch}/meta/schema_drift_log").collect()}
    assert log[q1].status == "baseline" and log[q2].status == "changed"
    assert log[q2].added == ["smart_9_raw"] and log[q2].removed == ["smart_188_raw"]
    rep = ingest.drift_report(spark.read.parquet(f"{scratch}/meta/schema_history")).collect()
    row = {r.quarter: r for r in rep}[q2]
    assert row.prior_quarter == q1 and row.added == ["smart_9_raw"] and row.removed == ["smart_188_raw"]


def test_bad_quarter_rejected(spark):
    good = ["2026Q1", "1999Q4"]
    bad = ["2026Q5", "2026Q0", "26Q1", "2026q1", "2026Q11", " 2026Q1", "2026Q1\n", "", "２０２６Q1"]
    assert [q for q in good + bad if ingest.is_quarter(q)] == good
    with pytest.raises(ValueError):
        ingest.ingest_quarters(spark, {"2026Q5": ["x"]}, "r", "m")


def _drop(scratch, quarter, header, *lines, name="a"):
    os.makedirs(f"{scratch}/land/quarter={quarter}", exist_ok=True)
    with open(f"{scratch}/land/quarter={quarter}/{name}.csv", "w") as f:
        f.write("\n".join([header, *lines]) + "\n")


def _load(spark, scratch, quarter):
    return ingest.ingest_quarter(spark, quarter, f"{scratch}/land/quarter={quarter}", f"{scratch}/raw", f"{scratch}/meta")


def test_ragged_rows_fail_the_load(spark, scratch):
    _drop(scratch, "2026Q1", "date,serial_number,failure", "2026-01-01,S1,0,9,9", "2026-01-01,S2", "2026-01-01,S3,1")
    with pytest.raises(ingest.ReconciliationError, match="2 corrupt"):
        _load(spark, scratch, "2026Q1")
    assert not os.path.exists(f"{scratch}/raw")
    assert not os.path.exists(f"{scratch}/meta/schema_history")


def test_values_survive_the_type_pass(spark, scratch):
    _drop(
        scratch, "2026Q1", 'date,serial_number,at,day,flag,tag,code,n,x,yes,"a,b"',
        "2026-01-01,S1,2026-01-01 13:45:10,2026-01-02,Y,1D,007,-5,1.5,true,q",
        "2026-01-01,S2,2026-01-02,2026-01-03,n,2F,008,123456789012345678,2,FALSE,",
    )
    rep = _load(spark, scratch, "2026Q1")
    types = {c: rep.types[c] for c in ("at", "day", "flag", "tag", "code", "n", "x", "yes", "a,b")}
    assert types == {
        "at": "timestamp_ntz", "day": "date", "flag": "string", "tag": "string", "code": "string", "n": "bigint",
        "x": "double", "yes": "boolean", "a,b": "string",
    }
    row = ingest.read_raw_zone(spark, f"{scratch}/raw").where("serial_number = 'S1'").first()
    assert (str(row["at"]), row["flag"], row["tag"], row["code"], row["n"]) == ("2026-01-01 13:45:10", "Y", "1D", "007", -5)


def test_types_widen_across_batches(spark, scratch):
    """Quarters that type a column differently stay readable, whichever comes first."""
    _drop(scratch, "2026Q1", "date,serial_number,smart_5_raw,late,word", "2026-01-01,S1,7,,5", "2026-01-02,S1,8,,6")
    _drop(scratch, "2026Q2", "date,serial_number,smart_5_raw,late,word", "2026-04-01,S1,1.5,3,x")
    _drop(scratch, "2025Q4", "date,serial_number,late,word", "2025-12-31,S1,2.5,7")
    for q in ("2026Q1", "2026Q2", "2025Q4"):
        assert _load(spark, scratch, q).ok
    back = ingest.read_raw_zone(spark, f"{scratch}/raw")
    assert {c: t for c, t in back.dtypes if c in ("smart_5_raw", "late", "word")} == {
        "smart_5_raw": "double", "late": "double", "word": "string"
    }
    got = {(r.quarter, r.smart_5_raw, r.late, r.word) for r in back.collect()}
    assert got == {
        ("2026Q1", 7.0, None, "5"), ("2026Q1", 8.0, None, "6"), ("2026Q2", 1.5, 3.0, "x"), ("2025Q4", None, 2.5, "7")
    }
    some = ingest.read_raw_zone(spark, f"{scratch}/raw", ["2026Q1"])
    assert dict(some.dtypes)["smart_5_raw"] == "bigint" and some.count() == 2


def test_retyped_quarter_is_stored(spark, scratch):
    _drop(scratch, "2026Q1", "date,serial_number,n", "2026-01-01,S1,7")
    assert _load(spark, scratch, "2026Q1").drift["status"] == "baseline"
    _drop(scratch, "2026Q1", "date,serial_number,n", "2026-01-01,S1,7.5")
    assert _load(spark, scratch, "2026Q1").drift["status"] == "retyped"
    types = {r.column_name: r.data_type for r in spark.read.parquet(f"{scratch}/meta/schema_history").collect()}
    assert types["n"] == "double"


def test_unreadable_history_is_an_error(spark, scratch):
    _drop(scratch, "2026Q1", "date,serial_number,n", "2026-01-01,S1,7")
    os.makedirs(f"{scratch}/meta/schema_history/quarter=2025Q4")
    with open(f"{scratch}/meta/schema_history/quarter=2025Q4/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        _load(spark, scratch, "2026Q1")


def test_landing_batch_many_quarters_fixed_jobs(spark, raw_pdf, scratch):
    qs = _quarters(raw_pdf)[:6]
    for i, q in enumerate(qs):
        p = raw_pdf[raw_pdf.quarter == q].drop(columns=["quarter"])
        cols = list(p.columns) if i % 2 == 0 else list(reversed([c for c in p.columns if c != "pod_slot_num"]))
        _write_csv(p, f"{scratch}/land/quarter={q}/part-0.csv", cols)
    assert ingest.quarter_of_path(f"{scratch}/land/quarter={qs[0]}/part-0.csv") == qs[0]
    reps = ingest.ingest_landing(spark, f"{scratch}/land", f"{scratch}/raw", f"{scratch}/meta")
    assert [r.quarter for r in reps] == qs and all(r.ok for r in reps)
    back = ingest.read_raw_zone(spark, f"{scratch}/raw")
    got = {r.quarter: (r.n, r.slots) for r in back.groupBy("quarter").agg(
        F.count(F.lit(1)).alias("n"), F.count("pod_slot_num").alias("slots")).collect()}
    for i, q in enumerate(qs):
        n = int((raw_pdf.quarter == q).sum())
        assert got[q][0] == n
        assert (got[q][1] == 0) == (i % 2 == 1)  # quarters without the column read as NULL
    drift = {r.quarter: r for r in reps}
    assert drift[qs[0]].drift["status"] == "baseline"
    assert drift[qs[1]].drift["removed"] == ["pod_slot_num"] and drift[qs[2]].drift["added"] == ["pod_slot_num"]
