"""The command line: ingest a landing folder, build, check; exit codes."""

from __future__ import annotations

import os

import pytest

from fleetlens.__main__ import main
from fleetlens.sources.telemetry import raw_drive_stats

from helpers import SF001


def test_ingest_build_check(spark, scratch, capsys):
    raw_drive_stats(spark, SF001).write.partitionBy("quarter").option("header", True).csv(f"{scratch}/landing")
    assert main(["ingest", "--landing", f"{scratch}/landing", "--raw", f"{scratch}/raw", "--meta", f"{scratch}/meta"],
                spark) == 0
    assert main(["build", "--raw", f"{scratch}/raw", "--out", f"{scratch}/wh",
                 "--min-drive-count", "1", "--min-drive-days", "2"], spark) == 0
    code = main(["check", "--raw", f"{scratch}/raw", "--out", f"{scratch}/wh"], spark)
    out = capsys.readouterr().out
    assert "71 checks" in out
    # the warehouse built from the derived telemetry passes every error-level check
    assert code == 0 and "0 failed" in out
    # a refreshed warehouse has every table the checks read
    quarters = sorted(q.removeprefix("quarter=") for q in os.listdir(f"{scratch}/raw") if q.startswith("quarter="))
    args = ["--raw", f"{scratch}/raw", "--out", f"{scratch}/inc"]
    assert main(["refresh", *args, "--min-drive-count", "1", "--min-drive-days", "2", "--quarters", *quarters], spark) == 0
    assert main(["check", *args], spark) == 0


def test_sync_stream_and_failing_rows(spark, scratch, capsys):
    few = raw_drive_stats(spark, SF001).where("quarter < '1996Q1'").repartition("quarter")
    few.write.partitionBy("quarter").option("header", True).csv(f"{scratch}/landing")
    roots = ["--raw", f"{scratch}/raw", "--out", f"{scratch}/wh"]
    limits = ["--min-drive-count", "1", "--min-drive-days", "2", "--drive-buckets", "4"]
    drops = ["--landing", f"{scratch}/landing", "--meta", f"{scratch}/meta", "--checkpoint", f"{scratch}/checkpoint"]
    assert main(["stream", *roots, *limits, *drops], spark) == 0
    assert '{"batches": 1}' in capsys.readouterr().out
    assert main(["sync", *roots, *limits], spark) == 0  # the stream left nothing to do
    assert '"changed": [], "vanished": []' in capsys.readouterr().out
    assert main(["check", *roots, "--rows", f"{scratch}/failing"], spark) == 0
    assert "0 failed" in capsys.readouterr().out
    found = spark.read.parquet(f"{scratch}/failing").where("severity = 'error'")
    assert found.isEmpty()


def test_ingest_rejects_bad_quarter(spark):
    with pytest.raises(SystemExit):
        main(["ingest", "--quarter", "2026Q9", "--csv", "/x", "--raw", "/y", "--meta", "/z"], spark)
