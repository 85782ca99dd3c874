"""What a task holds, and the files that are written, must not follow the size of the input."""

from __future__ import annotations

import glob
import os

from pyspark.sql import functions as F

from fleetlens.plans import registry
from fleetlens.session import ROWS_PER_TASK, size_shuffles
from fleetlens.sources import ingest

from helpers import SF01


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_shuffles_follow_the_rows(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", "8")
    size_shuffles(own, 8 * ROWS_PER_TASK)
    assert ", 8)" in _plan(own.range(100).repartition("id"))
    size_shuffles(own, 20 * ROWS_PER_TASK + 1)
    assert ", 21)" in _plan(own.range(100).repartition("id"))
    size_shuffles(own, 10 * ROWS_PER_TASK)  # a smaller table after a larger one: AQE coalesces
    assert own.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == "21"


def test_raw_zone_has_few_files(spark):
    path = registry._raw_path(spark, SF01, "quarter")
    raw = registry.raw_drive_stats(spark, SF01)
    again = spark.read.schema(raw.schema).parquet(path)
    assert len(again.inputFiles()) == again.select("quarter").distinct().count()
    assert again.columns == raw.columns and again.exceptAll(raw).isEmpty() and raw.exceptAll(again).isEmpty()


def test_lines_are_counted_without_a_sort(spark, scratch, monkeypatch):
    os.makedirs(f"{scratch}/csv")
    for name, text in (("a", "\n  \nx,y\n1,2\nx,y\n"), ("b", 'y;"x"\n"1";2\n'), ("c", "\n")):
        with open(f"{scratch}/csv/{name}.csv", "w") as f:
            f.write(text)
    plans = []
    frame = type(spark.range(0))
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: plans.append(_plan(self)) or collect(self))
    files = ingest.list_csv_files(spark, f"{scratch}/csv")
    found = {os.path.basename(f): d for f, d in ingest.scan_files(spark, files).items()}
    assert plans and not any("SortAggregate" in p for p in plans)
    assert {f: (d.header, d.lines, d.dialect.delimiter) for f, d in found.items()} == {
        "a.csv": (("x", "y"), 2, ","), "b.csv": (("y", "x"), 1, ";"), "c.csv": ((), 0, ",")
    }


def test_header_is_found_where_hashes_collide(spark, scratch, monkeypatch):
    os.makedirs(f"{scratch}/csv")
    with open(f"{scratch}/csv/a.csv", "w") as f:
        f.write("x,y\n1,2\n3,4\n")
    monkeypatch.setattr(ingest.F, "xxhash64", lambda c: F.lit(5).cast("long"))
    (drop,) = ingest.scan_files(spark, ingest.list_csv_files(spark, f"{scratch}/csv")).values()
    assert (drop.header, drop.lines) == (("x", "y"), 2)


def test_landed_drops_are_split(spark, scratch, monkeypatch):
    monkeypatch.setattr(registry, "DROP_RECORDS", 10)
    rows = spark.range(95).selectExpr("id", "'1996Q1' as quarter").coalesce(1)
    registry.land_drops(rows, f"{scratch}/drops")
    assert len(glob.glob(f"{scratch}/drops/quarter=1996Q1/*.csv")) == 10
