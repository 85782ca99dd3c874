"""The landing loader processes each file exactly once across runs."""

from __future__ import annotations

import os

import pytest

from fleetlens.sources.telemetry import RAW_COLUMNS, raw_drive_stats
from fleetlens.streaming.loader import load_available

from helpers import SF001
from helpers import int_columns

TYPES = {"date": "date", "failure": "tinyint", "capacity_bytes": "bigint", "serial_number": "string",
         "model": "string"}


def test_available_now_loads_new_files_once(spark, scratch):
    pdf = int_columns(raw_drive_stats(spark, SF001).toPandas())
    cols = [c for c in RAW_COLUMNS if c != "quarter"]
    types = {**{c: "bigint" for c in cols}, **TYPES}
    land = f"{scratch}/landing"
    os.makedirs(land)
    pdf.iloc[:1000][cols].to_csv(f"{land}/a.csv", index=False)
    pdf.iloc[1000:2500][cols].to_csv(f"{land}/b.csv", index=False)
    n1 = load_available(spark, land, f"{scratch}/raw", cols, types, f"{scratch}/ckpt")
    assert n1 == 2500
    pdf.iloc[2500:3000][cols].to_csv(f"{land}/c.csv", index=False)
    n2 = load_available(spark, land, f"{scratch}/raw", cols, types, f"{scratch}/ckpt")
    n3 = load_available(spark, land, f"{scratch}/raw", cols, types, f"{scratch}/ckpt")
    assert (n2, n3) == (500, 0)
    back = spark.read.parquet(f"{scratch}/raw")
    assert back.count() == 3000
    assert back.where("quarter is null").count() == 0


def _land(spark, scratch, rows, columns, name):
    os.makedirs(f"{scratch}/landing", exist_ok=True)
    with open(f"{scratch}/landing/{name}.csv", "w") as f:
        f.write("\n".join([",".join(columns), *(",".join(map(str, r)) for r in rows)]) + "\n")


COLUMNS = ["date", "serial_number", "smart_5_raw", "smart_187_raw"]
SMALL = {"date": "date", "smart_5_raw": "bigint", "smart_187_raw": "bigint"}


def test_swapped_header_stops_the_stream(spark, scratch):
    _land(spark, scratch, [("2026-01-01", "S1", 5, 187)], COLUMNS, "a")
    swapped = ["date", "serial_number", "smart_187_raw", "smart_5_raw"]
    _land(spark, scratch, [("2026-01-01", "S2", 187, 5)], swapped, "b")
    with pytest.raises(Exception, match="header|FAILED_READ_FILE"):
        load_available(spark, f"{scratch}/landing", f"{scratch}/raw", COLUMNS, SMALL, f"{scratch}/ckpt")


def test_a_table_keeps_its_checkpoint(spark, scratch):
    _land(spark, scratch, [("2026-01-01", "S1", 5, 187)], COLUMNS, "a")
    args = (spark, f"{scratch}/landing", f"{scratch}/raw", COLUMNS, SMALL)
    assert load_available(*args, f"{scratch}/ckpt") == 1
    _land(spark, scratch, [("2026-01-02", "S1", 6, 188)], COLUMNS, "b")
    with pytest.raises(ValueError):
        load_available(*args, f"{scratch}/other")
    assert load_available(*args, f"{scratch}/ckpt") == 1
    assert spark.read.parquet(f"{scratch}/raw").count() == 2


def test_rows_of_more_batches_than_spark_remembers(spark, scratch):
    """Every file is a batch of its own; the count does not come from the stream's recent progress."""
    keep = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        for i in range(5):
            _land(spark, scratch, [("2026-01-01", f"S{i}", i, i)], COLUMNS, f"f{i}")
        n = load_available(spark, f"{scratch}/landing", f"{scratch}/raw", COLUMNS, SMALL, f"{scratch}/ckpt", 1)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", keep)
    assert n == 5
