"""Drops taken in by the stream: a batch that stops in its middle is done again, and nothing is done twice."""

from __future__ import annotations

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from fleetlens.plans import refresh as R
from fleetlens.plans.warehouse import WarehouseBuild, read_raw
from fleetlens.sources.telemetry import raw_drive_stats
from fleetlens.streaming.refresher import refresh_from_landing

from helpers import SF001


def land(raw, folder, quarters):
    rows = raw.where(F.col("quarter").isin(quarters)).repartition("quarter")
    rows.write.partitionBy("quarter").option("header", True).csv(folder)


def test_a_stopped_batch_is_replayed_and_ends_like_a_full_build(spark, scratch):
    raw = raw_drive_stats(spark, SF001).cache()
    qs = sorted(r.quarter for r in raw.select("quarter").distinct().collect())[:4]
    calls = []

    def run(stop=False):
        def after(batch_id):
            calls.append(batch_id)
            if stop:
                raise RuntimeError("stopped in the middle")

        return refresh_from_landing(
            spark, f"{scratch}/landing", f"{scratch}/raw", f"{scratch}/meta", f"{scratch}/wh", f"{scratch}/checkpoint", buckets=4, after_load=after
        )

    land(raw, f"{scratch}/landing/one", qs[2:])
    assert run() == 1
    land(raw, f"{scratch}/landing/two", qs[:2])  # a backfill
    with pytest.raises(StreamingQueryException):
        run(stop=True)
    assert run() == 1 and calls == [0, 1, 1]
    assert run() == 0  # nothing new
    done = R.refresh(spark, f"{scratch}/raw", f"{scratch}/wh", buckets=4)
    assert done.changed == [] and done.rewritten_buckets == []
    full = WarehouseBuild(spark, read_raw(spark, f"{scratch}/raw"), f"{scratch}/full").run()
    for table in ("dim_drive", "dim_model", "int_drive_spans"):
        a, b = R.read_table(spark, done, table), spark.read.parquet(full.tables[table])
        assert sorted(map(str, a.select(*sorted(a.columns)).collect())) == sorted(map(str, b.select(*sorted(b.columns)).collect())), table
    batches = spark.read.parquet(f"{scratch}/wh/_state/batches").orderBy("batch_id").collect()
    assert [(r.batch_id, r.quarters) for r in batches] == [(0, qs[2:]), (1, qs[:2])]


def test_a_drop_without_a_quarter_stops_the_stream(spark, scratch):
    raw_drive_stats(spark, SF001).limit(3).drop("quarter").write.option("header", True).csv(f"{scratch}/landing/some")
    with pytest.raises(StreamingQueryException, match="quarter"):
        refresh_from_landing(spark, f"{scratch}/landing", f"{scratch}/raw", f"{scratch}/meta", f"{scratch}/wh", f"{scratch}/checkpoint")
