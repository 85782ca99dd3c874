"""Refresh by manifest: what changed is found, only what depends on it is written, and the result is a full build's."""

from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import functions as F

from fleetlens.plans import refresh as R
from fleetlens.plans.warehouse import WarehouseBuild, read_raw, write_table
from fleetlens.sources.files import drop_folders, list_files
from fleetlens.sources.telemetry import raw_drive_stats

from helpers import SF001

BUCKETS = 3
SAME = ("int_drive_spans", "dim_drive", "dim_model", "dim_date", "mart_model_afr_quarterly")


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def files(spark, path):
    """{partition folder: its files with their times}"""
    out: dict[str, set] = {}
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    for r in listed.select("path", "modificationTime").collect():
        out.setdefault(r.path.split(path)[-1].rsplit("/", 1)[0].strip("/"), set()).add((r.path, r.modificationTime))
    return out


def changed_folders(before, after):
    return {k for k in before.keys() | after.keys() if before.get(k) != after.get(k)}


def run(spark, scratch, **options):
    return R.refresh(spark, f"{scratch}/raw", f"{scratch}/wh", buckets=BUCKETS, **options)


def equals_full_build(spark, scratch, result, name="full"):
    full = WarehouseBuild(spark, read_raw(spark, f"{scratch}/raw"), f"{scratch}/{name}").run()
    for table in SAME:
        assert rows(R.read_table(spark, result, table)) == rows(spark.read.parquet(full.tables[table])), table
    for table, key in (("fct_drive_daily", "drive_day_key"), ("fct_failures", "failure_event_key")):
        a, b = (rows(spark.read.parquet(p).select(key, "smart_5_reallocated_sectors_raw")) for p in (result.paths[table], full.tables[table]))
        assert a == b, table


@pytest.fixture(scope="module")
def raw(spark):
    """The first nine quarters."""
    path = write_table(raw_drive_stats(spark, SF001), f"{tempfile.mkdtemp(prefix='fleetlens-test-', dir='/tmp')}/all")
    df = spark.read.parquet(path)
    return df.where(F.col("quarter").isin(quarters_of(df)[:9]))


def quarters_of(raw):
    return sorted(r.quarter for r in raw.select("quarter").distinct().collect())


def test_add_replace_and_remove_without_naming_a_quarter(spark, scratch, raw):
    qs = quarters_of(raw)
    root = f"{scratch}/raw"
    wrong = qs[2]
    early = raw.where(F.col("quarter").isin(qs[:5])).withColumn("failure", F.when(F.col("quarter") == wrong, 1).otherwise(0).cast("tinyint"))
    write_table(early, root, partition_by="quarter")
    first = run(spark, scratch)
    assert first.changed == qs[:5] and first.vanished == []
    write_table(raw.where(F.col("quarter").isin(qs[5:] + [wrong])), root, partition_by="quarter", dynamic=True)
    drop_folders(spark, [f"{root}/quarter={qs[0]}", f"{root}/quarter={qs[3]}"])
    second = run(spark, scratch)
    assert second.changed == sorted([wrong, *qs[5:]]) and second.vanished == [qs[0], qs[3]]
    equals_full_build(spark, scratch, second)
    left = {r.quarter for r in spark.read.parquet(second.paths["int_drive_quarter_partials"]).select("quarter").distinct().collect()}
    assert left == set(qs) - {qs[0], qs[3]}
    log = spark.read.parquet(f"{scratch}/wh/_state/log").orderBy("logged_at").collect()
    assert [r.vanished for r in log] == [[], [qs[0], qs[3]]] and log[1].touched_drives == second.touched_drives


def test_nothing_new_writes_nothing(spark, scratch, raw):
    write_table(raw.where(F.col("quarter").isin(quarters_of(raw)[:3])), f"{scratch}/raw", partition_by="quarter")
    run(spark, scratch)
    before = files(spark, f"{scratch}/wh")
    again = run(spark, scratch)
    assert again.changed == [] and again.rewritten_buckets == []
    assert files(spark, f"{scratch}/wh") == before


def test_rewritten_files_hold_the_same_rows_touch_no_drive(spark, scratch, raw):
    few = raw.where(F.col("quarter").isin(quarters_of(raw)[:3]))
    write_table(few, f"{scratch}/raw", partition_by="quarter")
    first = run(spark, scratch)
    write_table(few.repartition(3), f"{scratch}/raw", partition_by="quarter", dynamic=True)
    before = {t: files(spark, first.paths[t]) for t in R.TABLES}
    second = run(spark, scratch)
    assert second.changed and second.touched_drives == 0 and second.rewritten_buckets == []
    for t in R.TABLES[2:]:
        assert files(spark, second.paths[t]) == before[t], t


def test_one_drive_changes_one_bucket(spark, scratch, raw):
    """A correction of one drive in one quarter rewrites its bucket's partitions, its fact partition and no other."""
    write_table(raw, f"{scratch}/raw", partition_by="quarter")
    first = run(spark, scratch)
    q = quarters_of(raw)[5]
    one = raw.where(F.col("quarter") == q)
    serial = one.agg(F.min("serial_number")).first()[0]
    other = one.withColumn("smart_5_raw", F.col("smart_5_raw") + 1).where((F.col("serial_number") != serial) | (F.col("failure") > 9))
    write_table(other, f"{scratch}/raw", partition_by="quarter", dynamic=True)
    before = {t: files(spark, first.paths[t]) for t in R.TABLES}
    second = run(spark, scratch)
    bucket = raw.select(R.bucket_of(F.lit(serial), BUCKETS)).first()[0]
    assert second.changed == [q] and second.touched_drives == 1 and second.touched_buckets == [bucket]
    after = {t: files(spark, second.paths[t]) for t in R.TABLES}
    assert changed_folders(before["fct_drive_daily"], after["fct_drive_daily"]) == {f"quarter={q}"}
    assert changed_folders(before["int_drive_quarter_partials"], after["int_drive_quarter_partials"]) <= {f"bucket={bucket}/quarter={q}"}
    for t in ("int_drives", "int_model_parts", "int_model_quarter_parts"):
        assert changed_folders(before[t], after[t]) == {f"bucket={bucket}"}, t
    moved = {f"bucket={b}" for b in second.rewritten_buckets}
    for t in ("int_drive_spans", "dim_drive"):
        assert changed_folders(before[t], after[t]) == moved, t
    assert len(second.mart_quarters) <= 1
    equals_full_build(spark, scratch, second)


def test_the_last_date_moves_back_when_the_last_quarter_goes(spark, scratch, raw):
    qs = quarters_of(raw)[:6]
    write_table(raw.where(F.col("quarter").isin(qs)), f"{scratch}/raw", partition_by="quarter")
    run(spark, scratch)
    drop_folders(spark, [f"{scratch}/raw/quarter={qs[-1]}"])
    result = run(spark, scratch)
    assert result.vanished == [qs[-1]]
    equals_full_build(spark, scratch, result)


def test_a_models_capacity_reaches_drives_of_other_buckets(spark, scratch, raw):
    """Drives without a capacity of their own follow their model's, wherever it was seen."""
    qs = quarters_of(raw)[:2]
    bare = raw.where(F.col("quarter") == qs[0]).withColumn("capacity_bytes", F.lit(-1).cast("bigint"))
    write_table(bare, f"{scratch}/raw", partition_by="quarter")
    run(spark, scratch)
    write_table(raw.where(F.col("quarter") == qs[1]).limit(3), f"{scratch}/raw", partition_by="quarter", dynamic=True)
    result = run(spark, scratch)
    equals_full_build(spark, scratch, result)


@pytest.mark.parametrize("step", ["_partials", "_per_drive", "_moved", "_mart"])
def test_a_refresh_that_dies_is_done_again(spark, scratch, raw, monkeypatch, step):
    qs = quarters_of(raw)[:3]
    write_table(raw.where(F.col("quarter").isin(qs[:2])), f"{scratch}/raw", partition_by="quarter")
    run(spark, scratch)
    write_table(raw.where(F.col("quarter") == qs[2]), f"{scratch}/raw", partition_by="quarter", dynamic=True)
    drop_folders(spark, [f"{scratch}/raw/quarter={qs[1]}"])
    whole = getattr(R.Refresh, step)

    def dies(self, *args):
        if step != "_partials":
            whole(self, *args)  # its work is done, and nothing after it
        raise RuntimeError("lost")

    monkeypatch.setattr(R.Refresh, step, dies)
    with pytest.raises(RuntimeError):
        run(spark, scratch)
    monkeypatch.setattr(R.Refresh, step, whole)
    equals_full_build(spark, scratch, run(spark, scratch))


def test_all_quarters_may_vanish(spark, scratch, raw):
    qs = quarters_of(raw)[:2]
    write_table(raw.where(F.col("quarter").isin(qs)), f"{scratch}/raw", partition_by="quarter")
    run(spark, scratch)
    drop_folders(spark, [f"{scratch}/raw/quarter={q}" for q in qs])
    result = run(spark, scratch)
    assert result.vanished == qs
    for t in ("dim_model", "dim_date"):
        assert spark.read.parquet(result.paths[t]).isEmpty()
    for t in ("fct_drive_daily", "int_drives", "dim_drive", "mart_model_afr_quarterly"):
        assert spark.read.parquet(result.paths[t]).isEmpty(), t
    assert run(spark, scratch).vanished == []


def test_listing_of_no_folder(spark, scratch):
    assert list_files(spark, f"{scratch}/none").isEmpty()
