"""Plan shape: pushdown, pruning, hash aggregation, and sampling of whole histories."""

from __future__ import annotations

from fleetlens.operators import contract, dims, facts
from fleetlens.plans.export import month_drive_days, sample_drives
from fleetlens.plans.warehouse import read_raw, write_table
from fleetlens.sources.telemetry import raw_drive_stats

from helpers import SF001


def _plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return df._jdf.queryExecution().executedPlan().toString()


def _raw(spark, scratch):
    return read_raw(spark, write_table(raw_drive_stats(spark, SF001), f"{scratch}/raw", partition_by="quarter"))


def test_failure_filter_pushed_and_columns_pruned(spark, scratch):
    raw = _raw(spark, scratch)
    plan = _plan(facts.fct_failures(contract.stage_contract(raw)))
    assert "PushedFilters: [IsNotNull(failure), EqualTo(failure,1)]" in plan
    assert "pod_slot_num" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_month_query_prunes_partitions(spark, scratch):
    raw = _raw(spark, scratch)
    pruned = _plan(month_drive_days(raw, 1996, 5, prune_partitions=True))
    assert "PartitionFilters: [isnotnull(quarter" in pruned and "1996Q2" in pruned
    unpruned = _plan(month_drive_days(raw, 1996, 5, prune_partitions=False))
    assert "PartitionFilters: []" in unpruned
    a = month_drive_days(raw, 1996, 5, True).orderBy("snapshot_date").collect()
    b = month_drive_days(raw, 1996, 5, False).orderBy("snapshot_date").collect()
    assert a == b and len(a) > 0


def test_partials_use_hash_aggregate(spark, scratch):
    stg = contract.stage_contract(_raw(spark, scratch))
    plan = _plan(dims.drive_model_partials(stg))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_sample_keeps_whole_drive_histories(spark, scratch):
    stg = contract.stage_contract(_raw(spark, scratch))
    s = sample_drives(stg, 0.3)
    kept = {r.serial_number for r in s.select("serial_number").distinct().collect()}
    assert 0 < len(kept) < 200
    full_counts = {r.serial_number: r["count"] for r in stg.groupBy("serial_number").count().collect()}
    got = {r.serial_number: r["count"] for r in s.groupBy("serial_number").count().collect()}
    assert all(got[k] == full_counts[k] for k in kept)


def test_bucketed_warehouse_joins_fact_without_exchange(spark, scratch):
    from fleetlens.operators import afr
    from fleetlens.plans.warehouse import WarehouseBuild

    raw = _raw(spark, scratch)
    plain = WarehouseBuild(spark, raw, f"{scratch}/plain").run()
    res = WarehouseBuild(spark, raw, f"{scratch}/bucketed", buckets=8, database="fleetlens_test").run()
    fct, dd, dm = (res.read(spark, n) for n in ("fct_drive_daily", "dim_drive", "dim_model"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(afr.model_quarter_counts(fct, dd))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join_side = plan.split("SortMergeJoin")[1]
    # below the fact-to-drive join there is no exchange: both inputs are bucketed by serial
    assert "Exchange" not in join_side
    from fleetlens.operators import checks

    spec = next(c for c in checks.WAREHOUSE_SUITE if c.kind == "unique" and c.table == "fct_drive_daily")
    uniq = _plan(checks.unique_failures(fct, spec.column, spec.via))
    assert "Exchange" not in uniq  # the grain test runs inside the buckets
    assert checks.unique_failures(fct, spec.column, spec.via).count() == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rel = _plan(checks.orphan_row_count(fct, "serial_number", dd, "serial_number"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    below_join = rel.split("SortMergeJoin")[1]
    assert "Exchange" not in below_join  # fact -> dim_drive referential check inside the buckets
    for name in ("dim_drive", "dim_model", "int_drive_spans", "mart_model_afr_quarterly"):
        a = sorted(tuple(r) for r in res.read(spark, name).collect())
        b = sorted(tuple(r) for r in plain.read(spark, name).collect())
        assert a == b, name


def test_scale_settings_size_partitions(spark):
    from fleetlens.session import apply_settings, scale_settings

    s = scale_settings(100 * 1024**4)  # 100 TB
    assert int(s["spark.sql.shuffle.partitions"]) == 409600
    assert scale_settings(1024)["spark.sql.shuffle.partitions"] == "200"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    applied = apply_settings(spark, {"spark.sql.shuffle.partitions": "7", "spark.sql.files.maxPartitionBytes": "64m"})
    assert "spark.sql.shuffle.partitions" not in applied  # already set by the session: kept
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    if "spark.sql.files.maxPartitionBytes" in applied:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
