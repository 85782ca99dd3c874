"""Incremental, backfill-safe warehouse refresh keyed on the quarter partition.

A date high-water mark would skip a backfilled older quarter, so refreshes are
keyed on partitions: only the touched quarters of the raw zone are read
(partition pruning), and only their partitions of two per-quarter tables are
replaced (dynamic partition overwrite):

* ``fct_drive_daily``             the fact itself (drive-day rows),
* ``int_drive_quarter_partials``  per (serial, model, calendar quarter, partition) partials.

``fct_failures`` is partitioned alike. A reloaded quarter may have no failure left, which a partition
overwrite would not notice: its partition is dropped.

Spans, dimensions and the AFR mart depend on all quarters (first_seen, status,
drive_type, capacity), so they are rebuilt, but from the drive-sized partials, which merge
exactly: a rebuild never rescans the fact or the raw zone. The merged partials are written
once (``int_drive_model_partials``) and every table reads them. A quarter that is gone from
the raw zone is not a refresh: its partitions stay until they are dropped. ``plans/refresh.py`` finds
changed and vanished quarters by itself and rewrites only the drives that they touch; this module
is the form in which the caller names the quarters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetlens.config import AfrThresholds, PUBLISHED_THRESHOLDS
from fleetlens.operators import afr, contract, dims, facts
from fleetlens.plans.warehouse import write_table
from fleetlens.sources.files import drop_folders, keep_readable
from fleetlens.sources.ingest import read_raw_zone
from fleetlens.sources.seed import manufacturer_seed

PARTITION = "quarter"

TABLES = (
    "fct_drive_daily", "fct_failures", "int_drive_quarter_partials", "int_drive_model_partials",
    "int_drive_spans", "dim_drive", "dim_model", "dim_date", "mart_model_afr_quarterly",
)


def refresh_quarters(
    spark: SparkSession,
    raw_root: str,
    root: str,
    quarters: list[str],
    thresholds: AfrThresholds | None = PUBLISHED_THRESHOLDS,
    seed: DataFrame | None = None,
) -> dict[str, str]:
    """Load ``quarters`` of the raw zone into the warehouse at ``root``; rebuild the merged tables.

    Returns table name -> path. Running it twice for the same quarter leaves the
    same tables (partitions are replaced, never appended).
    """
    root = root.rstrip("/")
    seed = seed if seed is not None else manufacturer_seed(spark)
    paths = {name: f"{root}/{name}" for name in TABLES}

    def replace(df: DataFrame, name: str) -> None:
        write_table(df, paths[name], partition_by=PARTITION, dynamic=True)

    def rebuilt(df: DataFrame, name: str) -> DataFrame:
        write_table(df, paths[name])
        return spark.read.parquet(paths[name])

    stg = contract.stage_contract(read_raw_zone(spark, raw_root, quarters))
    replace(facts.fct_drive_daily(stg, keep=(PARTITION,)), "fct_drive_daily")
    events = facts.fct_failures(stg, keep=(PARTITION,))
    replace(events, "fct_failures")
    failed = {r[0] for r in stg.where("failure_flag = 1").select(PARTITION).distinct().collect()}
    drop_folders(spark, [f"{paths['fct_failures']}/{PARTITION}={q}" for q in quarters if q not in failed])
    keep_readable(spark, events, paths["fct_failures"], PARTITION)
    replace(dims.drive_quarter_partials(stg, by=(PARTITION,)), "int_drive_quarter_partials")

    by_quarter = spark.read.parquet(paths["int_drive_quarter_partials"])
    partials = rebuilt(dims.merge_quarters(by_quarter), "int_drive_model_partials")
    rebuilt(dims.spans_from_partials(partials), "int_drive_spans")
    rebuilt(dims.dim_date_from_partials(partials), "dim_date")
    drives = rebuilt(dims.dim_drive_from_partials(partials), "dim_drive")
    models = rebuilt(dims.dim_model_from_partials(partials, seed), "dim_model")
    counts = afr.model_quarter_counts_from_partials(by_quarter, drives)
    rebuilt(afr.afr_from_counts(counts, models, thresholds), "mart_model_afr_quarterly")
    return paths
