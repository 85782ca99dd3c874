"""The whole warehouse as Spark jobs: raw zone -> staging -> partials -> dims, facts -> marts.

Tables are written as Parquet under one root (a shared folder on a cluster). A
table that several later tables read (the (serial, model) partials, the
dimensions) is written once and read back: that cuts lineage, lets a lost
executor recompute from the written table instead of from raw, and gives the
planner real file sizes for its broadcast decisions.

Every write also counts the rows that break the table's column checks (``checks.observed``); the
staging view is counted while the fact is written from it. A map stage that is run again after the
loss of an executor may count its rows again: a count of zero stays zero, others are at least right.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.config import AfrThresholds, PUBLISHED_THRESHOLDS
from fleetlens.operators import afr, checks, contract, dims, facts
from fleetlens.sources.ingest import read_raw_zone
from fleetlens.sources.seed import manufacturer_seed

FACT_PARTITION = "quarter"


# Tables keyed by drive: with ``buckets`` they are bucketed on serial_number with one
# bucket count, so per-drive aggregates and fact-to-drive joins need no exchange.
SERIAL_BUCKETED = ("int_drive_model_partials", "int_drive_spans", "dim_drive", "fct_drive_daily")


@dataclass
class BuildResult:
    root: str
    tables: dict[str, str] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)
    catalog: dict[str, str] = field(default_factory=dict)  # table name -> catalog name (bucketed builds)
    counts: dict[str, int] = field(default_factory=dict)  # column check -> offending rows, counted by the writes

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        if name in self.catalog:
            return spark.table(self.catalog[name])
        return spark.read.parquet(self.tables[name])

    def register_views(self, spark: SparkSession, raw_root: str | None = None) -> list[str]:
        """Temp views over the built tables (and the staging view) for SQL users."""
        names = []
        for name in self.tables:
            self.read(spark, name).createOrReplaceTempView(name)
            names.append(name)
        if raw_root is not None:
            self.staged(spark, raw_root).createOrReplaceTempView("stg_drive_stats")
            names.append("stg_drive_stats")
        return names

    def staged(self, spark: SparkSession, raw_root: str) -> DataFrame:
        """The staging view over the raw zone (staging is a view, never materialized)."""
        return contract.stage_contract(read_raw(spark, raw_root))


def write_table(df: DataFrame, path: str, partition_by: str | None = None, dynamic: bool = False) -> str:
    """Overwrite a Parquet table (zstd). ``dynamic`` replaces only the partitions present in ``df``."""
    w = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(partition_by)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)
    return path


def read_raw(spark: SparkSession, raw_root: str) -> DataFrame:
    """Hive-partitioned raw zone (``quarter=YYYYQn``); quarters may differ in columns and types."""
    return read_raw_zone(spark, raw_root)


class WarehouseBuild:
    """Builds the tables in dependency order; each step is one or two Spark jobs.

    ``buckets``: write the drive-keyed tables (SERIAL_BUCKETED) as catalog tables
    bucketed by serial_number into that many buckets, under ``database``. Each is
    repartitioned by serial first, so a bucket is one file per partition. This pays
    one shuffle of the fact when it is written and removes it from every later read:
    the per-drive rollups of the partials, and the fact-to-dim_drive joins of the AFR
    mart and the daily model counts, then run without any exchange on the fact
    (checked in tests/test_plans.py). Needs a session catalog (a metastore on a cluster).
    """

    def __init__(
        self,
        spark: SparkSession,
        raw: DataFrame,
        root: str,
        thresholds: AfrThresholds | None = PUBLISHED_THRESHOLDS,
        seed: DataFrame | None = None,
        buckets: int | None = None,
        database: str = "fleetlens",
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.stg = contract.stage_contract(raw)
        self.thresholds = thresholds
        self.seed = seed if seed is not None else manufacturer_seed(spark)
        self.buckets = buckets
        self.database = database
        self.result = BuildResult(self.root)
        if buckets:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _write_bucketed(self, df: DataFrame, name: str, partition_by: str | None) -> str:
        table = f"{self.database}.{name}"
        w = (
            df.repartition(self.buckets, "serial_number")
            .write.mode("overwrite")
            .option("compression", "zstd")
            .option("path", self.path(name))
        )
        if partition_by:
            w = w.partitionBy(partition_by)
        # No sortBy: with quarter partitions a bucket spans one file per quarter, so Spark
        # could not use a within-file order for the merge join anyway; it would only cost a sort.
        w.bucketBy(self.buckets, "serial_number").saveAsTable(table)
        self.result.catalog[name] = table
        return table

    def _step(self, name: str, make: Callable[[], DataFrame], partition_by: str | None = None) -> DataFrame:
        t0 = time.perf_counter()
        df, counts = checks.observed(make(), checks.column_checks(name, checks.WAREHOUSE_SUITE))
        if self.buckets and name in SERIAL_BUCKETED:
            self._write_bucketed(df, name, partition_by)
            p = self.path(name)
        else:
            p = write_table(df, self.path(name), partition_by)
        self.result.counts |= counts()
        self.result.tables[name] = p
        self.result.seconds[name] = time.perf_counter() - t0
        return self.result.read(self.spark, name)

    def run(self) -> BuildResult:
        partials = self._step("int_drive_model_partials", lambda: dims.drive_model_partials(self.stg))
        self._step("int_drive_spans", lambda: dims.spans_from_partials(partials))
        dim_drive = self._step("dim_drive", lambda: dims.dim_drive_from_partials(partials))
        dim_model = self._step("dim_model", lambda: dims.dim_model_from_partials(partials, self.seed))
        self._step("dim_date", lambda: dims.dim_date(self.stg))
        stg, counts = checks.observed(self.stg, checks.column_checks("stg_drive_stats", checks.WAREHOUSE_SUITE))
        fct = self._step(
            "fct_drive_daily",
            lambda: facts.fct_drive_daily(stg, keep=(FACT_PARTITION,)),
            partition_by=FACT_PARTITION,
        )
        self.result.counts |= counts()
        self._step("fct_failures", lambda: facts.fct_failures(self.stg))
        self._step("mart_model_afr_quarterly", lambda: afr.afr_quarterly(fct, dim_drive, dim_model, self.thresholds))
        return self.result


spans_from_partials = dims.spans_from_partials  # re-export (used by the incremental refresh)
