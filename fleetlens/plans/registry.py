"""Registered queries: (spark, sf_dir) -> DataFrame, and their DuckDB oracle SQL.

Every query starts from the given ``lineitem`` and ``part`` tables of ``sf_dir``
through the telemetry mapping, so its work grows with the tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.config import PUBLISHED_THRESHOLDS, TEST_SCALE_THRESHOLDS, FleetColumns
from fleetlens.operators import afr, checks, contract, dims, facts, fleet, gaps, spans, survival, trend
from fleetlens.functions.columns import normalize_model, quarter_label, surrogate_key
from fleetlens.plans import oracle as O
from fleetlens.plans.export import export_gold, export_marts, month_drive_days, sample_drives, sample_rows, sample_threshold
from fleetlens.plans.incremental import refresh_quarters
from fleetlens.plans.refresh import read_table, refresh
from fleetlens.plans.warehouse import WarehouseBuild, write_table
from fleetlens.session import checkpoint_dir
from fleetlens.sources.files import drop_folders, statistics_session
from fleetlens.sources.ingest import drift_report, ingest_landing, ingest_quarter, read_raw_zone
from fleetlens.sources.seed import manufacturer_seed
from fleetlens.sources.telemetry import RAW_COLUMNS, raw_drive_stats
from fleetlens.streaming.refresher import refresh_from_landing

Query = Callable[[SparkSession, str], DataFrame]


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.stage_contract(raw_drive_stats(spark, sf_dir))


def materialized_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived raw zone, written once as Parquet in a new folder of the session's shared
    checkpoint directory and read back.

    A query whose plan reads the staged rows along several branches (facts, partials,
    bounds) would otherwise derive the telemetry from lineitem once per branch, since
    the branches prune different columns and no exchange is shared. The written table
    is derived once, keeps column pruning and statistics, and cuts the lineage: a lost
    executor re-reads the table instead of re-deriving it.
    """
    return spark.read.parquet(_raw_path(spark, sf_dir))


def _raw_path(spark: SparkSession, sf_dir: str, partition_by: str | None = None) -> str:
    path = f"{checkpoint_dir(spark).rstrip('/')}/fleetlens-raw-{uuid.uuid4().hex}"
    raw = raw_drive_stats(spark, sf_dir)
    # a partition's rows come together in tasks of the advisory size: few files, and no task sorts rows of all partitions
    return write_table(raw.hint("rebalance", F.col(partition_by)) if partition_by else raw, path, partition_by)


def raw_by_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``materialized_raw`` partitioned by quarter: readers of some quarters list and read only those."""
    return spark.read.schema(raw_drive_stats(spark, sf_dir).schema).parquet(_raw_path(spark, sf_dir, "quarter"))


class Warehouse:
    """Frames of the warehouse DAG for one input directory.

    The dimensions, the spans and the mart all merge from the (serial, model, quarter) partials,
    written once in the shared checkpoint folder: drive-sized, from one scan and one shuffle of the
    drive-days. Facts and day measures read the derived rows lazily, without a shuffle at their grain.
    ``materialize``: also write the derived raw rows once; for queries that aggregate them along
    several branches.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = False):
        self.spark = spark
        raw = materialized_raw(spark, sf_dir) if materialize else raw_drive_stats(spark, sf_dir)
        self.stg = contract.stage_contract(raw)

    @cached_property
    def quarter_partials(self) -> DataFrame:
        path = f"{checkpoint_dir(self.spark).rstrip('/')}/fleetlens-partials-{uuid.uuid4().hex}"
        write_table(dims.drive_quarter_partials(self.stg), path)
        return self.spark.read.parquet(path)

    @property
    def partials(self) -> DataFrame:
        return dims.merge_quarters(self.quarter_partials)

    @property
    def spans(self) -> DataFrame:
        return dims.spans_from_partials(self.partials)

    @property
    def dim_drive(self) -> DataFrame:
        return dims.dim_drive_from_partials(self.partials)

    @property
    def dim_model(self) -> DataFrame:
        return dims.dim_model_from_partials(self.partials, manufacturer_seed(self.spark))

    @property
    def dim_date(self) -> DataFrame:
        return dims.dim_date_from_partials(self.quarter_partials)

    @property
    def fct_drive_daily(self) -> DataFrame:
        return facts.fct_drive_daily(self.stg)

    @property
    def fct_failures(self) -> DataFrame:
        return facts.fct_failures(self.stg)

    @property
    def model_daily(self) -> DataFrame:
        return afr.model_daily_counts_by_row(self.stg, self.partials)

    @property
    def model_quarters(self) -> DataFrame:
        return afr.model_quarter_counts_from_partials(self.quarter_partials, self.dim_drive)

    def mart(self, thresholds=TEST_SCALE_THRESHOLDS) -> DataFrame:
        return afr.afr_from_counts(self.model_quarters, self.dim_model, thresholds)


FRESHNESS_AS_OF = "2002-06-30"
MONTH = (1996, 5)  # the partition-pruning query's month (O25)
SAMPLE_FRACTION = 0.25  # the CI sample's share of drives (A16)
SAMPLE_ROWS = 20_000  # rows of the CI sample of a stated size


def check_tables(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The warehouse tables for the check suite, with lineage cut after the raw zone (a written
    table) and after the (serial, model) partials and the small tables (reliable checkpoints),
    all in the session's checkpoint folder, so ~70 checks do not each re-derive the tables,
    and a lost executor recomputes from them, not from the source tables."""
    checkpoint_dir(spark)
    raw = materialized_raw(spark, sf_dir)
    stg = contract.stage_contract(raw)
    partials = dims.drive_model_partials(stg).checkpoint()
    dim_drive = dims.dim_drive_from_partials(partials).checkpoint()
    dim_model = dims.dim_model_from_partials(partials, manufacturer_seed(spark)).checkpoint()
    fct = facts.fct_drive_daily(stg)
    tables = {
        "stg_drive_stats": stg,
        "int_drive_spans": dims.spans_from_partials(partials).checkpoint(),
        "dim_drive": dim_drive,
        "dim_model": dim_model,
        "dim_date": dims.dim_date(stg).checkpoint(),
        "fct_drive_daily": fct,
        "fct_failures": facts.fct_failures(stg),
        "mart_model_afr_quarterly": afr.afr_quarterly(fct, dim_drive, dim_model, TEST_SCALE_THRESHOLDS).checkpoint(),
    }
    return tables, raw


def _data_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, raw = check_tables(spark, sf_dir)
    return checks.checks_suite_with_singular(tables, raw)


#: The checks whose rows are asked for, and what is planted in the frame that they look at (SQL that both engines read).
PLANTED_CHECKS = {
    "not_null:stg_drive_stats.model", "accepted_values:stg_drive_stats.failure_flag", "temperature_within_bounds",
    "quarter_label_matches_partition", "unique:fct_drive_daily.drive_day_key",
    "relationships:fct_drive_daily.serial_number->dim_drive.serial_number", "dim_drive_capacity_positive",
}
PLANTED = {
    "model": "case when smart_5_reallocated_sectors_raw % 37 = 0 then null else model end",
    "failure_flag": "case when smart_5_reallocated_sectors_raw % 41 = 0 then 7 else failure_flag end",
    "smart_194_temperature_celsius_raw": "case when smart_188_command_timeout_raw = 7 and smart_5_reallocated_sectors_raw % 5 = 0 "
    "then 130 else smart_194_temperature_celsius_raw end",
    "quarter": "case when smart_5_reallocated_sectors_raw % 43 = 0 then '1900Q1' else quarter end",
}
TWICE = "smart_5_reallocated_sectors_raw % 47 = 0"
WITHOUT_DIM, WITHOUT_CAPACITY = "serial_number like '%77'", "serial_number like '%5'"


def failing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that break a check, over a frame with planted defects, as written to the table of offending rows."""
    stg = contract.stage_contract(materialized_raw(spark, sf_dir))
    whole = dims.dim_drive(stg)
    bad = stg.unionByName(stg.where(TWICE)).selectExpr(*[f"{PLANTED.get(c, c)} as {c}" for c in stg.columns])
    bad = bad.withColumn("failure_flag", F.col("failure_flag").cast("tinyint"))
    drives = whole.where(f"not ({WITHOUT_DIM})").withColumn("capacity_bytes", F.expr(f"case when {WITHOUT_CAPACITY} then -1 else capacity_bytes end"))
    tables = {"stg_drive_stats": bad, "dim_drive": drives, "fct_drive_daily": facts.fct_drive_daily(bad)}
    suite = [s for s in checks.WAREHOUSE_SUITE if s.check_name in PLANTED_CHECKS]
    root = f"{checkpoint_dir(spark).rstrip('/')}/fleetlens-failing-{uuid.uuid4().hex}"
    rows = spark.read.parquet(checks.write_failing_rows(checks.failing_rows(tables, suite), root))
    return rows.select(
        "check_name",
        "table_name",
        "severity",
        F.get_json_object("row", "$.serial_number").alias("serial_number"),
        F.get_json_object("row", "$.snapshot_date").alias("snapshot_date"),
    )


#: Quarters from this one on are landed and loaded as a second batch.
SECOND_BATCH = "1996Q1"


#: Records of a landed drop at most: a drop whose records span lines is read by one task.
DROP_RECORDS = 1_000_000


def land_drops(rows: DataFrame, folder: str, **options: str) -> None:
    """``rows`` as CSV drops in folders by quarter."""
    rows.write.partitionBy("quarter").options(header=True, maxRecordsPerFile=DROP_RECORDS, **options).csv(folder)


def land_and_ingest(spark: SparkSession, sf_dir: str, rerun: str | None = None) -> str:
    """Land the derived telemetry as quarterly CSV drops and load them in two batches; returns the folder.

    The landing is a new folder under the session's checkpoint directory. Quarters 3
    and 4 of every year are landed with a drifted header (columns in reverse order,
    ``pod_slot_num`` absent), so files must be joined by name. From SECOND_BATCH on, SMART 5 is
    landed as decimals, so the raw zone must widen it across batches. Every quarter reconciles, or
    the load raises. ``rerun``: load that quarter once more. Layout: ``landing-1/``, ``landing-2/``, ``raw/``, ``meta/``.
    """
    root = f"{checkpoint_dir(spark).rstrip('/')}/fleetlens-ingest-{uuid.uuid4().hex}"
    raw = raw_by_quarter(spark, sf_dir)
    late = raw.withColumn("smart_5_raw", F.concat(F.col("smart_5_raw").cast("string"), F.lit(".25")))
    qn = F.substring("quarter", 6, 1)
    drifted = [c for c in reversed(RAW_COLUMNS) if c not in ("quarter", "pod_slot_num")] + ["quarter"]
    for landing, rows in (
        ("landing-1", raw.where(F.col("quarter") < SECOND_BATCH)),
        ("landing-2", late.where(F.col("quarter") >= SECOND_BATCH)),
    ):
        land_drops(rows.where(qn.isin("1", "2")), f"{root}/{landing}/a")
        land_drops(rows.where(qn.isin("3", "4")).select(*drifted), f"{root}/{landing}/b")
        ingest_landing(spark, f"{root}/{landing}", f"{root}/raw", f"{root}/meta")
    if rerun:
        landing = "landing-1" if rerun < SECOND_BATCH else "landing-2"
        folder = "a" if rerun[-1] in "12" else "b"
        ingest_quarter(spark, rerun, f"{root}/{landing}/{folder}/quarter={rerun}", f"{root}/raw", f"{root}/meta")
    return root


def ingest_dialects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw zone of drops with a free-text column whose quoted values hold delimiters, quotes, line ends and empty
    lines; the drops of every third and fourth quarter are delimited by semicolons."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/fleetlens-dialects-{uuid.uuid4().hex}"
    note = F.concat(F.lit('said "'), "serial_number", F.lit('";\n\nthen, '), F.col("smart_188_raw").cast("string"))
    rows = raw_by_quarter(spark, sf_dir).withColumn("note", F.when(F.col("smart_5_raw") % 3 == 0, note))
    qn = F.substring("quarter", 6, 1)
    for folder, mark, some in (("a", ",", ("1", "2")), ("b", ";", ("3", "4"))):
        land_drops(rows.where(qn.isin(*some)), f"{root}/landing/{folder}", sep=mark, escape='"')
    ingest_landing(spark, f"{root}/landing", f"{root}/raw", f"{root}/meta")
    return read_raw_zone(spark, f"{root}/raw").select("serial_number", "date", "failure", "note", "quarter")


def raw_zone_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw zone after two batches and a rerun of one quarter: one copy of every row, SMART 5
    widened to a decimal over both batches."""
    root = land_and_ingest(spark, sf_dir, rerun=SECOND_BATCH)
    return read_raw_zone(spark, f"{root}/raw").select("serial_number", "date", "smart_5_raw", "quarter")


def ingest_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run log of the two batches: what was counted in each quarter."""
    root = land_and_ingest(spark, sf_dir)
    return spark.read.parquet(f"{root}/meta/ingest_log").select(
        "quarter", "csv_rows", "csv_lines", "corrupt_rows", "parquet_rows", "delta", "result"
    )


def schema_drift_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drift log of the two batches: each quarter against the latest earlier one stored then."""
    root = land_and_ingest(spark, sf_dir)
    return spark.read.parquet(f"{root}/meta/schema_drift_log").select("quarter", "status", "prior_quarter", "columns", "prior_columns")


def incremental_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart after newer quarters, then a backfill of older ones, then one quarter again."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/fleetlens-incremental-{uuid.uuid4().hex}"
    raw_root = _raw_path(spark, sf_dir, "quarter")
    quarters = sorted(r.quarter for r in spark.read.parquet(raw_root).select("quarter").distinct().collect())
    newer, older = [q for q in quarters if q >= SECOND_BATCH], [q for q in quarters if q < SECOND_BATCH]
    for some in (newer, older, newer[:1]):
        paths = refresh_quarters(spark, raw_root, f"{root}/warehouse", some, TEST_SCALE_THRESHOLDS)
    return spark.read.parquet(paths["mart_model_afr_quarterly"])


#: Drive buckets of the refreshed warehouses of the registered queries.
REFRESH_BUCKETS = 4


def manifest_refresh(table: str) -> Query:
    """A table of a warehouse that was refreshed twice without naming a quarter: first the older half of the raw zone, one
    quarter of it with wrong rows; then the newer half is added, the wrong quarter replaced and the oldest one removed."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = f"{checkpoint_dir(spark).rstrip('/')}/fleetlens-manifest-{uuid.uuid4().hex}"
        raw = raw_by_quarter(spark, sf_dir)
        quarters = sorted(r.quarter for r in raw.select("quarter").distinct().collect())
        older, wrong = quarters[: len(quarters) // 2], quarters[len(quarters) // 3]
        in_older = raw.where(F.col("quarter").isin(older))
        # every third drive is missing from the wrong quarter, the others have failed in it
        tampered = in_older.where((F.col("quarter") != wrong) | (F.crc32("serial_number") % 3 != 0)).withColumn(
            "failure", F.when(F.col("quarter") == wrong, 1).otherwise(F.col("failure")).cast("tinyint")
        )
        raw_root = write_table(tampered, f"{root}/raw", partition_by="quarter")
        refresh(spark, raw_root, f"{root}/warehouse", TEST_SCALE_THRESHOLDS, buckets=REFRESH_BUCKETS)
        fresh = raw.where(~F.col("quarter").isin(older) | (F.col("quarter") == wrong))
        write_table(fresh, raw_root, partition_by="quarter", dynamic=True)
        drop_folders(spark, [f"{raw_root}/quarter={quarters[0]}"])
        done = refresh(spark, raw_root, f"{root}/warehouse", TEST_SCALE_THRESHOLDS, buckets=REFRESH_BUCKETS)
        return read_table(spark, done, table)

    return run


class StoppedInBatch(RuntimeError):
    pass


def stream_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart after three drops, the last one of older quarters, taken in by the stream; it stops in the middle of the
    second batch, after the load and before the refresh, and is started again."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/fleetlens-stream-{uuid.uuid4().hex}"
    raw = raw_by_quarter(spark, sf_dir)
    quarters = sorted(r.quarter for r in raw.select("quarter").distinct().collect())
    third = len(quarters) // 3
    stops = [1]

    def stop(batch_id: int) -> None:
        if batch_id in stops:
            stops.remove(batch_id)
            raise StoppedInBatch(f"batch {batch_id}")

    for n, some in enumerate((quarters[third : 2 * third], quarters[2 * third :], quarters[:third])):
        land_drops(raw.where(F.col("quarter").isin(some)), f"{root}/landing/drop-{n}")
        for attempt in (1, 2):
            try:
                refresh_from_landing(
                    spark, f"{root}/landing", f"{root}/raw", f"{root}/meta", f"{root}/warehouse", f"{root}/checkpoint",
                    TEST_SCALE_THRESHOLDS, REFRESH_BUCKETS, after_load=stop,
                )
                break
            except StreamingQueryException:
                if attempt == 2 or stops:
                    raise
    return spark.read.parquet(f"{root}/warehouse/mart_model_afr_quarterly")


def gold_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exported day aggregate of data drives, read back from the gold folder."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/fleetlens-gold-{uuid.uuid4().hex}"
    built = WarehouseBuild(spark, raw_by_quarter(spark, sf_dir), f"{root}/warehouse", TEST_SCALE_THRESHOLDS).run()
    out = export_gold(spark, built.tables, f"{root}/gold", "parquet")
    return spark.read.parquet(out["fct_model_daily"])


def gold_export_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One measure of each exported mart, read back from the gold folder: (mart, row_key, measure)."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/fleetlens-marts-{uuid.uuid4().hex}"
    raw = materialized_raw(spark, sf_dir)
    built = WarehouseBuild(spark, raw, f"{root}/warehouse", TEST_SCALE_THRESHOLDS).run()
    out = export_marts(spark, built.tables, contract.stage_contract(raw), f"{root}/gold")
    measures = {
        "int_drive_spans": ("serial_number", "observed_days"),
        "mart_cohort_survival": ("concat_ws('|', model, age_bucket)", "survival"),
        "mart_cohort_survival_late_entry": ("concat_ws('|', model, age_bucket)", "at_risk"),
        "mart_trend_anomaly": ("concat_ws('|', model, snapshot_date)", "rolling_afr_pct"),
        "mart_rolling_90d": ("concat_ws('|', model, snapshot_date)", "window_drive_days"),
        "fleet_daily": ("cast(snapshot_date as string)", "active_drives"),
    }
    parts = [
        spark.read.parquet(out[m]).selectExpr(f"'{m}' as mart", f"{key} as row_key", f"cast({value} as double) as measure")
        for m, (key, value) in measures.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def fleet_by_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over the views of a built warehouse, the staging view included: drives, drive-days and readings by manufacturer and status."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/fleetlens-views-{uuid.uuid4().hex}"
    raw_root = _raw_path(spark, sf_dir, "quarter")
    WarehouseBuild(spark, read_raw_zone(spark, raw_root), f"{root}/warehouse", TEST_SCALE_THRESHOLDS).run().register_views(spark, raw_root)
    return spark.sql(FLEET_BY_VIEW)


#: One statement for both engines: over the registered views here, over the SQL of the tables there.
FLEET_BY_VIEW = """
select m.manufacturer, d.status, count(*) as drives, cast(sum(d.drive_days) as bigint) as drive_days, cast(sum(s.readings) as bigint) as readings
from dim_drive d
join dim_model m on m.model = d.model
join (select serial_number, count(smart_9_power_on_hours_raw) as readings from stg_drive_stats group by serial_number) s
  on s.serial_number = d.serial_number
group by m.manufacturer, d.status"""


def freshness_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freshness of the written raw zone from its files' statistics: no row is read."""
    return checks.source_freshness(statistics_session(spark).read.parquet(_raw_path(spark, sf_dir)), "date", FRESHNESS_AS_OF)


def dim_date_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar over the written raw zone, its bounds from its files' statistics."""
    raw = statistics_session(spark).read.parquet(_raw_path(spark, sf_dir))
    return dims.date_spine(raw, FleetColumns(date="date")).select(*dims.calendar_columns(F.col("date_day")))


def raw_zone_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, first and last day of every quarter of the written raw zone, from its files' statistics."""
    raw = statistics_session(spark).read.parquet(_raw_path(spark, sf_dir, "quarter"))
    days = (F.min("date").alias("first_day"), F.max("date").alias("last_day"))
    return raw.groupBy("quarter").agg(F.count(F.lit(1)).alias("rows"), *days)


def ingest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV drops -> batch ingest -> raw zone -> staging, over every row of the derived telemetry."""
    root = land_and_ingest(spark, sf_dir)
    return contract.stage_contract(read_raw_zone(spark, f"{root}/raw"))


def schema_drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drift report of the landed quarters (each vs the previous stored quarter)."""
    root = land_and_ingest(spark, sf_dir)
    rep = drift_report(spark.read.parquet(f"{root}/meta/schema_history"))
    return rep.select(
        "quarter",
        "prior_quarter",
        F.col("columns").cast("bigint").alias("columns"),
        F.array_join("added", ",").alias("added"),
        F.array_join("removed", ",").alias("removed"),
    )


def afr_reconciliation(w: "Warehouse") -> DataFrame:
    """The AFR mart (every data model-quarter) reconciled against figures computed directly from the
    staged rows per (row's normalized model, calendar quarter), as one would against a published table.

    Full outer join on model|quarter: data models PASS, boot models appear only on the
    direct side (INVESTIGATE, explained by the data-drive scope of the mart).
    """
    computed = w.mart(None).select("model_quarter_key", "drive_days", "failures", "afr_pct")
    published = (
        w.stg.where(F.col("serial_number").isNotNull() & F.col("snapshot_date").isNotNull())
        .groupBy(surrogate_key(normalize_model("model"), quarter_label("snapshot_date")).alias("model_quarter_key"))
        .agg(
            F.count(F.lit(1)).alias("drive_days"),
            F.count(F.when(F.col("failure_flag") == 1, F.lit(1))).alias("failures"),
        )
    )
    return checks.reconcile_published(computed, published, key="model_quarter_key")


def _wh(fn: Callable[[Warehouse], DataFrame], materialize: bool = False) -> Query:
    """A registered query over the warehouse frames; ``materialize`` for the few queries that
    aggregate the staged rows along several branches."""

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Warehouse(spark, sf_dir, materialize))

    return q


QUERIES: dict[str, Query] = {
    "raw_drive_stats": raw_drive_stats,
    "stg_drive_stats": staged,
    "int_drive_spans": _wh(lambda w: w.spans),
    "dim_drive": _wh(lambda w: w.dim_drive),
    "capacity_repair": _wh(lambda w: dims.repair_capacity_from_partials(w.partials)),
    "dim_model": _wh(lambda w: w.dim_model),
    "dim_date": _wh(lambda w: w.dim_date),
    "fct_drive_daily": _wh(lambda w: w.fct_drive_daily),
    "fct_failures": _wh(lambda w: w.fct_failures),
    "mart_model_afr_quarterly": _wh(lambda w: w.mart(TEST_SCALE_THRESHOLDS)),
    "afr_published_cutoff": _wh(lambda w: w.mart(PUBLISHED_THRESHOLDS)),
    "afr_all_data_model_quarters": _wh(lambda w: w.mart(None)),
    "fleet_afr": _wh(lambda w: afr.fleet_afr(w.mart(TEST_SCALE_THRESHOLDS))),
    "afr_leaders_by_drive_days": _wh(lambda w: afr.top_models(w.mart(TEST_SCALE_THRESHOLDS), 10, "drive_days")),
    "afr_lowest_afr_models": _wh(lambda w: afr.top_models(w.mart(TEST_SCALE_THRESHOLDS), 5, "afr_pct", descending=False)),
    "afr_highest_afr_models": _wh(lambda w: afr.top_models(w.mart(TEST_SCALE_THRESHOLDS), 5, "afr_pct")),
    "afr_yoy": _wh(lambda w: afr.yoy_afr(w.mart(None))),
    "rolling_30d_failure_rate": _wh(lambda w: trend.rolling_of_daily(w.model_daily, 30)),
    "rolling_90d_failure_rate": _wh(lambda w: trend.rolling_of_daily(w.model_daily, 90)),
    "rolling_90d_failure_rate_expand": _wh(lambda w: trend.rolling_of_daily(w.model_daily, 90, method="expand")),
    "rolling_90d_failure_rate_join": _wh(lambda w: trend.rolling_of_daily(w.model_daily, 90, method="join")),
    "trend_anomaly": _wh(lambda w: trend.trend_of_daily(w.model_daily)),
    "temperature_anomaly": _wh(lambda w: trend.temperature_anomaly(w.fct_drive_daily)),
    "cohort_survival": _wh(lambda w: survival.cohort_survival(w.dim_drive)),
    "cohort_survival_by_vintage": _wh(lambda w: survival.cohort_survival(w.dim_drive, by_vintage=True)),
    "cohort_survival_late_entry": _wh(lambda w: survival.late_entry_survival(survival.drive_ages(w.stg), w.dim_drive)),
    "cohort_survival_late_entry_observed": _wh(
        lambda w: survival.late_entry_survival(survival.drive_ages(w.stg, "observed"), w.dim_drive)
    ),
    "cohort_survival_late_entry_vintage": _wh(
        lambda w: survival.late_entry_survival(survival.drive_ages(w.stg), w.dim_drive, by_vintage=True, actuarial=True)
    ),
    "fleet_daily": _wh(lambda w: fleet.fleet_daily_from_partials(w.stg, w.quarter_partials)),
    "dedupe_drive_days": _wh(lambda w: fleet.dedupe_grain(w.stg)),
    "afr_by_model": _wh(lambda w: afr.afr_by_model(w.mart(TEST_SCALE_THRESHOLDS))),
    "fleet_summary": _wh(lambda w: afr.fleet_summary(w.mart(TEST_SCALE_THRESHOLDS))),
    "manufacturer_fleet": _wh(lambda w: dims.manufacturer_fleet(w.dim_model)),
    "observation_gaps": _wh(lambda w: spans.observation_gaps(w.spans)),
    "attribute_consistency": _wh(lambda w: dims.attribute_consistency(w.stg), materialize=True),
    "excluded_boot_models": _wh(
        lambda w: afr.excluded_of_counts(w.model_quarters, w.dim_model, TEST_SCALE_THRESHOLDS)
    ),
    "drive_modal_capacity": _wh(lambda w: dims.dim_drive(w.stg, capacity_rule="mode"), materialize=True),
    "int_drive_spans_grace_30d": _wh(lambda w: dims.spans_from_partials(w.partials, grace_days=30)),
    "dim_model_slot_quarters": _wh(
        lambda w: dims.dim_model(w.stg, manufacturer_seed(w.spark), drive_type_scope="slot_quarters"), materialize=True
    ),
    "month_drive_days": lambda spark, sf_dir: month_drive_days(raw_drive_stats(spark, sf_dir), *MONTH),
    "ci_sample_rows": _wh(lambda w: sample_rows(w.stg, w.dim_drive, SAMPLE_ROWS)),
    "drive_gaps": _wh(lambda w: gaps.drive_gaps(gaps.observed_runs(w.quarter_partials), gaps.fleet_days(w.quarter_partials))),
    "fleet_outages": _wh(lambda w: gaps.fleet_days(w.quarter_partials).drop("outages_so_far")),
    "spans_beside_outages": _wh(lambda w: gaps.spans_beside_outages(w.partials, gaps.fleet_days(w.quarter_partials))),
    "ci_sample_drives": _wh(lambda w: sample_drives(w.stg, SAMPLE_FRACTION)),
    "afr_reconciliation": _wh(afr_reconciliation),
    "ingest_roundtrip": ingest_roundtrip,
    "ingest_dialects": ingest_dialects,
    "schema_drift_report": schema_drift_report,
    "raw_zone_rerun": raw_zone_rerun,
    "ingest_run_log": ingest_run_log,
    "schema_drift_log": schema_drift_log,
    "incremental_refresh": incremental_refresh,
    "manifest_refresh": manifest_refresh("mart_model_afr_quarterly"),
    "manifest_refresh_drives": manifest_refresh("dim_drive"),
    "stream_refresh": stream_refresh,
    "gold_export": gold_export,
    "gold_export_marts": gold_export_marts,
    "fleet_by_view": fleet_by_view,
    "source_freshness_files": freshness_of_files,
    "dim_date_files": dim_date_of_files,
    "raw_zone_counts": raw_zone_counts,
    "data_checks": _data_checks,
    "failing_rows": failing_rows,
    "source_freshness": _wh(
        lambda w: checks.source_freshness(w.stg, "snapshot_date", FRESHNESS_AS_OF)
    ),
    "failure_only_on_last_seen": _wh(lambda w: checks.failure_only_on_last_seen(w.stg, w.spans)),
    "model_manufacturer": _wh(
        lambda w: dims.longest_prefix_match(
            dims.model_rollup(w.partials), "model", manufacturer_seed(w.spark),
            broadcast_table=True,
        )
    ),
}


_MART = O.mart_rows_sql(TEST_SCALE_THRESHOLDS.min_drive_count, TEST_SCALE_THRESHOLDS.min_drive_days)

ORACLE: dict[str, str] = {
    "raw_drive_stats": f"{O.with_ctes(*O.BASE[:1])} select * from raw_drive_stats",
    "stg_drive_stats": f"{O.with_ctes(*O.BASE)} select * from stg",
    "int_drive_spans": f"{O.with_ctes(*O.BASE, O.SPANS_CTE)} select * from spans",
    "dim_drive": f"{O.with_ctes(*O.BASE, O.SPANS_CTE, O.DIM_DRIVE_CTE)} "
    "select * from dim_drive",
    "capacity_repair": f"""{O.with_ctes(*O.BASE, O.CAPACITY_CTE)}
select serial_number, model, own_size as drive_capacity_bytes, model_size as model_capacity_bytes,
  coalesce(own_size, model_size) as capacity_bytes,
  if(own_size is not null, 'drive', if(model_size is not null, 'model', 'none')) as repair_source
from capacities""",
    "dim_model": f"{O.with_ctes(*O.BASE, O.DIM_MODEL_CTE)} select * from dim_model",
    "dim_date": f"{O.with_ctes(*O.BASE, O.DIM_DATE_CTE)} select * from dim_date",
    "fct_drive_daily": f"{O.with_ctes(*O.BASE, O.FACT_CTE)} select * from fct_drive_daily",
    "fct_failures": f"{O.with_ctes(*O.BASE, O.FACT_CTE)} select * from fct_failures",
    "mart_model_afr_quarterly": O.mart_sql(TEST_SCALE_THRESHOLDS.min_drive_count, TEST_SCALE_THRESHOLDS.min_drive_days),
    "afr_published_cutoff": O.mart_sql(PUBLISHED_THRESHOLDS.min_drive_count, PUBLISHED_THRESHOLDS.min_drive_days),
    "afr_all_data_model_quarters": O.mart_sql(None, None),
    "fleet_afr": f"""with mart as ({O.mart_sql(TEST_SCALE_THRESHOLDS.min_drive_count, TEST_SCALE_THRESHOLDS.min_drive_days)})
select quarter_label, count(*) as models, cast(sum(drive_count) as bigint) as drive_count,
  cast(sum(drive_days) as bigint) as drive_days, cast(sum(failures) as bigint) as failures,
  {O.AFR.format(f='sum(failures)', d='sum(drive_days)')} as afr_pct
from mart group by quarter_label""",
    "afr_leaders_by_drive_days": O.top_sql(_MART, 10, "drive_days desc"),
    "afr_lowest_afr_models": O.top_sql(_MART, 5, "afr_pct asc"),
    "afr_highest_afr_models": O.top_sql(_MART, 5, "afr_pct desc"),
    "afr_yoy": O.yoy_sql(O.mart_rows_sql(None, None)),
    "rolling_30d_failure_rate": O.rolling_sql(30),
    "rolling_90d_failure_rate": O.rolling_sql(90),
    "rolling_90d_failure_rate_expand": O.rolling_sql(90),
    "rolling_90d_failure_rate_join": O.rolling_sql(90),
    "trend_anomaly": O.TREND_SQL,
    "temperature_anomaly": O.TEMPERATURE_SQL,
    "cohort_survival": O.survival_sql(False),
    "cohort_survival_by_vintage": O.survival_sql(True),
    "cohort_survival_late_entry": O.late_entry_sql("smart_9_power_on_hours_raw // 24"),
    "cohort_survival_late_entry_observed": O.late_entry_sql(
        "datediff('day', min(snapshot_date) over (partition by serial_number), snapshot_date)"
    ),
    "cohort_survival_late_entry_vintage": O.late_entry_sql("smart_9_power_on_hours_raw // 24", by_vintage=True, actuarial=True),
    "fleet_daily": O.FLEET_DAILY_SQL,
    "dedupe_drive_days": O.DEDUPE_SQL,
    "afr_by_model": O.by_model_sql(_MART),
    "manufacturer_fleet": f"""{O.with_ctes(*O.BASE, O.DIM_MODEL_CTE)}
select manufacturer, count(*) as models, count(*) filter (where drive_type = 'data') as data_models,
  cast(sum(fleet_drive_count) as bigint) as drives
from dim_model group by manufacturer""",
    "observation_gaps": f"""{O.with_ctes(*O.BASE, O.SPANS_CTE)}
select serial_number, first_seen, last_seen, datediff('day', first_seen, last_seen) + 1 as span_days,
  observed_days, datediff('day', first_seen, last_seen) + 1 - observed_days as missing_days
from spans where first_seen is not null and datediff('day', first_seen, last_seen) + 1 - observed_days <> 0""",
    "attribute_consistency": f"""{O.with_ctes(*O.BASE)},
n as (select serial_number as k, {O.NORM.format(c='model')} as m,
        case when not is_capacity_sentinel then capacity_bytes end as c from stg)
select
  (select count(*) from (select k from (select distinct k, m from n where k is not null and m is not null)
     group by k having count(*) > 1)) as drives_with_several_models,
  (select count(*) from (select k from (select distinct k, c from n where k is not null and c is not null)
     group by k having count(*) > 1)) as drives_with_several_capacities,
  (select count(*) from (select m from (select distinct m, c from n where m is not null and c is not null)
     group by m having count(*) > 1)) as models_with_several_capacities""",
    "fleet_summary": f"""select count(*) as model_quarters, count(distinct model) as models,
  cast(sum(drive_count) as bigint) as drive_count, cast(sum(drive_days) as bigint) as drive_days,
  cast(sum(failures) as bigint) as failures, {O.AFR.format(f='sum(failures)', d='sum(drive_days)')} as afr_pct
from {_MART} m""",
    "excluded_boot_models": f"""{O.with_ctes(*O.WAREHOUSE, O.MQ_CTE)}
select mq.model, mq.quarter_label, dm.manufacturer, mq.drive_count, mq.drive_days, mq.failures
from mq join dim_model dm on dm.model = mq.model
where dm.drive_type = 'boot' and mq.drive_count > {TEST_SCALE_THRESHOLDS.min_drive_count}
  and mq.drive_days > {TEST_SCALE_THRESHOLDS.min_drive_days}""",
    "drive_modal_capacity": O.MODAL_DIM_DRIVE_SQL,
    "int_drive_spans_grace_30d": f"{O.with_ctes(*O.BASE, O.spans_cte(30))} select * from spans",
    "dim_model_slot_quarters": O.SLOT_SCOPED_DIM_MODEL_SQL,
    "month_drive_days": O.month_sql(*MONTH),
    "ci_sample_rows": f"""{O.with_ctes(*O.BASE, O.SPANS_CTE, O.DIM_DRIVE_CTE)},
hashed as (select *, md5(serial_number || '|42') as h from dim_drive),
strata as (
  select serial_number, drive_days from hashed
  where h in (select min(h) from hashed group by model) or h in (select min(h) from hashed group by status)),
others as (
  select serial_number, coalesce(sum(drive_days) over (order by h rows between unbounded preceding and 1 preceding), 0) as start
  from hashed where serial_number not in (select serial_number from strata))
select * from stg where serial_number in (select serial_number from strata)
  or serial_number in (select serial_number from others where start < {SAMPLE_ROWS} - (select sum(drive_days) from strata))""",
    "drive_gaps": f"""{O.with_ctes(*O.BASE, O.OUTAGE_CTE)},
seen as (select distinct serial_number, snapshot_date as day from stg where serial_number is not null and snapshot_date is not null),
pairs as (select serial_number, lag(day) over (partition by serial_number order by day) as prior, day from seen)
select serial_number, prior + 1 as gap_start, day - 1 as gap_end, cast(day - prior - 1 as bigint) as missing_days,
  (select count(*) from fleet f where f.is_outage and f.snapshot_date > prior and f.snapshot_date < day) as outage_days
from pairs where day - prior > 1""",
    "fleet_outages": f"{O.with_ctes(*O.BASE, O.OUTAGE_CTE)} select * from fleet",
    "spans_beside_outages": f"""{O.with_ctes(*O.BASE, O.SPANS_CTE, O.OUTAGE_CTE)}
select * replace (case when final_day_failure_flag = 1 then 'failed'
    when last_seen < (select max(snapshot_date) from fleet where not is_outage) then 'exited_without_failure'
    else 'active' end as censoring_status)
from spans where serial_number is not null""",
    "ci_sample_drives": f"""{O.with_ctes(*O.BASE)}
select * from stg
where substr(md5(serial_number || '|42'), 1, 6) < '{sample_threshold(SAMPLE_FRACTION)}'""",
    "ingest_roundtrip": f"""{O.with_ctes(*O.BASE)}
select * replace (case when substr(quarter, 6, 1) in ('3', '4') then null else pod_slot_num end as pod_slot_num)
from stg""",
    "afr_reconciliation": f"""with mart as {O.mart_rows_sql(None, None)},
{O.with_ctes(*O.BASE)[5:]},
pub as (
  select ({O.NORM.format(c='model')}) || '|' || (cast(year(snapshot_date) as varchar) || 'Q' ||
         cast(quarter(snapshot_date) as varchar)) as model_quarter_key,
    count(*) as drive_days, count(*) filter (where failure_flag = 1) as failures
  from stg where serial_number is not null and snapshot_date is not null group by 1),
rc as (select model_quarter_key, drive_days as computed_drive_days, failures as computed_failures,
         afr_pct as computed_afr_pct from mart),
rp as (select model_quarter_key, drive_days as published_drive_days, failures as published_failures,
         {O.AFR.format(f='failures', d='drive_days')} as published_afr_pct from pub)
select coalesce(rc.model_quarter_key, rp.model_quarter_key) as model_quarter_key,
  computed_drive_days, computed_failures, computed_afr_pct,
  published_drive_days, published_failures, published_afr_pct,
  computed_drive_days - published_drive_days as drive_days_delta,
  computed_failures - published_failures as failures_delta,
  computed_afr_pct - published_afr_pct as afr_pct_delta,
  case when coalesce(computed_drive_days = published_drive_days and computed_failures = published_failures
                     and abs(computed_afr_pct - published_afr_pct) <= 0.01, false)
       then 'PASS' else 'INVESTIGATE' end as result
from rc full outer join rp on rc.model_quarter_key = rp.model_quarter_key""",
    "schema_drift_report": f"""{O.with_ctes(O.RAW_CTE)},
lq as (select distinct quarter from raw_drive_stats),
lp as (select quarter, lag(quarter) over (order by quarter) as prior_quarter from lq)
select quarter, prior_quarter,
  cast(case when substr(quarter, 6, 1) in ('3', '4') then 12 else 13 end as bigint) as columns,
  case when substr(quarter, 6, 1) in ('1', '2') and substr(prior_quarter, 6, 1) in ('3', '4')
       then 'pod_slot_num' else '' end as added,
  case when substr(quarter, 6, 1) in ('3', '4') and substr(prior_quarter, 6, 1) in ('1', '2')
       then 'pod_slot_num' else '' end as removed
from lp""",
    "ingest_dialects": f"""{O.with_ctes(O.RAW_CTE)}
select serial_number, date, failure, quarter,
  case when smart_5_raw % 3 = 0 then 'said "' || serial_number || '";' || chr(10) || chr(10) || 'then, ' || smart_188_raw end as note
from raw_drive_stats""",
    "raw_zone_rerun": f"""{O.with_ctes(O.RAW_CTE)}
select serial_number, date, quarter,
  cast(smart_5_raw as double) + if(quarter >= '{SECOND_BATCH}', 0.25, 0) as smart_5_raw
from raw_drive_stats""",
    "ingest_run_log": f"""{O.with_ctes(O.RAW_CTE)}
select quarter, count(*) as csv_rows, count(*) as csv_lines, cast(0 as bigint) as corrupt_rows,
  count(*) as parquet_rows, cast(0 as bigint) as delta, 'PASS' as result
from raw_drive_stats group by quarter""",
    "schema_drift_log": f"""{O.with_ctes(O.RAW_CTE)},
sizes as (select distinct quarter, cast(if(quarter[-1] in ('3', '4'), 12, 13) as bigint) as columns from raw_drive_stats)
select quarter, if(lag(quarter) over w is null, 'baseline', 'changed') as status, lag(quarter) over w as prior_quarter,
  columns, lag(columns) over w as prior_columns
from sizes window w as (order by quarter)""",
    "incremental_refresh": O.mart_sql(TEST_SCALE_THRESHOLDS.min_drive_count, TEST_SCALE_THRESHOLDS.min_drive_days),
    "manifest_refresh": O.without_first_quarter(O.mart_sql(TEST_SCALE_THRESHOLDS.min_drive_count, TEST_SCALE_THRESHOLDS.min_drive_days)),
    "manifest_refresh_drives": O.without_first_quarter(
        f"{O.with_ctes(*O.BASE, O.SPANS_CTE, O.DIM_DRIVE_CTE)} select * from dim_drive"
    ),
    "stream_refresh": O.mart_sql(TEST_SCALE_THRESHOLDS.min_drive_count, TEST_SCALE_THRESHOLDS.min_drive_days),
    "gold_export": f"""{O.with_ctes(*O.WAREHOUSE, O.MODEL_DAILY_CTE)}
select model, snapshot_date, drive_days, failures
from md where model in (select model from dim_model where drive_type = 'data')""",
    "gold_export_marts": f"""
select 'int_drive_spans' as mart, serial_number as row_key, cast(observed_days as double) as measure
from ({O.with_ctes(*O.BASE, O.SPANS_CTE)} select * from spans)
union all select 'mart_cohort_survival', concat_ws('|', model, age_bucket), survival from ({O.survival_sql(False)})
union all select 'mart_cohort_survival_late_entry', concat_ws('|', model, age_bucket), at_risk
from ({O.late_entry_sql("smart_9_power_on_hours_raw // 24")})
union all select 'mart_trend_anomaly', concat_ws('|', model, snapshot_date), rolling_afr_pct from ({O.TREND_SQL})
union all select 'mart_rolling_90d', concat_ws('|', model, snapshot_date), window_drive_days from ({O.rolling_sql(90)})
union all select 'fleet_daily', cast(snapshot_date as varchar), active_drives from ({O.FLEET_DAILY_SQL})""",
    "fleet_by_view": f"{O.with_ctes(*O.WAREHOUSE)}, stg_drive_stats as (select * from stg) {FLEET_BY_VIEW}",
    "source_freshness_files": O.freshness_sql(FRESHNESS_AS_OF),
    "dim_date_files": f"{O.with_ctes(*O.BASE, O.DIM_DATE_CTE)} select * from dim_date",
    "raw_zone_counts": f"""{O.with_ctes(O.RAW_CTE)}
select quarter, count(*) as rows, min(date) as first_day, max(date) as last_day from raw_drive_stats group by quarter""",
    "data_checks": O.checks_sql(
        checks.WAREHOUSE_SUITE, TEST_SCALE_THRESHOLDS.min_drive_count, TEST_SCALE_THRESHOLDS.min_drive_days
    ),
    "failing_rows": O.failing_rows_sql(PLANTED, TWICE, WITHOUT_DIM, WITHOUT_CAPACITY),
    "source_freshness": O.freshness_sql(FRESHNESS_AS_OF),
    "failure_only_on_last_seen": O.LAST_SEEN_SQL,
    "model_manufacturer": O.MANUFACTURER_SQL,
}
