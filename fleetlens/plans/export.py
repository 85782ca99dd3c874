"""Gold export, partition-pruned queries and the CI sample."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.operators import fleet, survival, trend
from fleetlens.operators.afr import model_daily_counts

GOLD_TABLES = ["dim_drive", "dim_model", "dim_date", "mart_model_afr_quarterly"]


def export_gold(spark: SparkSession, tables: dict[str, str], out: str, fmt: str = "parquet") -> dict[str, str]:
    """Write dims, marts and a data-drive (model, day) fact aggregate to ``out`` as Parquet or CSV.

    CSV gets a header and stays split in part files (no ``coalesce(1)``: a single
    writer task would not scale); the fact is exported aggregated, never row-level.
    """
    if fmt not in ("parquet", "csv"):
        raise ValueError("fmt must be 'parquet' or 'csv'")
    out = out.rstrip("/")
    frames = {name: spark.read.parquet(tables[name]) for name in GOLD_TABLES if name in tables}
    data_models = frames["dim_model"].where(F.col("drive_type") == "data").select("model")
    frames["fct_model_daily"] = model_daily_counts(
        spark.read.parquet(tables["fct_drive_daily"]), frames["dim_drive"]
    ).join(data_models, "model", "left_semi")
    return _write_all(frames, out, fmt)


def _write_all(frames: dict[str, DataFrame], out: str, fmt: str) -> dict[str, str]:
    written = {}
    for name, df in frames.items():
        w = df.write.mode("overwrite")
        path = f"{out.rstrip('/')}/{name}"
        if fmt == "csv":
            w.option("header", True).csv(path)
        else:
            w.option("compression", "zstd").parquet(path)
        written[name] = path
    return written


def export_marts(spark: SparkSession, tables: dict[str, str], stg: DataFrame, out: str, fmt: str = "parquet") -> dict[str, str]:
    """The analytical marts, from the written tables and the staged rows: spans, survival (from age zero and with late
    entry), trend with control limits, 90-day rolling rates and the fleet's days.

    The (model, day) counts that trend and rolling rates share are written first, so the fact is read once for both.
    """
    if fmt not in ("parquet", "csv"):
        raise ValueError("fmt must be 'parquet' or 'csv'")
    drives, fact = spark.read.parquet(tables["dim_drive"]), spark.read.parquet(tables["fct_drive_daily"])
    daily = _write_all({"fct_model_daily_all": model_daily_counts(fact, drives)}, out, "parquet")["fct_model_daily_all"]
    counts = spark.read.parquet(daily)
    return _write_all(
        {
            "int_drive_spans": spark.read.parquet(tables["int_drive_spans"]),
            "mart_cohort_survival": survival.cohort_survival(drives),
            "mart_cohort_survival_late_entry": survival.late_entry_survival(survival.drive_ages(stg), drives),
            "mart_trend_anomaly": trend.trend_of_daily(counts),
            "mart_rolling_90d": trend.rolling_of_daily(counts, 90),
            "fleet_daily": fleet.fleet_daily(stg),
        },
        out,
        fmt,
    )


def quarter_of_month(year: int, month: int) -> str:
    return f"{year}Q{(month - 1) // 3 + 1}"


def month_drive_days(raw: DataFrame, year: int, month: int, prune_partitions: bool = True) -> DataFrame:
    """Drive-days and failures per day of one month of the raw zone.

    Spark cannot derive the ``quarter`` partition from a date predicate, so with
    ``prune_partitions`` the quarter equality is added; ``explain`` then shows it
    under PartitionFilters and only that quarter's files are listed and read. The
    date range itself is pushed to the Parquet reader (PushedFilters).
    """
    start = _dt.date(year, month, 1)
    end = _dt.date(year + (month == 12), month % 12 + 1, 1)
    df = raw
    if prune_partitions:
        df = df.where(F.col("quarter") == quarter_of_month(year, month))
    d = F.col("date").cast("date")
    return (
        df.where((d >= F.lit(start)) & (d < F.lit(end)))
        .groupBy(d.alias("snapshot_date"))
        .agg(
            F.count(F.lit(1)).alias("drive_days"),
            F.count(F.when(F.col("failure") == 1, 1)).alias("failures"),
        )
    )


SAMPLE_HEX_DIGITS = 6


def sample_threshold(fraction: float) -> str:
    """The hex prefix bound of ``sample_drives`` for a fraction in (0, 1]."""
    if not 0.0 < fraction <= 1.0:
        raise ValueError("fraction must be in (0, 1]")
    return format(int(fraction * 16**SAMPLE_HEX_DIGITS), f"0{SAMPLE_HEX_DIGITS}x")


def sample_drives(df: DataFrame, fraction: float, seed: int = 42, entity: str = "serial_number") -> DataFrame:
    """Deterministic sample of whole drive histories (the CI fixture): keep a drive iff the
    first 6 hex digits of md5(serial || '|' || seed) are below ``fraction`` of the hex range.

    Every row of a kept drive is kept, so spans and censoring stay valid on the
    sample; a narrow filter, no shuffle. md5 gives the same sample in any engine (the
    DuckDB oracle computes it with the same expression).
    """
    bound = sample_threshold(fraction)
    if fraction >= 1.0:  # the bound would need a 7th digit: every drive is kept
        return df.where(F.col(entity).isNotNull())
    h = F.substring(F.md5(F.concat(F.col(entity), F.lit(f"|{seed}"))), 1, SAMPLE_HEX_DIGITS)
    return df.where(h < F.lit(bound))


#: Leading hex digits of the hash by which ``sample_rows`` first counts.
HISTOGRAM_DIGITS = 3


def sample_rows(df: DataFrame, drives: DataFrame, rows: int = 100_000, seed: int = 42, entity: str = "serial_number") -> DataFrame:
    """Deterministic sample of whole drive histories of a stated size: ``rows`` rows, and at most the rest of one
    drive's history more (fewer only if ``df`` has fewer; more if the strata alone need them).

    ``drives`` has (serial_number, model, status, drive_days). One drive of every model and of every status is always
    kept, that of the smallest hash; the others are taken in the order of md5(serial || '|' || seed) until the rows
    are reached. No global sort: rows are summed by the first digits of the hash, a running sum over that
    histogram finds the bin in which the size is reached, and only the drives of this bin are put in order. The rows themselves
    are then filtered by the hash of the last drive taken, without a shuffle. Drives without a serial are left out.
    """
    h = F.md5(F.concat(F.col(entity), F.lit(f"|{seed}")))
    d = drives.where(F.col("serial_number").isNotNull()).select(
        "serial_number", "model", "status", "drive_days", F.md5(F.concat("serial_number", F.lit(f"|{seed}"))).alias("h")
    )
    first = F.min(F.struct("h", "serial_number", "drive_days")).alias("d")
    strata = d.groupBy("model").agg(first).select("d.*").unionByName(d.groupBy("status").agg(first).select("d.*")).distinct()
    left = F.lit(rows) - strata.agg(F.coalesce(F.sum("drive_days"), F.lit(0))).scalar()
    others = d.join(strata.select("serial_number"), "serial_number", "left_anti").withColumn("bin", F.substring("h", 1, HISTOGRAM_DIGITS))
    # at most 16 ** HISTOGRAM_DIGITS rows in one task
    upto = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    bins = others.groupBy("bin").agg(F.sum("drive_days").alias("n")).withColumn("upto", F.sum("n").over(upto))
    before = bins.select("bin", (F.col("upto") - F.col("n")).alias("before"), "upto").withColumn("left", left)
    cut = before.where("before < left and upto >= left")
    along = Window.partitionBy("bin").orderBy("h", "serial_number").rowsBetween(Window.unboundedPreceding, -1)
    in_cut = others.join(cut, "bin").withColumn("start", F.col("before") + F.coalesce(F.sum("drive_days").over(along), F.lit(0)))
    last = in_cut.where("start < left").agg(F.max("h")).scalar()
    # where the size is not reached all drives are in, where the strata fill it none
    bound = F.coalesce(last, F.when(left > 0, F.lit("g")).otherwise(F.lit("")))
    hashed = df.where(F.col(entity).isNotNull()).withColumn("_h", h).withColumn("_bound", bound)
    always = strata.select(F.col("serial_number").alias("_kept"))
    marked = hashed.join(always, F.col(entity) == F.col("_kept"), "left")
    return marked.where("_kept is not null or _h <= _bound").drop("_h", "_bound", "_kept")
