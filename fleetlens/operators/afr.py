"""Annualized failure rate marts and the measures built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.config import AfrThresholds, PUBLISHED_THRESHOLDS
from fleetlens.functions.columns import afr_pct, normalize_model, quarter_label, surrogate_key


def drive_quarter_counts(fct_daily: DataFrame) -> DataFrame:
    """(serial_number, quarter_label, drive_days, failures) per drive and calendar quarter.

    Rows with a NULL serial or date are left out: the star join of the mart (fact to
    dim_drive on serial, to dim_date on date) drops them. The calendar quarter is
    computed from the date, which is what the join to dim_date returns for every
    date inside the dimension's range. Map-side partial aggregation cuts the fact to
    at most one row per drive and quarter before the first shuffle.
    """
    return (
        fct_daily.where(F.col("serial_number").isNotNull() & F.col("snapshot_date").isNotNull())
        .groupBy("serial_number", quarter_label("snapshot_date").alias("quarter_label"))
        .agg(
            F.count(F.lit(1)).alias("drive_days"),
            F.count(F.when(F.col("failure_flag") == 1, F.lit(1))).alias("failures"),
        )
    )


def model_quarter_counts_from_partials(quarter_partials: DataFrame, dim_drive: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``model_quarter_counts`` from ``dims.drive_quarter_partials``: drive-sized rows only. ``by``: further
    grouping columns of ``dim_drive``."""
    per_drive = (
        quarter_partials.where(F.col("serial_number").isNotNull() & F.col("quarter_label").isNotNull())
        .groupBy("serial_number", "quarter_label")
        .agg(F.sum("rows").alias("drive_days"), F.sum("failures").alias("failures"))
    )
    return (
        per_drive.join(dim_drive.select("serial_number", "model", *by), "serial_number")
        .groupBy(*by, "model", "quarter_label")
        .agg(
            F.count(F.lit(1)).alias("drive_count"),
            F.sum("drive_days").alias("drive_days"),
            F.sum("failures").alias("failures"),
        )
    )


def merge_model_quarter_counts(parts: DataFrame) -> DataFrame:
    """``model_quarter_counts`` of all drives from those of disjoint sets of drives."""
    return parts.groupBy("model", "quarter_label").agg(
        F.sum("drive_count").alias("drive_count"), F.sum("drive_days").alias("drive_days"), F.sum("failures").alias("failures")
    )


def model_quarter_counts(fct_daily: DataFrame, dim_drive: DataFrame) -> DataFrame:
    """(model, quarter_label, drive_count, drive_days, failures) over all models and quarters.

    The fact is pre-aggregated per (serial, quarter), joined to the drive dimension on
    serial (both sides at drive grain, so the join moves drive-sized rows, never
    drive-day rows), and summed per (model, quarter). A drive has one model in
    dim_drive, so its (serial, quarter) rows count distinct drives exactly.
    Failures are the fact's failure_flag = 1 rows, i.e. exactly the failure fact.
    """
    per_drive = drive_quarter_counts(fct_daily)
    drives = dim_drive.select("serial_number", "model")
    return (
        per_drive.join(drives, "serial_number")
        .groupBy("model", "quarter_label")
        .agg(
            F.count(F.lit(1)).alias("drive_count"),
            F.sum("drive_days").alias("drive_days"),
            F.sum("failures").alias("failures"),
        )
    )


def afr_quarterly(
    fct_daily: DataFrame,
    dim_drive: DataFrame,
    dim_model: DataFrame,
    thresholds: AfrThresholds | None = PUBLISHED_THRESHOLDS,
) -> DataFrame:
    """AFR per model and calendar quarter, data drives only, above the (strict) cutoff.

    Columns: model_quarter_key, model, quarter_label, manufacturer, capacity_class,
    drive_count, drive_days, failures, afr_pct. ``thresholds=None`` keeps every
    data model-quarter. The model dimension is model-sized; AQE broadcasts it when
    its runtime size is under the broadcast threshold.
    """
    return afr_from_counts(model_quarter_counts(fct_daily, dim_drive), dim_model, thresholds)


def afr_from_counts(counts: DataFrame, dim_model: DataFrame, thresholds: AfrThresholds | None) -> DataFrame:
    """The mart from (model, quarter_label, drive_count, drive_days, failures): data drives,
    strict cutoff, AFR, surrogate key. Shared by the full and the incremental builds."""
    models = dim_model.where(F.col("drive_type") == "data").select("model", "manufacturer", "capacity_class")
    out = counts.join(models, "model")
    if thresholds is not None:
        out = out.where(
            (F.col("drive_count") > thresholds.min_drive_count) & (F.col("drive_days") > thresholds.min_drive_days)
        )
    return out.select(
        surrogate_key("model", "quarter_label").alias("model_quarter_key"),
        "model",
        "quarter_label",
        "manufacturer",
        "capacity_class",
        "drive_count",
        "drive_days",
        "failures",
        afr_pct(F.col("failures"), F.col("drive_days")).alias("afr_pct"),
    )


def fleet_afr(mart: DataFrame) -> DataFrame:
    """Fleet AFR per quarter over the mart's rows: sum(failures) / (sum(drive_days)/365), not a mean of rates."""
    return mart.groupBy("quarter_label").agg(
        F.count(F.lit(1)).alias("models"),
        F.sum("drive_count").alias("drive_count"),
        F.sum("drive_days").alias("drive_days"),
        F.sum("failures").alias("failures"),
    ).withColumn("afr_pct", afr_pct(F.col("failures"), F.col("drive_days")))


def fleet_summary(mart: DataFrame) -> DataFrame:
    """One row over the whole mart: model-quarters, models, summed drive_count, drive-days,
    failures, and the fleet AFR of the sums (the headline reconciliation figure)."""
    return mart.agg(
        F.count(F.lit(1)).alias("model_quarters"),
        F.countDistinct("model").alias("models"),
        F.sum("drive_count").alias("drive_count"),
        F.sum("drive_days").alias("drive_days"),
        F.sum("failures").alias("failures"),
    ).withColumn("afr_pct", afr_pct(F.col("failures"), F.col("drive_days")))


def excluded_models_above_cutoff(
    fct_daily: DataFrame, dim_drive: DataFrame, dim_model: DataFrame, thresholds: AfrThresholds | None
) -> DataFrame:
    """Model-quarters that pass the cutoff but are left out of the mart as boot drives:
    (model, quarter_label, manufacturer, drive_count, drive_days, failures). Explains a
    gap between the fleet's drive count and the mart's."""
    return excluded_of_counts(model_quarter_counts(fct_daily, dim_drive), dim_model, thresholds)


def excluded_of_counts(counts: DataFrame, dim_model: DataFrame, thresholds: AfrThresholds | None) -> DataFrame:
    """``excluded_models_above_cutoff`` from the model-quarter counts."""
    boot = dim_model.where(F.col("drive_type") == "boot").select("model", "manufacturer")
    out = counts.join(boot, "model")
    if thresholds is not None:
        out = out.where(
            (F.col("drive_count") > thresholds.min_drive_count) & (F.col("drive_days") > thresholds.min_drive_days)
        )
    return out.select("model", "quarter_label", "manufacturer", "drive_count", "drive_days", "failures")


def afr_by_model(mart: DataFrame) -> DataFrame:
    """AFR per model over all quarters of the mart (summed days and failures)."""
    return mart.groupBy("model", "manufacturer").agg(
        F.count(F.lit(1)).alias("quarters"),
        F.sum("drive_days").alias("drive_days"),
        F.sum("failures").alias("failures"),
    ).withColumn("afr_pct", afr_pct(F.col("failures"), F.col("drive_days")))


def top_models(mart: DataFrame, n: int = 10, by: str = "drive_days", descending: bool = True) -> DataFrame:
    """Top-n models by a measure summed over the mart (the reconciliation / dashboard report).

    The limit is the feature. Ties broken by model name so the result is deterministic.
    ``orderBy().limit()`` is planned as TakeOrderedAndProject: a per-partition top-n,
    so only n rows per partition reach the final merge.
    """
    per_model = afr_by_model(mart)
    order = F.col(by).desc() if descending else F.col(by).asc()
    return per_model.orderBy(order, F.col("model").asc()).limit(n)


def yoy_afr(mart: DataFrame) -> DataFrame:
    """AFR change against the same quarter one year earlier, per model.

    A self-join on (model, year - 1, quarter number), not ``lag(4)``: quarters may be
    missing. Rows without a prior-year quarter keep NULL prior values.
    """
    cur = mart.select(
        "model",
        "quarter_label",
        F.substring("quarter_label", 1, 4).cast("int").alias("_y"),
        F.substring("quarter_label", 6, 1).cast("int").alias("_q"),
        "afr_pct",
        "drive_days",
        "failures",
    )
    prev = cur.select(
        "model",
        (F.col("_y") + 1).alias("_y"),
        "_q",
        F.col("quarter_label").alias("prior_quarter_label"),
        F.col("afr_pct").alias("prior_afr_pct"),
    )
    return cur.join(prev, ["model", "_y", "_q"], "left").select(
        "model",
        "quarter_label",
        "afr_pct",
        "prior_quarter_label",
        "prior_afr_pct",
        (F.col("afr_pct") - F.col("prior_afr_pct")).alias("afr_delta"),
    )


def model_daily_counts(fct_daily: DataFrame, dim_drive: DataFrame) -> DataFrame:
    """(model, snapshot_date, drive_days, failures): drive-days and failures per model and day.

    The fact is joined to dim_drive on serial (drops NULL serials, as the star join
    does) and aggregated per (model, day); the result is models x days in size.
    """
    f = fct_daily.where(F.col("snapshot_date").isNotNull()).select("serial_number", "snapshot_date", "failure_flag")
    return (
        f.join(dim_drive.select("serial_number", "model"), "serial_number")
        .groupBy("model", "snapshot_date")
        .agg(
            F.count(F.lit(1)).alias("drive_days"),
            F.count(F.when(F.col("failure_flag") == 1, F.lit(1))).alias("failures"),
        )
    )


def model_daily_counts_by_row(stg: DataFrame, partials: DataFrame) -> DataFrame:
    """``model_daily_counts`` without a join or shuffle of drive-day rows.

    Rows are counted by their own normalized model and day, map-side first. That is the drive's
    model but for drives seen under several (``partials``: one row per serial and model, written):
    only the rows of those drives whose model is not the drive's are moved to it.
    """
    rows = stg.where(F.col("serial_number").isNotNull() & F.col("snapshot_date").isNotNull()).select(
        "serial_number", normalize_model("model").alias("model"), "snapshot_date", (F.col("failure_flag") == 1).alias("failed")
    )

    def counted(df: DataFrame, model: str, sign: int) -> DataFrame:
        return df.groupBy(F.col(model).alias("model"), "snapshot_date").agg(
            (F.count(F.lit(1)) * sign).alias("drive_days"), (F.count(F.when(F.col("failed"), 1)) * sign).alias("failures")
        )

    several = (
        partials.where(F.col("serial_number").isNotNull())
        .groupBy("serial_number")
        .agg(F.count(F.lit(1)).alias("n"), F.max("model").alias("drive_model"))
        .where("n > 1")
        .drop("n")
    )
    moved = rows.join(several, "serial_number").where("not model <=> drive_model")
    parts = counted(rows, "model", 1).unionByName(counted(moved, "model", -1)).unionByName(counted(moved, "drive_model", 1))
    return (
        parts.groupBy("model", "snapshot_date")
        .agg(F.sum("drive_days").alias("drive_days"), F.sum("failures").alias("failures"))
        .where("drive_days > 0")
    )
