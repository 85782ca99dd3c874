"""Rolling failure rates, SPC control limits and anomaly flags.

All windows run on (model, day) or per-day aggregates, never on raw rows, with
calendar RANGE frames over a day number so that gaps in the days are respected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.columns import afr_pct
from fleetlens.operators.afr import model_daily_counts
from fleetlens.operators.survival import round_to


def _day(c: str = "snapshot_date") -> Column:
    return F.unix_date(F.col(c)).cast("bigint")


def exact_limits(value: Column, order_day: Column, partition: list[str], baseline_days: int, scale: int = 100):
    """(mean, sd, n) of the trailing baseline, today excluded, for values with a fixed number of decimals.

    The values are taken as exact integers k = round(value * scale); the window sums
    k and k*k as BIGINT (exact, so independent of summation order) and
    mean = sum(k) / n / scale, sd = sqrt((n * sum(k^2) - sum(k)^2) / (n (n - 1))) / scale,
    i.e. the sample standard deviation. Any engine computing this gets the same bits.
    """
    w = (Window.partitionBy(*partition) if partition else Window).orderBy(order_day).rangeBetween(-baseline_days, -1)
    k = F.round(value * F.lit(scale)).cast("bigint")
    s1, s2, n = F.sum(k).over(w), F.sum(k * k).over(w), F.count(k).over(w)
    mean = s1.cast("double") / n / F.lit(float(scale))
    var = (n * s2 - s1 * s1).cast("double") / (n * (n - 1)) / F.lit(float(scale * scale))
    sd = F.when(n > 1, F.sqrt(var))
    return mean, sd, n


def _flag(value: Column, mean: Column, sd: Column, n: Column, min_points: int, sigmas: float) -> Column:
    ok = F.coalesce((n >= min_points) & (sd > 0) & value.isNotNull(), F.lit(False))
    level = (
        F.when(value > mean + F.lit(sigmas) * sd, F.lit("high"))
        .when(value < mean - F.lit(sigmas) * sd, F.lit("low"))
        .otherwise(F.lit("normal"))
    )
    return F.when(ok, level)


def trend_anomaly(
    fct_daily: DataFrame,
    dim_drive: DataFrame,
    window_days: int = 30,
    baseline_days: int = 90,
    min_points: int = 30,
    sigmas: float = 3.0,
) -> DataFrame:
    """Per (model, day): rolling ``window_days`` AFR and its control limits over the prior baseline.

    Columns: model, snapshot_date, drive_days, failures, window_drive_days,
    window_failures, rolling_afr_pct, baseline_mean, baseline_sd, baseline_points,
    anomaly ('high' / 'low' / 'normal' / NULL). The baseline mean and sample standard
    deviation come from exact integer sums (``exact_limits``); reported rounded to 6 places.
    """
    return trend_of_daily(model_daily_counts(fct_daily, dim_drive), window_days, baseline_days, min_points, sigmas)


def trend_of_daily(
    daily: DataFrame, window_days: int = 30, baseline_days: int = 90, min_points: int = 30, sigmas: float = 3.0
) -> DataFrame:
    """``trend_anomaly`` from (model, snapshot_date, drive_days, failures)."""
    daily = daily.withColumn("_day", _day())
    w = Window.partitionBy("model").orderBy("_day").rangeBetween(-(window_days - 1), 0)
    r = daily.select(
        "model",
        "snapshot_date",
        "_day",
        "drive_days",
        "failures",
        F.sum("drive_days").over(w).alias("window_drive_days"),
        F.sum("failures").over(w).alias("window_failures"),
    ).withColumn("rolling_afr_pct", afr_pct(F.col("window_failures"), F.col("window_drive_days")))
    # rolling_afr_pct has exactly 2 decimals: exact integer window sums, order-independent
    mean, sd, n = exact_limits(F.col("rolling_afr_pct"), F.col("_day"), ["model"], baseline_days, 100)
    r = r.select("*", mean.alias("_m"), sd.alias("_s"), n.alias("baseline_points"))
    return r.select(
        "model",
        "snapshot_date",
        "drive_days",
        "failures",
        "window_drive_days",
        "window_failures",
        "rolling_afr_pct",
        round_to(F.col("_m")).alias("baseline_mean"),
        round_to(F.col("_s")).alias("baseline_sd"),
        "baseline_points",
        _flag(F.col("rolling_afr_pct"), F.col("_m"), F.col("_s"), F.col("baseline_points"), min_points, sigmas).alias(
            "anomaly"
        ),
    )


def temperature_anomaly(
    fct_daily: DataFrame, baseline_days: int = 90, min_points: int = 30, sigmas: float = 3.0
) -> DataFrame:
    """Fleet-average SMART 194 temperature per day against its trailing control limits.

    The daily average is reported to 1e-4 degrees (sensors report whole degrees) and the
    limits use exact integer sums of those values (``exact_limits``), so the result
    does not depend on summation order. The per-day series is one row per calendar
    day (bounded by the calendar span), so the un-partitioned window is a small
    single-task step.
    """
    t = "smart_194_temperature_celsius_raw"
    daily = (
        fct_daily.where(F.col("snapshot_date").isNotNull())
        .groupBy("snapshot_date")
        .agg(F.count(t).alias("readings"), F.avg(t).alias("_avg"))
        .where(F.col("readings") > 0)
        .withColumn("_day", _day())
        .withColumn("avg_temperature", round_to(F.col("_avg"), 4))
    )
    v = F.col("avg_temperature")
    mean, sd, n = exact_limits(v, F.col("_day"), [], baseline_days, 10_000)
    r = daily.select("*", mean.alias("_m"), sd.alias("_s"), n.alias("baseline_points"))
    return r.select(
        "snapshot_date",
        "readings",
        "avg_temperature",
        round_to(F.col("_m")).alias("baseline_mean"),
        round_to(F.col("_s")).alias("baseline_sd"),
        "baseline_points",
        _flag(v, F.col("_m"), F.col("_s"), F.col("baseline_points"), min_points, sigmas).alias("anomaly"),
    )


def rolling_rate_window(daily: DataFrame, days: int) -> DataFrame:
    """Rolling sums over a calendar RANGE window: (model, snapshot_date, window_drive_days, window_failures, rolling_afr_pct)."""
    w = Window.partitionBy("model").orderBy("_day").rangeBetween(-(days - 1), 0)
    return (
        daily.withColumn("_day", _day())
        .select(
            "model",
            "snapshot_date",
            F.sum("drive_days").over(w).alias("window_drive_days"),
            F.sum("failures").over(w).alias("window_failures"),
        )
        .withColumn("rolling_afr_pct", afr_pct(F.col("window_failures"), F.col("window_drive_days")))
    )


def rolling_rate_expand(daily: DataFrame, days: int) -> DataFrame:
    """The same rolling sums without a window: each day's counts are fanned out to the
    ``days`` target days whose frame contains it, then summed per (model, target day).

    Equi-grouping instead of a range self-join: no pair of days is ever compared, the
    expansion is exactly ``days`` rows per input row, and the aggregation is hash-based
    with map-side partials. Target days that are not observation days are dropped by
    a semi-join, so both forms return the same rows.
    """
    fan = daily.select(
        "model",
        F.explode(F.sequence(F.col("snapshot_date"), F.date_add("snapshot_date", days - 1))).alias("snapshot_date"),
        "drive_days",
        "failures",
    )
    sums = fan.groupBy("model", "snapshot_date").agg(
        F.sum("drive_days").alias("window_drive_days"), F.sum("failures").alias("window_failures")
    )
    observed = daily.select("model", "snapshot_date")
    return sums.join(observed, ["model", "snapshot_date"], "left_semi").withColumn(
        "rolling_afr_pct", afr_pct(F.col("window_failures"), F.col("window_drive_days"))
    )


def rolling_rate_join(daily: DataFrame, days: int) -> DataFrame:
    """The same rolling sums as a self-join: every day against the days of its frame.

    A join on a date range alone would be a nested loop. Days are cut into bins as long as the frame, so that a frame lies
    in a day's own bin and the one before: each source row goes to its bin and the next, the sides meet
    by (model, bin), and the exact range is a condition on the rows that met. At most twice the pairs of the frame are
    compared, whatever the length of the calendar.
    """
    d = daily.withColumn("_day", _day()).withColumn("_bin", F.floor(F.col("_day") / days))
    target = d.select("model", "snapshot_date", "_day", "_bin")
    source = d.select(
        F.col("model").alias("_model"), F.col("_day").alias("_source"), "drive_days", "failures",
        F.explode(F.array(F.col("_bin"), F.col("_bin") + 1)).alias("_met"),
    )
    met = F.col("model").eqNullSafe(F.col("_model")) & (F.col("_bin") == F.col("_met"))
    inside = (F.col("_source") <= F.col("_day")) & (F.col("_source") > F.col("_day") - days)
    return (
        target.join(source, met & inside)
        .groupBy("model", "snapshot_date")
        .agg(F.sum("drive_days").alias("window_drive_days"), F.sum("failures").alias("window_failures"))
        .withColumn("rolling_afr_pct", afr_pct(F.col("window_failures"), F.col("window_drive_days")))
    )


def rolling_failure_rate(
    fct_daily: DataFrame, dim_drive: DataFrame, days: int = 90, method: str = "window"
) -> DataFrame:
    """Rolling ``days``-day failure rate per model and observation day (BI measure).

    ``method='window'`` uses a RANGE window; ``method='expand'`` the window-free
    equi-grouping form, ``method='join'`` a self-join by bins of days. All give identical rows.
    """
    return rolling_of_daily(model_daily_counts(fct_daily, dim_drive), days, method)


def rolling_of_daily(daily: DataFrame, days: int = 90, method: str = "window") -> DataFrame:
    """``rolling_failure_rate`` from (model, snapshot_date, drive_days, failures)."""
    if method == "window":
        return rolling_rate_window(daily, days)
    if method == "expand":
        return rolling_rate_expand(daily, days)
    if method == "join":
        return rolling_rate_join(daily, days)
    raise ValueError(f"method must be 'window', 'expand' or 'join', got {method!r}")
