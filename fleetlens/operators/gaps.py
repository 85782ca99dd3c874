"""Days on which a drive was not seen: its own gaps, and outages of the source.

The partials hold the observed days of a drive's quarter as bits. Runs of days are decoded from
the bits (a run starts where a day is set and the one before is not), so a gap costs a row for each run
of days and none for each day. An outage is a day on which most of the fleet is absent: a drive
that is missing then has not left, so an outage at the end of the data ends no span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.operators.dims import active_drives_by_day, drive_rollup
from fleetlens.operators.spans import censoring_status

#: An outage is a day with fewer than this percentage of the drives of the fullest of the days before.
OUTAGE_PERCENT, LOOKBACK_DAYS = 50, 30
_DAYS = 92  # days of the longest quarter


def observed_runs(quarter_partials: DataFrame) -> DataFrame:
    """(serial_number, run_start, run_end): the runs of consecutive observed days of each drive in each calendar quarter.

    One row a run; drives without a serial and rows without a date have none.
    """
    bits = (
        quarter_partials.where("serial_number is not null and quarter_label is not null")
        .groupBy("serial_number", F.trunc("first_seen", "quarter").alias("start"))
        .agg(F.coalesce(F.bit_or("days_low"), F.lit(0)).alias("low"), F.coalesce(F.bit_or("days_high"), F.lit(0)).alias("high"))
    )

    def seen(day: str) -> str:
        return f"(case when {day} < 64 then shiftright(low, {day}) else shiftright(high, {day} - 64) end) & 1"

    days = f"sequence(0, {_DAYS - 1})"
    first = f"filter({days}, d -> {seen('d')} = 1 and (d = 0 or {seen('(d - 1)')} = 0))"
    last = f"filter({days}, d -> {seen('d')} = 1 and (d = {_DAYS - 1} or {seen('(d + 1)')} = 0))"
    runs = bits.select("serial_number", "start", F.explode(F.arrays_zip(F.expr(first).alias("a"), F.expr(last).alias("b"))).alias("r"))
    return runs.select("serial_number", F.date_add("start", F.col("r.a")).alias("run_start"), F.date_add("start", F.col("r.b")).alias("run_end"))


def fleet_days(quarter_partials: DataFrame, percent: int = OUTAGE_PERCENT, lookback: int = LOOKBACK_DAYS) -> DataFrame:
    """(snapshot_date, active_drives, is_outage, outages_so_far): every calendar day of the data, one row each.

    A day is an outage if its drives are fewer than ``percent`` of the most drives of one of the ``lookback`` days before; a
    day without any row counts zero drives. The calendar bounds the table, so its windows are one small task.
    """
    active = active_drives_by_day(quarter_partials)
    bounds = quarter_partials.where("serial_number is not null").agg(F.min("first_seen").alias("a"), F.max("last_seen").alias("b"))
    days = bounds.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("snapshot_date"))
    days = days.join(active, "snapshot_date", "left").select("snapshot_date", F.coalesce("active_drives", F.lit(0)).alias("active_drives"))
    before = Window.orderBy(F.unix_date("snapshot_date")).rangeBetween(-lookback, -1)
    outage = F.coalesce(F.col("active_drives") * 100 < F.max("active_drives").over(before) * percent, F.lit(False))
    upto = Window.orderBy("snapshot_date").rowsBetween(Window.unboundedPreceding, 0)
    days = days.withColumn("is_outage", outage)
    return days.withColumn("outages_so_far", F.sum(F.col("is_outage").cast("bigint")).over(upto))


def drive_gaps(runs: DataFrame, days: DataFrame) -> DataFrame:
    """(serial_number, gap_start, gap_end, missing_days, outage_days): one row for each gap inside a drive's span.

    ``outage_days`` are the days of the gap on which the source failed (from ``fleet_days``): if they are all of them, the
    drive itself was never away. A window over the runs of one drive; the days are joined by date, not by range.
    """
    order = Window.partitionBy("serial_number").orderBy("run_start")
    gaps = (
        runs.select("serial_number", F.lag("run_end").over(order).alias("seen"), "run_start")
        .where(F.datediff("run_start", "seen") > 1)
        .select("serial_number", F.date_add("seen", 1).alias("gap_start"), F.date_add("run_start", -1).alias("gap_end"), "seen")
    )

    def upto(date: str, name: str) -> DataFrame:
        return days.select(F.col("snapshot_date").alias(date), F.col("outages_so_far").alias(name))

    gaps = gaps.join(upto("seen", "_before"), "seen").join(upto("gap_end", "_after"), "gap_end")
    return gaps.select(
        "serial_number",
        "gap_start",
        "gap_end",
        (F.datediff("gap_end", "gap_start") + 1).cast("bigint").alias("missing_days"),
        (F.col("_after") - F.col("_before")).alias("outage_days"),
    )


def last_whole_day(days: DataFrame) -> Column:
    """The last day of the data that is no outage (a scalar)."""
    return days.where(~F.col("is_outage")).agg(F.max("snapshot_date")).scalar()


def spans_beside_outages(partials: DataFrame, days: DataFrame) -> DataFrame:
    """Spans of all drives, censored at the last day that is no outage: (serial_number, first_seen, last_seen,
    observed_days, final_day_failure_flag, censoring_status)."""
    drives = drive_rollup(partials).where(F.col("serial_number").isNotNull())
    status = censoring_status(F.col("final_day_failure_flag"), F.col("last_seen"), F.col("_whole"))
    return drives.withColumn("_whole", last_whole_day(days)).select(
        "serial_number", "first_seen", "last_seen", "observed_days", "final_day_failure_flag", status.alias("censoring_status")
    )
