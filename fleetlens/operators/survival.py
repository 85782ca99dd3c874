"""Cohort survival (life table) with right censoring.

Age is observed age: days since the drive's first_seen. A drive is at risk in
every 90-day bucket from 0 up to the bucket of its last observed age; it then
either fails there (status 'failed') or leaves the risk set censored (any other
status), never counted as a failure.

Everything runs on drive-grain rows (dim_drive), then on (cohort, bucket) rows:
the risk set of a bucket is a reverse running sum of drive exits over buckets,
and survival is a running product of (1 - failures / at_risk). Window groups
hold one cohort's buckets, bounded by (max age / bucket width).

``late_entry_survival`` is the table of a left-truncated fleet: a drive may be old when it is
first seen, so it is at risk only in the buckets between its first and its last known age. Each
drive adds one to the risk set at its entry bucket and takes it away after its exit bucket; the
running sum of these events over a cohort's buckets is the risk set.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.config import DEFAULT_COLUMNS, STATUS_FAILED, FleetColumns
from fleetlens.functions.columns import quarter_label


def round_to(x: Column, places: int = 6) -> Column:
    """round(x * 10^p) / 10^p on doubles (the same formula is used by the oracle)."""
    scale = float(10**places)
    return F.round(x * F.lit(scale)) / F.lit(scale)


def cohort_survival(
    dim_drive: DataFrame,
    bucket_days: int = 90,
    by_vintage: bool = False,
    actuarial: bool = False,
) -> DataFrame:
    """Per (model[, vintage_quarter], age_bucket): at_risk, failures, censored, survival.

    ``actuarial`` uses at_risk - censored / 2 as the effective risk set.
    ``by_vintage`` adds the quarter of first_seen to the cohort.
    Drives with a NULL first_seen or last_seen (no dated row) are left out.
    """
    keys = ["model"] + (["vintage_quarter"] if by_vintage else [])
    d = dim_drive.where(F.col("first_seen").isNotNull() & F.col("last_seen").isNotNull())
    d = d.select(
        "model",
        quarter_label("first_seen").alias("vintage_quarter"),
        F.floor(F.datediff("last_seen", "first_seen") / F.lit(bucket_days)).cast("bigint").alias("exit_bucket"),
        (F.col("status") == STATUS_FAILED).alias("is_failed"),
    )
    exits = d.groupBy(*keys, "exit_bucket").agg(
        F.count(F.when(F.col("is_failed"), 1)).alias("failures"),
        F.count(F.when(~F.col("is_failed"), 1)).alias("censored"),
    )
    # Every bucket from 0 to the cohort's last exit bucket (buckets nobody leaves keep survival flat).
    spine = exits.groupBy(*keys).agg(F.max("exit_bucket").alias("_maxb")).select(
        *keys, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_maxb"))).alias("age_bucket")
    )
    t = spine.join(exits.withColumnRenamed("exit_bucket", "age_bucket"), keys + ["age_bucket"], "left").select(
        *keys,
        "age_bucket",
        F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures"),
        F.coalesce("censored", F.lit(0)).cast("bigint").alias("censored"),
    )
    later = Window.partitionBy(*keys).orderBy(F.col("age_bucket").desc()).rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("at_risk", F.sum(F.col("failures") + F.col("censored")).over(later))
    risk = F.col("at_risk") - F.col("censored") / F.lit(2.0) if actuarial else F.col("at_risk").cast("double")
    step = F.lit(1.0) - F.col("failures").cast("double") / risk
    upto = Window.partitionBy(*keys).orderBy("age_bucket").rowsBetween(Window.unboundedPreceding, 0)
    return t.select(
        *keys,
        "age_bucket",
        (F.col("age_bucket") * bucket_days).alias("age_start_days"),
        "at_risk",
        "failures",
        "censored",
        round_to(F.product(step).over(upto)).alias("survival"),
    )


AGES = ("power_on", "observed")


def drive_ages(stg: DataFrame, age: str = "power_on", cols: FleetColumns = DEFAULT_COLUMNS) -> DataFrame:
    """(serial_number, entry_age, exit_age, null_age_rows): the first and last known age of each drive in days.

    ``power_on``: whole days of power-on hours (a negative reading is no age); ``observed``: days since the drive's
    first day. Rows without an age (or, observed, without a date) are counted in ``null_age_rows``. One hash
    aggregate with map-side partials: the drive-days are read once and only drive-sized rows move.
    """
    if age not in AGES:
        raise ValueError(f"age must be one of {AGES}")
    d, hours = F.col(cols.date), F.col(cols.power_on_hours)
    if age == "power_on":
        known = F.when(hours >= 0, F.floor(hours / F.lit(24)).cast("bigint"))
        first, last = F.min(known), F.max(known)
    else:
        known = d
        first, last = F.when(F.min(d).isNotNull(), F.lit(0).cast("bigint")), F.datediff(F.max(d), F.min(d)).cast("bigint")
    return (
        stg.where(F.col(cols.entity).isNotNull())
        .groupBy(F.col(cols.entity).alias("serial_number"))
        .agg(
            first.alias("entry_age"),
            last.alias("exit_age"),
            (F.count(F.lit(1)) - F.count(known)).alias("null_age_rows"),
        )
    )


def late_entry_survival(
    ages: DataFrame, dim_drive: DataFrame, bucket_days: int = 90, by_vintage: bool = False, actuarial: bool = False
) -> DataFrame:
    """Per (model[, vintage_quarter], age_bucket): entered, at_risk, failures, censored, null_age_rows, survival.

    ``ages`` as of ``drive_ages``. ``at_risk`` are the drives whose known ages span the bucket; a drive leaves at its last
    known age, as a failure if its status is ``failed``, else censored. Buckets run from the cohort's first entry to its last
    exit; where nobody is at risk survival stays as it was. ``actuarial`` takes half of the censored drives and half of
    those that entered after the start of the bucket out of the risk set.

    ``null_age_rows`` counts the cohort's rows without an age (the same in all its buckets); a cohort without any
    known age has one row, of a NULL bucket, with nobody at risk and no survival.
    """
    keys = ["model"] + (["vintage_quarter"] if by_vintage else [])
    drives = dim_drive.select("serial_number", "model", quarter_label("first_seen").alias("vintage_quarter"), "status").join(
        ages, "serial_number"
    )
    width = F.lit(bucket_days)
    entry, leave = (F.floor(F.col(c) / width).cast("bigint") for c in ("entry_age", "exit_age"))
    failed = (F.col("status") == STATUS_FAILED).cast("bigint")
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")

    def event(bucket: Column, entered: Column, left: Column, late: Column, failures: Column, censored: Column) -> Column:
        return F.struct(
            bucket.alias("age_bucket"), entered.alias("entered"), left.alias("left"), late.alias("late"),
            failures.alias("failures"), censored.alias("censored"),
        )

    late = (F.pmod("entry_age", width) != 0).cast("bigint")
    sweep = F.array(
        event(entry, one, zero, late, zero, zero),
        event(leave, zero, zero, zero, failed, one - failed),
        event(leave + 1, zero, one, zero, zero, zero),
    )
    events = (
        drives.where(F.col("entry_age").isNotNull())
        .select(*keys, F.explode(sweep).alias("e"))
        .groupBy(*keys, "e.age_bucket")
        .agg(*[F.sum(F.col("e")[c]).alias(c) for c in ("entered", "left", "late", "failures", "censored")])
    )
    cohorts = drives.groupBy(*keys).agg(
        F.min(entry).alias("_first"), F.max(leave).alias("_last"), F.sum("null_age_rows").alias("null_age_rows")
    )
    same = reduce(lambda a, b: a & b, [F.col(f"c.{k}").eqNullSafe(F.col(f"e.{k}")) for k in keys])
    spine = cohorts.select(*keys, "null_age_rows", F.explode_outer(F.sequence("_first", "_last")).alias("age_bucket"))
    counts = [F.coalesce(F.col(f"e.{c}"), zero).alias(c) for c in ("entered", "left", "late", "failures", "censored")]
    t = (
        spine.alias("c")
        .join(events.alias("e"), same & (F.col("c.age_bucket") == F.col("e.age_bucket")), "left")
        .select(*[F.col(f"c.{k}") for k in (*keys, "age_bucket", "null_age_rows")], *counts)
    )
    upto = Window.partitionBy(*keys).orderBy("age_bucket").rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("at_risk", F.sum(F.col("entered") - F.col("left")).over(upto))
    risk = F.col("at_risk").cast("double")
    if actuarial:
        risk = risk - (F.col("censored") + F.col("late")) / F.lit(2.0)
    step = F.when(risk > 0, F.lit(1.0) - F.col("failures").cast("double") / risk).otherwise(F.lit(1.0))
    return t.select(
        *keys,
        "age_bucket",
        (F.col("age_bucket") * bucket_days).alias("age_start_days"),
        "entered",
        "at_risk",
        "failures",
        "censored",
        "null_age_rows",
        F.when(F.col("age_bucket").isNotNull(), round_to(F.product(step).over(upto))).alias("survival"),
    )
