"""Per-drive observation spans with three-state right censoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.config import DEFAULT_COLUMNS, STATUS_ACTIVE, STATUS_EXITED, STATUS_FAILED, FleetColumns


# Encoding of (date, small integer flag) into one long so that "flag on the last
# day" is a plain max() over a fixed-width value (HashAggregate) instead of a max
# over a struct (sort-based aggregate). flag + 129 lies in 1..256 for a TINYINT,
# 0 stands for a NULL flag; dates before 1970 work because decoding uses pmod.
_FLAG_BASE = 512
_FLAG_OFFSET = 129


def encode_day_flag(date: Column, flag: Column) -> Column:
    """unix_date(date) * 512 + (flag + 129), flag NULL -> + 0; NULL date -> NULL."""
    code = F.coalesce(flag.cast("int") + F.lit(_FLAG_OFFSET), F.lit(0))
    return F.when(date.isNotNull(), F.unix_date(date).cast("long") * F.lit(_FLAG_BASE) + code)


def decode_day_flag(encoded: Column) -> Column:
    """The flag part of ``encode_day_flag``; NULL when the flag (or every date) was NULL."""
    r = F.pmod(encoded, F.lit(_FLAG_BASE))
    return F.when(r > 0, r - F.lit(_FLAG_OFFSET))


def last_day_flag(date: Column, flag: Column) -> Column:
    """Aggregate: max(flag) over the rows on the latest non-NULL date of the group.

    For TINYINT flags; hash-aggregatable.
    """
    return decode_day_flag(F.max(encode_day_flag(date, flag)))


def censoring_status(final_flag: Column, last_seen: Column, dataset_max: Column, grace_days: int = 0) -> Column:
    """'failed' first, then 'exited_without_failure' if last_seen < dataset max, else 'active'.

    A NULL last_seen falls through to 'active', as a CASE does. ``grace_days`` > 0
    keeps a drive 'active' when it is missing only from the last few days of the
    data (a known source gap), i.e. exited means last_seen < max - grace_days.
    """
    cutoff = dataset_max if grace_days == 0 else F.date_sub(dataset_max, grace_days)
    return (
        F.when(final_flag == 1, F.lit(STATUS_FAILED))
        .when(last_seen < cutoff, F.lit(STATUS_EXITED))
        .otherwise(F.lit(STATUS_ACTIVE))
    )


def span_aggregates(cols: FleetColumns = DEFAULT_COLUMNS) -> list[Column]:
    d = F.col(cols.date)
    return [
        F.min(d).alias("first_seen"),
        F.max(d).alias("last_seen"),
        F.count(F.lit(1)).alias("observed_days"),
        F.coalesce(last_day_flag(d, F.col(cols.failure)), F.lit(0)).cast("int").alias("final_day_failure_flag"),
    ]


def observation_spans(stg: DataFrame, cols: FleetColumns = DEFAULT_COLUMNS, grace_days: int = 0) -> DataFrame:
    """One row per drive: first_seen, last_seen, observed_days, final_day_failure_flag, censoring_status.

    One hash aggregate by entity (partial aggregation absorbs hot drives) and a scalar
    subquery for the last date of the data (the NULL-entity group included). Both read the
    staged rows: over written partials ``dims.spans_from_partials`` reads drive-sized rows only.
    """
    spans = stg.groupBy(cols.entity).agg(*span_aggregates(cols))
    dataset_max = spans.agg(F.max("last_seen")).scalar()
    return spans.withColumn("dataset_max_date", dataset_max).select(
        cols.entity,
        "first_seen",
        "last_seen",
        "observed_days",
        "final_day_failure_flag",
        censoring_status(
            F.col("final_day_failure_flag"), F.col("last_seen"), F.col("dataset_max_date"), grace_days
        ).alias("censoring_status"),
    )


def observation_gaps(spans_df: DataFrame) -> DataFrame:
    """Per drive with a dated span: calendar span, observed days and the days missing inside it
    (source gaps, not defects). Drives observed every day of their span are left out."""
    span_days = (F.datediff("last_seen", "first_seen") + 1).cast("bigint")
    return (
        spans_df.where(F.col("first_seen").isNotNull())
        .select(
            "serial_number",
            "first_seen",
            "last_seen",
            span_days.alias("span_days"),
            "observed_days",
            (span_days - F.col("observed_days")).alias("missing_days"),
        )
        .where(F.col("missing_days") != 0)
    )
