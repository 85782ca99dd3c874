"""Fleet-level daily measures and grain deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.config import DEFAULT_COLUMNS, FleetColumns
from fleetlens.functions.columns import non_sentinel
from fleetlens.operators.dims import active_drives_by_day


def fleet_daily(stg: DataFrame, cols: FleetColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Per date: drive_days (rows), active_drives (distinct serials), failures, capacity_bytes
    (sum of non-sentinel capacity), avg_temperature, temperature_readings.

    The distinct count is planned as a two-level aggregation ((date, serial) then date),
    so no group of raw rows is ever held in one task.
    """
    t = F.col(cols.temperature)
    return (
        stg.where(F.col(cols.date).isNotNull())
        .groupBy(F.col(cols.date).alias("snapshot_date"))
        .agg(
            F.count(F.lit(1)).alias("drive_days"),
            F.countDistinct(cols.entity).alias("active_drives"),
            F.count(F.when(F.col(cols.failure) == 1, 1)).alias("failures"),
            F.sum(non_sentinel(F.col(cols.capacity), F.col(cols.sentinel))).alias("capacity_bytes"),
            F.avg(t).alias("avg_temperature"),
            F.count(t).alias("temperature_readings"),
        )
    )


def fleet_daily_from_partials(stg: DataFrame, quarter_partials: DataFrame, cols: FleetColumns = DEFAULT_COLUMNS) -> DataFrame:
    """``fleet_daily`` without a shuffle at drive-day grain: one hash aggregate by day over the
    staged rows, and the distinct drives from the day bits of ``dims.drive_quarter_partials``."""
    t = F.col(cols.temperature)
    daily = (
        stg.where(F.col(cols.date).isNotNull())
        .groupBy(F.col(cols.date).alias("snapshot_date"))
        .agg(
            F.count(F.lit(1)).alias("drive_days"),
            F.count(F.when(F.col(cols.failure) == 1, 1)).alias("failures"),
            F.sum(non_sentinel(F.col(cols.capacity), F.col(cols.sentinel))).alias("capacity_bytes"),
            F.avg(t).alias("avg_temperature"),
            F.count(t).alias("temperature_readings"),
        )
    )
    return daily.join(active_drives_by_day(quarter_partials), "snapshot_date", "left").select(
        "snapshot_date",
        "drive_days",
        F.coalesce("active_drives", F.lit(0)).cast("long").alias("active_drives"),
        "failures",
        "capacity_bytes",
        "avg_temperature",
        "temperature_readings",
    )


def dedupe_grain(
    stg: DataFrame,
    keys: tuple[str, ...] = ("serial_number", "snapshot_date"),
    prefer: list[Column] | None = None,
) -> DataFrame:
    """One row per grain key; the kept row is the max by ``prefer`` then by every column.

    Default rule: a failure row wins (failure_flag desc), then the row with a
    non-sentinel capacity, then the larger values (full-row tie-break, so the result
    is deterministic). Done as ``groupBy(keys).agg(max(struct(...)))``: a hash-shuffle
    with map-side partials, so a key with very many copies is reduced before the
    shuffle instead of being sorted in one window task.
    """
    if prefer is None:
        prefer = [
            F.coalesce(F.col("failure_flag").cast("int"), F.lit(-1)),
            F.coalesce((~F.col("is_capacity_sentinel")).cast("int"), F.lit(-1)),
        ]
    others = [c for c in stg.columns if c not in keys]
    rank = F.struct(*[p.alias(f"_p{i}") for i, p in enumerate(prefer)], *[F.col(c) for c in others])
    best = stg.groupBy(*keys).agg(F.max(rank).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in others]).select(*stg.columns)
