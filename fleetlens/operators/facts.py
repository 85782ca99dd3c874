"""Facts: drive-day grain and failure events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.config import DEFAULT_COLUMNS, SMART_COLUMNS, FleetColumns
from fleetlens.functions.columns import surrogate_key


def fct_drive_daily(stg: DataFrame, cols: FleetColumns = DEFAULT_COLUMNS, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per staged row (no filter, no dedupe): key, serial, date, failure flag, 7 SMART.

    A narrow projection: no shuffle, stays in the scan's codegen stage. ``keep`` adds
    staged columns after the contract (e.g. the partition column when writing).
    """
    return stg.select(
        surrogate_key(cols.entity, cols.date).alias("drive_day_key"),
        F.col(cols.entity).alias("serial_number"),
        F.col(cols.date).alias("snapshot_date"),
        F.col(cols.failure).alias("failure_flag"),
        *SMART_COLUMNS,
        *keep,
    )


def fct_failures(stg: DataFrame, cols: FleetColumns = DEFAULT_COLUMNS, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per failure event (failure_flag = 1), SMART values as of that day.

    The predicate is pushed into the Parquet scan when ``stg`` reads Parquet. ``keep`` as in
    ``fct_drive_daily``.
    """
    return stg.where(F.col(cols.failure) == 1).select(
        surrogate_key(cols.entity, cols.date).alias("failure_event_key"),
        F.col(cols.entity).alias("serial_number"),
        F.col(cols.date).alias("failure_date"),
        *SMART_COLUMNS,
        *keep,
    )
