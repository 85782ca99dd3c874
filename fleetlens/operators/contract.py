"""Staging contract (explicit column list, renames, casts, sentinel flag)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StringType

from fleetlens.config import SMART_RENAMES
from fleetlens.functions.columns import capacity_sentinel

# Raw columns the contract reads and the type a missing one arrives as.
CONTRACT_INPUTS: list[tuple[str, DataType]] = (
    [("date", StringType()), ("serial_number", StringType()), ("model", StringType()),
     ("capacity_bytes", LongType()), ("failure", LongType())]
    + [(raw, LongType()) for raw, _ in SMART_RENAMES]
    + [("pod_slot_num", LongType()), ("quarter", StringType())]
)

STAGED_COLUMNS = (
    ["snapshot_date", "serial_number", "model", "capacity_bytes", "is_capacity_sentinel", "failure_flag"]
    + [new for _, new in SMART_RENAMES]
    + ["pod_slot_num", "quarter"]
)


def _source_col(raw: DataFrame, name: str, dtype: DataType):
    """The raw column, or a typed NULL when a quarter lacks it (schema drift)."""
    if name in raw.columns:
        return F.col(name)
    return F.lit(None).cast(dtype)


def stage_contract(raw: DataFrame) -> DataFrame:
    """Raw drive-day frame -> the 15-column staged contract.

    Only renames, casts and the flag happen here: no filter, no dedupe, so the row
    count equals the raw count. Columns outside the contract are pruned, and because
    this is a plain projection Catalyst pushes it into the Parquet scan.
    """
    src = {name: _source_col(raw, name, t) for name, t in CONTRACT_INPUTS}
    cap = src["capacity_bytes"].cast("bigint")
    cols = [
        src["date"].cast("date").alias("snapshot_date"),
        src["serial_number"].cast("string").alias("serial_number"),
        src["model"].cast("string").alias("model"),
        cap.alias("capacity_bytes"),
        capacity_sentinel(cap).alias("is_capacity_sentinel"),
        src["failure"].cast("tinyint").alias("failure_flag"),
    ]
    cols += [src[r].cast("bigint").alias(n) for r, n in SMART_RENAMES]
    cols += [src["pod_slot_num"].cast("bigint").alias("pod_slot_num"), src["quarter"].cast("string").alias("quarter")]
    return raw.select(*cols)
