"""Analytics over the written gold tables (used by the benchmark and the export)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetlens.operators import afr, survival, trend
from fleetlens.plans.warehouse import BuildResult

GoldQuery = Callable[[SparkSession, BuildResult], DataFrame]


def _t(spark: SparkSession, r: BuildResult, name: str) -> DataFrame:
    return r.read(spark, name)  # catalog table when the build is bucketed, else the Parquet path


GOLD_QUERIES: dict[str, GoldQuery] = {
    "fleet_afr": lambda s, r: afr.fleet_afr(_t(s, r, "mart_model_afr_quarterly")),
    "top_models_by_drive_days": lambda s, r: afr.top_models(_t(s, r, "mart_model_afr_quarterly"), 10, "drive_days"),
    "afr_yoy": lambda s, r: afr.yoy_afr(_t(s, r, "mart_model_afr_quarterly")),
    "cohort_survival": lambda s, r: survival.cohort_survival(_t(s, r, "dim_drive")),
    "trend_anomaly": lambda s, r: trend.trend_anomaly(_t(s, r, "fct_drive_daily"), _t(s, r, "dim_drive")),
    "rolling_90d": lambda s, r: trend.rolling_failure_rate(_t(s, r, "fct_drive_daily"), _t(s, r, "dim_drive"), 90),
    "temperature_anomaly": lambda s, r: trend.temperature_anomaly(_t(s, r, "fct_drive_daily")),
}
