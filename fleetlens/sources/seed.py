"""Manufacturer seed: model-string prefix -> manufacturer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

SEED_SCHEMA = StructType(
    [StructField("model_prefix", StringType(), False), StructField("manufacturer", StringType(), False)]
)

# The manufacturer seed, in its original order (must equal the reference's seed).
MANUFACTURER_SEED = [
    ("ST", "Seagate"),
    ("Seagate", "Seagate"),
    ("WDC", "Western Digital"),
    ("WUH", "Western Digital"),
    ("WD", "Western Digital"),
    ("HGST", "HGST"),
    ("Hitachi", "HGST"),
    ("TOSHIBA", "Toshiba"),
    ("CT", "Crucial"),
    ("Crucial", "Crucial"),
    ("Micron", "Micron"),
    ("MTFDDAV", "Micron"),
    ("Samsung", "Samsung"),
    ("DELLBOSS", "Dell"),
    ("SSDSCKKB", "Intel"),
]


def manufacturer_seed(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The seed as a DataFrame: the built-in list, or a header CSV with the same two columns.

    The built-in seed is an inline VALUES table (a local relation with a known size),
    so the planner can decide to broadcast it from its statistics.
    """
    if path is None:
        return spark.sql(f"SELECT model_prefix, manufacturer FROM {seed_sql_values()}")
    return spark.read.schema(SEED_SCHEMA).option("header", True).csv(path)


def seed_sql_values() -> str:
    """The seed as a SQL VALUES list (used by the DuckDB oracle)."""
    rows = ", ".join(f"('{p}', '{m}')" for p, m in MANUFACTURER_SEED)
    return f"(values {rows}) as seed_manufacturer(model_prefix, manufacturer)"
