"""Raw drive-day telemetry derived from the driver's TPC-H-style tables.

No given table holds telemetry, so the raw zone is derived from ``lineitem``
and ``part``: a part is a drive, a ship date is an observation day, and the
lineitems of one (part, day) make one drive-day row. The construction is fixed
(see FIXTURES.md section 6); the DuckDB twin lives in ``fleetlens.plans.oracle``.

Plan shape: lineitem is pruned to five columns and aggregated by (part, day)
with map-side partial aggregation; each part's first and last day come from a
window partitioned by part over that aggregate (one row per drive-day, so a
window group is bounded by the number of observed days, never by the raw row
count); the join to ``part`` is an equi-join on the same key, so the
aggregate's partitioning is reused and AQE broadcasts ``part`` only when its
measured size is under the threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.session import size_shuffles

# Column order of the raw drive-day table (a prefix of the full raw layout).
RAW_COLUMNS = [
    "date",
    "serial_number",
    "model",
    "capacity_bytes",
    "failure",
    "smart_5_raw",
    "smart_187_raw",
    "smart_188_raw",
    "smart_197_raw",
    "smart_198_raw",
    "smart_9_raw",
    "smart_194_raw",
    "pod_slot_num",
    "quarter",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drive_days_from_tables(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Map (lineitem, part) to the raw drive-day table, columns in RAW_COLUMNS order.

    Types follow the raw-zone contract of the CSV ingest (date DATE, failure TINYINT,
    capacity BIGINT, integers BIGINT), so the staging casts are no-ops and a
    predicate on the staged failure flag is pushed into the Parquet scan.
    """
    li = (
        lineitem.select(
            F.col("l_partkey").alias("k"),
            F.col("l_shipdate").cast("date").alias("d"),
            "l_linenumber",
            "l_quantity",
            "l_discount",
        )
        .groupBy("k", "d")
        .agg(
            F.max("l_linenumber").alias("ln"),
            F.sum("l_quantity").cast("bigint").alias("q"),
            F.round(F.max("l_discount") * F.lit(100)).cast("bigint").alias("dc"),
        )
    )
    per_part = Window.partitionBy("k")
    li = li.withColumn("fd", F.min("d").over(per_part)).withColumn("ld", F.max("d").over(per_part))
    p = part.select(
        F.col("p_partkey").alias("k"),
        "p_type",
        "p_size",
        (F.col("p_partkey") % 5).alias("m"),
    )
    t = li.join(p, "k")

    k, d, ln, q, dc = F.col("k"), F.col("d"), F.col("ln"), F.col("q"), F.col("dc")
    ptype, psize, m = F.col("p_type"), F.col("p_size"), F.col("m")
    last_day = d == F.col("ld")

    # Fixed values of the mapping (model families and capacities).
    family = (
        F.when(ptype == "ECONOMY", F.lit("ST"))
        .when(ptype == "SMALL", F.when(k % 2 == 0, F.lit("WDC WUH")).otherwise(F.lit("WUH")))
        .when(ptype == "STANDARD", F.lit("TOSHIBA MG"))
        .when(ptype == "PROMO", F.lit("HGST HUH"))
        .when(ptype == "LARGE", F.lit("CT"))
        .otherwise(F.lit("XX"))
    )
    capacity = (
        F.when((ln == 7) | (k % 97 == 0), F.lit(-1).cast("bigint"))
        .when(ptype == "LARGE", F.lit(250059350016))
        .otherwise((m * 4 + 4) * F.lit(1000204886016))
    )
    return t.select(
        d.alias("date"),
        F.concat(F.lit("S"), k.cast("string")).alias("serial_number"),
        F.concat(family, m.cast("string")).alias("model"),
        capacity.cast("bigint").alias("capacity_bytes"),
        F.when(last_day & (k % 10 == 3), 1).otherwise(0).cast("tinyint").alias("failure"),
        q.alias("smart_5_raw"),
        dc.alias("smart_187_raw"),
        ln.cast("bigint").alias("smart_188_raw"),
        F.when(last_day, F.lit(None)).otherwise(q % 7).cast("bigint").alias("smart_197_raw"),
        F.when(last_day, F.lit(None)).otherwise(q % 3).cast("bigint").alias("smart_198_raw"),
        (F.lit(24) * (F.datediff(d, F.col("fd")) + psize * 10)).cast("bigint").alias("smart_9_raw"),
        (F.lit(20) + psize % 20 + dc).cast("bigint").alias("smart_194_raw"),
        F.when((ptype == "LARGE") | (ln == 6), F.lit(None)).otherwise(psize).cast("bigint").alias("pod_slot_num"),
        F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string")).alias("quarter"),
    )


def raw_drive_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw drive-day table for a scale-factor directory. Its shuffles follow the rows of lineitem, as the files' footers tell them."""
    lineitem = read_table(spark, sf_dir, "lineitem")
    size_shuffles(spark, lineitem.count())
    return drive_days_from_tables(lineitem, read_table(spark, sf_dir, "part"))
