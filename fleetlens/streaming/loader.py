"""Landing-folder loader on Structured Streaming.

New CSV files dropped into a landing folder are picked up by a file stream with
a fixed string schema, typed, tagged with their calendar quarter and written to
a quarter-partitioned Parquet table by the streaming FILE SINK. With
``trigger(availableNow=True)`` each run processes whatever has landed since the
last run and stops, so it is a restartable batch loader.

Exactly-once: the source offsets (which files were read) and the sink's
``_spark_metadata`` commit log (which output files belong to a committed batch)
both live in durable folders; a run that dies mid-batch is replayed on restart
and its half-written files are never listed, because readers of the table go
through the commit log. (A ``foreachBatch`` append would be at-least-once.)
The checkpoint is an argument: it stays with the table across sessions.

The table root belongs to the stream: readers list it through the sink's commit
log, so files written there by batch jobs (e.g. ``ingest_quarters``) would be
invisible. Use a separate root per loader, or the batch ingest alone.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fleetlens.functions.columns import quarter_label


def landing_stream(spark: SparkSession, landing: str, columns: list[str], max_files_per_trigger: int = 100) -> DataFrame:
    """The landed files as strings. A file whose header is not exactly ``columns`` stops the stream
    with an error: values are never taken by position under another name."""
    schema = StructType([StructField(c, StringType(), True) for c in columns])
    return (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .csv(landing)
    )


def typed_rows(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the string columns and add the quarter partition derived from ``date``."""
    out = df.select(*[F.col(c).cast(types.get(c, "string")).alias(c) for c in df.columns])
    return out.withColumn("quarter", quarter_label(F.col("date").cast("date")))


def _rows(spark: SparkSession, table_root: str) -> int:
    """Committed rows of the table; 0 before its first batch."""
    try:
        return spark.read.parquet(table_root).count()
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return 0
        raise


def load_available(
    spark: SparkSession,
    landing: str,
    table_root: str,
    columns: list[str],
    types: dict[str, str],
    checkpoint: str,
    max_files_per_trigger: int = 100,
) -> int:
    """Process every file landed so far into ``table_root`` (partitioned by quarter) and stop.

    ``checkpoint`` is a durable folder that belongs to this table for good: with another one the
    table's commit log and the offsets would disagree and files would be lost, so a table that
    has rows must come with the checkpoint that wrote them. Returns the rows this run committed.
    """
    before = _rows(spark, table_root)
    if before and not _started(spark, checkpoint):
        raise ValueError(f"{table_root} holds rows, but {checkpoint} is not the checkpoint that wrote them")
    q = (
        typed_rows(landing_stream(spark, landing, columns, max_files_per_trigger), types)
        .writeStream.format("parquet")
        .option("path", table_root)
        .option("checkpointLocation", checkpoint)
        .option("compression", "zstd")
        .partitionBy("quarter")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return _rows(spark, table_root) - before


def _started(spark: SparkSession, checkpoint: str) -> bool:
    """True if the checkpoint holds the identity of a stream."""
    try:
        return not spark.read.text(f"{checkpoint.rstrip('/')}/metadata").isEmpty()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
