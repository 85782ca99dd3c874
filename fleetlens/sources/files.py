"""Folders of tables: file listings, partitions that go, and tables that may not exist yet."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

LISTING = "path string, quarter string, length bigint, modified timestamp"


def list_files(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """(path, quarter, length, modified) of the files of a quarter-partitioned folder; no content is read."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(root)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LISTING)
    if "quarter" not in files.columns:  # no quarter is left
        return spark.createDataFrame([], LISTING)
    return files.selectExpr("path", "cast(quarter as string) as quarter", "length", "modificationTime as modified")


def stored(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The Parquet table at ``path``; an empty frame of ``schema`` where there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def keep_readable(spark: SparkSession, df: DataFrame, path: str, *partition: str) -> None:
    """Where a partitioned table has no file at all, an empty one (in the default partition) that holds its schema."""
    try:
        spark.read.parquet(path)
    except AnalysisException:
        folder = "/".join(f"{c}=__HIVE_DEFAULT_PARTITION__" for c in partition)
        df.drop(*partition).limit(0).coalesce(1).write.mode("overwrite").parquet(f"{path}/{folder}")


def statistics_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose Parquet scans answer min, max and count from the footers of the files
    (bare columns, no filter but on partitions): no row group is read, whatever the size of the table."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def drop_folders(spark: SparkSession, paths: list[str]) -> None:
    """Deletes folders (partitions of a table without rows) through Hadoop's file system, so that any store
    works; folders that do not exist are passed over. Their number is one per partition value, not per row."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
