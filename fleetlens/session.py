"""SparkSession helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int | None = None,
    app: str = "fleetlens",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """A local session for tests and benchmarks: AQE on, UI off, UTC."""
    n = os.cpu_count() if cores == "*" else int(cores)
    parts = shuffle_partitions or max(2 * int(n or 8), 8)
    b = SparkSession.builder
    for k, v in (extra_conf or {}).items():
        b = b.config(k, v)
    return (
        b.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # local runs keep the catalog's folder out of the working directory
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="fleetlens-wh-", dir="/tmp"))
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session. Where it is unset, a local session gets a fresh scratch folder; on a
    cluster that is an error, since a folder of one machine is not seen by the others.
    """
    configured = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not is_local(spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="fleetlens-ckpt-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(path)
    return path


def is_local(master: str) -> bool:
    """True for ``local`` and ``local[...]``, whose tasks run in the driver."""
    return master == "local" or master.startswith("local[")


def scale_settings(input_bytes: int, target_partition_mb: int = 256, min_partitions: int = 200) -> dict[str, str]:
    """Spark SQL settings for a run over ``input_bytes`` of input (e.g. 100 TB on a cluster).

    Shuffle partitions are sized so that a post-shuffle partition of the largest
    shuffle (at most the input) is about ``target_partition_mb``; AQE then coalesces
    small ones and splits skewed ones to the same advisory size. File splits use the
    same size, so scan tasks and shuffle tasks are alike.
    """
    target = target_partition_mb * 1024 * 1024
    parts = max(min_partitions, -(-int(input_bytes) // target))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{target_partition_mb}m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{2 * target_partition_mb}m",
        "spark.sql.files.maxPartitionBytes": f"{target_partition_mb}m",
        "spark.sql.parquet.compression.codec": "zstd",
    }


#: Rows of a shuffle that a task takes on at first; AQE then puts small partitions together.
ROWS_PER_TASK = 500_000


def size_shuffles(spark: SparkSession, rows: int) -> None:
    """Lets shuffles of ``rows`` rows start with a partition for every ROWS_PER_TASK of them, where the session's number of
    shuffle partitions is lower: what a task holds then does not grow with the input. Smaller shuffles are coalesced by AQE."""
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    parts = -(-rows // ROWS_PER_TASK)
    if parts > int(spark.conf.get("spark.sql.shuffle.partitions")) and parts > int(spark.conf.get(name, None) or 0):
        spark.conf.set(name, str(parts))


def apply_settings(spark: SparkSession, settings: dict[str, str], overwrite: bool = False) -> dict[str, str]:
    """Set each setting unless the session already has a value (the cluster's own config wins)."""
    applied = {}
    for k, v in settings.items():
        current = spark.conf.get(k, None)
        if overwrite or current is None:
            spark.conf.set(k, v)
            applied[k] = v
    return applied
