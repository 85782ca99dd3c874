"""A stream of landed CSV drops that loads the raw zone and refreshes the warehouse.

The file source tracks which drops were seen (names only: the content column is never read); each
micro-batch names the quarters of its drops. ``foreachBatch`` loads all drops of those quarters,
since a quarter is replaced as a whole, and then refreshes the warehouse by its manifest.

A micro-batch may run twice: a run that dies in the middle is replayed under the same id. Both
steps replace partitions, so a replayed batch ends where a whole one does. A batch that was done
to its end is noted under its id and passed over when it comes again (the stream's own commit may
have been what was lost).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.config import PUBLISHED_THRESHOLDS, AfrThresholds
from fleetlens.plans.refresh import refresh
from fleetlens.sources.files import stored
from fleetlens.sources.ingest import ingest_quarters, list_csv_files, quarter_of_path

FILES = "path string, modificationTime timestamp, length long, content binary"
DONE = "batch_id bigint, quarters array<string>"


def refresh_from_landing(
    spark: SparkSession,
    landing: str,
    raw_root: str,
    meta_root: str,
    root: str,
    checkpoint: str,
    thresholds: AfrThresholds | None = PUBLISHED_THRESHOLDS,
    buckets: int = 64,
    max_files_per_trigger: int = 1000,
    after_load: Callable[[int], None] | None = None,
) -> int:
    """Takes in every drop that landed since the last run and stops; returns the micro-batches done.

    ``checkpoint`` belongs to this landing folder and warehouse for good. Drops lie in folders named after their
    quarter. ``after_load`` is called between the load of a batch and the refresh (tests stop the stream there).
    """
    done_path = f"{root.rstrip('/')}/_state/batches"
    count = 0

    def take(batch: DataFrame, batch_id: int) -> None:
        nonlocal count
        if not stored(spark, done_path, DONE).where(F.col("batch_id") == batch_id).isEmpty():
            return
        # one row a drop
        quarters = {quarter_of_path(r.path): r.path for r in batch.select("path").collect()}
        if None in quarters:
            raise ValueError(f"cannot tell the quarter of {quarters[None]}: put it under a quarter=YYYYQn folder")
        if quarters:
            sources: dict[str, list[str]] = {q: [] for q in quarters}
            for f in list_csv_files(spark, landing):
                q = quarter_of_path(f)
                if q in sources:
                    sources[q].append(f)
            ingest_quarters(spark, sources, raw_root, meta_root)
            if after_load is not None:
                after_load(batch_id)
            refresh(spark, raw_root, root, thresholds, buckets=buckets)
        spark.createDataFrame([(batch_id, sorted(quarters))], DONE).coalesce(1).write.mode("append").parquet(done_path)
        count += 1

    drops = (
        spark.readStream.format("binaryFile")
        .schema(FILES)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.[cC][sS][vV]")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(landing)
    )
    query = drops.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return count
