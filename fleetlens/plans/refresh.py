"""Refresh by manifest: finds which quarters changed, and rewrites only what depends on them.

What changed. The raw zone's files (path, bytes, time) are listed and compared with the manifest
of the last refresh; quarters whose files differ are new, changed or, where none is left,
vanished. Nobody names a quarter, and a vanished one is retracted from every table.

Keyed merge. Drives are dealt into ``buckets`` by a hash of the serial number. The per-drive
tables are partitioned by bucket, and all that a bucket's partitions hold follows from its
drives alone:

* ``int_drive_quarter_partials`` (bucket, quarter)   what each drive did in each quarter,
* ``int_drives``                 (bucket)            spans, model and own capacity of each drive,
* ``int_model_parts``            (bucket)            what dim_model sums up,
* ``int_model_quarter_parts``    (bucket)            what the mart sums up.

The partials of the changed quarters are computed anew and compared with the stored ones row by
row: only the buckets of drives with another row are touched, and only their partitions are
replaced. Two things cross buckets, the last date of the data (who is active) and the capacity of
a model (the fallback of drives without their own): where they moved, the buckets of the drives
that change with them are found by one pass over ``int_drives`` and rewritten too.

Small tables (dim_model, dim_date) are written where a row differs, the mart by quarter
likewise; facts by changed quarter.

Recovery. Touched buckets are noted before the first table changes, and the manifest is
written last: a refresh that dies is found out by the next one, which does the noted buckets again.
Every step replaces partitions, so doing it twice is doing it once.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fleetlens.config import PUBLISHED_THRESHOLDS, AfrThresholds
from fleetlens.operators import afr, contract, dims, facts
from fleetlens.operators.spans import censoring_status
from fleetlens.session import checkpoint_dir
from fleetlens.sources.files import LISTING, drop_folders, keep_readable, list_files, stored
from fleetlens.sources.ingest import read_raw_zone
from fleetlens.sources.seed import manufacturer_seed

BUCKET = "bucket"
PARTIALS = (
    "serial_number string, model string, quarter_label string, first_seen date, last_seen date, rows bigint, last_day_code bigint, "
    "slot_rows bigint, capacity_bytes bigint, failures bigint, days_low bigint, days_high bigint, bucket int, quarter string"
)
DRIVES = (
    "serial_number string, first_seen date, last_seen date, observed_days bigint, final_day_failure_flag int, model string, "
    "drive_capacity_bytes bigint, bucket int"
)
MODEL_PARTS = "model string, fleet_drive_count bigint, observations bigint, slot_observations bigint, capacity_bytes bigint, bucket int"
MODEL_QUARTER_PARTS = "model string, quarter_label string, drive_count bigint, drive_days bigint, failures bigint, bucket int"
PENDING = "bucket int"
STATE = "max_date date"
LOG = (
    "logged_at timestamp, changed array<string>, vanished array<string>, touched_drives bigint, touched_buckets array<int>, "
    "rewritten_buckets array<int>, mart_quarters array<string>, seconds double"
)
TABLES = (
    "fct_drive_daily", "fct_failures", "int_drive_quarter_partials", "int_drives", "int_model_parts", "int_model_quarter_parts",
    "int_drive_spans", "dim_drive", "dim_model", "dim_date", "mart_model_afr_quarterly",
)


@dataclass
class RefreshResult:
    paths: dict[str, str]
    changed: list[str] = field(default_factory=list)
    vanished: list[str] = field(default_factory=list)
    touched_drives: int = 0
    touched_buckets: list[int] = field(default_factory=list)  # a drive of theirs has another partial
    rewritten_buckets: list[int] = field(default_factory=list)  # and those that follow the last date or a model's capacity
    mart_quarters: list[str] = field(default_factory=list)


def bucket_of(serial: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(serial), F.lit(buckets)).cast("int")


def changed_quarters(listing: DataFrame, manifest: DataFrame) -> tuple[list[str], list[str]]:
    """(new or changed quarters, vanished ones): those with a file that is not in both, alike."""
    sides = listing.withColumn("side", F.lit(1)).unionByName(manifest.withColumn("side", F.lit(-1)))
    files = sides.groupBy("path", "quarter", "length", "modified").agg(F.sum("side").alias("side"))
    quarters = files.groupBy("quarter").agg(F.max(F.col("side") != 0).alias("differs"), F.max(F.col("side") >= 0).alias("left"))
    rows = quarters.where("differs").collect()  # one row a quarter
    # a quarter all of whose files are of the manifest alone is gone
    return sorted(r.quarter for r in rows if r.left), sorted(r.quarter for r in rows if not r.left)


def _differing(new: DataFrame, old: DataFrame) -> DataFrame:
    """Rows of one side that the other has not as many of, with ``side`` 1 (new) or -1."""
    columns = new.columns
    both = new.withColumn("side", F.lit(1)).unionByName(old.select(*columns).withColumn("side", F.lit(-1)))
    return both.groupBy(*columns).agg(F.sum("side").alias("side")).where("side <> 0")


class Refresh:
    """One warehouse at ``root`` over one raw zone; ``buckets`` must stay what it was at the first refresh."""

    def __init__(
        self,
        spark: SparkSession,
        raw_root: str,
        root: str,
        thresholds: AfrThresholds | None = PUBLISHED_THRESHOLDS,
        seed: DataFrame | None = None,
        buckets: int = 64,
    ):
        self.spark, self.raw_root, self.root = spark, raw_root.rstrip("/"), root.rstrip("/")
        self.thresholds, self.buckets = thresholds, buckets
        self.seed = seed if seed is not None else manufacturer_seed(spark)
        self.paths = {name: f"{self.root}/{name}" for name in TABLES}

    # ----------------------------------------------------------------- tables

    def _state(self, name: str) -> str:
        return f"{self.root}/_state/{name}"

    def _read(self, name: str, schema: str) -> DataFrame:
        return stored(self.spark, self.paths[name], schema)

    def _scratch(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written in the shared checkpoint folder and read back."""
        path = f"{checkpoint_dir(self.spark).rstrip('/')}/fleetlens-refresh-{name}-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _replace(self, df: DataFrame, name: str, by: list[str], all_of: list[tuple]) -> None:
        """Replaces the partitions ``all_of`` (values of ``by``) by the rows of ``df``, which are all in them;
        those without a row go."""
        seen = Observation()  # the write itself tells which partitions it filled
        (
            df.observe(seen, F.collect_set(F.concat_ws("/", *by)).alias("filled"))
            .write.mode("overwrite")
            .option("compression", "zstd")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*by)
            .parquet(self.paths[name])
        )
        filled = set(seen.get["filled"])
        gone = [values for values in all_of if "/".join(str(v) for v in values) not in filled]
        folders = ["/".join(f"{c}={v}" for c, v in zip(by, values)) for values in gone]
        self._drop(name, folders, df, by)

    def _drop(self, name: str, folders: list[str], like: DataFrame, by: list[str]) -> None:
        """Deletes partitions of a table; a table that lost all of them still has its schema."""
        drop_folders(self.spark, [f"{self.paths[name]}/{folder}" for folder in folders])
        keep_readable(self.spark, like, self.paths[name], *by)

    def _replace_whole(self, df: DataFrame, name: str) -> bool:
        """Writes a small table if a row of it differs."""
        new = self._scratch(df, name)
        old = stored(self.spark, self.paths[name], new.schema)
        if _differing(new, old).isEmpty() and not (old.isEmpty() and new.isEmpty()):
            return False
        new.coalesce(1).write.mode("overwrite").option("compression", "zstd").parquet(self.paths[name])
        return True

    # ----------------------------------------------------------------- steps

    def _touch(self, buckets: list[int]) -> None:
        """Notes buckets that are about to be rewritten."""
        if buckets:
            self.spark.createDataFrame([(b,) for b in buckets], PENDING).coalesce(1).write.mode("append").parquet(self._state("pending"))

    def _facts(self, changed: list[str], gone: list[str]) -> None:
        if changed:
            stg = contract.stage_contract(read_raw_zone(self.spark, self.raw_root, changed))
            quarters = [(q,) for q in changed]
            self._replace(facts.fct_drive_daily(stg, keep=("quarter",)), "fct_drive_daily", ["quarter"], quarters)
            self._replace(facts.fct_failures(stg, keep=("quarter",)), "fct_failures", ["quarter"], quarters)
        for name in ("fct_drive_daily", "fct_failures") if gone else ():
            self._drop(name, [f"quarter={q}" for q in gone], self.spark.read.parquet(self.paths[name]), ["quarter"])

    def _partials(self, changed: list[str], gone: list[str]) -> tuple[DataFrame, list[tuple], int]:
        """(partials of the changed quarters, (bucket, quarter) in which a drive's row differs, such drives)."""
        if changed:
            stg = contract.stage_contract(read_raw_zone(self.spark, self.raw_root, changed))
            new = dims.drive_quarter_partials(stg, by=("quarter",)).withColumn(BUCKET, bucket_of(F.col("serial_number"), self.buckets))
            new = self._scratch(new, "partials")
        else:
            new = self.spark.createDataFrame([], PARTIALS)
        old = self._read("int_drive_quarter_partials", PARTIALS).where(F.col("quarter").isin(changed + gone))
        differing = self._scratch(_differing(new, old).select("serial_number", BUCKET, "quarter"), "touched")
        # at most buckets x quarters rows
        pairs = sorted(tuple(r) for r in differing.select(BUCKET, "quarter").distinct().collect())
        return new, pairs, differing.select("serial_number").distinct().count()

    def _per_drive(self, touched: list[int]) -> None:
        """The tables that follow from a bucket's drives alone."""
        keys = [(b,) for b in touched]
        parts = self._read("int_drive_quarter_partials", PARTIALS).where(F.col(BUCKET).isin(touched))
        merged = self._scratch(
            dims.merge_quarters(parts).withColumn(BUCKET, bucket_of(F.col("serial_number"), self.buckets)), "merged"
        )
        drives = dims.drive_rollup(merged).withColumn(BUCKET, bucket_of(F.col("serial_number"), self.buckets))
        self._replace(drives.hint("rebalance", F.col(BUCKET)), "int_drives", [BUCKET], keys)
        drives = self._read("int_drives", DRIVES).where(F.col(BUCKET).isin(touched))
        self._replace(dims.model_rollup(merged, (BUCKET,)).hint("rebalance", F.col(BUCKET)), "int_model_parts", [BUCKET], keys)
        counts = afr.model_quarter_counts_from_partials(parts, drives, (BUCKET,))
        self._replace(counts.hint("rebalance", F.col(BUCKET)), "int_model_quarter_parts", [BUCKET], keys)

    def _moved(self, drives: DataFrame, old_max: object, new_max: object, old_models: DataFrame, models: DataFrame) -> list[int]:
        """Buckets of drives whose status follows the last date, or whose capacity follows their model's."""
        before, now = (
            censoring_status(F.col("final_day_failure_flag"), F.col("last_seen"), F.lit(d).cast("date")) for d in (old_max, new_max)
        )
        found = set()
        if old_max != new_max:
            found |= {r.bucket for r in drives.where(~before.eqNullSafe(now)).select(BUCKET).distinct().collect()}
        other = _differing(models, old_models).select("model").distinct()
        if not other.isEmpty():
            without = drives.where("drive_capacity_bytes is null")
            found |= {r.bucket for r in without.join(other, "model", "left_semi").select(BUCKET).distinct().collect()}
        return sorted(found)

    def run(self) -> RefreshResult:
        began = time.perf_counter()
        result = RefreshResult(self.paths)
        spark = self.spark
        listing = list_files(spark, self.raw_root)
        manifest = stored(spark, self._state("manifest"), LISTING)
        result.changed, result.vanished = changed_quarters(listing, manifest)
        pending = sorted({r.bucket for r in stored(spark, self._state("pending"), PENDING).collect()})
        if not result.changed and not result.vanished and not pending:
            return result
        # what is listed now is what the manifest will say, whatever lands meanwhile
        listing = self._scratch(listing, "listing")

        self._facts(result.changed, result.vanished)
        new, pairs, result.touched_drives = self._partials(result.changed, result.vanished)
        result.touched_buckets = sorted({b for b, _ in pairs})
        touched = sorted({*result.touched_buckets, *pending})
        self._touch([b for b in touched if b not in pending])
        if pairs:
            of_pairs = F.concat_ws("/", BUCKET, "quarter").isin([f"{b}/{q}" for b, q in pairs])
            rows = new.where(F.col(BUCKET).isin(result.touched_buckets) & of_pairs)
            self._replace(rows.hint("rebalance", F.col(BUCKET)), "int_drive_quarter_partials", [BUCKET, "quarter"], pairs)
        if touched:
            self._per_drive(touched)

        # what crosses buckets
        drives = self._read("int_drives", DRIVES)
        state = stored(spark, self._state("last_date"), STATE).first()
        old_max, new_max = state.max_date if state else None, drives.agg(F.max("last_seen")).first()[0]
        stats = self._scratch(dims.merge_model_rollups(self._read("int_model_parts", MODEL_PARTS)), "models")
        fallback = stats.select("model", F.col("capacity_bytes").alias("model_capacity_bytes"))
        old_fallback = stored(spark, self._state("model_capacity"), fallback.schema)
        moved = self._moved(drives, old_max, new_max, old_fallback, fallback)
        result.rewritten_buckets = sorted({*touched, *moved})
        self._touch([b for b in moved if b not in touched])
        if result.rewritten_buckets:
            keys, own = [(b,) for b in result.rewritten_buckets], drives.where(F.col(BUCKET).isin(result.rewritten_buckets))
            last = F.lit(new_max).cast("date")
            bucket = bucket_of(F.col("serial_number"), self.buckets)
            self._replace(dims.spans_of(own, last).withColumn(BUCKET, bucket).hint("rebalance", F.col(BUCKET)), "int_drive_spans", [BUCKET], keys)
            dim_drive = dims.dim_drive_of(own, fallback, last).withColumn(BUCKET, bucket)
            self._replace(dim_drive.hint("rebalance", F.col(BUCKET)), "dim_drive", [BUCKET], keys)
        self._replace_whole(dims.dim_model_of(stats, self.seed), "dim_model")
        self._replace_whole(dims.dim_date_from_partials(drives), "dim_date")
        result.mart_quarters = self._mart()

        fallback.coalesce(1).write.mode("overwrite").parquet(self._state("model_capacity"))
        spark.createDataFrame([(new_max,)], STATE).coalesce(1).write.mode("overwrite").parquet(self._state("last_date"))
        listing.write.mode("overwrite").parquet(self._state("manifest"))
        spark.createDataFrame([], PENDING).coalesce(1).write.mode("overwrite").parquet(self._state("pending"))
        row = (
            result.changed, result.vanished, result.touched_drives, result.touched_buckets, result.rewritten_buckets,
            result.mart_quarters, time.perf_counter() - began,
        )
        log = spark.createDataFrame([row], LOG.partition(", ")[2]).select(F.current_timestamp().alias("logged_at"), "*")
        log.coalesce(1).write.mode("append").parquet(self._state("log"))
        return result

    def _mart(self) -> list[str]:
        """The mart from the sums of all buckets; only quarters with another row are written."""
        counts = afr.merge_model_quarter_counts(self._read("int_model_quarter_parts", MODEL_QUARTER_PARTS))
        models = self.spark.read.parquet(self.paths["dim_model"])
        mart = self._scratch(afr.afr_from_counts(counts, models, self.thresholds), "mart")
        old = stored(self.spark, self.paths["mart_model_afr_quarterly"], mart.schema)
        quarters = sorted(r[0] for r in _differing(mart, old).select("quarter_label").distinct().collect())
        if quarters or old.isEmpty():
            rows = mart.where(F.col("quarter_label").isin(quarters))
            self._replace(rows.coalesce(1), "mart_model_afr_quarterly", ["quarter_label"], [(q,) for q in quarters])
        return quarters


def refresh(
    spark: SparkSession,
    raw_root: str,
    root: str,
    thresholds: AfrThresholds | None = PUBLISHED_THRESHOLDS,
    seed: DataFrame | None = None,
    buckets: int = 64,
) -> RefreshResult:
    """Brings the warehouse at ``root`` up to the raw zone as it is now (see the module's text).

    ``buckets`` is the number of drive buckets, the unit that is rewritten: choose it so that a bucket of drives is a
    file of some tens of MB, and keep it. A refresh with nothing new reads a listing and writes nothing.
    """
    return Refresh(spark, raw_root, root, thresholds, seed, buckets).run()


def read_table(spark: SparkSession, result: RefreshResult, name: str) -> DataFrame:
    """A table of the refreshed warehouse without its bucket column."""
    return spark.read.parquet(result.paths[name]).drop(BUCKET)
