"""Exact dedup against immutable snapshots with static binary-fuse filters (operator 5).

A snapshot is a written table of digests (one row per distinct normalised text: the largest
doc_id and the number of rows) with one static binary-fuse filter per digest bucket. A new
batch is first grouped by itself, so a digest of thousands of copies is one row; its digests
are screened by the filters of each snapshot, and only positives join the exact buckets.
Rows that share a digest with a kept row of another id are then compared byte by byte with it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import fuse
from fleetlens.llm.common import KEY, LOWER, UPPER, one_per_group, rows_of, split_maybe, with_key, without_rows, written

#: Digests that one filter holds on average.
FILTER_KEYS = 1 << 15


def normalized(text: str = "text") -> Column:
    """Null as empty, A-Z lower-cased, nothing else changed."""
    return F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)


def group_batch(rows: DataFrame) -> DataFrame:
    """digest, keep_id (largest doc_id, null if all are), rows_n of one batch by itself."""
    return rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("rows_n"))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.conv(F.substring("digest", 1, 12), 16, 10).cast("long"), F.lit(buckets))


def _key64(digests: pd.Series) -> np.ndarray:
    return np.array([int(d[12:28], 16) for d in digests], np.uint64)


class Snapshot:
    """Immutable: the written digest table and its written filters."""

    def __init__(self, spark: SparkSession, groups: DataFrame):
        self.digests = written(spark, groups, "snapshot")
        self.buckets = max(1, -(-self.digests.count() // FILTER_KEYS))

        def filters(pdf: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"bucket": pdf["bucket"].iloc[:1], "filter": [fuse.build(_key64(pdf["digest"]))]})

        self.filters = written(
            spark,
            self.digests.select("digest", _bucket(self.buckets).alias("bucket"))
            .groupBy("bucket")
            .applyInPandas(filters, "bucket long, filter binary"),
            "filters",
        )

    def positives(self, groups: DataFrame) -> DataFrame:
        """The rows of ``groups`` whose digest the snapshot may hold: all it does, 1 in 256 others."""

        def screen(incoming: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
            if incoming.empty or filters.empty:
                return incoming.iloc[:0][["digest", "keep_id", "rows_n"]]
            hit = fuse.contains(filters["filter"].iloc[0], _key64(incoming["digest"]))
            return incoming.loc[hit, ["digest", "keep_id", "rows_n"]]

        return (
            groups.withColumn("bucket", _bucket(self.buckets))
            .groupBy("bucket")
            .cogroup(self.filters.groupBy("bucket"))
            .applyInPandas(screen, "digest string, keep_id long, rows_n long")
        )


def _merged_groups(spark: SparkSession, batches: Sequence[DataFrame]) -> DataFrame:
    """digest, keep_id, rows_n over all batches (each: digest rows), by screening batch after batch."""
    owns = [written(spark, group_batch(b), "batch-groups") for b in batches]
    met = None
    for i, own in enumerate(owns[:-1]):
        old = Snapshot(spark, own)
        for new in owns[i + 1 :]:
            # exact bucket: what the filter lets through joins the snapshot's digest rows
            found = old.positives(new).select("digest").join(old.digests.select("digest"), "digest")
            met = found if met is None else met.unionByName(found)
    everything = owns[0]
    for own in owns[1:]:
        everything = everything.unionByName(own)
    if met is None:
        return everything
    met = written(spark, met.distinct(), "met")
    several = (
        everything.join(met, "digest", "left_semi")
        .groupBy("digest")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("rows_n").alias("rows_n"))
    )
    return everything.join(met, "digest", "left_anti").unionByName(several)


def _clashing(spark: SparkSession, docs: DataFrame, rows: DataFrame, groups: DataFrame, digest: Column) -> DataFrame:
    """Digests under which some row's bytes differ from those of the row that stays."""
    copies = groups.where("rows_n > 1").select("digest", "keep_id")
    member_keys = rows.join(copies, "digest").select(*KEY, "digest", (F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("stays"))
    member_keys = written(spark, member_keys, "copies")
    keyed = with_key(docs)
    stay = rows_of(keyed, member_keys.where("stays").select(*KEY, "digest").distinct())
    stay = stay.select("digest", normalized().alias("kept_text"))
    others = split_maybe(keyed, member_keys.where("not stays"))[0]
    others = others.select(digest.alias("digest"), normalized().alias("own_text"))
    return others.join(stay, "digest").where(F.col("own_text") != F.col("kept_text")).select("digest")


def exact_dedup(
    spark: SparkSession, batches: Sequence[DataFrame], digest: Callable[[Column], Column] = lambda c: F.sha2(c, 256)
) -> DataFrame:
    """One row per input row of all batches: doc_id, KEY, digest, keep_id, group_size, kept, group (its name).

    The first batch becomes a snapshot, against which later batches are screened, and so on;
    an only batch is grouped by itself. Of equal texts (null as empty) the row with the largest
    doc_id stays: a null id loses to any other, ids that are all null stay together, and so do
    rows that repeat the id that stays. Empty batches add no row; other columns are ignored.
    ``digest`` is a hexadecimal digest of 28 digits or more; should two texts share one, their
    rows are grouped by the text itself.
    """
    made = digest(normalized())
    parts = [
        written(spark, with_key(docs).select("doc_id", *KEY, made.alias("digest")), "digests") for docs in batches
    ]
    groups = written(spark, _merged_groups(spark, parts), "groups")
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    docs = batches[0].select("doc_id", "text")
    for more in batches[1:]:
        docs = docs.unionByName(more.select("doc_id", "text"))
    out = rows.join(groups.withColumnRenamed("rows_n", "group_size"), "digest").withColumn("group", F.col("digest"))
    clash = written(spark, _clashing(spark, docs, rows, groups, made), "clashes").distinct()
    if not clash.isEmpty():
        texts = with_key(docs).withColumn("digest", made).join(clash, "digest").withColumn("own_text", normalized())
        exact = texts.groupBy("digest", "own_text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        again = texts.join(exact, ["digest", "own_text"]).withColumn("group", F.concat_ws(":", "digest", "own_text"))
        out = out.join(clash, "digest", "left_anti").unionByName(again.select(*out.columns))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def halves(docs: DataFrame) -> list[DataFrame]:
    """Two batches of a table that came as one: a snapshot and what arrives after it, by a hash of the id."""
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    return [docs.where(half == 0), docs.where(half == 1)]


def dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_dedup(spark, halves(docs)).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


def drop_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    dropped = exact_dedup(spark, halves(docs)).where("not kept").select(*KEY)
    return without_rows(docs, written(spark, dropped, "dropped"))


def one_of_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One document of each group of equal texts, with all its columns, repeated and null ids included."""
    return one_per_group(spark, docs, exact_dedup(spark, halves(docs)))


SQL = f"""
with d as (select doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') as t from documents)
select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
       doc_id = max(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from d
"""
