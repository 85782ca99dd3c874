"""From raw documents to packed training sequences.

STAGES lists the stages in order; each takes (spark, docs, sf_dir) and returns a DataFrame,
which is written as Parquet and read again as the next stage's docs. All but the last return
the columns of documents. Every stage works on all that the one before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetlens.llm import exact_dedup, lang_id, near_dedup, packing, suffix_dedup
from fleetlens.llm.common import prepare, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; texts that are null or have no letter go."""
    return lang_id.drop_undetermined(spark, docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the largest doc_id) of each group of equal texts, A-Z lower-cased; one row also
    where several rows have that id or all ids are null."""
    return exact_dedup.one_of_copies(spark, docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of each component of near copies: five-word shingles, 0.8; one
    row also where several rows have that id or all ids are null."""
    return near_dedup.one_of_near_copies(spark, docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 200 bytes and more that occur at more than one place."""
    return suffix_dedup.cut_repeats(spark, docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens."""
    return packing.pack(spark, docs)


STAGES = [
    ("language", language),
    ("exact", exact),
    ("near", near),
    ("repeats", repeats),
    ("packed", packed),
]

#: The learned classifier and the tokeniser are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
