"""The registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetlens.llm import (
    chat, collocations, exact_dedup, hard_negatives, lang_id, near_dedup, packing, pieces, quality, substring_dedup, suffix_dedup, topk, toxicity,
)
from fleetlens.llm.common import prepare

Query = Callable[[SparkSession, str], DataFrame]


def _ready(query: Query) -> Query:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    name: _ready(query)
    for name, query in {
        "op1_substring_dedup": substring_dedup.substring_query,
        "op2_chat": chat.chat_query,
        "op3_quality": quality.quality_query,
        "op4_packing": packing.pack_query,
        "op5_exact_dedup": exact_dedup.dedup_query,
        "op6_near_dedup": near_dedup.near_query,
        "op7_suffix_dedup": suffix_dedup.suffix_query,
        "op8_topk": topk.topk_query,
        "op9_lang_id": lang_id.lang_query,
        "op10_sentencepiece": pieces.pieces_query,
        "op11_toxicity": toxicity.toxicity_query,
        "op12_hard_negatives": hard_negatives.negatives_query,
        "op13_collocations": collocations.collocations_query,
    }.items()
}

SQL: dict[str, str] = {
    "op1_substring_dedup": substring_dedup.SQL,
    "op2_chat": chat.SQL,
    "op5_exact_dedup": exact_dedup.SQL,
    "op6_near_dedup": near_dedup.SQL,
    "op7_suffix_dedup": suffix_dedup.SQL,
    "op8_topk": topk.SQL,
    "op12_hard_negatives": hard_negatives.SQL,
    "op13_collocations": collocations.SQL,
}
