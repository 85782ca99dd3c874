"""The language stage on documents of which none has a label."""

from pyspark.sql import functions as F

import corpus_pipeline


def test_unlabelled_documents_stay(spark, frame, rows):
    docs = [(1, "the house"), (2, None), (3, "12 !?"), (None, "la ville"), (3, ""), (4, "é")]
    df = frame(docs).withColumn("lang", F.lit(None).cast("string"))
    out = corpus_pipeline.language(spark, df, "")
    assert out.columns == df.columns
    assert rows(out, "doc_id", "text") == [(None, "la ville"), (1, "the house"), (4, "é")]
