"""The stages of the pipeline, each against a brute-force version on its own input."""

import brute
import pytest

import corpus_pipeline
from fleetlens.llm import packing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """Input and output of every stage over sf0.001, written and read again."""
    root = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{root}/{i}")
        new = spark.read.parquet(f"{root}/{i}")
        out.append((name, docs, new))
        docs = new
    return out


def texts(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()))


def test_columns_stay(staged):
    for _, before, after in staged[:-1]:
        assert after.columns == before.columns


def test_language(staged):
    _, before, after = staged[0]
    assert texts(after) == [(i, t) for i, t in texts(before) if t and any(c.isalpha() for c in t)]


def test_exact(staged):
    _, before, after = staged[1]
    docs = texts(before)
    assert texts(after) == [d for d, r in zip(docs, brute.exact_dedup(docs)) if r[3]]


def test_near(staged):
    _, before, after = staged[2]
    docs = texts(before)
    assert texts(after) == [d for d, r in zip(docs, brute.near_dedup(docs, 5, 80)) if r[3]]


def test_repeats(staged):
    _, before, after = staged[3]
    want = []
    for (i, t), gone in zip(texts(before), brute.repeated_bytes(texts(before), 200)):
        kept, at = "", 0
        for c in t:
            n = len(c.encode())
            kept += "" if all(gone[at : at + n]) else c
            at += n
        want.append((i, kept))
    assert texts(after) == want


def test_packed(staged):
    _, before, after = staged[4]
    encoder = packing.public_encoder()
    want = {i: len(encoder(t)) // 4 + 1 for i, t in texts(before)}
    got = {}
    for r in after.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
        assert r["doc_tokens"] == want[r["doc_id"]]
    assert got == want


def test_registered(spark):
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names
    assert [n for n in range(1, 11) if any(x.startswith(f"op{n}_") for x in names)] == list(range(1, 11))
    assert len(corpus_pipeline.STAGES) == 5
