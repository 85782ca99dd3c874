"""Stages exact, near and repeats on rows that repeat an id or have none."""

import random

import corpus_pipeline

STAGES = dict(corpus_pipeline.STAGES)


def prose(seed, n=60):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(10_000)}" for _ in range(n))


def test_one_document_of_each_group_reaches_the_end(spark, frame, rows, tmp_path):
    a, b, c, d, e, f = (prose(i) for i in range(6))
    near_d = f"{d} one"
    docs = [(1, a), (1, a), (1, a.upper())]  # a repeated id, cases apart
    docs += [(None, b), (None, b), (None, b.upper())]  # all ids of a group null
    docs += [(None, c), (2, c), (2, c), (0, c), (0, c)]  # repeated rows that stay and that go
    docs += [(None, d), (None, near_d), (None, f"{d} two")]  # near copies under null ids
    docs += [(3, e), (3, f"{e} three"), (3, f), (4, f"{f} four")]  # near copies of one id; another group of that id
    docs += [(5, "short"), (5, "short")]
    df = frame(docs)
    for name in ("exact", "near", "repeats"):
        df = STAGES[name](spark, df, "")
        assert df.columns == frame([]).columns
        df.write.parquet(f"{tmp_path}/{name}")
        df = spark.read.parquet(f"{tmp_path}/{name}")
    got = rows(df, "doc_id", "text")
    assert [i for i, _ in got] == [None, None, 1, 2, 3, 3, 5]
    texts = [t.lower() for _, t in got]
    assert sum(b == t for t in texts) == 1 and sum(t.startswith(d) for t in texts) == 1
    assert texts[2:4] == [a, c] and texts[6] == "short"
    assert sorted(t[: len(e)] == e for t in texts[4:6]) == [False, True]
    assert sum(t.startswith(f) for t in texts[4:6]) == 1


def test_near_leaves_wordless_rows_alone(spark, frame, rows):
    docs = [(1, " "), (1, " "), (None, None), (None, None), (2, prose(1)), (2, prose(1))]
    got = rows(STAGES["near"](spark, frame(docs), ""), "doc_id", "text")
    assert got == [(None, None), (None, None), (1, " "), (1, " "), (2, prose(1))]
