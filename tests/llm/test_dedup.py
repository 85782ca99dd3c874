"""Exact, near, substring and suffix dedup against brute force, with every edge case."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import exact_dedup, fuse, near_dedup, substring_dedup, suffix_dedup
from fleetlens.llm.common import KEY
from fleetlens.llm.components import connected_components

NONE_FIRST = {"key": lambda r: [(x is not None, x) for x in r]}


def corpus(seed=5, n=60):
    """Random texts with exact, cased and near copies, shared passages, nulls, ties and repeated rows."""
    r = random.Random(seed)
    words = ["alpha", "beta", "Gamma", "délta", "eps", "zeta,", "eta.", "θ", "iota", "kappa"]

    def text(k):
        return " ".join(r.choice(words) + str(r.randrange(30)) for _ in range(k))

    passage = text(20)
    docs = [(i, text(r.randrange(1, 60))) for i in range(n)]
    for i in range(n, n + 12):
        docs.append((i, docs[i - n][1].upper() if i % 3 == 0 else docs[i - n][1]))
    for i in range(n + 12, n + 30):
        w = docs[i - n][1].split()
        w[r.randrange(len(w))] = "changed"
        docs.append((i, " ".join(w)))
    for i in range(n + 30, n + 45):
        docs.append((i, f"{text(r.randrange(5))} {passage}\t{text(r.randrange(5))}"))
    # one word over and over, white space only, empty, null, short, repeated rows, null ids
    docs += [(900, "same " * 80), (901, "same " * 79), (902, " \t\n"), (903, ""), (904, None), (905, None), (906, "x"), (907, "X")]
    docs += [(908, passage), (908, passage), (908, text(9)), (None, passage), (None, text(3)), (None, None), (909, "ab" * 300)]
    return docs


def test_exact_dedup(spark, frame, rows):
    docs = corpus()
    want = sorted(brute.exact_dedup(docs), **NONE_FIRST)
    columns = ["doc_id", "keep_id", "group_size", "kept", "digest"]
    for batches in ([frame(docs)], exact_dedup.halves(frame(docs)), [frame(docs[:50]), frame(docs[50:90]), frame(docs[90:])]):
        assert rows(exact_dedup.exact_dedup(spark, batches), *columns) == want
    assert exact_dedup.exact_dedup(spark, exact_dedup.halves(frame([]))).count() == 0


def test_exact_dedup_compares_bytes(spark, frame, rows):
    """A digest that sees the first letter only still groups by text."""
    docs = [(1, "aa"), (2, "ab"), (3, "Aa"), (4, "b"), (5, "ab"), (6, None), (7, "")]
    weak = exact_dedup.exact_dedup(spark, [frame(docs[:4]), frame(docs[4:])], lambda c: F.sha2(F.substring(c, 1, 1), 256))
    assert rows(weak, "doc_id", "keep_id", "group_size", "kept") == [r[:4] for r in brute.exact_dedup(docs)]


@pytest.mark.parametrize("n", [0, 1, 2, 50, 5000])
def test_fuse_filter(n):
    r = np.random.default_rng(n)
    keys = r.integers(0, 1 << 63, n, dtype=np.uint64)
    blob = fuse.build(keys)
    assert fuse.contains(blob, keys).all()
    assert fuse.contains(blob, r.integers(0, 1 << 63, 20_000, dtype=np.uint64)).mean() < 0.01


def test_near_dedup(spark, frame, rows):
    docs = corpus()
    columns = ["doc_id", "n_shingles", "component_id", "kept"]
    for words, percent in ((3, 85), (2, 80)):
        got = rows(near_dedup.near_dedup(spark, frame(docs), words, percent), *columns)
        assert got == sorted(brute.near_dedup(docs, words, percent), **NONE_FIRST)
    assert near_dedup.near_dedup(spark, frame([])).count() == 0


def test_near_dedup_judges_what_the_star_misses(spark, frame, rows):
    """A large band whose members are not all close to its centre: every link still counts."""
    r = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    docs = []
    for i in range(70):
        w = list(base)
        for at in r.sample(range(60), r.randrange(1, 4)):
            w[at] = f"v{r.randrange(4)}"
        docs.append((i, " ".join(w)))
    got = rows(near_dedup.near_dedup(spark, frame(docs), 1, 90), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(brute.near_dedup(docs, 1, 90))


def test_blocks_of_a_large_band(spark, frame, rows, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    test_near_dedup_judges_what_the_star_misses(spark, frame, rows)


def test_components(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100 + r.randrange(60), 100 + r.randrange(60)) for _ in range(40)] + [(7, 7)]
    edges += [(500, k) for k in range(501, 540)] + [(540, 501)]
    df = spark.createDataFrame(edges, "u long, v long")
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        if u != v:
            a, b = sorted((find(u), find(v)))
            parent[b] = a
    got = sorted(map(tuple, connected_components(spark, df).collect()))
    assert got == sorted((x, find(x)) for x in parent if find(x) != x or any(find(y) == x for y in parent if y != x))
    assert connected_components(spark, df.limit(0)).count() == 0


@pytest.mark.parametrize("window", [13, 4, 2])
def test_substring_dedup(spark, frame, rows, window):
    docs = corpus()
    got = rows(substring_dedup.substring_dedup(spark, frame(docs), window), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(brute.substring_dedup(docs, window), **NONE_FIRST)


def test_substring_dedup_empty(spark, frame):
    assert substring_dedup.substring_dedup(spark, frame([])).count() == 0


@pytest.mark.parametrize("length", [40, 9, 1])
def test_suffix_dedup(spark, frame, rows, length):
    docs = corpus()
    got = rows(suffix_dedup.suffix_dedup(spark, frame(docs), length), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(brute.suffix_dedup(docs, length), **NONE_FIRST)


def test_suffix_dedup_empty(spark, frame):
    assert suffix_dedup.suffix_dedup(spark, frame([])).count() == 0


def test_cut_repeats_keeps_whole_characters(spark, frame, rows):
    """The stage's texts lose repeated characters only where all their bytes repeat, and keep every column."""
    docs = corpus()
    length = 30
    df = frame(docs)
    out = suffix_dedup.cut_repeats(spark, df, length)
    assert out.columns == df.columns
    want = []
    for (i, t), gone in zip(docs, brute.repeated_bytes(docs, length)):
        kept, at = "", 0
        for c in t or "":
            n = len(c.encode())
            kept += "" if all(gone[at : at + n]) else c
            at += n
        want.append((i, None if t is None else kept))
    assert rows(out, "doc_id", "text") == sorted(want, **NONE_FIRST)


def test_stages_keep_columns(spark, frame, rows):
    docs = corpus()
    df = frame(docs)
    kept = exact_dedup.drop_copies(spark, df)
    assert kept.columns == df.columns
    assert rows(kept, "doc_id", "text") == sorted([d for d, x in zip(docs, brute.exact_dedup(docs)) if x[3]], **NONE_FIRST)
    kept = near_dedup.drop_near_copies(spark, df)
    assert kept.columns == df.columns
    assert rows(kept, "doc_id", "text") == sorted([d for d, x in zip(docs, brute.near_dedup(docs, 5, 80)) if x[3]], **NONE_FIRST)


def test_keys_tell_rows_apart(spark, frame):
    from fleetlens.llm.common import with_key

    df = frame([(None, "a"), (0, "a"), (0, None), (0, ""), (1, "a")])
    assert with_key(df).select(*KEY).distinct().count() == 5
