"""Language identification, the quality classifier and the piece codec."""

import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import lang_id, pieces, quality

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = lang_id.lang_query(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right = got.agg(F.avg(F.expr("cast(lang_pred = lang as double)"))).first()[0]
    assert right > 0.98
    plain = docs.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 4 == 2).alias("h"))
    assert plain.where("h").count() == got.count()


def test_naive_bayes_equals_brute_force(spark, frame, monkeypatch):
    """Counts, log probabilities and posteriors of a few texts, computed by hand."""
    monkeypatch.setattr(lang_id, "BUCKETS", 64)
    texts = [("de", "Über die Brücke"), ("fr", "la façade"), ("de", "zu"), ("fr", ""), ("fr", "çà et là là")]
    df = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(texts)], "doc_id long, text string, lang string")

    def buckets(text):
        points = [ord(c) + 32 if ("A" <= c <= "Z" or ("À" <= c <= "Þ" and c != "×")) else ord(c) for c in text]
        out = []
        for order in lang_id.ORDERS:
            for i in range(len(points) - order + 1):
                h = order * 0x27D4EB2F & 0xFFFFFFFF
                for j in range(order):
                    h = ((h ^ points[i + j]) * int(lang_id._MULTIPLIERS[j])) & 0xFFFFFFFF
                    h ^= h >> 15
                out.append((h >> 2) % 64)
        return out

    # the tasks run in other processes, which keep the usual number of buckets: count here
    counted = list(lang_id._counted(iter([b for b in df.select("text", "lang").toArrow().to_batches()])))
    got = {}
    for b in counted:
        for lang, bucket, n in zip(*(b.column(i).to_pylist() for i in range(3))):
            got[lang, bucket] = got.get((lang, bucket), 0) + n
    want = {}
    for lang, t in texts:
        for x in buckets(t):
            want[lang, x] = want.get((lang, x), 0) + 1
    assert got == want


def test_language_edges(spark, frame, rows):
    train = spark.createDataFrame(
        [(1, "the house of the people", "en"), (2, "la maison de la ville", "fr"), (3, None, "fr"), (4, "xyz", None)],
        "doc_id long, text string, lang string",
    )
    model = lang_id.train(train)
    assert sorted(model.languages) == ["en", "fr"]
    docs = [(1, None), (2, ""), (3, "123 !?"), (4, "²½"), (5, "the people"), (5, "la ville"), (None, "de la maison"), (6, "the " * 50_000)]
    df = frame(docs).withColumn("lang_pred", F.lit("old"))
    got = rows(lang_id.identify(spark, df, model), "doc_id", "lang_pred", "score")
    assert [(i, p) for i, p, _ in got] == [
        (None, "fr"), (1, "und"), (2, "und"), (3, "und"), (4, "und"), (5, "en"), (5, "fr"), (6, "en")
    ]
    assert all(0 <= s <= 1 for *_, s in got) and all(s == 0 for _, p, s in got if p == "und")
    nothing = lang_id.train(train.limit(0))
    assert rows(lang_id.identify(spark, frame(docs), nothing), "lang_pred", "score") == [("und", 0.0)] * len(docs)
    assert lang_id.identify(spark, frame([]), model).count() == 0
    kept = lang_id.drop_undetermined(spark, df)
    assert kept.columns == df.columns and kept.count() == 4


def test_expectation_maximisation_finds_accuracies():
    """Votes drawn from known accuracies: the estimates come close, posteriors follow the truth."""
    r = random.Random(4)
    right = [0.9, 0.8, 0.95, 0.7, 0.85, 0.9, 0.75, 0.9, 0.8][: len(quality.LABELLERS)]
    counts, truth = {}, {}
    for _ in range(20_000):
        good = r.random() < 0.7
        votes = "".join(
            quality.ABSTAIN if r.random() < 0.2 else (quality.GOOD if (r.random() < a) == good else quality.BAD) for a in right
        )
        counts[votes] = counts.get(votes, 0) + 1
        truth.setdefault(votes, []).append(good)
    labels = quality.expectation_maximisation(counts)
    assert abs(labels.prior - 0.7) < 0.03
    assert np.abs(labels.right.mean(1) - right).max() < 0.05
    correct = sum((labels.posterior[v] >= 0.5) == g for v, gs in truth.items() for g in gs)
    assert correct / 20_000 > 0.95


def test_statistics_by_hand():
    text = "The cat!\n" * 5 + "É the the dog"
    data = np.frombuffer(text.encode(), np.uint8)
    s = dict(zip([x[0] for x in quality.LABELLERS], quality.statistics(data, np.array([0, len(data)]))[0]))
    assert s["symbols"] == pytest.approx(5 / len(data)) and s["capitals"] == pytest.approx(5 / len(data))
    assert s["repeated_lines"] == pytest.approx(1 - 2 / 6)
    assert s["word_length"] == pytest.approx((5 * 7 + 1 + 3 + 3 + 3) / 14)
    assert math.isnan(s["distinct"])


def test_quality_against_labels(spark):
    got = quality.quality_query(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    kept = {r["quality"]: r["k"] for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert kept[1] > 0.98 and kept[0] < 0.2


def test_quality_edges(spark, frame, rows):
    docs = [(1, None), (2, ""), (3, " \n"), (4, "the house of the people is on the hill and we like it"), (4, "### $$$ %%%"), (None, "x " * 9999)]
    got = rows(quality.quality(spark, frame(docs)), "doc_id", "score", "kept")
    assert len(got) == len(docs)
    assert all(s == 0 and not k for i, s, k in got if i in (1, 2, 3))
    assert quality.quality(spark, frame([])).count() == 0


@pytest.fixture(scope="module")
def codec():
    v = pieces.load(public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.Codec(v, pieces.build_trie(v))


def best_score(vocabulary, ids, word):
    best = [0.0] + [-math.inf] * len(word)
    for i in range(len(word)):
        if best[i] == -math.inf or (word[i] & 0xC0) == 0x80:
            continue
        k = len(re.match(rb".[\x80-\xbf]*", word[i:], re.S)[0])
        best[i + k] = max(best[i + k], best[i] + k * vocabulary.scores[vocabulary.byte_ids[0]])
        for n in range(1, min(64, len(word) - i) + 1):
            p = ids.get(word[i : i + n])
            if p is not None:
                best[i + n] = max(best[i + n], best[i] + vocabulary.scores[p])
    return best[-1]


def test_viterbi_finds_the_best_score(codec):
    r = random.Random(6)
    v, flags = codec.vocabulary, codec.vocabulary.is_byte
    ids = {p: i for i, p in enumerate(v.pieces) if p and not flags[i]}
    words = ["".join(r.choice("abcdeéñ日z😀q") for _ in range(r.randrange(1, 15))) for _ in range(300)]
    words += ["internationalization", "x" * 200, "the", "\n\t", "▁"]
    for word, got in zip(words, codec.encode_many(words)):
        if "▁" not in word:
            total = v.scores[np.frombuffer(got, "<u4")].sum()
            assert total == pytest.approx(best_score(v, ids, ("▁" + word).encode()))


def test_trie_holds_exactly_the_pieces(codec):
    v, t, flags = codec.vocabulary, codec.trie, codec.vocabulary.is_byte
    for i, piece in enumerate(v.pieces):
        if not piece or flags[i]:
            continue
        s = 0
        for b in piece:
            child = int(t.base[s]) + b + 1
            assert t.check[child] == s
            s = child
        assert t.piece[s] == i
    assert (t.piece >= 0).sum() == sum(1 for i, p in enumerate(v.pieces) if p and not flags[i])


TEXTS = [None, "", " ", "   ", "a", " lead", "trail ", "two  spaces", "▁ marker ▁▁", "x\x00y", "😀日本\n\t", "w " * 20_000, "q" * 3000]


def test_round_trip(spark, frame, rows, codec):
    docs = list(enumerate(TEXTS)) + [(3, "again"), (None, "no id")]
    encoded = pieces.encode(spark, frame(docs), codec.vocabulary)
    back = pieces.decode(spark, encoded, codec.vocabulary)
    assert rows(back, "doc_id", "text") == sorted(((i, t or "") for i, t in docs), key=lambda r: [(x is not None, x) for x in r])
    told = pieces.measured(spark, frame(docs), codec.vocabulary).collect()
    assert len(told) == len(docs) and all(r["round_trip"] for r in told)
    assert pieces.measured(spark, frame([]), codec.vocabulary).count() == 0


def test_a_full_table_forgets_nothing_it_needs(codec, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_WORDS", 3)
    small = pieces.Codec(codec.vocabulary, codec.trie)
    texts = ["one two three", "two four five six", "one six seven", "eight two"]
    for _ in range(2):
        assert small.encode_many(texts) == codec.encode_many(texts)
