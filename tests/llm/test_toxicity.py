import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import gru, toxicity as T
from fleetlens.llm.lang_id import held_out

SF01 = "/root/testdata/sf0.1"


def buffer(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])


def test_words_and_windows():
    words = gru.words_in(*buffer(["Ab, cd!ab", "", "  ", "É1 x"]))
    assert words.before.tolist() == [0, 3, 3, 3, 5]
    assert len(words.distinct) == 4 and words.place[0] == words.place[2]
    assert words.sizes.sum() == len(words.codes)
    for n in (0, 1, 23, 24, 25, 36, 37, 500):
        text, first, size = gru.windows_of(np.array([0, n]))
        seen = {i for a, k in zip(first, size) for i in range(a, a + k)}
        assert seen == set(range(n)) and all(k == min(n, gru.WINDOW) for k in size)
        assert all(b - a <= gru.STRIDE for a, b in zip(first, first[1:]))


def test_gradients_equal_differences():
    words = gru.words_in(*buffer(["hello World you idiot, yes", "a b c d", "one two three " * 10]))
    net = gru.Network(words.distinct[:5])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    text, first, n = gru.windows_of(words.before)
    ids, mask = gru.steps_of(words.place, first, n)
    y = (np.arange(len(text)) % 2).astype(float)

    def loss():
        z = net.forward(net.inputs(words.distinct, words.codes, words.sizes), ids, mask)
        return float(np.sum(np.log1p(np.exp(z)) - y * z))

    kept: dict = {}
    inputs = net.inputs(words.distinct, words.codes, words.sizes)
    z = net.forward(inputs, ids, mask, kept)
    g = net.backward((words.distinct, words.codes, words.sizes), inputs, ids, mask, kept, 1 / (1 + np.exp(-z)) - y)
    for k, v in net.p.items():
        flat, slope = v.reshape(-1), g[k].reshape(-1)
        for i in np.argsort(-np.abs(slope))[:3]:
            old, e = flat[i], 1e-2
            flat[i] = old + e
            up = loss()
            flat[i] = old - e
            down = loss()
            flat[i] = old
            assert slope[i] == pytest.approx((up - down) / (2 * e), rel=0.02, abs=2e-5), k


def plain_logit(net, tokens):
    """One window, one step and one unit at a time."""
    data, offsets = buffer([" ".join(tokens)])
    words = gru.words_in(data, offsets)
    x = net.inputs(words.distinct, words.codes, words.sizes)[words.place].astype(float)
    sig = lambda v: 1 / (1 + np.exp(-v))
    states = []
    for way, order in (("ahead", range(len(x))), ("back", reversed(range(len(x))))):
        h, got = np.zeros(gru.HIDDEN), {}
        for t in order:
            a, s = x[t] @ net.p[f"{way}_in"] + net.p[f"{way}_bias"], h @ net.p[f"{way}_state"]
            z, r = (sig(a[i : i + gru.HIDDEN] + s[i : i + gru.HIDDEN]) for i in (0, gru.HIDDEN))
            h = (1 - z) * np.tanh(a[2 * gru.HIDDEN :] + r * s[2 * gru.HIDDEN :]) + z * h
            got[t] = h
        states.append([got[t] for t in range(len(x))])
    both = np.concatenate(states, 1)
    e = np.exp(np.tanh(both @ net.p["attention"] + net.p["attention_bias"]) @ net.p["query"])
    return float((e / e.sum()) @ both @ net.p["out"] + net.p["out_bias"][0])


def test_logits_equal_a_plain_network():
    rng = np.random.default_rng(0)
    texts = [" ".join(rng.choice(["so", "you", "über", "idiot", "x" * 40], n)) for n in (1, 5, 24, 25, 61)]
    words = gru.words_in(*buffer(texts))
    net = gru.Network(words.distinct[1:3])
    text, logit = net.logits(words)
    _, first, n = gru.windows_of(words.before)
    for t, z, a, k in zip(text, logit, first, n):
        own = texts[t].split(" ")[a - words.before[t] :][:k]
        assert z == pytest.approx(plain_logit(net, own), abs=1e-4)


def test_edge_cases_have_defined_results(spark, frame):
    bad = [(i, f"some words here and a {w} there") for i, w in zip(range(0, 400, 2), ["idiot", "scum"] * 100)]
    good = [(i, "some words here and a house there") for i in range(1, 400, 2)]
    odd = [(None, "you idiot"), (500, None), (501, ""), (502, " .,! "), (7, "you idiot"), (7, "you idiot"), (503, "x" * 300_000), (504, "good " * 60_000 + "idiot")]
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in bad] + [(i, 0, 1) for i, _ in good] + [(None, 1, 1), (1000, None, 0), (0, 0, 0)], "doc_id long, toxic int, quality int")
    docs = frame(bad + good + odd)
    model = T.train(spark, docs, labels)
    got = T.toxicity(spark, docs, model)
    assert got.columns == ["doc_id", "score", "predicted"] and got.count() == docs.count()
    assert got.where("not score between 0 and 1").count() == 0
    told = {r["doc_id"]: r["predicted"] for r in got.where("doc_id is not null").collect()}
    assert all(told[i] == 1 for i, _ in bad) and all(told[i] == 0 for i, _ in good if i != 7)
    assert [r["score"] for r in got.where("doc_id in (500, 501, 502)").collect()] == [0.0] * 3
    # a long text has the score of the highest of its windows
    words = ("some words here and a house there " * 400 + "idiot").split()
    starts = [*range(0, len(words) - gru.WINDOW, gru.STRIDE), len(words) - gru.WINDOW]
    parts = [(i, " ".join(words[a : a + gru.WINDOW])) for i, a in enumerate(starts)]
    scores = {r["doc_id"]: r["score"] for r in T.toxicity(spark, frame([(-1, " ".join(words)), *parts]), model).collect()}
    assert scores.pop(-1) == pytest.approx(max(scores.values()), abs=1e-5)
    # a null id and repeated ids change no score
    again = T.toxicity(spark, frame([(None, "you idiot"), (7, "you idiot"), (8, "you idiot")]), model).collect()
    assert len({round(r["score"], 6) for r in again}) == 1
    assert round(again[0]["score"], 6) == round(got.where("doc_id is null").first()["score"], 6)
    assert T.toxicity(spark, frame([]), model).count() == 0


def test_nothing_to_learn_from(spark, frame):
    docs = frame([(1, "you idiot"), (2, "hello")])
    for rows in ([], [(1, 1), (2, 1)], [(9, 1), (8, 0)]):
        model = T.train(spark, docs, spark.createDataFrame(rows, "doc_id long, toxic int"))
        assert model.network is None
        assert {r["score"] for r in T.toxicity(spark, docs, model).collect()} == {0.0}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet").select("doc_id", "toxic")
    model = T.train(spark, docs.where(~held_out()), labels)
    got = T.toxicity(spark, docs.where(held_out()), model).join(labels, "doc_id")
    share = {r["toxic"]: r["p"] for r in got.groupBy("toxic").agg(F.avg("predicted").alias("p")).collect()}
    assert share[1] >= 0.8 and share[0] <= 0.05, share
