"""The scorer's features and fit against plain loops, and repeated rows."""

import time

import numpy as np
import pytest

from fleetlens.llm import quality as Q
from fleetlens.llm.common import KEY, mix64, with_key, written


def buffer(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])


def test_features_equal_a_plain_count():
    texts = ["The cat, the CAT.", "ab", "", "ÉTÉ été " * 9, "x" * 40 + "\n" + "y z " * 30]
    data, offsets = buffer(texts)
    stats = Q.statistics(data, offsets)
    got = Q.features(data, offsets, stats)
    for i, t in enumerate(texts):
        raw = bytes(b + 32 if 65 <= b <= 90 else b for b in t.encode())
        want = np.zeros(Q.FEATURES)
        for k in range(len(raw) - 2):
            code = raw[k] | raw[k + 1] << 8 | raw[k + 2] << 16
            want[int(mix64(np.array([code], np.uint64))[0]) % Q.FEATURES] += 1
        want = np.sqrt(want / max(1, len(raw) - 2))
        for j, (_, _, high, _) in enumerate(Q.LABELLERS):
            x = stats[i, j]
            b = Q.BINS + 1 if np.isnan(x) else int(np.clip(x / (2 * high) * Q.BINS, 0, Q.BINS))
            want[int(mix64(np.array([1000003 * (j + 1) + b], np.uint64))[0]) % Q.FEATURES] += 1
        assert got[i] == pytest.approx(want, abs=1e-5)


def test_fit_equals_a_plain_loop_and_weights_are_repetitions():
    rng = np.random.default_rng(0)
    x, y, n = rng.random((12, 5)).astype(np.float32), rng.random(12), rng.integers(1, 4, 12)
    w, m, v = [0.0] * 6, [0.0] * 6, [0.0] * 6
    for t in range(1, 21):
        g = [0.0] * 6
        for row, target, times in zip(x.astype(float), y, n):
            e = 1 / (1 + np.exp(-(sum(a * b for a, b in zip(row, w)) + w[5]))) - target
            for k in range(5):
                g[k] += times * e * row[k] / n.sum()
            g[5] += times * e / n.sum()
        for k in range(6):
            g[k] += 1e-4 * w[k] if k < 5 else 0.0
            m[k], v[k] = 0.9 * m[k] + 0.1 * g[k], 0.99 * v[k] + 0.01 * g[k] ** 2
            w[k] -= 0.1 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-8)
    assert Q.fit(x, y, n.astype(float), rounds=20) == pytest.approx(np.array(w), abs=2e-3)
    assert Q.fit(np.repeat(x, n, 0), np.repeat(y, n), rounds=20) == pytest.approx(np.array(w), abs=2e-3)
    assert not Q.fit(x[:0], y[:0], n[:0].astype(float)).any()


def test_repeated_rows_are_one_text_of_the_sample(spark, frame):
    good = "the of and to in is that for it as was with be by on not he this are or his from at which but have an had they you were "
    rows = [(1, good * 3)] * 10_000 + [(i, "$$$ ### buy NOW !!! " * (i % 5 + 8)) for i in range(2, 60)]
    docs = with_key(frame(rows))
    voted = written(spark, docs.mapInArrow(Q._voted, Q._VOTED), "votes")
    assert voted.groupBy(*KEY).count().where("count = 10000").count() == 1
    began = time.time()
    labels, weights = Q.train(spark, docs, voted)
    assert time.time() - began < 120 and np.isfinite(weights).all()
    few = with_key(frame(sorted(set(rows))))
    assert Q.train(spark, few, written(spark, few.mapInArrow(Q._voted, Q._VOTED), "votes"))[1] != pytest.approx(weights)
    got = Q.quality(spark, frame(rows))
    assert got.count() == len(rows) and got.where("doc_id = 1").select("score").distinct().count() == 1
