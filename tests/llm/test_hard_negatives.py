import math

import numpy as np
import pytest

from fleetlens.llm import hard_negatives as H

SCHEMA = "vec_id long, label long, embedding array<double>, place int, v string, at int"


def brute(rows, anchors, positives=5, negatives=10, least=30, most=90):
    """Per anchor row: (anchor, positive, rank, negative, scores), everything by comparison."""
    ok = [
        (i, label, [math.floor(256 * x) for x in v])
        for i, label, v in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, label, v in ok:
        if not anchors(i):
            continue
        others = [(sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in ok if j != i and len(w) == len(v)]
        for p, j, _ in sorted((x for x in others if x[2] == label), key=lambda x: (-x[0], x[1]))[:positives]:
            far = [x for x in others if x[2] != label and least * p <= 100 * x[0] <= most * p]
            for rank, (s, k, _) in enumerate(sorted(far, key=lambda x: (-x[0], x[1]))[:negatives], 1):
                out.append((i, j, rank, k, p, s))
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, m, v, 1, "x", 2) for i, m, v in rows], SCHEMA)
    got = H.hard_negatives(spark, df.where("vec_id % 4 = 0"), df, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def test_equals_brute_force_with_ties_nulls_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(H, "TILE", 16)
    rng = np.random.default_rng(1)
    rows = [(i, int(rng.integers(0, 3)), [float(x) for x in rng.integers(-2, 4, 3) / 4]) for i in range(90)]
    rows += [(200, 1, None), (201, None, [1.0, 1.0, 1.0]), (None, 1, [1.0, 1.0, 1.0]), (204, 1, [1.0, None, 1.0])]
    rows += [(208, 2, [1.0, float("nan"), 1.0]), (212, 0, [1.0, float("inf"), 1.0]), (216, 0, []), (220, 1, [1.0, 0.5])]
    rows += [rows[5]] * 12 + [rows[8]] * 3  # repeated rows, an anchor among them
    assert run(spark, rows) == brute(rows, lambda i: i % 4 == 0)


def test_many_tiles_and_other_windows(spark):
    rng = np.random.default_rng(2)
    near = rng.standard_normal((7, 8))
    rows = [(i, i % 7, [float(x) for x in near[i % 7] + 0.4 * rng.standard_normal(8)]) for i in range(600)]
    got = run(spark, rows, positives=3, negatives=4, least=10, most=60)
    assert got == brute(rows, lambda i: i % 4 == 0, 3, 4, 10, 60)
    assert got


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(i, i % 2, [float(2**20 + i), float(2**20 - i), 2.0**18]) for i in range(24)]
    big = brute(rows, lambda i: i % 4 == 0, most=100)
    assert run(spark, rows, most=100) == big
    assert max(r[4] for r in big) > 2**53


def test_one_label_and_empty_table(spark):
    rows = [(i, 3, [1.0, 2.0]) for i in range(8)]
    assert run(spark, rows) == []
    assert run(spark, []) == []


@pytest.mark.parametrize("n", [1, 63, 64, 65, 512, 4096])
def test_boxes_hold_their_rows(n):
    rng = np.random.default_rng(n)
    matrix = np.floor(rng.standard_normal((n, 5)) * 100)
    order = H.tile_order(matrix)
    assert sorted(order.tolist()) == list(range(n))
    matrix = matrix[order]
    boxes, sizes = H.boxes_of(matrix), H.levels(n)
    assert len(boxes) == sum(sizes) and sizes[-1] == 1
    anchor = rng.standard_normal(5).round(1)
    up, down = np.maximum(anchor, 0), np.minimum(anchor, 0)
    at, width = 0, H.LEAF
    for size in sizes:
        for j in range(size):
            high, low = boxes[at + j][:5], boxes[at + j][5:]
            own = matrix[j * width : (j + 1) * width]
            assert (own <= high).all() and (own >= low).all()
            score = own @ anchor
            assert score.max() <= high @ up + low @ down + 1e-6 and score.min() >= high @ down + low @ up - 1e-6
        at, width = at + size, width * H.FANOUT
