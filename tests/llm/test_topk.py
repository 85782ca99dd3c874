"""Top-k by three phases against a full sort."""

import math
import random

import pytest
from pyspark.sql import functions as F

from fleetlens.llm import topk

SCHEMA = "vec_id long, embedding array<double>, label int, salt int, place long"


def brute(rows, k, scale=1024):
    ok = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, qv in ok:
        if q % 5:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(qv, v)), i) for i, v in ok if i != q and len(v) == len(qv)))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def run(spark, rows, k):
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], SCHEMA).repartition(3)
    got = topk.top_k(spark, df.where(F.col("vec_id") % 5 == 0), df, k)
    assert dict(got.dtypes)["rank"] == "int"
    return sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect()))


@pytest.mark.parametrize("dims,k,block", [(8, 3, 16), (3, 10, 7), (1, 2, 50), (16, 400, 64)])
def test_top_k(spark, dims, k, block, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_VECTORS", block)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 9)
    r = random.Random(dims)
    rows = [(i, [r.uniform(-1, 1) for _ in range(dims)]) for i in range(150)]
    rows += [(200 + i, rows[5][1]) for i in range(40)] + [(300, [0.0] * dims), (305, [-1.0] * dims)]
    rows += [(400, None), (401, [float("nan")] * dims), (402, [None] * dims), (405, [float("inf")] * dims), (None, [1.0] * dims)]
    assert run(spark, rows, k) == brute(rows, k)


def test_other_dimensions_few_candidates_and_large_values(spark):
    rows = [(0, [1.0, 2.0]), (1, [3.0, 1.0]), (5, [1.0]), (10, []), (11, []), (15, [0.5, -0.5]), (20, [3e7, 1e6]), (21, [2e3, -7e5])]
    assert run(spark, rows, 4) == brute(rows, 4)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert topk.top_k(spark, df, df).count() == 0


def by_id(rows, k, scale=1024):
    """As the SQL: one list for each query id, of all its rows' candidates."""
    ok = [(i, [math.floor(scale * x) for x in v]) for i, v in rows]
    out = []
    for q in sorted({i for i, _ in ok if i % 5 == 0}):
        scored = sorted((-sum(a * b for a, b in zip(x, v)), i) for j, x in ok if j == q for i, v in ok if i != q and len(v) == len(x))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("copies,queries,k", [(1, 1, 4), (1, 1 << 20, 7), (32, 200, 60)])
def test_cells_of_several_blocks(spark, copies, queries, k, monkeypatch):
    """Blocks of small and of large numbers in a cell, equal scores, ids that come twice, queries among them."""
    for name, value in (("BLOCK_VECTORS", 11), ("BLOCK_QUERIES", 4), ("COPIES", copies), ("CELL_QUERIES", queries)):
        monkeypatch.setattr(topk, name, value)
    r = random.Random(k)
    rows = [(i, [r.uniform(-1, 1) * 10 ** r.choice([0, 0, 0, 4, 6]) for _ in range(6)]) for i in range(90)]
    rows += [(i, [r.uniform(-1, 1) for _ in range(6)]) for i in (20, 21, 22, 35)] + [(100 + i, rows[7][1]) for i in range(30)]
    rows += [(200 + i, [0.5, -0.25]) for i in range(12)] + [(220 + i, [float(i)]) for i in range(3)]
    assert run(spark, rows, k) == by_id(rows, k)


def test_copies_of_queries_follow_the_vectors_not_the_partitions(spark):
    """Vectors of 2 GB and queries of 20 MB: each query is sent about as often as the vectors outweigh the queries."""
    vectors = spark.createDataFrame([(64, 4096, 2)] * 3760, "dims int, n int, width int")
    queries = spark.createDataFrame([(64, 512, 2)] * 300, "dims int, n int, width int")
    cells = {p: topk._cells(vectors, queries, p).first() for p in (8, 600, 100_000)}
    assert {c["q_cells"] for c in cells.values()} == {3}
    assert cells[8]["v_cells"] == -(-3760 * 4096 * 136 // topk.CELL_VECTORS)  # cells are of bounded size, however few partitions
    assert all(c["v_cells"] <= 3760 * 4096 // (300 * 512) for c in cells.values())


def test_copied_queries_are_never_broadcast(spark):
    """The copies of the queries go from task to task: Spark's estimate of their size knows nothing of the copies."""
    rows = [(i, [0.1 * i, 1.0, -0.5]) for i in range(40)]
    held = {x: spark.conf.get(x) for x in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}

    def nodes(plan):
        plan = plan.initialPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
        yield plan
        for i in range(plan.children().size()):
            yield from nodes(plan.children().apply(i))

    try:
        spark.conf.set("spark.sql.shuffle.partitions", "500")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
        df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], SCHEMA)
        plan = topk.top_k(spark, df.where(F.col("vec_id") % 5 == 0), df, 3)._jdf.queryExecution().executedPlan()
    finally:
        for x, value in held.items():
            spark.conf.set(x, value)
    found = list(nodes(plan))
    assert sum(x.nodeName() == "Generate" for x in found) > 0
    for x in found:
        assert x.nodeName() != "BroadcastExchange" or all(y.nodeName() != "Generate" for y in nodes(x))
