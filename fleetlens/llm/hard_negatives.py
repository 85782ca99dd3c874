"""Hard negatives by inner product in score windows, over STR-packed R-trees (operator 12).

Rows are packed by sort-tile-recursion: Spark ranges them into slabs by their first component
within a label, sorts each slab by the second one and cuts it into tiles; a tile becomes a small
R-tree, packed the same way on its two widest components. The box of a node gives an interval of
every component's product with the anchor, so of the score. A best-first queue over the roots of
many trees drops nodes whose interval misses all score windows of the anchor, or whose upper end
lies strictly below the k-th score that every window has already.

Anchors meet trees in cells: trees are dealt into at most TREES_PER_CELL a cell, blocks of anchors
into at most ANCHORS_PER_CELL, and every cell is a cogroup of its own. No table is broadcast.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import prepare, written

SCALE = 256
TILE, LEAF, FANOUT = 4096, 64, 8
ANCHOR_BLOCK = 256
TREES_PER_CELL, ANCHORS_PER_CELL = 32, 8192

_ROWS = "vec_id long, label long, dims int, c0 double, c1 double, v binary"
_BLOCKS = "place long, dims int, label long, n int, ids binary, matrix binary, boxes binary"
_FOUND = "anchor long, at int, rank int, vec_id long, score long"


def _valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with an id, a label and a vector of finite components, which become floor(SCALE * x)."""
    for batch in batches:
        rows = []
        for i, label, v in zip(batch.column("vec_id").to_pylist(), batch.column("label").to_pylist(), batch.column("embedding")):
            if i is None or label is None or not v.is_valid or v.values.null_count:
                continue
            x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if np.isfinite(x).all():
                x = np.floor(SCALE * x)
                rows.append((i, label, len(x), *([*x[:2], 0.0, 0.0][:2]), x.tobytes()))
        columns = list(zip(*rows)) or [()] * 6
        types = (pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [f.split()[0] for f in _ROWS.split(", ")])


def tile_order(matrix: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Sort-tile-recursive order of the rows on the two widest components."""
    n = len(matrix)
    if n <= leaf or not matrix.shape[1]:
        return np.arange(n)
    wide = np.argsort(matrix.min(0) - matrix.max(0), kind="stable")[:2]
    slabs = int(np.ceil(np.sqrt(-(-n // leaf))))
    slab = np.empty(n, np.int64)
    slab[np.argsort(matrix[:, wide[0]], kind="stable")] = np.arange(n) // (-(-n // (slabs * leaf)) * leaf)
    return np.lexsort((matrix[:, wide[-1]], slab))


def levels(n: int) -> list[int]:
    """Nodes of each level of a tree of n rows, leaves first."""
    out = [max(1, -(-n // LEAF))]
    while out[-1] > 1:
        out.append(-(-out[-1] // FANOUT))
    return out


def boxes_of(matrix: np.ndarray) -> np.ndarray:
    """Highest, then lowest components of every node, level after level (nodes x twice the dimension)."""
    high = np.maximum.reduceat(matrix, np.arange(0, len(matrix), LEAF))
    low = np.minimum.reduceat(matrix, np.arange(0, len(matrix), LEAF))
    out = [np.concatenate([high, low], 1)]
    while len(high) > 1:
        at = np.arange(0, len(high), FANOUT)
        high, low = np.maximum.reduceat(high, at), np.minimum.reduceat(low, at)
        out.append(np.concatenate([high, low], 1))
    return np.concatenate(out)


def _packed(size: int, tree: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of up to ``size`` consecutive rows of one label and dimension."""
    place = TaskContext.get().partitionId() << 32
    held: list[tuple[int, bytes]] = []
    key: tuple[int, int] | None = None

    def block() -> pa.RecordBatch:
        nonlocal place, held
        place += 1
        label, dims = key
        ids = np.array([i for i, _ in held], np.int64)
        matrix = np.frombuffer(b"".join(v for _, v in held), np.float64).reshape(len(held), dims)
        held = []
        boxes = b""
        if tree:
            order = tile_order(matrix)
            ids, matrix = ids[order], matrix[order]
            boxes = boxes_of(matrix).tobytes()
        row = [place, dims, label, len(ids), ids.tobytes(), matrix.tobytes(), boxes]
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], [f.split()[0] for f in _BLOCKS.split(", ")])

    for batch in batches:
        for i, label, dims, v in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "label", "dims", "v"))):
            if held and ((label, dims) != key or len(held) == size):
                yield block()
            key = (label, dims)
            held.append((i, v))
    if held:
        yield block()


def pack(rows: DataFrame, size: int, tree: bool) -> DataFrame:
    """Tiles of ``rows`` (_ROWS and a unique ``row``): slabs of one or few labels by range, sorted by the next component."""
    slabs = max(1, -(-rows.count() // (2 * TILE)))
    sorted_rows = rows.repartitionByRange(slabs, "label", "dims", "c0", "row").sortWithinPartitions("label", "dims", "c1", "row")
    return sorted_rows.select("vec_id", "label", "dims", "v").mapInArrow(lambda x: _packed(size, tree, x), _BLOCKS)


class Tree:
    def __init__(self, row: dict, whole: bool) -> None:
        dims = row["dims"]
        self.label = row["label"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.rows = np.frombuffer(row["matrix"], np.float64).reshape(row["n"], dims)
        self.sizes = levels(row["n"])
        self.boxes = np.frombuffer(row["boxes"], np.float64).reshape(sum(self.sizes), 2 * dims)
        if whole:
            self.rows, self.boxes = _whole(self.rows), _whole(self.boxes)
        self.first = np.concatenate([[0], np.cumsum(self.sizes)]).tolist()


def _whole(x: np.ndarray) -> np.ndarray:
    """Python integers: for products that doubles can't hold exactly."""
    return np.vectorize(int, otypes=[object])(x) if x.size else x.astype(object)


def best_first(forest: list[Tree], anchor: np.ndarray, own: int, low: np.ndarray, high: np.ndarray, k: int) -> list[list[tuple]]:
    """The k best (score, id) of each score window [low, high], ties to smaller ids; rows of id ``own`` are left out."""
    up, down = np.maximum(anchor, 0), np.minimum(anchor, 0)
    ends = np.stack([np.concatenate([up, down]), np.concatenate([down, up])], 1)
    least = low.copy()  # no score below this can enter a window
    found: list[list[tuple]] = [[] for _ in low]
    queue: list[tuple] = []

    def push(t: int, level: int, begin: int, end: int) -> None:
        tree = forest[t]
        interval = tree.boxes[tree.first[level] + begin : tree.first[level] + end] @ ends
        open_ = ((interval[:, :1] >= least) & (interval[:, 1:] <= high)).any(1)
        for j in np.flatnonzero(open_):
            heapq.heappush(queue, (-interval[j, 0], t, level, begin + int(j), interval[j, 1]))

    for t, tree in enumerate(forest):
        push(t, len(tree.sizes) - 1, 0, 1)
    while queue:
        top, t, level, i, bottom = heapq.heappop(queue)
        open_ = (least <= -top) & (bottom <= high)
        if not open_.any():
            if -top < least.min():
                break
            continue
        if level:
            push(t, level - 1, i * FANOUT, min((i + 1) * FANOUT, forest[t].sizes[level - 1]))
            continue
        tree = forest[t]
        score = tree.rows[i * LEAF : (i + 1) * LEAF] @ anchor
        ids = tree.ids[i * LEAF : (i + 1) * LEAF]
        best = score.max()
        for w in np.flatnonzero(open_ & (least <= best)):
            for j in np.flatnonzero((score >= least[w]) & (score <= high[w]) & (ids != own)):
                entry = (score[j], -int(ids[j]))
                if len(found[w]) < k:
                    heapq.heappush(found[w], entry)
                elif entry > found[w][0]:
                    heapq.heapreplace(found[w], entry)
            if len(found[w]) == k:
                least[w] = max(least[w], found[w][0][0])
    return [[(s, -i) for s, i in sorted(f, reverse=True)] for f in found]


def _search(k: int, negatives: bool, trees: pa.Table, anchors: pa.Table) -> pa.Table:
    """One cell: the k best of its trees for each anchor, in each of its windows if it has some."""
    out: list[tuple] = []
    trees_, anchors_ = trees.to_pylist(), anchors.to_pylist()
    if trees_ and anchors_:
        dims = trees_[0]["dims"]
        most = [max((np.abs(np.frombuffer(r["matrix"], np.float64)).max(initial=0) for r in side)) for side in (trees_, anchors_)]
        whole = most[0] * most[1] * dims >= 2.0**53
        forest = [Tree(r, whole) for r in trees_]
        for row in anchors_:
            own = [t for t in forest if (t.label != row["label"]) == negatives]
            ids = np.frombuffer(row["ids"], np.int64)
            matrix = np.frombuffer(row["matrix"], np.float64).reshape(row["n"], dims)
            matrix = _whole(matrix) if whole else matrix
            asked: dict[int, list[tuple]] = {}
            for w in row.get("windows") or []:
                asked.setdefault(w["at"], []).append((w["low"], w["high"], w["rank"]))
            for i in range(len(ids)) if own else ():
                windows = asked.get(i, []) if negatives else [(-np.inf, np.inf, 0)]
                if not windows:
                    continue
                low, high = (np.array([w[c] for w in windows], object if whole else float) for c in (0, 1))
                for (_, _, rank), best in zip(windows, best_first(own, matrix[i], ids[i], low, high, k)):
                    out += [(row["place"], i, rank, v, int(s)) for s, v in best]
    columns = list(zip(*out)) or [()] * 5
    types = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=[f.split()[0] for f in _FOUND.split(", ")])


def _cells(trees: DataFrame, anchors: DataFrame, keys: list[str], n_trees: int, n_blocks: int, k: int, negatives: bool) -> DataFrame:
    """Search of every cell; the cells of a key are enough to hold its trees and anchors within bounds."""
    busy = int(trees.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    across = max(1, -(-n_blocks // (ANCHORS_PER_CELL // ANCHOR_BLOCK)))
    down = max(-(-n_trees // TREES_PER_CELL), min(n_trees, -(-busy // across)), 1)

    def dealt(name: str, n: int) -> Column:
        return F.pmod(F.xxhash64("place"), F.lit(n)).cast("int").alias(name)

    def every(name: str, n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)

    left = trees.select("*", dealt("t", down)).select("*", every("g", across))
    right = anchors.select("*", dealt("g", across)).select("*", every("t", down))
    keys = [*keys, "t", "g"]
    # a lambda of three arguments would also be handed the key
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(lambda x, y: _search(k, negatives, x, y), _FOUND)


def hard_negatives(
    spark: SparkSession, anchors: DataFrame, vectors: DataFrame, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Both tables have vec_id, label (a whole number) and embedding. An anchor's positives are the best other rows of its
    label; the negatives of each are the best rows of other labels with
    least * positive_score <= 100 * negative_score <= most * positive_score. Scores are integer inner products of
    floor(SCALE * x); beyond 64 bits they are an error. Ties go to the smaller vec_id.

    Rows with a null id, label, vector or component, or a component that is not finite, take no part; vectors meet
    anchors of their own dimension only; rows under an anchor's own id are no partners of it. Repeated rows are rows of their own, as
    anchors too. Empty tables give no row; other columns are ignored.
    """
    prepare(spark)

    def rows(df: DataFrame, name: str) -> DataFrame:
        own = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
        return written(spark, own.mapInArrow(_valid, _ROWS).withColumn("row", F.monotonically_increasing_id()), name)

    trees = written(spark, pack(rows(vectors, "vectors"), TILE, True), "trees")
    asked = written(spark, pack(rows(anchors, "anchors"), ANCHOR_BLOCK, False).drop("boxes"), "anchor-blocks")
    size = trees.count(), asked.count()
    order = Window.partitionBy("anchor", "at", "rank").orderBy(F.desc("score"), "vec_id")

    def best(found: DataFrame, k: int) -> DataFrame:
        return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)

    near = best(_cells(trees, asked, ["dims", "label"], *size, positives, False), positives)
    near = written(spark, near.select("anchor", "at", F.col("place").alias("rank"), "vec_id", "score"), "positives")
    # whole numbers n with least * p <= 100 * n <= most * p; products may pass 64 bits
    hundredths = F.col("score").cast("decimal(20,0)")
    low = F.ceil(hundredths * least / F.lit(100).cast("decimal(3,0)")).cast("long")
    high = F.floor(hundredths * most / F.lit(100).cast("decimal(3,0)")).cast("long")
    windows = near.select("anchor", F.struct("at", "rank", low.alias("low"), high.alias("high")).alias("w")).where("w.low <= w.high")
    windows = windows.groupBy(F.col("anchor").alias("place")).agg(F.collect_list("w").alias("windows"))  # a block's own
    open_ = written(spark, asked.join(windows, "place"), "windows")
    far = best(_cells(trees, open_, ["dims"], *size, negatives, True), negatives)
    far = far.select("anchor", "at", "rank", F.col("place").alias("n"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    both = near.join(far, ["anchor", "at", "rank"]).join(_names(asked), ["anchor", "at"])
    return both.select(
        "anchor_id", F.col("vec_id").alias("positive_id"), F.col("n").alias("rank"), "negative_id",
        F.col("score").alias("positive_score"), "negative_score",
    )


def _names(asked: DataFrame) -> DataFrame:
    """anchor (block), at (place in it) and anchor_id."""

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, ids in zip(batch.column("place").to_pylist(), batch.column("ids").to_pylist()):
                ids = np.frombuffer(ids, np.int64)
                columns = [pa.array([place] * len(ids), pa.int64()), pa.array(np.arange(len(ids), dtype=np.int32)), pa.array(ids)]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "at", "anchor_id"])

    return asked.select("place", "ids").mapInArrow(names, "anchor long, at int, anchor_id long")


def negatives_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    vectors = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(spark, vectors.where(F.col("vec_id") % 100 == 0), vectors)


SQL = """
with v as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           [cast(floor(256 * cast(x as double)) as bigint) for x in embedding] as c
    from embeddings
    where embedding is not null and vec_id is not null and label is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
    select a.vec_id as anchor_id, v.vec_id as vec_id, a.label = v.label as same,
           cast(list_sum(list_transform(list_zip(a.c, v.c), lambda p: p[1] * p[2])) as bigint) as score
    from v a join v on a.vec_id % 100 = 0 and v.vec_id <> a.vec_id and len(v.c) = len(a.c)
), p as (
    select anchor_id, vec_id as positive_id, score as positive_score from s where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
), n as (
    select p.anchor_id, p.positive_id, s.vec_id as negative_id, p.positive_score, s.score as negative_score,
           row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) as rank
    from p join s on s.anchor_id = p.anchor_id and not s.same
     and 30 * cast(p.positive_score as hugeint) <= 100 * cast(s.score as hugeint)
     and 100 * cast(s.score as hugeint) <= 90 * cast(p.positive_score as hugeint)
)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from n where rank <= 10
"""
