"""Exact top-k by inner product with a three-phase uniform threshold (operator 8).

A score is the sum of the partial scores of SLICES dimension slices. Phase 1: every cell of
vectors lists its best entries of each slice for each query; the k-th best total among them is
a safe cutoff for the query. Phase 2: a vector whose total reaches the cutoff has a slice that
reaches cutoff / SLICES, so only entries above this uniform threshold are collected, less those
whose upper bound stays below the cutoff. Phase 3: their totals are resolved exactly.

Blocks of vectors meet blocks of queries in cogrouped cells of bounded size (`_cells`). How often a
block is copied follows the bytes of the two tables, not the number of shuffle partitions, and no copy
goes through the driver: the joins here that Spark may broadcast have a row for each number of dimensions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import prepare, reused_memory, written

SLICES = 4
BLOCK_VECTORS, BLOCK_QUERIES = 4096, 512
SCALE = 1024
#: Bytes of vectors and of queries that a cell holds, about.
CELL_VECTORS, CELL_QUERIES = 1 << 25, 1 << 23
#: Copies of the queries that are allowed even where they outweigh the vectors.
COPIES = 32
#: Partitions that cells are dealt to, at most.
MAX_PARTITIONS = 10_000

BLOCK_FIELDS = "dims int, ids binary, matrix binary, n int, width int, place long"
CELL = ["dims", "v_cell", "q_cell"]


def valid(column: pa.Array) -> list[np.ndarray | None]:
    """floor(SCALE * x) of every vector, as doubles; None for null vectors and null or non-finite components."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy()
    x = column.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy(zero_copy_only=False).astype(np.float64)
    offsets = offsets - offsets[0]
    finite = np.isfinite(x)
    odd = np.concatenate([[0], np.cumsum(~finite)])[offsets]
    whole = column.is_valid().to_numpy(zero_copy_only=False) & (odd[1:] == odd[:-1])
    x = np.floor(SCALE * x, where=finite, out=x)
    return [x[a:b].copy() if ok else None for a, b, ok in zip(offsets[:-1].tolist(), offsets[1:].tolist(), whole.tolist())]


def _packed(matrix: np.ndarray) -> np.ndarray:
    """``matrix`` in the smallest of int16, int32 and double that holds its integers."""
    most = np.abs(matrix).max(initial=0)
    return matrix.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.float64)


def _blocks(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of up to ``size`` vectors of one dimension."""
    held: dict[int, list[tuple[int, np.ndarray]]] = {}
    place = TaskContext.get().partitionId() << 32

    def row(dims: int) -> pa.RecordBatch:
        nonlocal place
        part = held.pop(dims)
        place += 1
        matrix = _packed(np.concatenate([v for _, v in part]))
        return pa.RecordBatch.from_arrays(
            [pa.array([dims], pa.int32()), pa.array([np.array([i for i, _ in part], np.int64).tobytes()], pa.binary()),
             pa.array([matrix.tobytes()], pa.binary()), pa.array([len(part)], pa.int32()), pa.array([matrix.itemsize], pa.int32()),
             pa.array([place], pa.int64())],
            [f.split()[0] for f in BLOCK_FIELDS.split(", ")],
        )

    for batch in batches:
        for i, v in zip(batch.column("vec_id").to_pylist(), valid(batch.column("embedding"))):
            if i is None or v is None:
                continue
            held.setdefault(len(v), []).append((i, v))
            if len(held[len(v)]) == size:
                yield row(len(v))
    for dims in list(held):
        yield row(dims)


class _Block:
    """A row of BLOCK_FIELDS: ids, whole-numbered vectors, and a bound of their lengths."""

    def __init__(self, table: pa.Table, i: int) -> None:
        get = lambda name: table.column(name)[i]
        n, dims, width = (get(name).as_py() for name in ("n", "dims", "width"))
        self.ids = np.frombuffer(get("ids").as_buffer(), np.int64)
        self.matrix = np.frombuffer(get("matrix").as_buffer(), {2: np.int16, 4: np.int32, 8: np.float64}[width]).reshape(n, dims)
        self.order = np.argsort(self.ids, kind="stable")
        with np.errstate(over="ignore"):
            self.length = 1.001 * np.sqrt(np.square(self.matrix, dtype=np.float64).sum(axis=1).max())


def _kind(queries: _Block, vectors: _Block) -> type:
    """The type in which sums of products, and SLICES of them, are exact: no sum passes the product of the lengths."""
    with np.errstate(over="ignore", invalid="ignore"):
        most = queries.length * vectors.length * SLICES
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object


def _as(kind: type, matrix: np.ndarray) -> np.ndarray:
    return np.vectorize(int, otypes=[object])(matrix) if kind is object and matrix.size else matrix.astype(kind)


def _slices(dims: int) -> list[slice]:
    edges = np.linspace(0, dims, min(SLICES, max(1, dims)) + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:])]


def _parts(queries: _Block, vectors: _Block) -> list[np.ndarray]:
    """Exact scores of each slice, a row for each query; -inf where a query meets its own id."""
    kind = _kind(queries, vectors)
    q, v = _as(kind, queries.matrix), _as(kind, vectors.matrix)
    out = [q[:, s] @ v[:, s].T if q.shape[1] else np.zeros((len(q), len(v)), kind) for s in _slices(q.shape[1])]
    ids = vectors.ids[vectors.order]
    first, last = np.searchsorted(ids, queries.ids, "left"), np.searchsorted(ids, queries.ids, "right")
    for j in np.flatnonzero(first < last):
        for part in out:
            part[j, vectors.order[first[j] : last[j]]] = -np.inf
    return out


def _hits(part: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and place in the flat ``part`` of all that reaches its row's value of ``low`` (rounding to a part's type is monotone)."""
    rows, n = part.shape
    reached = (part >= low.astype(part.dtype)[:, None]).ravel()
    if reached.size % 8:
        flat = np.flatnonzero(reached)
    else:  # few places are hit, so eight are looked at at once
        some = np.flatnonzero(reached.view(np.uint64))
        flat = np.flatnonzero(reached.reshape(-1, 8)[some])
        flat = some[flat >> 3] * 8 + (flat & 7)
    return np.repeat(np.arange(rows), np.diff(np.searchsorted(flat, np.arange(rows + 1) * n))), flat


def best(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores of every row, ties to smaller ids."""
    order = np.lexsort((ids, -scores, rows))
    ranked = rows[order]
    return order[np.arange(len(order)) - np.searchsorted(ranked, ranked) < k]


class _List:
    """The best k entries of a slice for each query so far, with their totals and the places of their vectors."""

    def __init__(self, queries: int, k: int) -> None:
        self.k = k
        self.values, self.totals = np.full((queries, k), -np.inf), np.full((queries, k), -np.inf)
        self.places = np.full((queries, k), -1)

    def take(self, parts: list[np.ndarray], s: int, begin: int) -> None:
        part, k = parts[s], self.k
        n = part.shape[1]
        low = self.values.min(axis=1)
        if n >= k and (low == -np.inf).any():
            # k groups or more have a value each that reaches the k-th best of the groups' highest values
            highest = part
            while (half := highest.shape[1] // 2) >= 4 * k:
                highest = np.maximum(highest[:, :half], highest[:, half : 2 * half])
            low = np.maximum(low + 1, np.sort(highest, axis=1)[:, -k])
        else:
            low = low + 1
        row, flat = _hits(part, low)
        real = np.flatnonzero(np.take(part, flat) > -np.inf)
        if not len(real):
            return
        row, flat = row[real], flat[real]
        at = k + np.arange(len(row)) - np.searchsorted(row, row)
        found = [np.take(p, flat) for p in parts]

        def longer(held: np.ndarray, more: np.ndarray, none: float) -> np.ndarray:
            out = np.full((len(held), at.max() + 1), none, np.result_type(held, more))
            out[:, :k] = held
            out[row, at] = more
            return out

        values = longer(self.values, found[s], -np.inf)
        if values.dtype == object:
            top = np.argsort(-values, axis=1, kind="stable")[:, :k]
        else:
            top = np.argpartition(values, values.shape[1] - k, axis=1)[:, -k:]
        self.values = np.take_along_axis(values, top, 1)
        self.totals = np.take_along_axis(longer(self.totals, sum(found), -np.inf), top, 1)
        self.places = np.take_along_axis(longer(self.places, begin + flat - row * n, -1), top, 1)


def _phase1(k: int, queries: _Block, cutoffs: dict, cell: list[_Block]) -> tuple[np.ndarray, ...]:
    """The best k totals of each query among the vectors of a cell that lead a slice's list."""
    lists = [_List(len(queries.ids), k) for _ in _slices(queries.matrix.shape[1])]
    begin = 0
    for vectors in cell:
        parts = _parts(queries, vectors)
        for s, leaders in enumerate(lists):
            leaders.take(parts, s, begin)
        begin += len(vectors.ids)
    rows = np.repeat(np.arange(len(queries.ids)), k)
    rows, places, totals = (np.concatenate(x) for x in zip(*((rows, x.places.ravel(), x.totals.ravel()) for x in lists)))
    _, once = np.unique(rows * (begin + 1) + places, return_index=True)
    once = once[places[once] >= 0]
    rows, totals, ids = rows[once], totals[once], np.concatenate([x.ids for x in cell])[places[once]]
    top = best(rows, totals, ids, k)
    return rows[top], ids[top], totals[top]


def _phase23(k: int, queries: _Block, cutoffs: dict, cell: list[_Block]) -> tuple[np.ndarray, ...]:
    """Entries of a cell that reach the uniform threshold in a slice, with exact totals that reach the cutoff."""
    cutoff = [cutoffs.get(q) for q in queries.ids.tolist()]
    m = len(_slices(queries.matrix.shape[1]))
    # an integer part reaches cutoff / m if it reaches its ceiling
    tau, uniform = ([-np.inf if c is None else f(c) for c in cutoff] for f in (int, lambda c: -(-c // m)))
    rows, ids, totals = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    for vectors in cell:
        parts = _parts(queries, vectors)
        kind = np.result_type(parts[0], np.float64)
        least, reach = np.array(tau, kind), np.array(uniform, kind)
        highest = parts[0]
        for part in parts[1:]:
            highest = np.maximum(highest, part)
        row, flat = _hits(highest, reach)
        found = [np.take(part, flat) for part in parts]
        low, floor = (np.take(x.astype(highest.dtype), row) for x in (least, reach))
        near = np.flatnonzero(sum(np.maximum(x, floor) for x in found) >= low)
        total = sum(x[near] for x in found)
        keep = np.flatnonzero((total >= low[near]) & (total > -np.inf))
        near, total = near[keep], total[keep]
        if len(near):
            more = row[near], vectors.ids[flat[near] - row[near] * len(vectors.ids)], total
            rows, ids, totals = (np.concatenate(x) for x in zip((rows, ids, totals), more))
            top = best(rows, totals, ids, k)
            rows, ids, totals = rows[top], ids[top], totals[top]
    return rows, ids, totals


ENTRIES = "query_id long, vec_id long, score long"


def _cell(phase, k: int, vectors: pa.Table, queries: pa.Table) -> pa.Table:
    """Entries of ``phase`` for every query of a cell."""
    found = []
    if len(vectors) and len(queries):
        with reused_memory():
            cell = [_Block(vectors, i) for i in range(len(vectors))]
            for i in range(len(queries)):
                asked = _Block(queries, i)
                cutoffs = queries.column("cutoffs")[i].as_py() if "cutoffs" in queries.column_names else None
                rows, ids, scores = phase(k, asked, {c["query_id"]: c["cutoff"] for c in cutoffs or []}, cell)
                # beyond 64 bits an error
                scores = pa.array([int(x) for x in scores], pa.int64()) if scores.dtype == object else pa.array(scores.astype(np.int64))
                found.append(pa.table([pa.array(asked.ids[rows]), pa.array(ids), scores], ["query_id", "vec_id", "score"]))
    return pa.concat_tables(found) if found else pa.schema([(f.split()[0], pa.int64()) for f in ENTRIES.split(", ")]).empty_table()


def _cells(blocks: DataFrame, asked: DataFrame, partitions: int) -> DataFrame:
    """dims, v_cells, q_cells: into how many groups the blocks of vectors and of queries fall, for each number of dimensions.

    A group of vectors meets every group of queries. Groups are of bounded size; smaller ones, for the sake of
    parallel work, up to a cell for each partition and as far as the copies of the queries stay below the vectors (or COPIES).
    """
    size = F.sum(F.col("n").cast("long") * (F.col("dims") * F.col("width").cast("long") + 8))
    v = blocks.groupBy("dims").agg(size.alias("v_bytes"), F.count("*").alias("v_blocks"))
    q = asked.groupBy("dims").agg(size.alias("q_bytes"))
    return (
        v.join(q, "dims")
        .withColumn("q_cells", F.expr(f"1 + (q_bytes - 1) div {CELL_QUERIES}"))
        .withColumn("spread", F.expr(f"least(v_blocks, 1 + ({partitions} - 1) div q_cells, greatest(v_bytes div q_bytes, {COPIES}))"))
        .withColumn("v_cells", F.expr(f"greatest(1 + (v_bytes - 1) div {CELL_VECTORS}, spread)"))
        .select("dims", "v_cells", "q_cells")
    )


def top_k(spark: SparkSession, queries: DataFrame, vectors: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k best vectors of every query, its own id apart.

    Both tables have vec_id and embedding; components count as floor(SCALE * x), a score is
    their integer inner product (beyond 64 bits it is an error). Ties go to the smaller vec_id;
    a query with fewer candidates gets them all. Null ids, null vectors and vectors with a null or non-finite component take no
    part; vectors meet queries of their own dimension only; repeated rows are candidates of
    their own; empty tables give no row; other columns are ignored.
    """
    prepare(spark)
    blocks = written(
        spark, vectors.select("vec_id", "embedding").mapInArrow(lambda x: _blocks(BLOCK_VECTORS, x), BLOCK_FIELDS), "vectors"
    )
    asked = written(
        spark,
        queries.select("vec_id", "embedding").mapInArrow(lambda x: _blocks(BLOCK_QUERIES, x), BLOCK_FIELDS),
        "queries",
    )
    cells = written(spark, _cells(blocks, asked, int(spark.conf.get("spark.sql.shuffle.partitions"))), "cells")
    parts = min(cells.agg(F.sum(F.expr("v_cells * q_cells"))).first()[0] or 1, MAX_PARTITIONS)

    def met(phase, question: DataFrame) -> DataFrame:
        def dealt(table: DataFrame, own: str, other: str) -> DataFrame:
            table = table.join(cells, "dims").withColumn(f"{own}_cell", F.expr(f"pmod(xxhash64(place), {own}_cells)"))
            table = table.withColumn(f"{other}_cell", F.expr(f"explode(sequence(0L, {other}_cells - 1))"))
            return table.drop("v_cells", "q_cells", "place").repartition(parts, *CELL).groupBy(*CELL)

        return dealt(blocks, "v", "q").cogroup(dealt(question, "q", "v")).applyInArrow(lambda v, q: _cell(phase, k, v, q), ENTRIES)

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    first = met(_phase1, asked)
    cutoffs = first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k).select("query_id", F.col("score").alias("cutoff"))
    ids = written(spark, _named(asked), "asked")
    per_block = ids.join(cutoffs.hint("merge"), "query_id").groupBy("place").agg(F.collect_list(F.struct("query_id", "cutoff")).alias("cutoffs"))
    bounded = written(spark, asked.join(per_block.hint("merge"), "place", "left"), "cutoffs")
    last = met(_phase23, bounded)
    return last.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _named(asked: DataFrame) -> DataFrame:
    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, ids in zip(batch.column("place").to_pylist(), batch.column("ids").to_pylist()):
                ids = np.unique(np.frombuffer(ids, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array([place] * len(ids), pa.int64()), pa.array(ids)], ["place", "query_id"])

    return asked.select("place", "ids").mapInArrow(names, "place long, query_id long")


def topk_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(spark, vectors.where(F.col("vec_id") % 100 == 0), vectors)


SQL = """
with v as (
    select vec_id, [cast(floor(1024 * cast(x as double)) as bigint) for x in embedding] as c
    from embeddings
    where embedding is not null and vec_id is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
    select q.vec_id as query_id, v.vec_id as vec_id,
           cast(list_sum(list_transform(list_zip(q.c, v.c), lambda p: p[1] * p[2])) as bigint) as score
    from v q join v on q.vec_id % 100 = 0 and v.vec_id <> q.vec_id and len(v.c) = len(q.c)
), r as (
    select query_id, vec_id, score, row_number() over (partition by query_id order by score desc, vec_id) as rank from s
)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 10
"""
