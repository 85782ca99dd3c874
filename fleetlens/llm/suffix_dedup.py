"""Repeated substrings over whole corpora, resolved by merging Burrows-Wheeler transforms (operator 7).

A position is covered when a window of ``length`` bytes around it starts at two places. The
windows that can repeat at all are found first: the window starts of a document fall into runs
that share their smallest q-gram hash (the anchor), so equal windows lie in runs with equal
anchors, at equal distances from them. Only hashes travel: runs whose anchor occurs once end
here, runs whose whole span occurs twice are repeats as they are, and what is left is split
into shorter runs (cells of equal distance to the anchor), which are judged in the same way.
Every task then builds the transforms of its shards of remaining windows, as strings of byte
blocks, and merges them by interleave refinement; rows that the refinement never parts are
repeated windows, byte for byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import bwt
from fleetlens.llm.common import (
    BYTE_VALUES,
    KEY,
    POWERS,
    mix64,
    plain_names,
    row_key,
    rows_of,
    split_maybe,
    text_slices,
    with_key,
    without_rows,
    written,
)

#: Symbols (byte blocks) of a window in a transform.
SYMBOLS = 8
#: Starts of the shortest cells: in cells of one start the hashed core would be the whole window, and
#: nothing would be left to the transforms.
LEAST_CELL = 3
#: Windows of one shard's transform, and windows that one task merges on average.
SHARD_WINDOWS, TASK_WINDOWS = 4096, 60_000

RUN_FIELDS = "a long, f long, u boolean, k_id long, k_text long, p long, s long, e long"


def gram_size(length: int) -> int:
    return max(1, length * 4 // 25)


class Hashes:
    """Polynomial hashes of substrings of one buffer."""

    def __init__(self, data: np.ndarray):
        self.up, self.down = POWERS.get(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[data] * self.up[: len(data)], out=self.sums[1:])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix64((self.sums[b] - self.sums[a]) * self.down[a])


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    n = len(values)
    blocks = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[:n] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def _span_name(h: Hashes, p: np.ndarray, s: np.ndarray, e: np.ndarray, length: int) -> np.ndarray:
    """Name of the bytes that the windows starting at s..e cover, and where they lie around p."""
    place = mix64((p - s).astype(np.uint64) << np.uint64(32) ^ (e - s).astype(np.uint64))
    return mix64(h.of(s, e + length) ^ place)


def runs_of(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(row, anchor name, span name, p, s, e) of every run of window starts s..e with anchor at p."""
    q = gram_size(length)
    width = length - q + 1
    n = len(data)
    if n < length:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    h = Hashes(data)
    at = np.arange(n - q + 1)
    name = (h.sums[q:] - h.sums[: n - q + 1]) * h.down[: n - q + 1]
    name = mix64(name)
    # the leftmost of the smallest: the high half orders, the low half is the place
    order = (name & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    anchor = (_smallest(order, width) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    last = np.repeat(offsets[1:] - length, np.diff(offsets))[: len(anchor)]
    valid = np.arange(len(anchor)) <= last
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(anchor)]
    begins = valid.copy()
    begins[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    s = np.flatnonzero(begins)
    p = anchor[s]
    ends = valid.copy()
    ends[:-1] &= ~valid[1:] | (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    e = np.flatnonzero(ends)
    first = offsets[row[s]]
    return row[s], name[p].view(np.int64), _span_name(h, p, s, e, length).view(np.int64), p - first, s - first, e - first


def _batch(columns: list, schema: str) -> pa.RecordBatch:
    types = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.large_binary(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])


def _all_runs(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column("k_id").to_numpy(), batch.column("k_text").to_numpy()
        for first, _, data, offsets in text_slices(batch.column("text")):
            row, a, f, p, s, e = runs_of(data, offsets, length)
            row = row + first
            yield _batch([a, f, np.ones(len(a), bool), ids[row], texts[row], p, s, e], RUN_FIELDS)


def _split_runs(length: int, cell: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs listed with each text, cut where their distance to the anchor passes a multiple of ``cell``."""
    for batch in batches:
        out: list[list[np.ndarray]] = [[] for _ in range(8)]
        for i in range(batch.num_rows):
            data = np.frombuffer(batch.column("text")[i].as_py().encode(), np.uint8)
            runs = np.array([list(r.values()) for r in batch.column("runs")[i].as_py()], np.int64)
            a, u, p, s, e = runs.T
            h = Hashes(data)
            near, far = (p - e) // cell, (p - s) // cell
            count = far - near + 1
            own = np.repeat(np.arange(len(a)), count)
            g = near[own] + np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
            s2 = np.maximum(s[own], p[own] - (g + 1) * cell + 1)
            e2 = np.minimum(e[own], p[own] - g * cell)
            # what every window of the cell has in common, around the anchor
            core = h.of(p[own] - g * cell, p[own] - (g + 1) * cell + 1 + length)
            a2 = mix64(core ^ mix64(a[own].view(np.uint64) + g.astype(np.uint64)))
            f2 = _span_name(h, p[own], s2, e2, length)
            ids = np.full(len(own), batch.column("k_id")[i].as_py()), np.full(len(own), batch.column("k_text")[i].as_py())
            for to, c in zip(out, (a2.view(np.int64), f2.view(np.int64), u[own].astype(bool), *ids, p[own], s2, e2)):
                to.append(c)
        if out[0]:
            yield _batch([np.concatenate(c) for c in out], RUN_FIELDS)


WINDOW_FIELDS = "a long, u boolean, k_id long, k_text long, s long, window binary"


def _windows(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            data = batch.column("text")[i].as_py().encode()
            k_id, k_text = batch.column("k_id")[i].as_py(), batch.column("k_text")[i].as_py()
            rows = [
                (r["a"], bool(r["u"]), k_id, k_text, at, data[at : at + length])
                for r in batch.column("runs")[i].as_py()
                for at in range(r["s"], r["e"] + 1)
            ]
            for k in range(0, len(rows), 4096):
                yield _batch(list(zip(*rows[k : k + 4096])), WINDOW_FIELDS)


def _merged(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of one task that occur twice in it, by merging the transforms of its shards."""
    size = -(-length // SYMBOLS)
    kept, blocks = [], []
    for batch in batches:
        if not batch.num_rows:
            continue
        raw = np.frombuffer(b"".join(x.ljust(size * SYMBOLS, b"\0") for x in batch.column("window").to_pylist()), f"V{size}")
        blocks.append(raw.reshape(-1, SYMBOLS))
        kept.append(batch.select(["u", "k_id", "k_text", "s"]))
    if not kept:
        return
    table = pa.Table.from_batches(kept).combine_chunks()
    raw = np.concatenate(blocks)
    # symbols: the names of the blocks in their order, from 1 (0 is the sentinel)
    _, symbols = np.unique(raw.ravel(), return_inverse=True)
    symbols = (symbols.reshape(raw.shape) + 1).astype(np.uint32)
    shards = [bwt.build(symbols[i : i + SHARD_WINDOWS], i) for i in range(0, len(symbols), SHARD_WINDOWS)]
    again = bwt.repeated(*bwt.merge_all(shards))
    found = table.take(pa.array(again))
    found = found.filter(found.column("u"))
    for b in found.select(["k_id", "k_text", "s"]).to_batches():
        yield b


class _Search:
    def __init__(self, spark: SparkSession, docs: DataFrame, length: int):
        self.spark, self.docs, self.length = spark, docs, length
        self.found: list[DataFrame] = []

    def judge(self, runs: DataFrame, name: str) -> DataFrame:
        """Keeps the repeated spans among the unresolved runs of ``runs``; returns what is still open:
        one run per distinct span of every anchor with an open one (u: the run itself is open)."""
        spark = self.spark
        runs = written(spark, runs, f"{name}-runs")
        often = written(spark, runs.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a"), f"{name}-anchors")
        met = written(spark, runs.join(often, "a"), f"{name}-met")
        one = F.min(F.struct(*KEY, "p", "s", "e")).alias("one")
        spans = met.groupBy("a", "f").agg(F.count("*").alias("n"), F.max("u").alias("u"), one)
        spans = written(spark, spans.select("a", "f", "n", "u", "one.*"), f"{name}-spans")
        twice = spans.where("n > 1 and u").select("a", "f")
        self.found.append(written(spark, met.where("u").join(twice, ["a", "f"]).select(*KEY, "s", "e"), f"{name}-found"))
        open_ = spans.groupBy("a").agg(F.count("*").alias("spans"), F.max(F.expr("n = 1 and u")).alias("open"))
        open_ = written(spark, open_.where("spans > 1 and open").select("a"), f"{name}-open")
        left = spans.join(open_, "a").select("a", F.expr("cast(n = 1 and u as long)").alias("u"), *KEY, "p", "s", "e")
        return written(spark, left.groupBy(*KEY).agg(F.collect_list(F.struct("a", "u", "p", "s", "e")).alias("runs")), f"{name}-left")

    def texts(self, left: DataFrame) -> DataFrame:
        return rows_of(self.docs, left).select(*KEY, "text", "runs")

    def spans(self) -> DataFrame:
        """KEY and the repeated window ranges (s, e) of every document that has some."""
        length = self.length
        width = length - gram_size(length) + 1
        left = self.judge(self.docs.mapInArrow(lambda x: _all_runs(length, x), RUN_FIELDS), "whole")
        for cell in sorted({min(width, max(LEAST_CELL, width // k)) for k in (12, 112)}, reverse=True):
            split = self.texts(left).mapInArrow(lambda x, cell=cell: _split_runs(length, cell, x), RUN_FIELDS)
            left = self.judge(split, f"cell{cell}")
        windows = written(self.spark, self.texts(left).mapInArrow(lambda x: _windows(length, x), WINDOW_FIELDS), "windows")
        tasks = max(1, -(-windows.count() // TASK_WINDOWS))
        last = windows.repartition(tasks, "a").mapInArrow(lambda x: _merged(length, x), "k_id long, k_text long, s long")
        found = last.withColumn("e", F.col("s"))
        for f in self.found:
            found = found.unionByName(f)
        return written(
            self.spark, found.groupBy(*KEY).agg(F.collect_list(F.struct("s", "e")).alias("spans")), "spans"
        )


def covered(size: int, spans: list[dict], length: int) -> np.ndarray:
    """True for the bytes that the windows starting in the spans cover."""
    edges = np.zeros(size + 1, np.int64)
    at = np.array([(x["s"], x["e"] + length) for x in spans], np.int64).reshape(-1, 2)
    np.add.at(edges, at[:, 0], 1)
    np.add.at(edges, at[:, 1], -1)
    return np.cumsum(edges[:-1]) > 0


def whole_characters(data: np.ndarray, removed: np.ndarray) -> np.ndarray:
    """``removed`` less the bytes of characters that are only removed in part."""
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    if not len(starts):
        return removed
    full = np.logical_and.reduceat(removed, starts)
    return np.repeat(full, np.diff(np.append(starts, len(data))))


def repeated_spans(spark: SparkSession, docs: DataFrame, length: int) -> DataFrame:
    """KEY and spans (s, e): starts of the windows of ``length`` bytes that start twice in the corpus.

    Rows without such a window are not listed. Null and shorter texts have none; a text that
    repeats in another row, null ids and repeated rows included, repeats as a whole.
    """
    return _Search(spark, with_key(docs), length).spans()


_CUT_FIELDS = "k_id long, k_text long, n_removed long, n_spans long, kept_sha256 string"


def _cut(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for k_id, k_text, text, spans in zip(*(batch.column(c) for c in (*KEY, "text", "spans"))):
            data = np.frombuffer(text.as_py().encode(), np.uint8)
            gone = covered(len(data), spans.as_py(), length)
            starts = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
            rows.append((k_id.as_py(), k_text.as_py(), int(gone.sum()), starts, hashlib.sha256(data[~gone].tobytes()).hexdigest()))
        if rows:
            yield _batch(list(zip(*rows)), _CUT_FIELDS)


def _kept_text(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, spans in zip(batch.column("text"), batch.column("spans")):
            data = np.frombuffer(text.as_py().encode(), np.uint8)
            gone = whole_characters(data, covered(len(data), spans.as_py(), length))
            texts.append(data[~gone].tobytes().decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column("k_id"), batch.column("k_text"), pa.array(texts, pa.string())], [*KEY, "kept_text"]
        )


def suffix_dedup(spark: SparkSession, docs: DataFrame, length: int = 400) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Every byte covered by a string of ``length`` bytes that also starts elsewhere is removed,
    all its occurrences included, judged on the input. Null is empty; ids may repeat or be
    null; an empty table gives no row; other columns are ignored.
    """
    keyed = with_key(docs)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    facts = keyed.select("doc_id", *KEY, F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("whole_sha256"))
    facts = written(spark, facts, "facts")
    spans = repeated_spans(spark, docs, length)
    cuts = rows_of(keyed, spans).select(*KEY, "text", "spans").mapInArrow(lambda x: _cut(length, x), _CUT_FIELDS)
    cuts = written(spark, cuts.dropDuplicates(KEY), "cuts")
    return facts.join(cuts, KEY, "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
    )


def suffix_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))


def cut_repeats(spark: SparkSession, docs: DataFrame, length: int = 200) -> DataFrame:
    """``docs`` with all columns, its texts without their repeated substrings of ``length`` bytes
    (characters that are repeated only in part stay); no row goes."""
    spans = repeated_spans(spark, docs, length)
    keyed = with_key(docs)
    cuts = rows_of(keyed, spans).select(*KEY, "text", "spans").mapInArrow(
        lambda x: _kept_text(length, x), "k_id long, k_text long, kept_text string"
    )
    cuts = written(spark, cuts.dropDuplicates(KEY), "cuts")
    plain = plain_names(docs)
    hit, others = split_maybe(plain.select("*", *row_key()), cuts)
    new = [F.coalesce("kept_text", "text").alias("text") if c == "text" else F.col(c) for c in plain.columns]
    return others.select(*plain.columns).unionByName(hit.join(cuts, KEY, "left").select(*new)).toDF(*docs.columns)


SQL = """
with bytes as (
    select doc_id, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, ''))) as n from documents
), windows as (
    select doc_id, i, md5(substr(h, 2 * i + 1, 800)) as w from (select *, unnest(generate_series(0, n - 400)) as i from bytes)
), again as (
    select doc_id, i from (select doc_id, i, count(*) over (partition by w) as c from windows) where c > 1
), marked as (
    select doc_id, i, coalesce(i - lag(i) over (partition by doc_id order by i) > 400, true) as opens from again
), numbered as (
    select doc_id, i, sum(opens::int) over (partition by doc_id order by i) as k from marked
), runs as (
    select doc_id, k, min(i) as a, max(i) + 400 as b from numbered group by all
), gaps as (
    select doc_id, a, b, lag(b, 1, 0) over (partition by doc_id order by a) as before from runs
), cut as (
    select doc_id, sum(b - a) as n_removed, count(*) as n_spans,
           string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' order by a) || substr(any_value(h), 2 * max(b) + 1) as kept
    from gaps join bytes using (doc_id) group by doc_id
)
select doc_id, n as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(unhex(coalesce(kept, h))) as kept_sha256
from bytes left join cut using (doc_id)
"""
