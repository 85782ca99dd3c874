"""Helpers shared by the operators: row keys, subset joins, written tables, text buffers."""

from __future__ import annotations

import contextlib
import ctypes
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.session import checkpoint_dir

#: Upper bound of the bit table that `maybe_in` broadcasts (2**25 bits in 64-bit words: 8 MB of rows).
BLOOM_MAX_BITS = 1 << 25

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


#: Environment of the Python workers: large numpy and Arrow buffers go back to the system when they are
#: freed, so that a reused worker does not keep the peak of every task it has run.
WORKER_ENV = {"MALLOC_ARENA_MAX": "2", "MALLOC_MMAP_THRESHOLD_": "1048576", "ARROW_DEFAULT_MEMORY_POOL": "system"}


def prepare(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver did, whatever its working
    folder, under WORKER_ENV. Called before an operator makes its first Python function."""
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if home not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [home, env.get("PYTHONPATH")]))
    for name, value in WORKER_ENV.items():
        env.setdefault(name, value)


@contextlib.contextmanager
def reused_memory() -> Iterator[None]:
    """Within a task of many large numpy steps: freed buffers are kept for the next step (each new one would be
    mapped page by page), and go back to the system at the end. Where the C library has no such setting, nothing."""
    libc = ctypes.CDLL(None)
    if not hasattr(libc, "mallopt") or not hasattr(libc, "malloc_trim"):
        yield
        return
    mapped_from, trimmed_from = -3, -1  # M_MMAP_THRESHOLD, M_TRIM_THRESHOLD of <malloc.h>
    libc.mallopt(mapped_from, 1 << 27)
    libc.mallopt(trimmed_from, 1 << 28)
    try:
        yield
    finally:
        libc.mallopt(mapped_from, int(WORKER_ENV["MALLOC_MMAP_THRESHOLD_"]))
        libc.mallopt(trimmed_from, int(WORKER_ENV["MALLOC_MMAP_THRESHOLD_"]))
        libc.malloc_trim(0)


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in a new folder of the shared checkpoint directory and read back.

    Cuts the lineage: after the loss of an executor later stages read the table again.
    """
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Identity of a row for joins back to its text: (id or a stand-in for null, null flag, text hash).

    Rows that repeat an id and a text are the same row to every operator, with the same result.
    """
    return [
        F.coalesce(F.col(doc_id).cast("long"), F.lit(0)).alias("k_id"),
        F.xxhash64(F.col(doc_id).isNull(), F.col(text)).alias("k_text"),
    ]


KEY = ["k_id", "k_text"]


def with_key(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text (as they are), any further named columns, and the row key; other columns go."""
    prepare(docs.sparkSession)
    return docs.select("doc_id", "text", *more, *row_key())


def _bit(bits: int) -> Column:
    return F.pmod(F.xxhash64("k_id", "k_text", F.lit(7)), F.lit(bits))


def _bit_words(keys: DataFrame) -> tuple[DataFrame, int]:
    n = keys.count()
    bits = 1 << 10
    while bits < min(16 * n, BLOOM_MAX_BITS):
        bits *= 2
    words = (
        keys.select(_bit(bits).alias("k_bit"))
        .groupBy(F.expr("k_bit div 64").alias("k_word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(k_bit % 64 as int))")).alias("k_bits"))
    )
    return words, bits


def split_maybe(docs: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that may be in ``keys``, rows that surely are not), by a one-hash bit table over KEY.

    The table is broadcast; it has at most BLOOM_MAX_BITS bits whatever the size of ``keys``
    (a fuller table only lets more rows through to the exact join). No text is shuffled here.
    """
    words, bits = _bit_words(keys.select(*KEY))
    marked = (
        docs.withColumn("k_bit", _bit(bits))
        .withColumn("k_word", F.expr("k_bit div 64"))
        .join(F.broadcast(words), "k_word", "left")
        .withColumn("k_hit", F.expr("coalesce(shiftright(k_bits, cast(k_bit % 64 as int)) & 1, 0) = 1"))
        .drop("k_word", "k_bits", "k_bit")
    )
    return marked.where("k_hit").drop("k_hit"), marked.where("not k_hit").drop("k_hit")


def rows_of(docs: DataFrame, info: DataFrame) -> DataFrame:
    """Rows of ``docs`` joined to ``info`` on KEY; only rows that may match are shuffled."""
    maybe, _ = split_maybe(docs, info)
    return maybe.join(info, KEY, "inner")


def plain_names(docs: DataFrame) -> DataFrame:
    """``docs`` with every column but doc_id and text renamed by its place, so that no name clashes
    with an operator's own; ``.toDF(*docs.columns)`` restores them."""
    return docs.toDF(*[c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(docs.columns)])


def without_rows(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` (any columns, with doc_id and text) less the rows whose KEY is in ``dropped``."""
    plain = plain_names(docs)
    maybe, others = split_maybe(plain.select("*", *row_key()), dropped)
    left = maybe.join(dropped.select(*KEY).distinct(), KEY, "left_anti")
    return others.select(*plain.columns).unionByName(left.select(*plain.columns)).toDF(*docs.columns)


def one_per_group(spark: SparkSession, docs: DataFrame, judged: DataFrame, apart: Column | None = None) -> DataFrame:
    """One row of ``docs`` (all columns) for each group of ``judged`` (KEY, group, kept; one row per row of docs).

    Among the kept rows of a group the smallest KEY stays, and of the rows that share it the one whose
    columns come first as JSON. Rows without a group stay as they are; ``apart`` must be true for their rows
    of ``docs``. No step brings a group, or the rows of one KEY, together but by aggregates with partial results.
    """
    keys = judged.where("group is not null").groupBy(*KEY, "group", "kept").agg(F.count("*").alias("n"))
    keys = written(spark, keys, "group-keys")
    stay = keys.where("kept").groupBy("group").agg(F.min(F.struct(*KEY)).alias("k")).select("k.*")
    dropped = written(spark, keys.select(*KEY).join(stay, KEY, "left_anti"), "dropped")
    again = written(spark, keys.where("n > 1").select(*KEY), "repeated-rows")
    if not again.isEmpty():
        plain = plain_names(docs)
        maybe, others = split_maybe(plain.select("*", *row_key()), again)
        # a row to be left apart is a group of its own
        own = F.monotonically_increasing_id()
        maybe = maybe.withColumn("k_apart", F.lit(0).cast("long") if apart is None else F.when(apart, own).otherwise(-1))
        row = F.struct(*plain.columns)
        one = maybe.groupBy(*KEY, "k_apart").agg(F.min_by(row, F.to_json(row)).alias("k_row")).select("k_row.*")
        docs = others.select(*plain.columns).unionByName(one).toDF(*docs.columns)
    return without_rows(docs, dropped)


def text_slices(column: pa.Array | pa.ChunkedArray, max_bytes: int = 1 << 19) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, bytes, row offsets) of consecutive row ranges of a string column.

    A range holds about ``max_bytes`` of UTF-8, or one longer row. Null rows are empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64, count=column.offset + n + 1)[column.offset :]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + max_bytes, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b - a, raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finisher (xor-shift and odd multipliers)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


_RNG = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)


class _Powers:
    """Powers of the base modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(_BASE, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(_BASE_INV, k, 1 << 64))])
        return self.up[:n], self.down[:n]


POWERS = _Powers()
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_WORD_VALUES = np.where(_IS_SPACE, np.uint64(0), BYTE_VALUES)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32


def words_of(data: np.ndarray, offsets: np.ndarray, fold_case: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word, words before each row): words are runs of bytes other than
    0x20 and 0x09-0x0D; a row's end also ends a word. ``fold_case`` lower-cases A-Z first."""
    rows = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64)
    if fold_case:
        data = _FOLD[data]
    word = ~_IS_SPACE[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[first] = word[first]
    starts = np.flatnonzero(begins)
    counts = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    up, down = POWERS.get(len(data) + 1)
    values = _WORD_VALUES[data]
    values *= up[: len(data)]
    hashes = np.add.reduceat(values, starts) * down[starts]
    return mix64(hashes), counts


_STEP = [int(x) | 1 for x in _RNG.integers(1, 1 << 63, 64, dtype=np.uint64)]


def ngrams_of(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive word hashes, rows ignored (len(words) - n + 1 values)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for j in range(n):
        out += words[j : j + len(out)] * np.uint64(_STEP[j])
        out ^= out >> np.uint64(29)
    return mix64(out)
