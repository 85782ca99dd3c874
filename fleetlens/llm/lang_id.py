"""Language identification: multinomial naive Bayes over hashed character n-grams (operator 9).

Training counts the n-grams of every labelled text in one pass: each task adds up its own
(language, bucket) counts, Spark sums them into a written table. The matrices of log
probabilities (BUCKETS x languages) are broadcast in blocks of at most BLOCK_LANGUAGES
languages, and texts are scored in numpy batches as sums of matrix rows over the n-grams they
hold; the best language and the sum of all scores are carried from block to block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from fleetlens.llm.common import plain_names, prepare, text_slices, written

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
#: A broadcast block holds at most so many languages: 64 x 2**15 floats, 8 MB; a pass over the texts
#: scores so many blocks.
BLOCK_LANGUAGES, PASS_BLOCKS = 64, 8
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def _code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased (Latin) code points of a buffer of UTF-8, and row offsets in them."""
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32).copy()
    upper = ((points >= 65) & (points <= 90)) | ((points >= 0xC0) & (points <= 0xDE) & (points != 0xD7))
    points[upper] += 32
    return points, before[offsets]


def grams(points: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: (bucket of the n-gram at each code point, whether it ends within its row)."""
    n = len(points)
    room = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(n)
    for order in ORDERS:
        h = np.full(max(0, n - order + 1), order * 0x27D4EB2F & 0xFFFFFFFF, np.uint32)
        for j in range(order):
            h = (h ^ points[j : j + len(h)]) * _MULTIPLIERS[j]
            h ^= h >> np.uint32(15)
        yield (h >> np.uint32(2)) % np.uint32(BUCKETS), room[: len(h)] >= order


@dataclass
class Block:
    """Up to BLOCK_LANGUAGES languages, in the order of the model."""

    languages: list[str]
    log_prob: np.ndarray  # BUCKETS x languages
    log_prior: np.ndarray


@dataclass
class Model:
    languages: list[str]  # the most frequent first, ties by name
    log_prior: np.ndarray
    counts: DataFrame | None = None  # written: lang, bucket, n
    smoothing: float = 0.5

    def block(self, first: int) -> Block:
        """The languages from place ``first`` on, with their matrix."""
        languages = self.languages[first : first + BLOCK_LANGUAGES]
        # at most BLOCK_LANGUAGES * BUCKETS rows
        own = self.counts.where(F.col("lang").isin(languages)).toArrow()
        places = pc.index_in(own.column("lang").combine_chunks(), pa.array(languages, pa.string())).to_numpy()
        counts = np.zeros((BUCKETS, len(languages)))
        counts[own.column("bucket").to_numpy(), places] = own.column("n").to_numpy()
        log_prob = np.log(counts + self.smoothing) - np.log(counts.sum(0) + self.smoothing * BUCKETS)
        return Block(languages, log_prob.astype(np.float32), self.log_prior[first : first + BLOCK_LANGUAGES])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, c in counts.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(c[at])],
                ["lang", "bucket", "n"],
            )
        counts.clear()

    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        for first, rows, data, offsets in text_slices(batch.column("text")):
            points, at = _code_points(data, offsets)
            names, code = np.unique(langs[first : first + rows].astype(str), return_inverse=True)
            code = np.repeat(code, np.diff(at))
            if len(names) > BLOCK_LANGUAGES:  # short texts of many languages
                own = [(code[: len(bucket)] * BUCKETS + bucket)[inside] for bucket, inside in grams(points, at)]
                cells, n = np.unique(np.concatenate(own), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[cells // BUCKETS], pa.string()), pa.array((cells % BUCKETS).astype(np.int32)), pa.array(n)],
                    ["lang", "bucket", "n"],
                )
                continue
            total = np.zeros(len(names) * BUCKETS, np.int64)
            for bucket, inside in grams(points, at):
                total += np.bincount((code[: len(bucket)] * BUCKETS + bucket)[inside], minlength=len(total))
            for i, name in enumerate(names):
                own = total[i * BUCKETS : (i + 1) * BUCKETS]
                counts[name] = counts[name] + own if name in counts else own
            if len(counts) > BLOCK_LANGUAGES:
                yield from flush()
    yield from flush()


def train(labelled: DataFrame, smoothing: float = 0.5) -> Model:
    """The model of all rows of ``labelled`` (text, lang) with both present; every text counts whole.

    Every label is learned, however many there are: the counts stay a written table, of which the
    driver reads one block of languages at a time (it holds all labels, but no other per-label
    data). Without any labelled row the model has no language.
    """
    spark = labelled.sparkSession
    prepare(spark)
    rows = labelled.select("text", "lang").where("text is not null and lang is not null")
    labels = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    if not labels:
        return Model([], np.zeros(0))
    counted = (
        rows.mapInArrow(_counted, "lang string, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    docs = np.array([r["count"] for r in labels], float)
    return Model([r["lang"] for r in labels], np.log(docs / docs.sum()), written(spark, counted, "languages"), smoothing)


def _scored(blocks: list[Block], column: pa.Array, names: list, top: np.ndarray, total: np.ndarray) -> None:
    """Takes ``blocks`` into what earlier ones gave each text: the best language (``names``), its log
    score (``top``) and the sum of all scores as a multiple of the best one (``total``)."""
    for first, rows, data, offsets in text_slices(column):
        points, at = _code_points(data, offsets)
        row = np.repeat(np.arange(rows), np.diff(at))
        found = [(bucket[inside], row[: len(bucket)][inside]) for bucket, inside in grams(points, at)]
        for block in blocks:
            scores = np.tile(block.log_prior, (rows, 1))
            for bucket, own in found:
                for j in range(len(block.languages)):
                    scores[:, j] += np.bincount(own, block.log_prob[bucket, j], rows)
            best = scores.argmax(1)
            new = scores.max(1)
            old = top[first : first + rows]
            both = np.maximum(old, new)
            own_total = np.exp(scores - new[:, None]).sum(1)
            total[first : first + rows] = total[first : first + rows] * np.exp(old - both) + own_total * np.exp(new - both)
            for i in np.flatnonzero(new > old):  # ties stay with the more frequent language
                names[first + i] = block.languages[best[i]]
            top[first : first + rows] = both


def identify(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1) added, or replaced where it has such columns.

    A null text, one without a letter, and every text of a model without languages are
    ``und`` with score 0. Ties go to the more frequent language. Ids may repeat or be null.
    The blocks of a model of more than PASS_BLOCKS * BLOCK_LANGUAGES languages are scored in
    several passes, between which ``docs`` is written with the best language so far.
    """
    prepare(spark)
    docs = docs.select(*[c for c in docs.columns if c not in ("lang_pred", "score")])
    fields = docs.schema.fields
    state = [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("k_total", DoubleType())]
    step = PASS_BLOCKS * BLOCK_LANGUAGES
    passes = range(0, max(1, len(model.languages)), step)

    def scorer(shared: list[Broadcast], begins: bool, ends: bool) -> Callable:
        def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                text, n = batch.column("text"), batch.num_rows
                if begins:
                    names, top, total = [UNDETERMINED] * n, np.full(n, -np.inf), np.zeros(n)
                else:
                    names = batch.column(len(fields)).to_pylist()
                    top, total = (batch.column(len(fields) + k).to_numpy().copy() for k in (1, 2))
                _scored([x.value for x in shared], text, names, top, total)
                out = [*batch.columns[: len(fields)]]
                if ends:
                    known = np.array([t is not None and bool(_LETTER.search(t)) for t in text.to_pylist()], bool) & (total > 0)
                    names = [x if k else UNDETERMINED for x, k in zip(names, known)]
                    out += [pa.array(names, pa.string()), pa.array(np.where(known, 1 / np.where(known, total, 1), 0.0))]
                else:
                    out += [pa.array(names, pa.string()), pa.array(top), pa.array(total)]
                yield pa.RecordBatch.from_arrays(out, [*batch.schema.names[: len(fields)], *[f.name for f in state[: 2 if ends else 3]]])

        return scored

    for at in passes:
        ends = at == passes[-1]
        shared = [
            spark.sparkContext.broadcast(model.block(first))
            for first in range(at, min(at + step, len(model.languages)), BLOCK_LANGUAGES)
        ]
        schema = StructType([*fields, *state[: 2 if ends else 3]])
        docs = docs.mapInArrow(scorer(shared, at == 0, ends), schema)
        if not ends:
            docs = written(spark, docs, "scored")
            for x in shared:
                x.destroy()
    return docs


def held_out() -> Column:
    """Rows kept from training: crc32 of the id as text is 2 modulo 4 (a null id is not held out)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def train_on(docs: DataFrame) -> Model:
    return train(docs.where(~held_out()))


def lang_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train_on(docs)
    return identify(spark, docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score"
    )


def _lettered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array([t is not None and bool(_LETTER.search(t)) for t in batch.column("text").to_pylist()], pa.bool_()))


def drop_undetermined(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents whose language could be told, with all their columns; where no row has a label
    to learn from, those with a letter."""
    model = train_on(docs)
    plain = plain_names(docs)  # the table may have columns called lang_pred or score
    if not model.languages:
        return plain.mapInArrow(_lettered, plain.schema).toDF(*docs.columns)
    return identify(spark, plain, model).where(F.col("lang_pred") != UNDETERMINED).drop("lang_pred", "score").toDF(*docs.columns)
