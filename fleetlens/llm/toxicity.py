"""Toxicity scores by a bidirectional gated recurrent network (operator 11).

The network (gru.py) is trained in numpy on a bounded sample of labelled texts: first every
sampled window under the label of its text, then the highest window of each text alone, as a
text is toxic where one of its windows is. A logistic curve through the texts' highest logits,
weighted to the shares of all labelled rows, turns logits into scores. Every whole text is
scored over all its overlapping windows in Arrow batches; its score is the highest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import KEY, mix64, prepare, rows_of, text_slices, with_key, written
from fleetlens.llm.gru import Adam, Network, steps_of, windows_of, words_in
from fleetlens.llm.lang_id import held_out

#: Bounds of the sample that the network is fitted on: texts of each label (those of the smallest key
#: hashes), windows of a text (those of the smallest index hashes), bytes of a window.
POSITIVES, NEGATIVES, SAMPLE_WINDOWS, WINDOW_BYTES = 1024, 2048, 32, 4096
#: Words with a vector of their own occur in at least so many sampled texts; so many at most, the most frequent.
LEAST_TEXTS, VOCABULARY = 4, 8192
THRESHOLD = 0.3

_SAMPLED = "toxic int, k_id long, k_text long, windows array<string>"
_SCORED = "doc_id long, score double"


@dataclass
class Model:
    network: Network | None  # None: there was nothing to tell apart
    scale: float = 1.0
    shift: float = 0.0


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: list[list[bytes]] = []
        for _, rows, data, offsets in text_slices(batch.column("text")):
            words = words_in(data, offsets)
            text, first, n = windows_of(words.before)
            raw = data.tobytes()
            for i in range(rows):
                own = np.flatnonzero(text == i)
                begin, end = words.starts[first[own]], words.ends[first[own] + n[own] - 1]
                chosen = own[end - begin <= WINDOW_BYTES]
                chosen = chosen[np.argsort(mix64(np.arange(len(chosen), dtype=np.uint64) + np.uint64(1)), kind="stable")[:SAMPLE_WINDOWS]]
                found.append([raw[words.starts[first[w]] : words.ends[first[w] + n[w] - 1]] for w in chosen])
        windows = pa.array([[w.decode("utf-8", "replace") for w in ws] for ws in found], pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("toxic", *KEY)), windows], ["toxic", *KEY, "windows"])


def sample(spark: SparkSession, docs: DataFrame, labels: DataFrame, positives: int, negatives: int) -> tuple[list, dict[int, int]]:
    """(at most ``positives`` + ``negatives`` rows of label and windows, labelled texts of each label).

    A text under an id with several labels is toxic if one of them says so.
    """
    keyed = with_key(docs)
    told = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    known = keyed.where("doc_id is not null and text is not null").select("doc_id", *KEY).distinct()
    known = written(spark, known.join(told, "doc_id").select(*KEY, "toxic"), "toxic-labels")
    shares = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}  # two rows
    order = [F.xxhash64(*KEY, F.lit(11)), *KEY]
    parts = [known.where(F.col("toxic") == y).orderBy(*order).limit(n) for y, n in ((1, positives), (0, negatives))]
    chosen = written(spark, parts[0].unionByName(parts[1]), "toxic-sample")
    texts = rows_of(keyed, chosen).dropDuplicates(KEY).select("toxic", *KEY, "text")
    rows = texts.mapInArrow(_sampled, _SAMPLED).collect()  # bounded by the sample
    return sorted((r["k_id"], r["k_text"], r["toxic"], r["windows"]) for r in rows if r["windows"]), shares


def vocabulary(hashes: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """The words (hashes, ascending) that occur in LEAST_TEXTS texts; VOCABULARY of them at most."""
    if not len(hashes):
        return hashes
    order = np.lexsort((texts, hashes))
    h, t = hashes[order], texts[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (t[1:] != t[:-1])])
    words, n = np.unique(h[new], return_counts=True)
    words, n = words[n >= LEAST_TEXTS], n[n >= LEAST_TEXTS]
    return np.sort(words[np.lexsort((words, -n))[:VOCABULARY]])


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Scale and shift of a weighted logistic curve with a small ridge, by Newton's method."""
    a, b = 1.0, 0.0
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        e, w = weight * (q - y), weight * q * (1 - q) + 1e-9
        g = np.array([(e * x).sum() + 0.01 * (a - 1), e.sum()])
        h = np.array([[(w * x * x).sum() + 0.01, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(max(a, 0.0)), float(b)


def fit(rows: list[tuple], shares: dict[int, int], epochs: int = 4, rounds: int = 6, batch: int = 256, seed: int = 5) -> Model:
    """The model of sampled rows (.., label, windows), for labelled texts in the given shares."""
    labels = np.array([r[-2] for r in rows], np.int64)
    if len(set(labels.tolist())) < 2:
        return Model(None)
    texts = [w.encode() for r in rows for w in r[-1]]
    owner = np.repeat(np.arange(len(rows)), [len(r[-1]) for r in rows])
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    words = words_in(np.frombuffer(b"".join(texts), np.uint8), offsets)
    sizes = np.diff(words.before)
    net = Network(vocabulary(words.distinct[words.place], np.repeat(owner, sizes)), seed)
    gram_at = np.concatenate([[0], np.cumsum(words.sizes)])
    target = labels[owner].astype(np.float32)
    rng, adam = np.random.default_rng(seed), Adam(net.p, 0.01)

    def learn(at: np.ndarray, weight: np.ndarray) -> None:
        for a in range(0, len(at), batch):
            own = at[a : a + batch]
            ids, mask = steps_of(words.place, words.before[own], sizes[own])
            used, ids = np.unique(ids, return_inverse=True)
            ids = ids.reshape(mask.shape)
            grams = words.sizes[used]
            codes = words.codes[np.arange(grams.sum()) + np.repeat(gram_at[used] - np.cumsum(grams) + grams, grams)]
            inputs = net.inputs(words.distinct[used], codes, grams)
            kept: dict = {}
            slope = 1 / (1 + np.exp(-np.clip(net.forward(inputs, ids, mask, kept), -30, 30))) - target[own]
            slope = (slope * weight[own] / len(own)).astype(np.float32)
            adam.step(net.backward((words.distinct[used], codes, grams), inputs, ids, mask, kept, slope))

    def scored() -> np.ndarray:
        inputs = net.inputs(words.distinct, words.codes, words.sizes)
        out = np.empty(len(owner), np.float32)
        for a in range(0, len(out), 4096):
            ids, mask = steps_of(words.place, words.before[a:-1][:4096], sizes[a : a + 4096])
            out[a : a + 4096] = net.forward(inputs, ids, mask)
        return out

    # every window under its text's label, as many of either label
    up, down = np.flatnonzero(target == 1), np.flatnonzero(target == 0)
    even = np.ones(len(target), np.float32)
    for _ in range(epochs):
        n = min(len(up), len(down))
        at = np.concatenate([rng.permutation(up)[:n], rng.permutation(down)[:n]])
        learn(rng.permutation(at), even)
    # then the highest window of each text
    adam.rate = 0.004
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    for _ in range(rounds):
        order = np.lexsort((scored(), owner))
        learn(rng.permutation(order[np.append(first[1:], len(owner)) - 1]), even)
    top = np.maximum.reduceat(scored(), first).astype(np.float64)
    y = labels[owner[first]]
    weight = np.where(y == 1, shares.get(1, 1) / max(1, (y == 1).sum()), shares.get(0, 1) / max(1, (y == 0).sum()))
    return Model(net, *logistic(top, y.astype(float), weight / weight.mean()))


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES) -> Model:
    """A model of ``docs`` (doc_id, text) under ``labels`` (doc_id, toxic: 0 or 1). Where no text has a
    label, or all have the same one, it knows nothing and scores 0."""
    prepare(spark)
    return fit(*sample(spark, docs, labels, positives, negatives))


def toxicity(spark: SparkSession, docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, score (0 to 1, the highest over all overlapping windows) and
    predicted (1 if score >= threshold).

    A null text, an empty one and one without words have score 0. Ids may repeat or be null; an empty
    table gives no row; other columns are ignored.
    """
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            score = np.zeros(batch.num_rows)
            if own.network is not None:
                for first, _, data, offsets in text_slices(batch.column("text")):
                    text, logit = own.network.logits(words_in(data, offsets))
                    if len(text):
                        edge = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
                        z = own.scale * np.maximum.reduceat(logit, edge).astype(np.float64) + own.shift
                        score[first + text[edge]] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scored, _SCORED)
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = train(spark, docs.where(~held_out()), labels)
    return toxicity(spark, docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
