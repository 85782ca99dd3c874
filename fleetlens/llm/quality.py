"""Quality classifier from weak labels (operator 3).

Heuristic labellers vote good, bad or nothing on every text. Expectation-maximisation over the
counts of vote patterns (at most 3 ** labellers rows, whatever the corpus) estimates how often
each labeller is right on good and on bad texts, and with that the posterior of each pattern.
The posteriors are the soft labels of a hashed linear scorer (byte n-grams and binned
statistics), fitted on a bounded sample and applied to every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import KEY, mix64, rows_of, text_slices, with_key, words_of, written

#: Texts on which the scorer is fitted: those of the smallest key hashes, or all of a smaller table.
SAMPLE = 4096
FEATURES = 4096
BINS = 20

# Frequent function words of the languages that the labeller knows.
STOP_WORDS = (
    "the of and to in is that for it as was with be by on not he this are or his from at which but have an had they you were "
    "their one all we can her has there been if more when will would who so no "
    "le la les de des du un une et est que qui dans pour pas sur au avec ce il sont plus par ne se son "
    "der die das und ist von den mit zu ein eine nicht auf im dem des für sich als auch es an werden aus er hat dass sie nach wird bei "
    "el los las en por con para del se lo como más pero sus y o este sí porque esta entre cuando muy sin sobre"
).split()
_STOP = np.unique(words_of(np.frombuffer(" ".join(STOP_WORDS).encode(), np.uint8), np.array([0, len(" ".join(STOP_WORDS).encode())]))[0])

#: Statistic, least value of the one side, least value of the other, and whether high values are good.
LABELLERS = (
    ("symbols", 0.07, 0.20, False),
    ("capitals", 0.10, 0.30, False),
    ("distinct", 0.30, 0.50, True),
    ("repeated_lines", 0.15, 0.40, False),
    ("word_length", 6.30, 7.20, False),
    ("stop_words", 0.04, 0.10, True),
    ("marks", 0.25, 0.60, False),
    ("distinct_pairs", 0.40, 0.60, True),
    ("top_word", 0.12, 0.25, False),
)
GOOD, BAD, ABSTAIN = "1", "0", "-"

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _row_sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """rows x labellers: the statistics of each text; NaN where a text has too little for one."""
    rows = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1)
    words, at = words_of(data, offsets, fold_case=True)
    n = np.diff(at)
    out = np.full((rows, len(LABELLERS)), np.nan)
    some = n > 0
    letters, spaces, upper = (_row_sums(t[data], offsets) for t in (_LETTER, _SPACE, _UPPER))
    symbols = np.diff(offsets) - letters - spaces
    # continuation bytes are no characters of their own
    chars = np.diff(offsets) - _row_sums((data & 0xC0) == 0x80, offsets) - spaces
    stop = _row_sums(np.isin(words, _STOP), at)
    raw = data.tobytes()
    out[some, 0] = (symbols / size)[some]
    out[some, 1] = (upper / size)[some]
    out[some, 4] = (chars / np.maximum(n, 1))[some]
    for i in range(rows):
        if n[i] >= 20:
            own = words[at[i] : at[i + 1]]
            counts = np.unique(own, return_counts=True)[1]
            out[i, 2] = len(counts) / n[i] ** 0.93
            out[i, 5] = stop[i] / n[i]
            out[i, 7] = len(np.unique(own[:-1] * np.uint64(3) + own[1:])) / (n[i] - 1)
            out[i, 8] = counts.max() / n[i]
            out[i, 6] = symbols[i] / n[i]
        lines = raw[offsets[i] : offsets[i + 1]].split(b"\n")
        if len(lines) >= 4:
            out[i, 3] = 1 - len(set(lines)) / len(lines)
    return out


def votes_of(stats: np.ndarray) -> list[str]:
    votes = np.full(stats.shape, ABSTAIN)
    for j, (_, low, high, rising) in enumerate(LABELLERS):
        votes[stats[:, j] < low, j] = BAD if rising else GOOD
        votes[stats[:, j] >= high, j] = GOOD if rising else BAD
    return ["".join(v) for v in votes]


@dataclass
class Labels:
    posterior: dict[str, float]
    prior: float
    right: np.ndarray  # labellers x (bad, good): how often a vote on such a text is right


def expectation_maximisation(patterns: dict[str, int], rounds: int = 200) -> Labels:
    """Posterior of good for every vote pattern; starts from the votes for bad, so good stays good."""
    keys = sorted(patterns)
    count = np.array([patterns[k] for k in keys], float)
    votes = np.array([[{GOOD: 1, BAD: 0}.get(c, -1) for c in k] for k in keys]).reshape(len(keys), len(LABELLERS))
    up, down = votes == 1, votes == 0
    # each defect has its own labellers, so a vote for bad says more than several for good
    good = 1 / (1 + down.sum(1) ** 2)
    prior, right = 0.5, np.full((len(LABELLERS), 2), 0.8)
    for _ in range(rounds):
        weight = count * good
        prior = (weight.sum() + 1) / (count.sum() + 2)
        for c, (w, agree) in enumerate(((count - weight, down), (weight, up))):
            cast = ((up | down) * w[:, None]).sum(0)
            right[:, c] = ((agree * w[:, None]).sum(0) + 4) / (cast + 5)
        log_bad = np.log(1 - prior) + down @ np.log(right[:, 0]) + up @ np.log(1 - right[:, 0])
        log_good = np.log(prior) + up @ np.log(right[:, 1]) + down @ np.log(1 - right[:, 1])
        new = 1 / (1 + np.exp(np.clip(log_bad - log_good, -60, 60)))
        done = np.abs(new - good).max(initial=0) < 1e-9
        good = new
        if done:
            break
    return Labels(dict(zip(keys, good.tolist())), float(prior), right)


def features(data: np.ndarray, offsets: np.ndarray, stats: np.ndarray) -> np.ndarray:
    """rows x FEATURES: shares of hashed byte 3-grams (square roots), and binned statistics (ones)."""
    rows = len(offsets) - 1
    out = np.zeros((rows, FEATURES), np.float32)
    lower = np.where(_UPPER[data], data + 32, data).astype(np.uint64)
    if len(data) >= 3:
        code = mix64(lower[:-2] | lower[1:-1] << np.uint64(8) | lower[2:] << np.uint64(16)) % np.uint64(FEATURES)
        row = np.repeat(np.arange(rows), np.diff(offsets))
        inside = row[:-2] == row[2:]
        flat = np.bincount(row[:-2][inside] * FEATURES + code[inside].astype(np.int64), minlength=rows * FEATURES)
        out[:] = np.sqrt(flat.reshape(rows, FEATURES) / np.maximum(np.diff(offsets) - 2, 1)[:, None])
    for j, (_, low, high, _) in enumerate(LABELLERS):
        bins = np.clip(np.nan_to_num(stats[:, j] / (2 * high), nan=0.0) * BINS, 0, BINS).astype(np.int64)
        bins[np.isnan(stats[:, j])] = BINS + 1
        at = mix64((np.uint64(1000003) * np.uint64(j + 1)) + bins.astype(np.uint64)) % np.uint64(FEATURES)
        out[np.arange(rows), at.astype(np.int64)] += 1.0
    return out


def fit(x: np.ndarray, target: np.ndarray, weight: np.ndarray | None = None, rounds: int = 120, ridge: float = 1e-4) -> np.ndarray:
    """Weights (the last is the bias) of a logistic scorer on soft targets, by Adam on all rows; a row counts ``weight`` times."""
    share = np.full(len(x), 1 / max(1, len(x))) if weight is None else weight / max(1, weight.sum())
    w = np.zeros(x.shape[1] + 1, np.float64)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1 if len(x) else 1):
        z = x @ w[:-1].astype(np.float32) + w[-1]
        e = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - target
        e = e * share
        g = np.append(x.T @ e.astype(np.float32) + ridge * w[:-1], e.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w


_VOTED = "doc_id long, k_id long, k_text long, votes string"
_SCORED = "doc_id long, votes string, posterior double, score double, kept boolean"
#: Bytes of text whose features are held at once, rows of features at once.
_SLICE_BYTES, _SLICE_ROWS = 1 << 20, 512


def _voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        votes = [v for _, _, data, offsets in text_slices(batch.column("text")) for v in votes_of(statistics(data, offsets))]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", *KEY)), pa.array(votes, pa.string())], ["doc_id", *KEY, "votes"]
        )


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for start in range(0, batch.num_rows, _SLICE_ROWS):
        for first, rows, data, offsets in text_slices(batch.column("text").slice(start, _SLICE_ROWS), _SLICE_BYTES):
            yield start + first, rows, data, offsets


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, rows, data, offsets in _pieces(batch):
            x = features(data, offsets, statistics(data, offsets)).astype(np.float16)
            own = [batch.column(c).slice(first, rows) for c in ("votes", "n")]
            yield pa.RecordBatch.from_arrays([*own, pa.array([r.tobytes() for r in x], pa.binary())], ["votes", "n", "x"])


def train(spark: SparkSession, docs: DataFrame, voted: DataFrame, sample: int = SAMPLE) -> tuple[Labels, np.ndarray]:
    """The label model of all votes, and the scorer's weights from at most ``sample`` texts.

    Rows that repeat an id and a text are one text of the sample, which counts as often as it occurs.
    """
    patterns = {r["votes"]: r["count"] for r in voted.groupBy("votes").count().collect()}  # at most 3 ** len(LABELLERS) rows
    labels = expectation_maximisation(patterns)
    told = voted.where(F.col("votes") != ABSTAIN * len(LABELLERS)).groupBy(*KEY, "votes").agg(F.count(F.lit(1)).alias("n"))
    chosen = written(spark, told.orderBy(F.xxhash64(*KEY, F.lit(3)), *KEY).limit(sample), "sample")
    texts = rows_of(docs, chosen).dropDuplicates(KEY).select("text", "votes", "n")
    rows = sorted(texts.mapInArrow(_sampled, "votes string, n long, x binary").collect(), key=lambda r: (r["x"], r["votes"]))
    x = np.stack([np.frombuffer(r["x"], np.float16) for r in rows]).astype(np.float32) if rows else np.zeros((0, FEATURES), np.float32)
    return labels, fit(x, np.array([labels.posterior[r["votes"]] for r in rows]), np.array([r["n"] for r in rows], float))


def quality(spark: SparkSession, docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: doc_id, votes, posterior, score (0 to 1), kept (score >= threshold).

    A null text, an empty one and one without words get no vote, the posterior of the prior and score 0, and are
    not kept. Ids may repeat or be null; an empty table gives no row; other columns are ignored.
    """
    keyed = with_key(docs)
    voted = written(spark, keyed.mapInArrow(_voted, _VOTED), "votes")
    labels, weights = train(spark, keyed, voted)
    shared = spark.sparkContext.broadcast((labels.posterior, labels.prior, weights))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        posterior, prior, w = shared.value
        for batch in batches:
            for first, rows, data, offsets in _pieces(batch):
                stats = statistics(data, offsets)
                votes = votes_of(stats)
                z = features(data, offsets, stats) @ w[:-1].astype(np.float32) + w[-1]
                score = np.where(np.isnan(stats[:, 0]), 0.0, 1 / (1 + np.exp(-np.clip(z, -40, 40))))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, rows), pa.array(votes, pa.string()),
                     pa.array([posterior.get(v, prior) for v in votes], pa.float64()), pa.array(score.astype(np.float64)),
                     pa.array(score >= threshold)],
                    [f.split()[0] for f in _SCORED.split(", ")],
                )

    return keyed.select("doc_id", "text").mapInArrow(scored, _SCORED)


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
