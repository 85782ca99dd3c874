"""Substring dedup on words with fixed-block anchors (operator 1).

The index holds the non-overlapping blocks of every document, half a window long, so that any
repeated window holds one whole block of each document it occurs in. Every rolling window of
block length probes the index; a probe hits where some block has its words and at least two
documents do. Windows that hold a hit are then compared as a whole across documents, and
overlapping repeated windows join into maximal repeats.

Probes and blocks travel as packed arrays, one row per chunk of documents and part of the
hash space, and only hits travel back to their chunk, so the exchange is a few bytes a word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import KEY, ngrams_of, rows_of, text_slices, with_key, words_of, written

WINDOW = 13
#: Text of one chunk: the larger, the fewer rows it takes to reach all parts.
CHUNK_BYTES = 1 << 20

#: One row: what a chunk sends to a part, or gets back from it. ``ids`` has a value per document
#: of the chunk that the row names by its place (``docs``); ``keys`` is set in one row of a chunk.
PACKED = "part int, chunk long, docs binary, hashes binary, blocks binary, places binary, ids binary, keys binary"


def block_words(window: int) -> int:
    return (window + 1) // 2


def _schema_batch(rows: list[dict]) -> pa.RecordBatch:
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in PACKED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], types[t]) for n, t in fields], [n for n, _ in fields])


def _packed(parts: int, chunk: int, doc: np.ndarray, hashes: np.ndarray, keys: np.ndarray, width: type,
            block: np.ndarray | None = None, ids: np.ndarray | None = None) -> pa.RecordBatch:
    """The rows that a chunk sends: its hashes by part, with the place of their document in the chunk."""
    part = ((hashes >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")
    part, doc, hashes = part[order], doc[order], hashes[order]
    block = block[order] if block is not None else None
    edges = np.searchsorted(part, np.arange(parts + 1))
    home = chunk % parts
    rows = []
    for p in np.union1d(np.unique(part), [home]):
        a, b = edges[p], edges[p + 1]
        row = {"part": int(p), "chunk": chunk, "hashes": hashes[a:b].astype(width).tobytes()}
        if ids is None:
            row["docs"] = doc[a:b].astype(np.uint16).tobytes()
            row["blocks"] = np.packbits(block[a:b]).tobytes()
        else:
            places, at = np.unique(doc[a:b], return_inverse=True)
            row |= {"docs": at.astype(np.uint16).tobytes(), "places": places.astype(np.uint16).tobytes(), "ids": ids[places].tobytes()}
        if p == home:
            row["keys"] = keys.tobytes()
        rows.append(row)
    return _schema_batch(rows)


def _chunks(batches: Iterator[pa.RecordBatch], more: str | None = None) -> Iterator[tuple]:
    """(chunk number, row keys, word hashes, words before each row, doc ids, more) of slices of the input."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in KEY], axis=1) if batch.num_rows else np.zeros((0, 2), np.int64)
        ids = batch.column("doc_id").fill_null(0).to_numpy()
        extra = batch.column(more).to_pylist() if more else None
        for first, rows, data, offsets in text_slices(batch.column("text"), CHUNK_BYTES):
            words, at = words_of(data, offsets)
            end = first + rows
            yield number, keys[first:end], words, at, ids[first:end], extra[first:end] if more else None
            number += 1


def _inside(at: np.ndarray, size: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, whether the window fits) of the windows of ``size`` words starting at each word."""
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    count = max(0, n - size + 1)
    return doc[:count], np.arange(count) + size <= np.repeat(at[1:], np.diff(at))[:count]


def _probes(window: int, parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    size = block_words(window)
    for chunk, keys, words, at, _, _ in _chunks(batches):
        doc, fits = _inside(at, size, len(words))
        # documents shorter than a window have nothing to find
        fits &= (np.diff(at) >= window)[doc] if len(doc) else fits
        hashes = ngrams_of(words, size)[fits]
        start = np.flatnonzero(fits)
        block = (start - at[doc[fits]]) % size == 0
        yield _packed(parts, chunk, doc[fits], hashes, keys, np.uint32, block=block)


def _gathered(batches: Iterator[pa.RecordBatch], width: type) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    """The rows of a task, their hashes end to end, and the row each hash came in."""
    rows = pd.concat([b.to_pandas() for b in batches] or [pd.DataFrame(columns=[f.split()[0] for f in PACKED.split(", ")])], ignore_index=True)
    hashes = [np.frombuffer(x, width) for x in rows["hashes"]]
    counts = [len(x) for x in hashes]
    return rows, np.concatenate([np.zeros(0, width), *hashes]), np.repeat(np.arange(len(rows)), counts)


def _replies(rows: pd.DataFrame, row: np.ndarray, hashes: np.ndarray, hit: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Back to each chunk: the documents and hashes that were hit, and its keys where they came along."""
    counts = np.bincount(row, minlength=len(rows))
    edges = np.concatenate([[0], np.cumsum(counts)])
    out = []
    for i, r in enumerate(rows.itertuples(index=False)):
        own = hit[edges[i] : edges[i + 1]]
        if not own.any() and r.keys is None:
            continue
        docs = np.frombuffer(r.docs, np.uint16)
        if r.places is not None:
            docs = np.frombuffer(r.places, np.uint16)[docs]
        # the part is kept with the hash: it is a piece of it
        out.append({"part": r.part, "chunk": r.chunk, "docs": docs[own].tobytes(),
                    "hashes": hashes[edges[i] : edges[i + 1]][own].tobytes(), "keys": r.keys})
        if len(out) == 500:
            yield _schema_batch(out)
            out = []
    if out:
        yield _schema_batch(out)


def _hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes that some block has and that lie in two documents or more."""
    rows, hashes, row = _gathered(batches, np.uint32)
    if not len(rows):
        return
    doc = np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(x, np.uint16).astype(np.int64) for x in rows["docs"]]])
    chunk = np.unique(rows["chunk"], return_inverse=True)[1]
    doc += chunk[row] << 16
    block = np.concatenate([np.zeros(0, bool), *[
        np.unpackbits(np.frombuffer(x, np.uint8), count=len(h) // 4).astype(bool) for x, h in zip(rows["blocks"], rows["hashes"])
    ]])
    hit = np.zeros(len(hashes), bool)
    if len(hashes):
        order = np.argsort(hashes, kind="stable")
        sorted_ = hashes[order]
        starts = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))
        good = np.logical_or.reduceat(block[order], starts)
        good &= np.minimum.reduceat(doc[order], starts) != np.maximum.reduceat(doc[order], starts)
        hit[order] = np.repeat(good, np.diff(np.append(starts, len(hashes))))
    yield from _replies(rows, row, hashes, hit)


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of whole windows that also start in a document with a smaller id."""
    rows, hashes, row = _gathered(batches, np.uint64)
    if not len(rows):
        return
    ids = np.concatenate([np.zeros(0, np.int64), *[
        np.frombuffer(i, np.int64)[np.frombuffer(d, np.uint16)] for i, d in zip(rows["ids"], rows["docs"])
    ]])
    hit = np.zeros(len(hashes), bool)
    if len(hashes):
        order = np.argsort(hashes, kind="stable")
        sorted_ = hashes[order]
        starts = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))
        least = np.minimum.reduceat(ids[order], starts)
        hit[order] = ids[order] > np.repeat(least, np.diff(np.append(starts, len(hashes))))
    yield from _replies(rows, row, hashes, hit)


def _to_documents(width: type) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def spread(pdf: pd.DataFrame) -> pd.DataFrame:
        """One row per document of a chunk with hits: its key and its distinct hit hashes."""
        keys = np.frombuffer(next(k for k in pdf["keys"] if k is not None), np.int64).reshape(-1, 2)
        docs = np.concatenate([np.frombuffer(x, np.uint16) for x in pdf["docs"]])
        hashes = np.concatenate([np.frombuffer(x, width) for x in pdf["hashes"]])
        if width is np.uint32:
            parts = np.repeat(pdf["part"].to_numpy().astype(np.uint64), [len(x) // 4 for x in pdf["hashes"]])
            hashes = parts << np.uint64(32) | hashes
        order = np.argsort(docs, kind="stable")
        docs, hashes = docs[order], hashes[order]
        places, starts = np.unique(docs, return_index=True)
        found = [np.unique(x).tobytes() for x in np.split(hashes, starts[1:])] if len(places) else []
        return pd.DataFrame({"k_id": keys[places, 0], "k_text": keys[places, 1], "found": found})

    return spread


def _per_document(found: list[bytes], values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """True where a value of a document is among what was found for that document."""
    out = np.zeros(len(values), bool)
    for i, x in enumerate(found):
        a, b = at[i], at[i + 1]
        out[a:b] = np.isin(values[a:b], np.frombuffer(x, np.uint64))
    return out


def _windows(window: int, parts1: int, parts2: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole windows that hold a hit, packed for the second exchange."""
    size = block_words(window)
    for chunk, keys, words, at, ids, found in _chunks(batches, "found"):
        grams = ngrams_of(words, size)
        sent = ((grams >> np.uint64(40)) % np.uint64(parts1)) << np.uint64(32) | (grams & np.uint64(0xFFFFFFFF))
        hit = _per_document(found, sent, np.minimum(at, len(sent)))
        doc, fits = _inside(at, window, len(words))
        before = np.concatenate([[0], np.cumsum(hit)])
        first = np.arange(len(doc))
        fits &= before[first + window - size + 1] > before[first]
        yield _packed(parts2, chunk, doc[fits], ngrams_of(words, window)[fits], keys, np.uint64, ids=ids)


def _exchange(sent: DataFrame, judge: Callable, width: type, parts: int) -> DataFrame:
    """What ``judge`` finds among the packed rows that meet in a part, back by document: KEY, found."""
    return (
        sent.repartition(parts, "part")
        .mapInArrow(judge, PACKED)
        .groupBy("chunk")
        .applyInPandas(_to_documents(width), "k_id long, k_text long, found binary")
    )


def removed_words(window: int, words: np.ndarray, found: bytes) -> np.ndarray:
    """True for the words covered by the windows whose hashes were found."""
    start = np.isin(ngrams_of(words, window), np.frombuffer(found, np.uint64))
    edges = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(start)
    edges[at] += 1
    edges[at + window] -= 1
    return np.cumsum(edges[:-1]) > 0


def _cut(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        removed, kept = [], []
        for first, rows, data, offsets in text_slices(batch.column("text")):
            hashes, at = words_of(data, offsets)
            raw = data.tobytes()
            for i in range(rows):
                words = raw[offsets[i] : offsets[i + 1]].split()
                gone = removed_words(window, hashes[at[i] : at[i + 1]], batch.column("found")[first + i].as_py())
                removed.append(int(gone.sum()))
                kept.append(b" ".join(w for w, g in zip(words, gone.tolist()) if not g))
        yield pa.RecordBatch.from_arrays(
            [batch.column("k_id"), batch.column("k_text"), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
            [*KEY, "n_removed", "kept"],
        )


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [(t.as_py() or "").encode().split() for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("doc_id", *KEY)]
            + [pa.array(map(len, words), pa.int64()), pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in words], pa.string())],
            ["doc_id", *KEY, "n_words", "whole_sha256"],
        )


def repeated_words(spark: SparkSession, docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """KEY, n_removed and kept (the words that stay, joined by one space) of the documents that lose words.

    A word goes when a window of ``window`` consecutive words that covers it also starts in a
    document with a smaller doc_id. Rows with a null id take no part; rows of one id never
    count against each other; a document shorter than a window loses nothing.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = with_key(docs.where("doc_id is not null"))
    hits = written(
        spark,
        _exchange(keyed.mapInArrow(lambda x: _probes(window, parts, x), PACKED), _hits, np.uint32, parts),
        "hits",
    ).dropDuplicates(KEY)
    sent = rows_of(keyed, hits).mapInArrow(lambda x: _windows(window, parts, parts, x), PACKED)
    later = written(spark, _exchange(sent, _later, np.uint64, parts), "later").dropDuplicates(KEY)
    return rows_of(keyed, later).mapInArrow(
        lambda x: _cut(window, x), "k_id long, k_text long, n_removed long, kept binary"
    )


def substring_dedup(spark: SparkSession, docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 (lowercase hex).

    Words are runs of bytes other than 0x20 and 0x09-0x0D, unchanged; a null text has none.
    Windows are judged on the input. An empty table gives no row; other columns are ignored.
    """
    facts = with_key(docs).mapInArrow(_facts, "doc_id long, k_id long, k_text long, n_words long, whole_sha256 string")
    cuts = repeated_words(spark, docs, window).select(*KEY, "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
    cuts = written(spark, cuts.where("n_removed > 0"), "cuts").dropDuplicates(KEY)
    return written(spark, facts, "facts").join(cuts, KEY, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
    )


def substring_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = f"""
with split as (
    select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as ws
    from documents
), windows as (
    select doc_id, i, array_to_string(ws[i : i + {WINDOW - 1}], ' ') as w
    from (select doc_id, ws, unnest(generate_series(1, len(ws) - {WINDOW - 1})) as i from split)
), firsts as (
    select w, min(doc_id) as first_id from windows group by w
), gone as (
    select distinct doc_id, unnest(generate_series(i, i + {WINDOW - 1})) as j
    from windows join firsts using (w) where first_id < doc_id
), words as (
    select doc_id, unnest(ws) as word, generate_subscripts(ws, 1) as j from split
), kept as (
    select doc_id, string_agg(word, ' ' order by j) as text from words anti join gone using (doc_id, j) group by doc_id
), lost as (
    select doc_id, count(*) as n from gone group by doc_id
)
select doc_id, len(ws) as n_words, coalesce(n, 0) as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
from split left join lost using (doc_id) left join kept using (doc_id)
"""
