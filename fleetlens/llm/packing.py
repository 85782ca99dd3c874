"""Harmonic packing of tokenised documents into fixed-length sequences (operator 4).

Piece lengths fall into reciprocal-capacity classes: the pieces of class k are at most
capacity/k long, and every bin of the class takes exactly k of them. A document is cut into
full sequences, then greedily into pieces that fill a class exactly, and its short tail goes
to the class it fits best. Workers fill bins on their own; the few pieces left in unfilled
bins of neighbouring workers meet once more, class by class, and what still does not fill a
bin is packed first-fit by falling length.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import prepare, written

CAPACITY = 1024
#: Documents per bin of each class; a piece of class k is at most CAPACITY // k tokens long.
CLASSES = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 36, 42, 51, 64, 73, 85, 102, 128, 170, 204, 256, 341, 512, 1024)
#: Pieces shorter than this are not cut again.
SHORTEST_CUT = 32
#: Tasks whose unfilled bins meet in one group of the second round.
NEIGHBOURS = 16
SPECIAL = "<|endoftext|>"
END_ID = 0
#: Words in each of the two generations of an encoder's table.
CACHE_WORDS = 200_000

PIECE_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "k_class int, k_task int"
)


class Encoder:
    """Byte-level BPE ids of a text as little-endian uint32 bytes, with the special token's string
    read as that token. Words met again come from a bounded table."""

    def __init__(self, ranks_path: str, pattern: str, special_id: int = 50256):
        import base64

        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("pack", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.special = np.array([special_id], "<u4").tobytes()
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.marks = {m: self._plain(m) for m in ".,"}
        # white space after a space: the pattern may then split at another place than before the space
        self.unsafe = re.compile(r" (?:\s|$)")

    def _plain(self, text: str) -> bytes:
        return np.array(self.bpe.encode_ordinary(text), "<u4").tobytes()

    def _missing(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            # a letter run and the mark after it are groups of their own
            if word[-1:] in self.marks and word[:-1].isalpha():
                ids = self._word(word[:-1]) + self.marks[word[-1]]
            else:
                ids = self._plain(" " + word)
        if len(self.words) >= CACHE_WORDS:
            self.older, self.words = self.words, {}
        self.words[word] = ids
        return ids

    def _word(self, word: str) -> bytes:
        return self.words.get(word) or self._missing(word)

    def _part(self, text: str) -> bytes:
        if self.unsafe.search(text):
            return self._plain(text)
        # every space starts a new token group of the pattern, so groups encode on their own
        first, *others = text.split(" ")
        get = self._word
        return self._plain(first) + b"".join([get(w) for w in others])

    def __call__(self, text: str) -> bytes:
        if SPECIAL not in text:
            return self._part(text)
        return self.special.join(self._part(p) for p in text.split(SPECIAL))


@functools.cache
def _encoder(ranks_path: str, pattern: str) -> Encoder:
    return Encoder(ranks_path, pattern)


def public_encoder(name: str = "byte_bpe_50k.tiktoken") -> Encoder:
    import public_tokenizers

    return _encoder(public_tokenizers.path(name), public_tokenizers.PATTERN)


def class_of(length: int) -> int:
    """The class with the shortest pieces that still hold ``length`` tokens."""
    return max(k for k in CLASSES if CAPACITY // k >= length)


CLASS_OF = [0] + [class_of(n) for n in range(1, CAPACITY + 1)]
_CUTS = [CAPACITY // k for k in CLASSES if CAPACITY // k >= SHORTEST_CUT]


def cut(tokens: int) -> list[int]:
    """Piece lengths of a document of ``tokens`` tokens, in order."""
    out = [CAPACITY] * (tokens // CAPACITY)
    rest = tokens % CAPACITY
    while rest >= SHORTEST_CUT:
        piece = next(c for c in _CUTS if c <= rest)
        out.append(piece)
        rest -= piece
    if rest:
        out.append(rest)
    return out


class Bins:
    """Open bins of one worker, one per class; ``full`` hands out the rows of a filled bin."""

    def __init__(self, first_id: int):
        self.next_id = first_id
        self.open: dict[int, list[tuple]] = defaultdict(list)

    def place(self, rows: list[tuple]) -> list[tuple]:
        offset, out = 0, []
        for row in rows:
            out.append((*row[:5], self.next_id, offset, *row[7:]))
            offset += row[2]
        self.next_id += 1
        return out

    def add(self, row: tuple, k: int) -> list[tuple]:
        rows = self.open[k]
        rows.append(row)
        if len(rows) < k:
            return []
        del self.open[k]
        return self.place(rows)


def _pack_task(encoder: Callable[[], Encoder], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId()
    bins, encode = Bins(task << 32), encoder()
    end = np.array([END_ID], "<u4").tobytes()
    names = [f.split()[0] for f in PIECE_SCHEMA.split(", ")]
    types = [{"long": pa.int64(), "int": pa.int32()}[f.split()[1]] for f in PIECE_SCHEMA.split(", ")]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    out: list[tuple] = []
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            ids = encode(text.as_py() or "") + end
            tokens, at = len(ids) // 4, 0
            for n in cut(tokens):
                row = (doc_id, at, n, zlib.crc32(ids[4 * at : 4 * (at + n)]), tokens, -1, -1, CLASS_OF[n], task)
                out += bins.add(row, CLASS_OF[n])
                at += n
            if len(out) > 50_000:
                yield table(out)
                out = []
    for rows in bins.open.values():
        out += rows
    if out:
        yield table(out)


def _pack_left(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """Second round over the pieces left by a few workers: at most k - 1 per class and worker."""
    bins = Bins((1 << 62) + (int(key[0]) << 32))
    out: list[tuple] = []
    pdf = pdf.sort_values(["k_task", "doc_id", "start", "ids_crc32"])
    ids = pdf["doc_id"].isna().to_numpy()
    for row, null in zip(pdf.itertuples(index=False, name=None), ids):
        out += bins.add((None if null else row[0], *row[1:]), row[7])
    rest = sorted((r for rows in bins.open.values() for r in rows), key=lambda r: -r[2])
    space: list[list] = []
    for row in rest:
        for b in space:
            if b[0] >= row[2]:
                break
        else:
            space.append(b := [CAPACITY, []])
        b[0] -= row[2]
        b[1].append(row)
    for _, rows in space:
        out += bins.place(rows)
    return pd.DataFrame(out, columns=pdf.columns).astype({"doc_id": "Int64"})


def pack(spark: SparkSession, docs: DataFrame, encoder: Callable[[], Encoder] = public_encoder) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text is the end id alone; a text of any length is cut into pieces that
    cover it once, in order. Rows that repeat an id are documents of their own; a null id stays
    null; an empty table gives no piece; other columns are ignored. Sequences hold at most
    CAPACITY tokens, gapless from 0; sequence ids are the same for the same input splits.
    """
    prepare(spark)
    first = written(
        spark,
        docs.select("doc_id", "text").mapInArrow(lambda batches: _pack_task(encoder, batches), PIECE_SCHEMA),
        "pieces",
    )
    left = (
        first.where("sequence_id < 0")
        .groupBy(F.expr(f"k_task div {NEIGHBOURS}").alias("k_group"))
        .applyInPandas(_pack_left, PIECE_SCHEMA)
    )
    return first.where("sequence_id >= 0").unionByName(left).drop("k_class", "k_task")


def pack_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
