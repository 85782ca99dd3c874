"""SentencePiece-style encoding and decoding: unigram Viterbi over a double-array trie (operator 10).

A space becomes the whitespace marker, and one marker leads the text. Pieces hold markers only
at their start, so the best segmentation of a text is that of its words (markers and what
follows them) one by one. Words not met before are segmented many at a time, in numpy: all of
them walk the trie from the same place in step, and keep the best score of every prefix.
Characters outside the vocabulary fall back to one piece per UTF-8 byte.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from fleetlens.llm.common import prepare

MARK = "▁"
MARK_BYTES = MARK.encode()
#: Bytes a fallback piece loses against the least likely piece.
FALLBACK_PENALTY = 4.0
CACHE_WORDS = 200_000
_WORD = re.compile(r" +[^ ]*")


@dataclass
class Vocabulary:
    """Pieces by id (bytes they stand for), log scores, and the ids of the 256 byte pieces. Ids
    without bytes (control pieces) are never produced."""

    pieces: list[bytes]
    scores: np.ndarray
    byte_ids: np.ndarray

    @property
    def is_byte(self) -> np.ndarray:
        flags = np.zeros(len(self.pieces), bool)
        flags[self.byte_ids] = True
        return flags


def load(path: str) -> Vocabulary:
    """The pieces of a SentencePiece model file with byte pieces. A merge model only ranks its
    pieces; a piece of rank r then has the log probability of Zipf's law, -log(r + 1) - log(H)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    pieces, scores, byte_ids = [b""] * n, np.full(n, -np.inf), np.zeros(256, np.int64)
    ranked = np.array([-model.get_score(i) for i in range(n)])
    harmonic = np.log(np.sum(1.0 / np.arange(1, n + 1)))
    for i in range(n):
        if model.is_byte(i):
            value = int(model.id_to_piece(i)[3:-1], 16)
            pieces[i], byte_ids[value] = bytes([value]), i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            pieces[i], scores[i] = model.id_to_piece(i).encode(), -np.log(ranked[i] + 1) - harmonic
    scores[byte_ids] = scores[np.isfinite(scores)].min() - FALLBACK_PENALTY
    return Vocabulary(pieces, scores, byte_ids)


@dataclass
class Trie:
    """Double array over bytes: the child of state s by byte b is base[s] + b + 1 if check there is s.

    ``piece`` is the id that ends in a state, or -1."""

    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray


def build_trie(vocabulary: Vocabulary) -> Trie:
    """Places the children of each node, in breadth-first order, at the first base where all their slots are free."""
    flags = vocabulary.is_byte
    tree: list[dict[int, int]] = [{}]
    ends = [-1]
    for i, piece in enumerate(vocabulary.pieces):
        if not piece or flags[i]:
            continue
        node = 0
        for b in piece:
            child = tree[node].get(b)
            if child is None:
                child = tree[node][b] = len(tree)
                tree.append({})
                ends.append(-1)
            node = child
        ends[node] = i
    size = 4 * len(tree) + 1024
    base, check, piece = np.zeros(size, np.int64), np.full(size, -1, np.int64), np.full(size, -1, np.int64)
    free = bytearray(b"\1" * size)
    free[0] = 0
    state, low = {0: 0}, 1
    queue = [0]
    for node in queue:
        children = tree[node]
        if not children:
            continue
        codes = sorted(children)
        if len(codes) == 1:
            # a single child fits into any free slot
            slot = free.index(1, max(low, codes[0] + 2))
            at = slot - codes[0] - 1
        else:
            slot = free.index(1, max(low, codes[0] + 2))
            at = slot - codes[0] - 1
            while not all(free[at + c + 1] for c in codes):
                slot = free.index(1, slot + 1)
                at = slot - codes[0] - 1
        s = state[node]
        base[s] = at
        for c in codes:
            t = at + c + 1
            free[t] = 0
            check[t], state[children[c]] = s, t
            piece[t] = ends[children[c]]
            queue.append(children[c])
        low = free.index(1, low)
    return Trie(base, check, piece)


def segment(words: list[bytes], trie: Trie, vocabulary: Vocabulary) -> list[bytes]:
    """Little-endian uint32 ids of the best segmentation of every word; ties go to the longer last piece."""
    out: list[bytes] = [b""] * len(words)
    order = sorted(range(len(words)), key=lambda i: -len(words[i]))
    for a in range(0, len(order), 20_000):
        part = order[a : a + 20_000]
        for i, ids in zip(part, _segment_block([words[i] for i in part], trie, vocabulary)):
            out[i] = ids
    return out


def _segment_block(words: list[bytes], trie: Trie, vocabulary: Vocabulary) -> list[bytes]:
    """``words`` by falling length: those that reach a place are a prefix of the list."""
    sizes = np.array([len(w) for w in words])
    longest = int(sizes[0]) if len(words) else 0
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    text = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
    flat = starts + np.arange(len(words))  # place of each word's state 0; a word has one state more than bytes
    best = np.full(len(text) + len(words), -np.inf)
    back = np.zeros(len(best), np.int32)
    via = np.full(len(best), -1, np.int32)
    best[flat] = 0.0
    fallback = vocabulary.scores[vocabulary.byte_ids[0]]
    for i in range(longest):
        reach = int(np.searchsorted(-sizes, -i, side="left"))  # words longer than i
        live = np.flatnonzero(best[flat[:reach] + i] > -np.inf)
        live = live[(text[starts[live] + i] & 0xC0) != 0x80]
        score = best[flat[live] + i]
        # the character as bytes
        lead = text[starts[live] + i]
        width = 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
        to = flat[live] + i + width
        better = score + width * fallback > best[to]
        best[to[better]], back[to[better]], via[to[better]] = (score + width * fallback)[better], width[better], -1
        state, step = np.zeros(len(live), np.int64), 0
        while len(live):
            at = trie.base[state] + text[starts[live] + i + step] + 1
            # a leaf has base 0; check decides
            ok = trie.check[at] == state
            live, state, score = live[ok], at[ok], score[ok]
            step += 1
            piece = trie.piece[state]
            ends = np.flatnonzero(piece >= 0)
            if len(ends):
                to, total = flat[live[ends]] + i + step, score[ends] + vocabulary.scores[piece[ends]]
                better = total > best[to]
                best[to[better]], back[to[better]], via[to[better]] = total[better], step, piece[ends][better]
            more = i + step < sizes[live]
            live, state, score = live[more], state[more], score[more]
    out = []
    byte_ids = vocabulary.byte_ids
    back_, via_ = back.tolist(), via.tolist()
    for w, f in zip(words, flat.tolist()):
        ids, end = [], len(w)
        while end:
            width, piece = back_[f + end], via_[f + end]
            if piece >= 0:
                ids.append(piece)
            else:
                ids.extend(byte_ids[b] for b in reversed(w[end - width : end]))
            end -= width
        out.append(np.array(ids[::-1], "<u4").tobytes())
    return out


class Codec:
    """Encoder and decoder with a bounded table of words met before."""

    def __init__(self, vocabulary: Vocabulary, trie: Trie):
        self.vocabulary, self.trie = vocabulary, trie
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        flags = vocabulary.is_byte
        # a piece's bytes, its markers as spaces; a byte piece is its byte
        self.text = [p if flags[i] else p.replace(MARK_BYTES, b" ") for i, p in enumerate(vocabulary.pieces)]

    def _learn(self, words: list[str]) -> None:
        # a marker of the text itself must not turn into a space: it goes by its bytes
        plain = [w for w in words if MARK not in w]
        ids = segment([w.replace(" ", MARK).encode() for w in plain], self.trie, self.vocabulary)
        self.words.update(zip(plain, ids))
        own = np.array(self.vocabulary.byte_ids[list(MARK_BYTES)], "<u4").tobytes()
        for w in words:
            if MARK in w:
                parts = segment([p.replace(" ", MARK).encode() for p in w.split(MARK)], self.trie, self.vocabulary)
                self.words[w] = own.join(parts)

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian uint32 bytes; an empty text has none."""
        if len(self.words) > CACHE_WORDS:
            self.older, self.words = self.words, {}
        split = [_WORD.findall(" " + t) if t else [] for t in texts]
        missing = set().union(*split) - self.words.keys() if split else set()
        known = {w: self.older[w] for w in missing if w in self.older}
        self._learn(sorted(missing - known.keys()))
        self.words.update(known)
        get = self.words.__getitem__
        return [b"".join(map(get, words)) for words in split]

    def decode(self, ids: bytes) -> bytes:
        """The UTF-8 of the text: pieces end to end, markers as spaces, less the leading one."""
        return b"".join(map(self.text.__getitem__, np.frombuffer(ids, "<u4").tolist()))[1:]


FIELDS = "doc_id long, n_pieces long, n_byte_pieces long, ids_crc32 long, decoded_chars long, round_trip boolean"
#: Bytes of text encoded together: their words and ids are held at once.
_SLICE = 2 << 20


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > _SLICE:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def encode(spark: SparkSession, docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id and ids (binary, little-endian uint32) of every row; FIELDS add up what they hold.

    A null or empty text has no piece and decodes to an empty one. Ids may repeat or be null; an
    empty table gives no row; other columns are ignored. The vocabulary and its trie are
    broadcast; their size is that of the model file, whatever the corpus.
    """
    prepare(spark)
    shared = spark.sparkContext.broadcast((vocabulary, build_trie(vocabulary)))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*shared.value)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in _slices(texts):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(codec.encode_many(texts[a:b]), pa.binary())], ["doc_id", "ids"]
                )

    return docs.select("doc_id", "text").mapInArrow(encoded, "doc_id long, ids binary")


def decode(spark: SparkSession, encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id and text of rows of ids."""
    prepare(spark)
    shared = spark.sparkContext.broadcast((vocabulary, Trie(*(np.zeros(0, np.int64),) * 3)))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*shared.value)
        for batch in batches:
            texts = [codec.decode(i).decode() for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decoded, "doc_id long, text string")


def measured(spark: SparkSession, docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """FIELDS of every row: pieces, byte pieces, CRC-32 of the ids, and whether decoding them gives the text back."""
    prepare(spark)
    shared = spark.sparkContext.broadcast((vocabulary, build_trie(vocabulary)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*shared.value)
        flags = shared.value[0].is_byte
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in _slices(texts):
                ids = codec.encode_many(texts[a:b])
                back = [codec.decode(x) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array([int(flags[np.frombuffer(x, "<u4")].sum()) for x in ids], pa.int64()),
                        pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                        pa.array([len(x.decode()) for x in back], pa.int64()),
                        pa.array([x == t.encode() for x, t in zip(back, texts[a:b])], pa.bool_()),
                    ],
                    [f.split()[0] for f in FIELDS.split(", ")],
                )

    return docs.select("doc_id", "text").mapInArrow(rows, FIELDS)


def pieces_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = load(public_tokenizers.path("piece_bpe_32k.model"))
    return measured(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary)
