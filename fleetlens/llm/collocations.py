"""Phrase collocations from Rabin-Karp fingerprints of every n-gram (operator 13).

A task takes its texts in slices of about SLICE_BYTES. Prefix polynomials over the word values of
a slice give the fingerprint of every n-gram as a difference of two prefixes. Lengths are screened one
after the other: the low half of each fingerprint and its count, added up over CHUNK_BYTES of text, go to
the part of the fingerprint, and those that reach the least count set a bit of a table (at most BITS
bits, broadcast). An n-gram is screened only where both shorter ones in it have their bits; a collision
or a fuller table only lets more through.

One more scan takes the n-grams of all lengths whose bits are set. Equal fingerprints of a slice are compared
word by word with the first of them, those that differ are kept apart; the slices of a chunk are added up by
text. One (fingerprint, count, pointer to an occurrence) of each goes to the part of its fingerprint, many to
a row. A part adds the counts up and keeps the pointers of the fingerprints that reach the
least count. Their texts are read at the pointers and counted by text, so that a collision
between chunks can neither add to a phrase nor hide one.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import mix64, prepare, reused_memory, text_slices, written

SLICE_BYTES = 1 << 21
#: Bytes of text whose n-grams are added up before they are sent, entries that a task holds unmerged at least.
CHUNK_BYTES, HELD = 1 << 25, 1 << 17
#: Bytes of text whose n-grams make a part, bits of the table of frequent fingerprints at most.
PART_BYTES, BITS = 1 << 25, 1 << 26
#: Bytes of text read at pointers that are in memory at once, rows of a lang that are ranked in one group at first.
READ_BYTES, SALTS = 1 << 22, 64

_ENDS = np.zeros(256, bool)
_ENDS[[*b".,;:!?", *range(10, 14)]] = True
_SPACE = _ENDS.copy()
_SPACE[[32, 9]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
#: Base of the polynomials over words, modulo 2**64.
_BASE = 0xD1342543DE82EF95
_BASE_INV = pow(_BASE, -1, 1 << 64)

_SENT = "part long, n int, doc binary, docs binary, prints binary, counts binary, starts binary"
_NUMBERS = ("doc", "docs", "prints", "counts", "starts")
_TYPES = {
    "doc": np.dtype(np.int64), "docs": np.dtype(np.uint32), "prints": np.dtype(np.uint64), "counts": np.dtype(np.uint32),
    "starts": np.dtype(np.uint32), "lows": np.dtype(np.uint32), "ats": np.dtype(np.int64), "fs": np.dtype(np.int64),
}
_SCREENED = "part long, lows binary, counts binary"
_LOW = np.uint64(0xFFFFFFFF)
#: A kept pointer is (text, count, words, first byte) with the last three in one number; a part writes one row of them for
#: every bucket of texts. n = 0 marks the words of a lang.
_KEPT = "n int, bucket long, doc binary, docs binary, ats binary, at long, lang string"
_FOUND = "doc long, found binary, at long, lang string"
_COUNT, _LENGTH, _MOST = 36, 32, (1 << 27) - 1
#: Groups in which the words of each lang are added up.
TOTALS = 64
#: Phrases of a lang and length that were read, in order, parted by line feeds (which none of them has).
_READ = "part long, n int, lang string, phrases binary, fs binary"
_PHRASES = "lang string, n int, phrase string, f long"


def _powers(n: int, base: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
    return out[:n]


class Pieces:
    """Words of a buffer of texts, split at white space and at the marks that end a piece; A-Z lower-cased."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.data = _FOLD[data]
        word = ~_SPACE[self.data]
        begins, closes = word.copy(), word.copy()
        begins[1:] &= ~word[:-1]
        closes[:-1] &= ~word[1:]
        some = offsets[:-1] < offsets[1:]
        first, last = offsets[:-1][some], offsets[1:][some] - 1
        begins[first], closes[last] = word[first], word[last]
        self.starts, self.stops = np.flatnonzero(begins), np.flatnonzero(closes) + 1
        self.before = np.searchsorted(self.starts, offsets)
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(self.before))
        # consecutive words of a piece share this number (and the text)
        self.piece = np.searchsorted(np.flatnonzero(_ENDS[self.data]), self.starts)
        # the words' bytes, eight at a time: (places of the words that reach so far, numbers)
        eights = np.ndarray(len(data) + 1, "<u8", np.append(self.data, np.zeros(8, np.uint8)), strides=(1,))
        self.sizes = self.stops - self.starts
        self.blocks: list[tuple[np.ndarray, np.ndarray]] = []
        self.words = self.sizes.astype(np.uint64)
        at = np.arange(len(self.starts))
        while len(at):
            k = 8 * len(self.blocks)
            block = eights[self.starts[at] + k]
            left = 8 - np.minimum(self.sizes[at] - k, 8)
            block &= ~np.uint64(0) >> (left * 8).astype(np.uint64)
            self.blocks.append((at, block))
            self.words[at] = mix64(self.words[at] * np.uint64(_BASE) + block)
            at = at[self.sizes[at] > k + 8]

    def within(self, n: int) -> np.ndarray:
        """Whether the n words from each place on are of one piece of one text."""
        last = len(self.words) - n + 1
        return (self.piece[:last] == self.piece[n - 1 :]) & (self.text[:last] == self.text[n - 1 :]) if last > 0 else np.zeros(0, bool)


def word_values(pieces: Pieces, lang: np.ndarray) -> np.ndarray:
    """The value of every word occurrence: its hash, mixed with that of the text's lang."""
    return mix64(pieces.words ^ lang[pieces.text]) if len(pieces.words) else pieces.words


def fingerprints(values: np.ndarray, n: int) -> np.ndarray:
    """Rabin-Karp fingerprint of every n consecutive values, from one prefix polynomial."""
    m = len(values) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _powers(len(values), _BASE))])
    return mix64((prefix[n:] - prefix[:m]) * _powers(m, _BASE_INV) + np.uint64(n))


def exact_words(p: Pieces, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of every word occurrence in its slice, place of the first of each): equal only for equal bytes under one lang."""
    order = np.argsort(values)
    edge = np.concatenate([[True], values[order][1:] != values[order][:-1]])
    number = np.empty(len(values), np.int64)
    number[order] = np.cumsum(edge) - 1
    first = order[edge]
    lead = first[number]
    odd = p.sizes != p.sizes[lead]
    rank = np.empty(len(values), np.int64)
    for at, block in p.blocks:
        rank[at] = np.arange(len(at))
        alike = at[~odd[at]]  # as long as its first one, so that both are in this block
        odd[alike] = block[rank[alike]] != block[rank[lead[alike]]]
    if odd.any():  # two words under one value: told apart by their bytes
        names: dict[tuple, int] = {}
        more = []
        for i in np.flatnonzero(odd).tolist():
            key = (int(values[i]), p.data[p.starts[i] : p.stops[i]].tobytes())
            if key not in names:
                names[key] = len(first) + len(names)
                more.append(i)
            number[i] = names[key]
        first = np.concatenate([first, more])
    return number, first


def counted(prints: np.ndarray, places: np.ndarray, numbers: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fingerprint, occurrences, first place) of each n-gram of a slice; n-grams that share a fingerprint stay apart."""
    order = np.argsort(prints)
    h, at = prints[order], places[order]
    new = np.concatenate([[True], h[1:] != h[:-1]])
    lead = at[np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))]
    odd = np.zeros(len(h), bool)
    for j in range(n):
        odd |= numbers[at + j] != numbers[lead + j]
    if odd.any():
        rest = counted(h[odd], at[odd], numbers, n)
    h, at, new = h[~odd], at[~odd], new[~odd]
    edge = np.flatnonzero(new)
    out = (h[edge], np.diff(np.append(edge, len(h))), at[edge])
    return tuple(np.concatenate(x) for x in zip(out, rest)) if odd.any() else out


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Pieces, np.ndarray, np.ndarray, pa.Array]]:
    """(pieces, names of the texts, values of their langs, langs) of slices of about SLICE_BYTES."""
    for batch in batches:
        docs, lang = (batch.column(c).to_numpy() for c in ("doc", "lang_value"))
        for first, rows, data, offsets in text_slices(batch.column("text"), SLICE_BYTES):
            own = slice(first, first + rows)
            yield Pieces(data, offsets), docs[own], lang[own].view(np.uint64), batch.column("lang").slice(first, rows)


def may_be(bits: np.ndarray, prints: np.ndarray) -> np.ndarray:
    at = prints & np.uint64(len(bits) * 8 - 1)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


def _screened(parts: int, n: int, bits: np.ndarray | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The low halves of the fingerprints of n words with their counts, a row for every chunk and part."""
    with reused_memory():
        held, size = [], 0
        for p, _, lang, _ in _slices(batches):
            values = word_values(p, lang)
            inside = p.within(n)
            if bits is not None and len(inside):
                shorter = may_be(bits, fingerprints(values, n - 1))
                inside &= shorter[:-1] & shorter[1:]
            h = fingerprints(values, n)[inside]
            held.append((h >> np.uint64(32)) % np.uint64(parts) << np.uint64(32) | h & _LOW)
            size += len(p.data)
            if size >= CHUNK_BYTES:
                yield _screen_rows(held)
                held, size = [], 0
        if held:
            yield _screen_rows(held)


def _screen_rows(held: list[np.ndarray]) -> pa.RecordBatch:
    keys = np.concatenate(held)
    keys.sort()
    edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    counts, keys = np.diff(np.append(edge, len(keys))), keys[edge]
    part = (keys >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(keys) else edge
    rows: list[list] = [[], []]
    for a, b in zip(first, np.append(first[1:], len(keys))):
        rows[0].append(_shut("lows", np.diff(keys[a:b] & _LOW, prepend=np.uint64(0))))
        rows[1].append(_shut("counts", counts[a:b]))
    arrays = [pa.array(part[first], pa.int64()), *(pa.array(c, pa.binary()) for c in rows)]
    return pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in _SCREENED.split(", ")])


def _may_reach(least: int, table: pa.Table) -> pa.Table:
    """The low halves of the fingerprints of one part that occur ``least`` times."""
    lows = np.concatenate([np.cumsum(_open("lows", x), dtype=np.uint32) for x in table.column("lows").to_pylist()])
    counts = np.concatenate([_open("counts", x) for x in table.column("counts").to_pylist()])
    order = np.argsort(lows)
    lows = lows[order]
    edge = np.flatnonzero(np.concatenate([[True], lows[1:] != lows[:-1]]))
    total = np.add.reduceat(counts[order].astype(np.int64), edge)
    return pa.table({"lows": pa.array([lows[edge][total >= least].tobytes()], pa.binary())})


def _sent(parts: int, bits: list[np.ndarray], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The n-grams of each chunk by part, of all lengths; also the number of words by lang (parts below 0)."""
    with reused_memory():
        yield from _messages(parts, bits, batches)


_ENTRIES = ["lang", "phrase", "print", "count", "doc", "start"]


class _Chunk:
    """The n-grams of the slices of a chunk: those of one text under one lang are one, with the print and pointer of the first."""

    def __init__(self) -> None:
        self.held: dict[int, list[pa.Table]] = {}
        self.merged: dict[int, int] = {}

    def add(self, n: int, entries: pa.Table) -> None:
        held = self.held.setdefault(n, [])
        held.append(entries)
        if sum(t.num_rows for t in held) > max(HELD, 2 * self.merged.get(n, 0)):
            held[:] = [self.one_each(held)]
            self.merged[n] = held[0].num_rows

    @staticmethod
    def one_each(held: list[pa.Table]) -> pa.Table:
        names = held[0].column_names
        wanted = [(c, "sum" if c == "count" else "first") for c in names if c not in ("lang", "phrase")]
        merged = pa.concat_tables(held).group_by(["lang", "phrase"], use_threads=False).aggregate(wanted)
        return merged.rename_columns([c.removesuffix("_sum").removesuffix("_first") for c in merged.column_names]).select(names)

    def taken(self) -> Iterator[tuple[int, pa.Table]]:
        """(n, its n-grams); the chunk is empty afterwards."""
        for n in sorted(self.held):
            merged = self.one_each(self.held.pop(n))
            if merged.num_rows:
                yield n, merged
        self.merged.clear()


def _messages(parts: int, bits: list[np.ndarray], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codes: dict[str, int] = {}
    chunk, size = _Chunk(), 0
    for slice_, (p, docs, lang, names) in enumerate(_slices(batches)):
        if not len(p.words):
            continue
        values = word_values(p, lang)
        numbers, first = exact_words(p, values)
        coded = names.dictionary_encode()
        own = coded.dictionary.to_pylist()
        words = np.bincount(coded.indices.to_numpy(), np.diff(p.before), len(own)).astype(np.int64)
        totals = [x.encode() for x in own], [str(x).encode() for x in words.tolist()]
        yield _message([-1 - slice_ % TOTALS] * len(words), 0, [*[[None] * len(words)] * 3, *totals])
        code = np.array([codes.setdefault(x, len(codes)) for x in own], np.int32)[coded.indices.to_numpy()]
        for n, table in enumerate(bits, 1):
            prints = fingerprints(values, n)
            if n == 1:
                own = may_be(table, prints[first])
                h, count, at = prints[first][own], np.bincount(numbers)[own], first[own]
            else:
                places = np.flatnonzero(p.within(n) & may_be(table, prints))
                if not len(places):
                    continue
                h, count, at = counted(prints[places], places, numbers, n)
            text = p.text[at]
            # pointers are bytes from the text's first word on
            start = p.starts[at] - p.starts[p.before[text]]
            for a, b, phrase in _phrases_at(p, at, n):
                own = slice(a, b)
                columns = [code[text[own]], phrase, h[own], count[own].astype(np.int64), docs[text[own]], start[own]]
                chunk.add(n, pa.table(dict(zip(_ENTRIES, columns))))
        size += len(p.data)
        if size >= CHUNK_BYTES:
            yield from (_pointers(parts, n, entries) for n, entries in chunk.taken())
            size = 0
    yield from (_pointers(parts, n, entries) for n, entries in chunk.taken())


def _pointers(parts: int, n: int, entries: pa.Table) -> pa.RecordBatch:
    """A row for every part, with the low halves of the fingerprints: texts are named once in it."""
    h, count, doc, start = (entries.column(c).to_numpy() for c in ("print", "count", "doc", "start"))
    part = (h >> np.uint64(32)) % np.uint64(parts)
    order = np.lexsort((start, doc, part))
    h, count, doc, start, part = h[order] & _LOW, count[order], doc[order], start[order], part[order]
    edge = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    columns: list[list] = [[] for _ in _NUMBERS]
    for a, b in zip(edge, np.append(edge[1:], len(h))):
        row = (*_once(doc[a:b]), h[a:b], count[a:b], start[a:b])
        for column, name, x in zip(columns, _NUMBERS, row):
            column.append(_shut(name, x))
    return _message(part[edge].astype(np.int64).tolist(), n, columns)


def _message(parts: list[int], n: int, columns: list[list]) -> pa.RecordBatch:
    arrays = [pa.array(parts, pa.int64()), pa.array([n] * len(parts), pa.int32()), *(pa.array(c, pa.binary()) for c in columns)]
    return pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in _SENT.split(", ")])


def _shut(name: str, x: np.ndarray) -> bytes:
    """The numbers, first bytes first, then the second ones and so on: bytes of one place compress together."""
    x = np.ascontiguousarray(x, _TYPES[name])
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T)
    return np.int64(x.nbytes).tobytes() + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _open(name: str, blob: bytes) -> np.ndarray:
    planes = pa.decompress(blob[8:], int(np.frombuffer(blob[:8], np.int64)[0]), "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(_TYPES[name].itemsize, -1).T).view(_TYPES[name]).ravel()


def _kept(n: int, rows: int, **columns: pa.Array) -> pa.Table:
    types = {"doc": pa.int64(), "at": pa.int64(), "lang": pa.string()}
    return pa.table({"n": pa.array(np.full(rows, n, np.int32)), **{k: columns.get(k, pa.nulls(rows, t)) for k, t in types.items()}})


def _once(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(each name once, how often it follows itself)."""
    run = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    return doc[run], np.diff(np.append(run, len(doc)))


def _runs(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(distinct keys, the bytes of the values of each); ``keys`` are sorted."""
    edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    offsets = (np.append(edge, len(keys)) * values.itemsize).astype(np.int32)
    return keys[edge], pa.Array.from_buffers(pa.binary(), len(edge), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])


def _by_text(table: pa.Table) -> pa.Table:
    """The pointers of one bucket, a row a text; words of langs (without a bucket) as they are."""
    if not table.column("bucket")[0].is_valid:
        none = {"doc": pa.nulls(table.num_rows, pa.int64()), "found": pa.nulls(table.num_rows, pa.binary())}
        return pa.table({**none, "at": table.column("at"), "lang": table.column("lang")})
    got = {c: [_open(c, x) for x in table.column(c).to_pylist()] for c in ("doc", "docs", "ats")}
    docs, ats = np.concatenate([np.repeat(d, s) for d, s in zip(got["doc"], got["docs"])]), np.concatenate(got["ats"])
    order = np.argsort(docs, kind="stable")
    doc, found = _runs(docs[order], ats[order])
    return pa.table({"doc": doc, "found": found, "at": pa.nulls(len(doc), pa.int64()), "lang": pa.nulls(len(doc), pa.string())})


def _packed(buckets: int, kept: pa.Table) -> pa.Table:
    """``kept`` with its pointers in one row for each bucket of texts."""
    pointers, others = kept.filter(pc.is_valid(kept.column("doc"))), kept.filter(pc.is_null(kept.column("doc")))
    out = [others.drop_columns("doc")]
    if pointers.num_rows:
        doc, at = (pointers.column(c).to_numpy() for c in ("doc", "at"))
        bucket = doc % buckets
        order = np.lexsort((doc, bucket))
        bucket, doc, at = bucket[order], doc[order], at[order]
        edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        columns: dict[str, list] = {"doc": [], "docs": [], "ats": []}
        for a, b in zip(edge, np.append(edge[1:], len(doc))):
            for (name, column), x in zip(columns.items(), (*_once(doc[a:b]), at[a:b])):
                column.append(_shut(name, x))
        n = pa.array(np.full(len(edge), pointers.column("n")[0].as_py(), np.int32))
        out.append(pa.table({"n": n, "bucket": bucket[edge], **{k: pa.array(v, pa.binary()) for k, v in columns.items()}}))
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    schema = pa.schema([(name, types[t]) for name, t in (f.split() for f in _KEPT.split(", "))])
    return pa.concat_tables([pa.table([t.column(f.name) if f.name in t.column_names else pa.nulls(t.num_rows, f.type) for f in schema], schema) for t in out])


def _frequent(least: int, table: pa.Table) -> pa.Table:
    """One part and n: the pointers of the fingerprints that occur ``least`` times.

    Pointers to one place of one text (copies, met in many chunks) are one pointer.
    """
    n = table.column("n")[0].as_py()
    if n == 0:  # words of each lang
        words: dict[bytes, int] = {}
        for name, x in zip(table.column("counts").to_pylist(), table.column("starts").to_pylist()):
            words[name] = words.get(name, 0) + int(x)
        return _kept(0, len(words), at=pa.array(list(words.values()), pa.int64()), lang=pa.array([w.decode() for w in words]))
    got = {k: [_open(k, x) for x in table.column(k).to_pylist()] for k in _NUMBERS}
    prints, counts, starts = (np.concatenate(got[k]) for k in ("prints", "counts", "starts"))
    doc = np.concatenate([np.repeat(d, s) for d, s in zip(got["doc"], got["docs"])])
    del got
    order = np.argsort(prints)
    h = prints[order]
    edge = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    total = np.add.reduceat(counts[order].astype(np.int64), edge)
    many = np.zeros(len(h), bool)
    many[order] = np.repeat(total >= least, np.diff(np.append(edge, len(h))))
    if not many.any():
        return _kept(n, 0)
    doc, counts, starts = doc[many], counts[many].astype(np.int64), starts[many]
    order = np.lexsort((starts, doc))
    doc, counts, starts = doc[order], counts[order], starts[order]
    place = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (starts[1:] != starts[:-1])]))
    doc, counts, starts = doc[place], np.add.reduceat(counts, place), starts[place]
    if counts.max() > _MOST:  # a count beyond its bits is several pointers
        times = -(-counts // _MOST)
        left = np.repeat(counts, times) - _MOST * (np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times))
        doc, starts, counts = np.repeat(doc, times), np.repeat(starts, times), np.minimum(left, _MOST)
    at = counts << _COUNT | n << _LENGTH | starts.astype(np.int64)
    return _kept(n, len(doc), doc=pa.array(doc), at=pa.array(at))


def _bit_table(lows: DataFrame) -> np.ndarray:
    """Bits of the low halves of frequent fingerprints; their number follows the fingerprints up to BITS."""
    total = lows.select(F.sum(F.octet_length("lows"))).first()[0] or 0
    bits = 1 << 12
    while bits < min(4 * total, BITS):
        bits *= 2

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("lows").to_pylist():
                at = np.unique(np.frombuffer(blob, np.uint32).astype(np.uint64) & np.uint64(bits - 1))
                word = (at >> np.uint64(6)).astype(np.int64)
                if not len(word):
                    continue
                edge = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
                own = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), edge).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(word[edge]), pa.array(own)], ["word", "bits"])

    table = lows.mapInArrow(words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[table.column("word").to_numpy()] = table.column("bits").to_numpy()
    return out.view(np.uint8)


def _read(parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases at the pointers of each text, added up over a chunk; words are joined by one space."""
    with reused_memory():
        codes: dict[str, int] = {}
        chunk, size = _Chunk(), 0
        for read in _phrases(codes, batches):
            for n, entries in read[1]:
                chunk.add(n, entries)
            size += read[0]
            if size >= CHUNK_BYTES:
                yield from (_phrase_rows(parts, n, codes, x) for n, x in chunk.taken())
                size = 0
        yield from (_phrase_rows(parts, n, codes, x) for n, x in chunk.taken())


def _phrases(codes: dict[str, int], batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple[int, pa.Table]]]]:
    """(bytes, (n, phrases) at the pointers) of each slice of the texts."""
    for batch in batches:
        lang, values = batch.column("lang").dictionary_encode(), batch.column("lang_value").to_numpy().view(np.uint64)
        code = np.array([codes.setdefault(x, len(codes)) for x in lang.dictionary.to_pylist()], np.int32)[lang.indices.to_numpy()]
        for first, rows, data, offsets in text_slices(batch.column("text"), READ_BYTES):
            own = slice(first, first + rows)
            yield len(data), _read_slice(Pieces(data, offsets), code[own], values[own], batch.column("found").slice(first, rows).to_pylist())


def _read_slice(p: Pieces, code: np.ndarray, lang: np.ndarray, found: list[bytes]) -> Iterator[tuple[int, pa.Table]]:
    pointers = np.frombuffer(b"".join(found), np.int64)
    text = np.repeat(np.arange(len(found)), [len(b) // pointers.itemsize for b in found])
    counts, length = pointers >> _COUNT, pointers >> _LENGTH & 15
    place = np.searchsorted(p.starts, (pointers & 0xFFFFFFFF) + p.starts[p.before[text]])
    values = word_values(p, lang)
    for n in np.unique(length).tolist():
        at = np.flatnonzero(length == n)
        prints = fingerprints(values, n)[place[at]]
        for a, b, phrase in _phrases_at(p, place[at], n):
            yield n, pa.table(dict(zip(_ENTRIES, [code[text[at[a:b]]], phrase, prints[a:b], counts[at[a:b]]])))


def _phrase_rows(parts: int, n: int, codes: dict[str, int], entries: pa.Table) -> pa.RecordBatch:
    """A row for every part and lang. Equal phrases of a lang have one fingerprint and so one part."""
    part = ((entries.column("print").to_numpy() >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
    entries = entries.append_column("part", pa.array(part)).sort_by([(c, "ascending") for c in ("part", "lang", "phrase")])
    part, code, count = (entries.column(c).to_numpy() for c in ("part", "lang", "count"))
    edge = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (code[1:] != code[:-1])]))
    phrases, names = entries.column("phrase"), list(codes)
    columns: list[list] = [[], []]
    for a, b in zip(edge, np.append(edge[1:], len(part))):
        text = "\n".join(phrases.slice(a, b - a).to_pylist()).encode()
        columns[0].append(np.int64(len(text)).tobytes() + pa.compress(text, "zstd", asbytes=True))
        columns[1].append(_shut("fs", count[a:b]))
    langs = pa.array([names[c] for c in code[edge]], pa.string())
    arrays = [pa.array(part[edge]), pa.array([n] * len(edge), pa.int32()), langs, *(pa.array(c, pa.binary()) for c in columns)]
    return pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in _READ.split(", ")])


def _by_phrase(least: int, table: pa.Table) -> pa.Table:
    """The phrases of one part and length that occur ``least`` times, counted by text."""
    rows = []
    for lang, blob, fs in zip(*(table.column(c).to_pylist() for c in ("lang", "phrases", "fs"))):
        text = pa.decompress(blob[8:], int(np.frombuffer(blob[:8], np.int64)[0]), "zstd", asbytes=True).decode()
        phrase = pa.array(text.split("\n"), pa.string())
        rows.append(pa.table({"lang": pa.array([lang] * len(phrase), pa.string()), "phrase": phrase, "f": _open("fs", fs)}))
    out = pa.concat_tables(rows).group_by(["lang", "phrase"], use_threads=False).aggregate([("f", "sum")])
    out = out.filter(pc.greater_equal(out.column("f_sum"), least))
    n = pa.array(np.full(out.num_rows, table.column("n")[0].as_py(), np.int32))
    return pa.table({"lang": out.column("lang"), "n": n, "phrase": out.column("phrase"), "f": out.column("f_sum")})


def _phrases_at(p: Pieces, place: np.ndarray, n: int) -> Iterator[tuple[int, int, pa.Array]]:
    """(from, to, phrases of n words at the places from..to), about READ_BYTES at a time."""
    last = np.cumsum(p.stops[place + n - 1] - p.starts[place])
    a = 0
    while a < len(place):
        b = max(a + 1, int(np.searchsorted(last, (last[a - 1] if a else 0) + READ_BYTES, side="right")))
        yield a, b, _joined(p, place[a:b], n)
        a = b


def _joined(p: Pieces, place: np.ndarray, n: int) -> pa.Array:
    words = (place[:, None] + np.arange(n)).ravel()
    size = p.stops[words] - p.starts[words] + 1  # a space after each
    ends = np.cumsum(size)
    within = np.arange(ends[-1]) - np.repeat(ends - size, size)
    out = np.where(within == np.repeat(size, size) - 1, np.uint8(32), p.data[np.minimum(np.repeat(p.starts[words], size) + within, len(p.data) - 1)])
    keep = np.ones(len(out), bool)
    keep[ends[n - 1 :: n] - 1] = False  # but the last
    offsets = np.concatenate([[0], ends[n - 1 :: n] - np.arange(1, len(place) + 1)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(place), pa.py_buffer(offsets.tobytes()), pa.py_buffer(out[keep].tobytes()))


def _named(rows: DataFrame) -> DataFrame:
    """``rows`` with ``doc``, a 64-bit name of (lang, text) that no two of them share: a seed under which two do is passed over."""
    for seed in range(100):
        doc, check = F.xxhash64(F.lit(seed), "lang", "text"), F.xxhash64("text", "lang", F.lit(seed))
        named = rows.select("lang", "text", doc.alias("doc"), F.xxhash64("lang", F.lit(13)).alias("lang_value"))
        both = rows.select(doc.alias("doc"), check.alias("check")).groupBy("doc").agg(F.min("check").alias("a"), F.max("check").alias("b"))
        if both.where("a <> b").isEmpty():
            return named
    raise RuntimeError("no seed names all texts apart")


@contextlib.contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a written table go when it is written, not when the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def frequent_phrases(spark: SparkSession, docs: DataFrame, longest: int = 3, least: int = 10) -> tuple[DataFrame, DataFrame]:
    """(lang, n, phrase, f of every phrase of 1 to ``longest`` words that occurs ``least`` times; lang, n of all words), written."""
    prepare(spark)
    if not 1 <= longest <= 15:
        raise ValueError("phrases have 1 to 15 words")
    with _shuffles_freed(spark):
        return _frequent_phrases(spark, docs, longest, least)


def _frequent_phrases(spark: SparkSession, docs: DataFrame, longest: int, least: int) -> tuple[DataFrame, DataFrame]:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    rows = docs.where("text is not null and text != ''").select(lang.alias("lang"), F.col("text").cast("string").alias("text"))
    parts = max(1, -(-(rows.select(F.sum(F.octet_length("text"))).first()[0] or 0) // PART_BYTES))
    named = _named(rows)
    tables: list = []
    for n in range(1, longest + 1):

        def screened(batches: Iterator[pa.RecordBatch], n: int = n, shorter=tables[-1] if tables else None) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            return _screened(parts, n, None if shorter is None else shorter.value, batches)

        def reaching(table: pa.Table) -> pa.Table:
            return _may_reach(least, table)

        lows = written(spark, named.mapInArrow(screened, _SCREENED).groupBy("part").applyInArrow(reaching, "lows binary"), f"lows-{n}")
        tables.append(spark.sparkContext.broadcast(_bit_table(lows)))

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _sent(parts, [t.value for t in tables], batches)

    def frequent(table: pa.Table) -> pa.Table:
        with reused_memory():
            return _packed(parts, _frequent(least, table))

    kept = named.mapInArrow(sent, _SENT).groupBy("part", "n").applyInArrow(frequent, _KEPT)
    # as many buckets of texts as parts: both follow the bytes of text
    kept = written(spark, kept.groupBy("bucket").applyInArrow(_by_text, _FOUND), "pointers")
    words = kept.where("found is null").groupBy("lang").agg(F.sum("at").alias("n"))
    pointers = kept.where("found is not null").select("doc", "found")
    # copies of a text under one lang are one text: one row of each is read
    texts = named.groupBy("doc").agg(*(F.first(c).alias(c) for c in ("lang", "text", "lang_value")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _read(parts, batches)

    def by_phrase(table: pa.Table) -> pa.Table:
        return _by_phrase(least, table)

    found = pointers.join(texts, "doc").select("lang", "lang_value", "text", "found").mapInArrow(read, _READ)
    phrases = found.groupBy("part", "n").applyInArrow(by_phrase, _PHRASES)
    return written(spark, phrases, "phrases"), words


def collocations(spark: SparkSession, docs: DataFrame, longest: int = 3, least: int = 10, best: int = 2000, covered: int = 50) -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n, score: each lang's ``best`` phrases of 2 to ``longest`` words.

    A phrase occurs ``a`` >= ``least`` times within pieces of texts. Of its cuts into two the one of the lowest
    floor(1000000 * a * a / (l * r)) counts, l and r being what its sides occur (ties: the first cut). A phrase that
    lies in a longer one of ``covered`` percent or more of its count is left out. Order: score, a, then the
    phrase's bytes. n is the number of all words of the lang.

    Null texts, empty ones and texts without words add nothing; a null lang is ``und``; ids play no part, repeated rows count
    each; empty tables give no row; other columns are ignored.
    """
    phrases, words = frequent_phrases(spark, docs, longest, least)
    long = phrases.where("n > 1").select("lang", "n", "phrase", F.col("f").alias("a"))
    split = F.split("phrase", " ")
    # the highest count of a longer phrase around each phrase; those of the most words have none
    around = None
    for m in range(2, longest):
        inner = F.explode(F.transform(F.sequence(F.lit(1), F.col("n") - m + 1), lambda i: F.array_join(F.slice(split, i, F.lit(m)), " ")))
        own = long.where(F.col("n") > m).select("lang", inner.alias("phrase"), "a")
        around = own if around is None else around.unionByName(own)
    if around is not None:
        around = around.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
        apart = long.where(F.col("n") < longest).join(around, ["lang", "phrase"], "left")
        apart = apart.where(F.expr(f"longer is null or 100 * longer < {int(covered)} * a")).select(*long.columns)
        long = apart.unionByName(long.where(F.col("n") == longest))
    k = F.explode(F.sequence(F.lit(1), F.col("n") - 1))
    cuts = long.select("lang", "n", "phrase", "a", k.alias("k"))
    # a phrase travels as its two sides
    left, right = F.array_join(F.slice(split, F.lit(1), F.col("k")), " "), F.array_join(F.slice(split, F.col("k") + 1, F.col("n")), " ")
    cuts = cuts.select("lang", F.col("n").cast("byte").alias("n"), left.alias("left"), right.alias("right"), "a", F.col("k").cast("byte").alias("k"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(phrases.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    score = F.expr("cast(cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0)) as decimal(38,0)) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    cuts = cuts.select("lang", "n", F.concat_ws(" ", "left", "right").alias("phrase"), "a", "k", "l", "r", score.alias("score"))
    names = ["lang", "phrase", "a", "score", "l", "r"]
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    several = cuts.where("n > 2").groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r")
    scored = cuts.where("n = 2").select(*names).unionByName(several.select(*names))  # two words have one cut
    order = [F.desc("score"), F.desc("a"), "phrase"]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    first = scored.withColumn("place", F.row_number().over(Window.partitionBy("lang", salt).orderBy(*order))).where(F.col("place") <= best)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= best)
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", words["n"], "score")


def collocations_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark, spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text"))


SQL = """
with t as (
    select coalesce(lang, 'und') as lang, row_number() over () as d,
           regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\n-\\r]') as pieces
    from documents where text is not null
), p as (
    select lang, d, unnest(pieces) as piece, generate_subscripts(pieces, 1) as at from t
), s as (
    select lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda w: w <> '') as w from p
), c as (
    select lang, sum(len(w)) as n from s group by lang
), g as (
    select lang, 1 as m, unnest(w) as phrase from s
    union all
    select lang, 2, unnest(list_transform(range(1, len(w)), lambda i: array_to_string(w[i : i + 1], ' '))) from s where len(w) >= 2
    union all
    select lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i : i + 2], ' '))) from s where len(w) >= 3
), f as (
    select lang, m, phrase, cast(count(*) as hugeint) as f from g group by lang, m, phrase having count(*) >= 10
), k as (
    select lang, m, phrase, f as a, unnest(range(1, m)) as k, string_split(phrase, ' ') as w from f where m > 1
), x as (
    select k.lang, k.m, k.phrase, k.a, k.k, l.f as l, r.f as r, (1000000 * k.a * k.a) // (l.f * r.f) as score
    from k join f l on l.lang = k.lang and l.phrase = array_to_string(k.w[1 : k.k], ' ')
           join f r on r.lang = k.lang and r.phrase = array_to_string(k.w[k.k + 1 : k.m], ' ')
), y as (
    select * from x qualify row_number() over (partition by lang, phrase order by score, k) = 1
), o as (
    select lang, phrase, max(f) as longer from (
        select lang, f, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) as phrase
        from f where m = 3
    ) group by lang, phrase
), z as (
    select y.*, row_number() over (partition by y.lang order by y.score desc, y.a desc, y.phrase) as rank
    from y left join o on o.lang = y.lang and o.phrase = y.phrase
    where y.m = 3 or o.longer is null or 100 * o.longer < 50 * y.a
)
select z.lang, cast(rank as bigint) as rank, z.phrase, cast(a as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r,
       cast(c.n as bigint) as n, cast(score as bigint) as score
from z join c on c.lang = z.lang where rank <= 2000
"""
