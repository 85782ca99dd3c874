"""Pieces cover every id once, sequences are gapless, ids are those of the tokenizers library."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fleetlens.llm import packing

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))

TEXTS = [
    None, "", " ", "a", "  two  spaces", "a \n b", "line\nline\n\n x ", "it 's, don't. <|endoftext|> end", "<|endoftext|>",
    "日本 語 é ñ", "\x85 a\x85 b", "tab\t x\x1c y", "word " * 3000, "x" * 5000, "12345 6,7 8.9\r\n \r\nz", "a b ",
]


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]


@pytest.mark.parametrize("text", TEXTS)
def test_encoder_equals_the_library(text):
    ids = packing.public_encoder()(text or "")
    assert np.frombuffer(ids, "<u4").tolist() == ids_of(text)[:-1]


def test_cut_covers_and_fits_classes():
    for n in range(1, 3000):
        pieces = packing.cut(n)
        assert sum(pieces) == n
        assert all(1 <= p <= packing.CAPACITY // packing.CLASS_OF[p] for p in pieces)


def check(docs, rows):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append(r)
    for pieces in by_sequence.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= packing.CAPACITY
    want = defaultdict(list)
    for i, t in docs:
        ids = ids_of(t)
        want[i].append((len(ids), np.array(ids, "<u4").tobytes()))
    assert set(want) == set(by_doc)
    for i, texts in want.items():
        # rows of one id: every text is there, cut without gaps
        got = sorted((r["doc_tokens"], r["start"], r["length"], r["ids_crc32"]) for r in by_doc[i])
        assert sum(g[2] for g in got) == sum(n for n, _ in texts)
        if len(texts) == 1:
            end = 0
            for n, start, length, crc in got:
                assert (n, start) == (texts[0][0], end)
                assert crc == zlib.crc32(texts[0][1][4 * start : 4 * (start + length)])
                end += length
    return 1 - sum(r["length"] for r in rows) / (packing.CAPACITY * len(by_sequence))


def test_pack_edges(spark, frame):
    docs = list(enumerate(TEXTS)) + [(3, "again a"), (3, "a"), (None, "no id"), (None, None)]
    check(docs, packing.pack(spark, frame(docs)).collect())
    assert packing.pack(spark, frame([])).count() == 0


def test_pack_wastes_little(spark, frame):
    docs = [(i, "some words of a text " * (1 + i * 7 % 90)) for i in range(600)]
    for parts in (1, 40):
        waste = check(docs, packing.pack(spark, frame(docs).repartition(parts)).collect())
        assert waste < 0.02
