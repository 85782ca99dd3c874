import re
from collections import Counter

import numpy as np

from fleetlens.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string, n int, phrase string, doc long, found string"


def brute(rows, longest=3, least=10, best=2000, covered=50):
    """(lang, rank, phrase, a, l, r, n, score) by counting tuples of words."""
    f, n = {}, Counter()
    for lang, text in rows:
        if text is None:
            continue
        lang = "und" if lang is None else lang
        count = f.setdefault(lang, Counter())
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text)
        for piece in re.split("[.,;:!?\\x0a-\\x0d]", lower):
            words = [w for w in re.split("[\\x20\\x09]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    count[tuple(words[i : i + k])] += 1
    out = []
    for lang, count in f.items():
        scored = []
        for phrase, a in count.items():
            if len(phrase) < 2 or a < least:
                continue
            inside = [
                x for x, b in count.items() if len(x) > len(phrase) and b >= least and 100 * b >= covered * a
                and any(x[i : i + len(phrase)] == phrase for i in range(len(x) - len(phrase) + 1))
            ]
            if inside:
                continue
            cuts = [(1000000 * a * a // (count[phrase[:k]] * count[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            scored.append((score, a, " ".join(phrase), count[phrase[:k]], count[phrase[k:]]))
        scored.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i, p, a, le, r, n[lang], s) for i, (s, a, p, le, r) in enumerate(scored[:best], 1)]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame([(7, t, lang, 1, "x", 3, "f") for lang, t in rows], SCHEMA)
    got = C.collocations(spark, df, **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in got.collect())


def words(rng, vocabulary, n):
    marks = np.array([" "] * 12 + ["  ", "\t", ". ", ",", "\n", "! "])
    return "".join(w + m for w, m in zip(rng.choice(vocabulary, n), rng.choice(marks, n)))


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(C, "SLICE_BYTES", 2000)
    monkeypatch.setattr(C, "PART_BYTES", 4000)
    rng = np.random.default_rng(3)
    vocabulary = np.array("a b über ÉTÉ the The new york city x-y 日本   \x1f".split(" "))
    rows = [(lang, words(rng, vocabulary, int(rng.integers(1, 120)))) for lang in ["en", "de", None, "en"] * 12]
    rows += [("en", None), ("en", ""), ("en", " \t\n.,"), ("fr", "one two. three"), ("und", "new york city " * 30), ("", "a b " * 20)]
    rows += [("de", words(rng, vocabulary, 5000)), *[rows[0]] * 15]  # a long text and copies
    want = brute(rows)
    assert {r[0] for r in want} >= {"en", "de", "und", ""}
    assert run(spark, rows) == want


def test_longer_phrases_and_few_places(spark):
    rows = [("en", "to be or not to be that is the question " * 4), ("en", "to be or not, to be")] * 3
    assert run(spark, rows, longest=5, least=3, best=4, covered=80) == brute(rows, 5, 3, 4, 80)


def test_empty_table_and_no_words(spark):
    assert run(spark, []) == []
    assert run(spark, [("en", None), (None, "")]) == []


def test_ends_of_pieces_part_words(spark):
    rows = [("en", "ab " + mark + " cd") for mark in ".,;:!?\x0a\x0b\x0c\x0d"] * 2
    assert run(spark, rows) == []
    assert [r[2] for r in run(spark, [("en", "AB \t cd")] * 10)] == ["ab cd"]


def test_colliding_fingerprints_stay_apart(spark, monkeypatch):
    """All values collide in 3 bits: the counts must be those of the texts all the same."""
    monkeypatch.setattr(C, "mix64", lambda x: x & np.uint64(7))
    rng = np.random.default_rng(4)
    texts = [words(rng, np.array(list("abcdefghijkl")), 60) for _ in range(40)]
    pieces = C.Pieces(np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0] + [len(t) for t in texts]))
    values = C.word_values(pieces, np.zeros(len(texts), np.uint64))
    numbers, lead = C.exact_words(pieces, values)
    assert sorted(numbers[lead].tolist()) == sorted(set(numbers.tolist()))
    names = [pieces.data[a:b].tobytes() for a, b in zip(pieces.starts, pieces.stops)]
    assert len(set(zip(numbers.tolist(), names))) == len(set(names)) == len(set(numbers.tolist()))
    for n in (1, 2, 3):
        at = np.flatnonzero(pieces.within(n))
        _, count, first = C.counted(C.fingerprints(values, n)[at], at, numbers, n)
        want = Counter(tuple(names[i : i + n]) for i in at)
        assert {tuple(names[i : i + n]): c for i, c in zip(first, count.tolist())} == want


def test_parts_with_collisions_keep_every_pointer(spark):
    """Two phrases under one fingerprint reach the least count together: both are read and counted by text."""
    import pyarrow as pa

    row = {"part": 0, "n": 2, "doc": np.zeros(1), "docs": np.array([2]), "prints": np.array([5, 5], np.uint64), "counts": np.array([4, 9]), "starts": np.array([0, 30])}
    table = pa.table({k: [v if k in ("part", "n") else C._shut(k, v)] for k, v in row.items()})
    out = [r["at"] for r in C._frequent(10, table).to_pylist() if r["at"] is not None]
    assert [(x >> C._COUNT, x >> C._LENGTH & 15, x & 0xFFFFFFFF) for x in out] == [(4, 2, 0), (9, 2, 30)]
    row["counts"] = np.array([C._MOST, 3 * (C._MOST // 2)])
    row["starts"] = np.array([7, 7])
    table = pa.table({k: [v if k in ("part", "n") else C._shut(k, v)] for k, v in row.items()})
    out = [r["at"] for r in C._frequent(10, table).to_pylist() if r["at"] is not None]
    assert sum(x >> C._COUNT for x in out) == C._MOST + 3 * (C._MOST // 2) and {x & 0xFFFFFFFF for x in out} == {7}


def test_pointers_travel_packed_and_come_back():
    import pyarrow as pa
    import pyarrow.compute as pc

    doc = np.array([7, 7, -3, 12, 12, 12, 5], np.int64)
    at = np.arange(len(doc), dtype=np.int64)
    table = pa.concat_tables([C._kept(2, len(doc), doc=pa.array(doc), at=pa.array(at)), C._kept(2, 1, prints=pa.array([b"x" * 8], pa.binary()))])
    packed = C._packed(2, table)
    rows = [r for r in packed.to_pylist() if r["docs"] is not None]
    assert len(rows) == 2 and packed.num_rows == 3  # a row a bucket, not a row a pointer
    back = {}
    for bucket in (0, 1):
        for r in C._by_text(packed.filter(pc.equal(packed.column("bucket"), bucket))).to_pylist():
            back[r["doc"]] = np.frombuffer(r["found"], np.int64).tolist()
    assert back == {7: [0, 1], -3: [2], 12: [3, 4, 5], 5: [6]}
    assert C._packed(2, C._kept(0, 1, at=pa.array([4]), lang=pa.array(["en"]))).select(["n", "at", "lang"]).to_pylist() == [{"n": 0, "at": 4, "lang": "en"}]


def arrow_batch(texts, lang="en"):
    import pyarrow as pa

    columns = [pa.array([lang] * len(texts)), pa.array(texts), pa.array(range(len(texts)), pa.int64()), pa.array([77] * len(texts), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["lang", "text", "doc", "lang_value"])


def test_slices_of_a_chunk_send_a_phrase_once(monkeypatch):
    """What is sent, kept and read follows the chunks and not the slices: one pointer of each phrase a chunk."""
    rng = np.random.default_rng(6)
    texts = [words(rng, np.array(["a", "b", "über", "the", "new", "york"]), 80) for _ in range(40)]
    want = {n: Counter() for n in (1, 2, 3)}
    for text in texts:
        for piece in re.split("[.,;:!?\\x0a-\\x0d]", text):
            w = piece.split()
            for n in want:
                want[n].update(" ".join(w[i : i + n]) for i in range(len(w) - n + 1))
    monkeypatch.setattr(C, "SLICE_BYTES", 700)
    monkeypatch.setattr(C, "HELD", 50)
    tables = [np.full(512, 255, np.uint8)] * 3  # every bit is set
    rows = [r for b in C._messages(2, tables, iter([arrow_batch(texts[:25]), arrow_batch(texts[25:])])) for r in b.to_pylist()]
    sent = {n: [r for r in rows if r["n"] == n] for n in want}
    for n in want:
        assert len(sent[n]) <= 2  # a row for every part
        assert sum(len(C._open("prints", r["prints"])) for r in sent[n]) == len(want[n])
        assert sum(int(C._open("counts", r["counts"]).sum()) for r in sent[n]) == sum(want[n].values())
    assert sum(int(r["starts"]) for r in rows if r["n"] == 0) == sum(want[1].values())


def test_screen_keeps_every_frequent_phrase(monkeypatch):
    """Counts of all chunks are added up by part; nothing that reaches the least count goes missing."""
    import pyarrow as pa

    texts = ["x y z. " * 3 + f"only{i} here{i}" for i in range(30)]
    monkeypatch.setattr(C, "SLICE_BYTES", 60)
    monkeypatch.setattr(C, "CHUNK_BYTES", 200)
    rows = pa.Table.from_batches(list(C._screened(1, 2, None, iter([arrow_batch(texts)]))))
    assert 1 < rows.num_rows < 30
    lows = np.frombuffer(C._may_reach(10, rows).column("lows")[0].as_py(), np.uint32)
    p = C.Pieces(np.frombuffer(b"x y z", np.uint8), np.array([0, 5]))
    assert set(lows.tolist()) == {int(h) & 0xFFFFFFFF for h in C.fingerprints(C.word_values(p, np.array([77], np.uint64)), 2)}
