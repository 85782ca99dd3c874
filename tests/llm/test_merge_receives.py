"""The windows left to the transforms, and what the transforms decide of them."""

import random

import brute
import pytest

from fleetlens.llm import suffix_dedup


@pytest.mark.parametrize("length", [200, 40])
def test_contested_windows_reach_the_merge(spark, frame, rows, monkeypatch, length):
    r = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz "

    def text(n):
        return "".join(r.choice(letters) for _ in range(n))

    # a passage in full and less some bytes at either end, so that its edges differ from place to place
    passage = text(3 * length)
    docs = [(i, text(30) + passage[r.randrange(9) : len(passage) - r.randrange(9)] + text(30)) for i in range(20)]
    left = []
    written = suffix_dedup.written

    def counting(spark, df, name):
        out = written(spark, df, name)
        if name == "windows":
            left.append(out.count())
        return out

    monkeypatch.setattr(suffix_dedup, "written", counting)
    got = rows(suffix_dedup.suffix_dedup(spark, frame(docs), length), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(brute.suffix_dedup(docs, length))
    assert left[0] > 0
