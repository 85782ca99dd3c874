"""Language identification with more labels than one block of the model holds."""

import random

import numpy as np
import pyarrow as pa
import pytest

from fleetlens.llm import lang_id
from fleetlens.llm.common import text_slices

LANGUAGES = 150


def word(lang, r):
    """A word of a language: its letters are its own."""
    return "".join(chr(0x4E00 + 40 * lang + r.randrange(30)) for _ in range(4))


@pytest.fixture(scope="module")
def labelled():
    r = random.Random(2)
    rows = []
    for lang in range(LANGUAGES):
        # frequencies fall with the number of the language
        rows += [(" ".join(word(lang, r) for _ in range(12)), f"x{lang:03}") for _ in range(4 + (LANGUAGES - lang) // 30)]
    return rows


def posterior(labelled, texts):
    """Predictions and posterior probabilities by one matrix of all languages."""
    names = sorted({x for _, x in labelled}, key=lambda x: (-sum(y == x for _, y in labelled), x))
    counts = np.zeros((lang_id.BUCKETS, len(names)))

    def buckets(text):
        for _, _, data, offsets in text_slices(pa.array([text])):
            points, at = lang_id._code_points(data, offsets)
            return np.concatenate([b[inside] for b, inside in lang_id.grams(points, at)])

    for text, lang in labelled:
        np.add.at(counts, (buckets(text), names.index(lang)), 1)
    log_prob = (np.log(counts + 0.5) - np.log(counts.sum(0) + 0.5 * lang_id.BUCKETS)).astype(np.float32)
    prior = np.log(np.array([sum(y == x for _, y in labelled) for x in names]) / len(labelled))
    out = []
    for text in texts:
        s = prior + log_prob[buckets(text)].astype(float).sum(0)
        out.append((names[s.argmax()], 1 / np.exp(s - s.max()).sum()))
    return out


@pytest.mark.parametrize("pass_blocks", [8, 1])
def test_every_label_is_learned(spark, labelled, monkeypatch, pass_blocks):
    monkeypatch.setattr(lang_id, "PASS_BLOCKS", pass_blocks)
    model = lang_id.train(spark.createDataFrame(labelled, "text string, lang string"))
    assert len(model.languages) == LANGUAGES
    r = random.Random(3)
    # whole texts of every language, and single characters that leave the language open
    texts = [" ".join(word(i, r) for _ in range(6)) for i in range(LANGUAGES)] + [word(i, r)[:1] for i in range(0, LANGUAGES, 7)] + ["a"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(map(tuple, lang_id.identify(spark, docs, model).select("doc_id", "lang_pred", "score").collect()))
    assert [x for _, x, _ in got[:LANGUAGES]] == [f"x{i:03}" for i in range(LANGUAGES)]
    want = posterior(labelled, texts)
    assert [x for _, x, _ in got] == [x for x, _ in want]
    assert [s for *_, s in got] == pytest.approx([s for _, s in want])


def test_counts_of_short_texts(labelled):
    """One slice with more labels than a block has counts the same as label by label."""

    def counted(rows):
        batch = pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows]), pa.array([x for _, x in rows])], ["text", "lang"])
        out = {}
        for b in lang_id._counted(iter([batch])):
            for lang, bucket, n in zip(*(b.column(i).to_pylist() for i in range(3))):
                out[lang, bucket] = out.get((lang, bucket), 0) + n
        return out

    want = {}
    for name in sorted({x for _, x in labelled}):
        want |= counted([r for r in labelled if r[1] == name])
    assert counted(labelled) == want
