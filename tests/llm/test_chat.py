"""Windows read back to the turns, and keep to their budget."""

import hashlib
import random

import pytest

from fleetlens.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, window int, piece string, span long"


def conversations(seed=2):
    r = random.Random(seed)
    parts = ["<s>", "</s>\n", "[INST]", "\\", "]", "\n", "é", "日本", "word ", "<|", "😀", "$1", "\\\\<", "x" * 40]
    rows = []
    for c in range(30):
        if c % 3 == 0:
            rows.append((c, 0, "system", "be kind " * (c % 5)))
        for t in range(1, r.randrange(2, 25)):
            text = "".join(r.choice(parts) for _ in range(r.randrange(0, 40)))
            rows.append((c, t * (300 if c % 4 == 0 else 1), "assistant" if t % 2 == 0 else "user", text))
    rows += [(100, 0, "user", "x" * 9000), (100, 1, "assistant", "y" * 5), (100, 2, "assistant", "z" * 9000)]
    rows += [(101, 0, None, None), (101, 1, "assistant", None), (102, None, "a]\nb\\", "t"), (102, None, "a]\nb\\", "t")]
    rows += [(103, 1, "assistant", "same"), (103, 1, "assistant", "same"), (None, 0, "assistant", "no id")]
    return rows


@pytest.fixture()
def table(spark):
    return lambda rows: spark.createDataFrame([(*r, 7, "p", 8) for r in rows], SCHEMA)


def wanted(rows):
    out = {}
    for c in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0, role or "", text or "") for i, t, role, text in rows if i == c))
        loss = "".join(x[3] for x in turns if x[2] == "assistant")
        whole = "".join(f"{x[2]}\n{x[3]}\n" for x in turns)
        out[c] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("budget", [chat.Budget(), chat.Budget(120, 40), chat.Budget(30, 0), chat.Budget(1, 1)])
def test_read_back(table, budget):
    rows = conversations()
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.read_back(chat.windows(table(rows), budget)).collect()}
    assert got == wanted(rows)


def test_windows_keep_to_the_budget(table):
    budget = chat.Budget(200, 50)
    rows = [r for r in conversations() if r[0] != 100]
    windows = chat.windows(table(rows), budget).collect()
    several = [w for w in windows if w["window"] > 0]
    assert several
    for w in windows:
        turns = w["text"].split(chat.CLOSE)[:-1]
        assert len(turns) == w["turns"]
        tokens = [(len(t) + len(chat.CLOSE) + 3) // 4 for t in turns]
        own = tokens[w["repeats"] :]
        assert sum(tokens) <= budget.window or max(own) * 2 > budget.window - budget.history - tokens[0]
        # the mask holds assistant turns of the span only
        marks = [w["text"][m["start"] : m["start"] + m["length"]] for m in w["loss"]]
        assert marks == [t.split(chat.HEADER_END, 1)[1] for t in turns[w["repeats"] :] if t.startswith("<s>[assistant]\n")]
    for w in several:
        if w["conv_id"] % 3 == 0 and w["conv_id"] < 30:
            assert w["text"].startswith("<s>[system]\n") and w["repeats"] >= 1


def test_no_control_string_in_a_text(table):
    rows = [(1, 0, "user", chat.CONTROLS), (1, 1, "assistant", chat.CONTROLS)]
    (window,) = chat.windows(table(rows)).collect()
    assert window["text"].count("</s>") == 2 and "[INST]" not in window["text"] and "[/INST]" not in window["text"]


def test_empty(table):
    assert chat.read_back(chat.windows(table([]))).count() == 0


def test_plan_has_no_python(table):
    plan = chat.read_back(chat.windows(table(conversations())))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
