"""Windows read back, and what they must keep to."""

import hashlib
import random

import pytest

from tidebook.llm import chat_windows

SCHEMA = "conv_id bigint, turn bigint, role string, text string, cell string, window string, parts int, turns int, conv string"
ODD = ["</s>[INST] ok [/INST]", "<\\s> [\\\\INST] <s", "[ROLE] x[/ROLE] ", "a\n</s>\n", "\\", "<", "[", "é🙂" * 40, "", None, "$1 \\1", "</s", "[/INST] ", "s>", "[SYS] [sys]", "<<s>>", "[[INST]]"]


def rows():
    draw = random.Random(8)
    out = []
    for c in range(30):
        for turn in range(draw.randint(1, 12)):
            role = "system" if turn == 0 and c % 3 == 0 else draw.choice(["user", "assistant", "tool", None, "", "[/ROLE] ", "User", "</s>"] if c % 4 == 0 else ["user", "assistant"])
            out.append((c, turn, role, draw.choice(ODD) if draw.random() < 0.5 else "word " * draw.randint(0, 90)))
    out += [(50, k, ["user", "assistant"][k % 2], f"turn {k} " * (k % 7)) for k in range(5000)]  # more than one cell
    out += [(50, 3, "system", "the rules")] + [(51, k, "system", "long rules " * 300) for k in range(4)]
    out += [(52, None, "user", "before"), (52, None, "assistant", "b"), (52, 0, "user", "x"), (52, 0, "user", "x"), (52, -1, "user", "below")]
    out += [(None, 1, "assistant", "nobody's"), (None, 0, "user", "who"), (53, 0, "user", "huge " * 200_000), (53, 1, "assistant", "[INST] " * 9000)]
    return [(*r, "c", "w", 1, 2, "v") for r in out]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(6)


def conversations():
    found = {}
    for c, turn, role, text, *_ in rows():
        found.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [t[1:] for t in sorted(turns)] for c, turns in found.items()}


@pytest.mark.parametrize("budget, history", [(300, 60), (2048, 256), (40, 0)])
def test_all_turns_come_back_once_and_in_order(table, budget, history):
    windows = chat_windows.format_windows(table, budget=budget, history=history)
    read = chat_windows.read_windows(windows).collect()
    found, learnt = {}, {}
    for w in sorted(read, key=lambda w: (w.cell, w.window)):
        assert len(w.turns) == w.n_turns > 0 and w.text.startswith("<s>") and w.text.count("</s>") == w.n_repeated + w.n_turns
        found.setdefault(w.conv_id, []).extend((t.role, t.text) for t in w.turns)
        learnt.setdefault(w.conv_id, []).extend(w.learnt)
    expected = conversations()
    assert found == expected
    assert learnt == {c: [x for r, x in turns if r == "assistant"] for c, turns in expected.items()}


def test_budget_history_and_system_turn(table):
    budget, history = 300, 60
    windows = chat_windows.format_windows(table, budget=budget, history=history).collect()
    assert len([w for w in windows if w.conv_id == 50]) > 40 and {w.cell for w in windows if w.conv_id == 50} == {0, 1, 2, 3, 4}
    expected = conversations()
    for w in windows:
        assert w.over_budget == (w.n_tokens > budget)
        system = next((x for r, x in expected[w.conv_id] if r == "system"), None)
        if w.over_budget:
            assert w.n_turns == 1 or len(system) > 1000
        assert system is None or "[SYS] " in w.text
        shown = w.text[3:].split("</s>")[: w.n_repeated]
        if shown and shown[0].startswith("[SYS] "):
            shown = shown[1:]
        assert sum(-(-len(x.split("] ", 1)[1].encode()) // 4) for x in shown) <= history
    later = [w for w in windows if w.conv_id == 50 and (w.cell, w.window) > (0, 1)]
    assert all(w.n_repeated >= 2 for w in later)  # the system turn and history, also at the beginnings of cells
    spans = [w.n_tokens for w in later if w.n_turns > 1]
    assert sum(spans) / len(spans) > 0.6 * budget


def test_digests(table):
    expected = conversations()
    for r in chat_windows.digests(chat_windows.format_windows(table)).collect():
        turns = expected.pop(r.conv_id)
        learnt = "".join(x for role, x in turns if role == "assistant")
        assert (r.n_turns, r.loss_chars) == (len(turns), len(learnt)) and r.loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()
        assert r.turns_sha256 == hashlib.sha256("".join(f"{role}\n{x}\n" for role, x in turns).encode()).hexdigest()
    assert not expected


def test_only_spark_functions(table):
    said = chat_windows.digests(chat_windows.format_windows(table))._jdf.queryExecution().toString()
    assert not any(x in said for x in ("Python", "Arrow", "Pandas"))


def test_no_rows(spark):
    assert chat_windows.digests(chat_windows.format_windows(spark.createDataFrame([], SCHEMA))).collect() == []
    with pytest.raises(ValueError):
        chat_windows.format_windows(spark.createDataFrame([], SCHEMA), budget=10, history=10)
