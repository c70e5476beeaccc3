"""The trie against one built of all rebuilt conversations at once."""

import hashlib
import random
import zlib

import pytest

from tidebook.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, base bigint, depth int, split boolean, part string"


def made():
    draw = random.Random(4)
    rows = []
    for c in [*range(-12, 40), 57, 103, 110, 205, 210, 211]:
        if c in (0, 20):  # bases that aren't there
            continue
        same = draw.random() < 0.5  # with turns that many share
        for turn in range(draw.randint(1, 9)):
            role = ["user", "assistant", None][turn % 2 if c % 5 else 2]
            rows.append((c, turn, role, f"{turn} shared" if same or turn < 3 and c % 3 else draw.choice(["é" * turn, "", None, "own"])))
    rows += [(30, None, "user", "before all"), (31, None, "system", None), (None, 1, "user", "nobody's"), (None, 0, "user", "0 shared"), rows[9], rows[9]]
    rows += [(110, k, "user", f"long {k}") for k in range(10, 300)] + [(211, k, "user", f"long {k}") for k in range(10, 300)]
    return [(c, t, r, x, 1, 2, True, "p") for c, t, r, x in rows]


def plain(rows, family, most):
    convs = {}
    for c, turn, role, text, *_ in rows:
        role, text = role or "", text or ""
        digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
        convs.setdefault(c, []).append(((turn is not None, turn or 0), digest, role, text))
    convs = {c: [(r, x) for *_, r, x in sorted(t, key=lambda t: t[:2])] for c, t in convs.items()}
    nodes = {}
    for c, turns in convs.items():
        h = zlib.crc32(str("" if c is None else c).encode()) % most
        base = None if c is None else c - (abs(c) % family) * (1 if c >= 0 else -1)
        path = tuple(([] if base is None else convs.get(base, [])[:h]) + turns[h:])
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append((c, d == len(path)))
    out = []
    smallest = {p: min((c for c, _ in m if c is not None), default=None) for p, m in nodes.items()}
    for p, members in nodes.items():
        below = [q for q in nodes if q[: len(p)] == p]
        children = {q for q in nodes if q[:-1] == p and q}
        leaves = [q for q in below if not any(o[:-1] == q and o for o in below)] if len(p) < 20 else [max(below, key=len)]
        ends = ",".join("" if c is None else str(c) for c in sorted((c for c, e in members if e), key=lambda c: (c is not None, c)))
        saved = sum((len(nodes[q]) - 1) * len(q[-1][1]) for q in below if q)
        out.append((smallest[p], len(p), smallest[p[:-1]] if p else None, len(members), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("family_rows", [100_000, 20, 1])
def test_trie_equals_that_of_all_at_once(spark, monkeypatch, family_rows):
    monkeypatch.setattr(prefix_trie, "FAMILY_ROWS", family_rows)  # families are whole, partly dealt out, all dealt out
    rows = made()
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert sorted(map(tuple, prefix_trie.prefix_trie(table, family=10).collect()), key=repr) == plain(rows, 10, 6)


def test_no_conversations_have_no_nodes(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_one_conversation_streams_through_its_task():
    """Neither a chain nor the sums of corrections keep what has passed."""
    chain = prefix_trie.Chain(5)
    rows = [chain.step(bytes([k % 7] * 16), 3) for k in range(10_000)] + [chain.row(chain.last, True)]
    assert len(rows) == 10_001 and [r[4] for r in rows] == list(range(10_001)) and rows[-1][-2:] == (5, "5")
    assert all(below[2:4] == above[:2] for above, below in zip(rows, rows[1:])) and len(chain.__dict__) == 2
