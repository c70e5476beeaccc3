"""What the language model's tasks do per token: words are told apart in bulk, and states are computed once where documents fit."""

import random
import time
from itertools import chain

import numpy as np
import pyarrow as pa
import pytest

from tidebook.llm import hmm_lm

ODD = ["", None, " ", "\x0b\x0c\r\n\t", "a", " A  b\tA ", "É É é\x85x y", "x\x1cy\x00z", "\n".join("Ab aB AB") + " ", "end\n", "İ ß ẞ K"]


def rows_of(texts, start=0):
    ids = range(start, start + len(texts))
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([i % 5 == 1 for i in ids]), pa.array(texts, pa.string())], ["doc_id", "held", "text"])


def word_by_word(texts):
    index, parts = {b"": 0}, []
    for text in texts:
        words = (text or "").encode().lower().split()
        for w in dict.fromkeys(words):
            if w not in index:
                index[w] = len(index)
        parts.append(np.fromiter(chain(map(index.__getitem__, words), (0,)), "<u4", len(words) + 1))
    return list(index), parts


def blocks_of(texts, monkeypatch):
    class Task:
        partitionId = staticmethod(lambda: 2)

    monkeypatch.setattr(hmm_lm.TaskContext, "get", lambda: Task)
    half = len(texts) // 2
    return [b.to_pylist()[0] for b in hmm_lm._blocks(iter([rows_of(texts[:half]), rows_of([]), rows_of(texts[half:], half)]))]


@pytest.mark.parametrize("size, words, at_once", [(1 << 23, 1_000_000, 256), (1, 1_000_000, 256), (90, 1_000_000, 3), (1 << 23, 5, 2)])
def test_blocks_hold_every_word_in_its_place(monkeypatch, size, words, at_once):
    texts = ODD * 3
    for name, value in (("BLOCK_BYTES", size), ("BLOCK_WORDS", words), ("BLOCK_ROWS", at_once)):
        monkeypatch.setattr(hmm_lm, name, value)
    found = blocks_of(texts, monkeypatch)
    assert len({b["block"] for b in found}) == len(found) and (len(found) > 1) == (size < 1000 or words < 1000)
    got, counts = [], {}
    for b in found:
        codes, cuts = hmm_lm.code_array(b["codes"]), np.cumsum(b["lengths"])
        assert len(set(b["words"])) == len(b["words"]) and len(codes) == cuts[-1]
        got += [(i, h, [b["words"][c] for c in part]) for i, h, part in zip(b["doc_ids"], b["held"], np.split(codes, cuts[:-1]))]
        for w, n in zip(b["words"], b["counts"]):
            counts[w] = counts.get(w, 0) + n
    names, parts = word_by_word(texts)
    assert got == [(i, i % 5 == 1, [names[c].decode() for c in p]) for i, p in enumerate(parts)]
    trained = [w for _, held, doc in got if not held for w in doc]
    assert {w: n for w, n in counts.items() if n} == {w: trained.count(w) for w in trained}


def test_blocks_take_less_than_a_loop_over_words():
    draw = random.Random(1)
    texts = [" ".join(f"w{int(draw.paretovariate(0.6)) % 200_000}" for _ in range(400)) for _ in range(1500)]
    rows = rows_of(texts)

    def seconds(f):
        times = []
        for _ in range(3):
            began = time.process_time()
            f()
            times.append(time.process_time() - began)
        return min(times)

    def block():
        b = hmm_lm.Block()
        for at in range(0, rows.num_rows, 256):
            b.add(rows.slice(at, 256))

    assert seconds(block) < 0.75 * seconds(lambda: word_by_word(rows.column(2).to_pylist()))


def model_and_documents():
    draw = np.random.default_rng(5)
    model = hmm_lm.Model(draw.dirichlet([1] * 3), draw.dirichlet([1] * 3, 3), draw.dirichlet([0.1] * 40, 3) + 1e-19)
    lengths = np.sort(draw.integers(1, 700, 60))[::-1].copy()
    return model, draw.integers(0, 40, lengths.sum()).astype("int32"), np.cumsum(lengths) - lengths, lengths


def test_states_are_computed_once_where_documents_fit(monkeypatch):
    calls, forwards = [], hmm_lm.forwards
    monkeypatch.setattr(hmm_lm, "forwards", lambda *args: calls.append(len(args[1])) or forwards(*args))
    model, obs, starts, lengths = model_and_documents()
    hmm_lm.document_counts(model, obs, starts, lengths)
    assert calls == [len(obs)]


@pytest.mark.parametrize("tokens, steps", [(1, 1), (1, 7), (500, 1), (3000, 64)])
def test_any_segments_give_the_counts_and_scores_of_whole_documents(monkeypatch, tokens, steps):
    model, obs, starts, lengths = model_and_documents()
    whole, scores = hmm_lm.document_counts(model, obs, starts, lengths), hmm_lm.forward(model, obs, lengths)
    one_by_one = [hmm_lm.document_counts(model, obs, starts[k : k + 1], lengths[k : k + 1]) for k in range(len(lengths))]
    monkeypatch.setattr(hmm_lm, "TOKENS_AT_ONCE", tokens)
    monkeypatch.setattr(hmm_lm, "SEGMENT", steps)
    assert all(np.allclose(x, y, rtol=1e-9) for x, y in zip(hmm_lm.document_counts(model, obs, starts, lengths), whole))
    assert all(np.allclose(x, y, rtol=1e-9) for x, y in zip(map(sum, zip(*one_by_one)), whole))
    assert np.allclose(hmm_lm.forward(model, obs, lengths), scores, rtol=1e-12)
    assert np.isclose(scores.sum() * np.log(10), whole[3])
    stretches = list(hmm_lm.at_once(lengths))
    assert [a for a, _ in stretches[1:]] + [len(lengths)] == [b for _, b in stretches] and stretches[0][0] == 0
