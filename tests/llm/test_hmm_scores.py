"""The query's scores against a language model written out plainly, sequence by sequence, with probabilities as they are."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from tidebook.llm import hmm_lm

STATES, ROUNDS = 2, 3


def words_of(text):
    return [*(text or "").encode().lower().split(), b""]


def forward_backward(model, seq):
    """Unscaled: probabilities of prefixes and suffixes."""
    n = len(seq)
    a, b = np.zeros((n, STATES)), np.ones((n, STATES))
    a[0] = model.start * model.emit[:, seq[0]]
    for t in range(1, n):
        for s in range(STATES):
            a[t, s] = sum(a[t - 1, r] * model.move[r, s] for r in range(STATES)) * model.emit[s, seq[t]]
    for t in range(n - 2, -1, -1):
        for s in range(STATES):
            b[t, s] = sum(model.move[s, r] * model.emit[r, seq[t + 1]] * b[t + 1, r] for r in range(STATES))
    return a, b


def plain(rows, n_own, n_common):
    """doc_id, score of each row, and the likelihood before each round."""
    trains = [t for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 5 != 1]
    c = Counter(w for t in trains for w in words_of(t))
    common = sorted((w for w in c if w), key=lambda w: (-c[w], w))
    level = lambda w: math.floor(math.log(c[w]) / math.log(hmm_lm.LEVEL))
    fits = [w for w in common if sum(level(x) >= level(w) for x in common) <= n_common]
    common = fits[:n_own]

    def kind(w):
        if w == b"":
            return 0
        if w in common:
            return 1 + common.index(w)
        h = xxhash.xxh64_intdigest(w.decode()[-hmm_lm.ENDING_LETTERS :].encode(), 42)
        return (h - (1 << 64) if h >> 63 else h) % hmm_lm.ENDING_CLASSES + 1 + len(common)

    classes = 1 + len(common) + hmm_lm.ENDING_CLASSES
    totals, distinct = np.zeros(classes), np.zeros(classes)
    for w, n in c.items():
        totals[kind(w)] += n
        distinct[kind(w)] += 1
    model, likelihoods = hmm_lm.Model.first(totals, STATES), []
    for _ in range(ROUNDS):
        start, move, emit, ll = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((STATES, classes)), 0.0
        for text in trains:
            seq = [kind(w) for w in words_of(text)]
            a, b = forward_backward(model, seq)
            p = a[-1].sum()
            ll += math.log(p)
            start += a[0] * b[0] / p
            for t, k in enumerate(seq):
                emit[:, k] += a[t] * b[t] / p
                if t:
                    for r in range(STATES):
                        for s in range(STATES):
                            move[r, s] += a[t - 1, r] * model.move[r, s] * model.emit[s, k] * b[t, s] / p
        likelihoods.append(ll)
        model = hmm_lm.Model.of_counts(start, move, emit, totals)
    scores = []
    for i, text in rows:
        seq = words_of(text)
        a, _ = forward_backward(model, [kind(w) for w in seq])
        within = [0.0 if kind(w) <= len(common) else math.log10((c[w] + 0.5) / (totals[kind(w)] + 0.5 * (distinct[kind(w)] + 1))) for w in seq]
        scores.append((repr(i), math.log10(a[-1].sum()) + sum(within)))
    return sorted(scores), likelihoods


@pytest.mark.parametrize("n_own", [8192, 4])
def test_scores_of_the_query(spark, monkeypatch, n_own):
    draw = random.Random(3)
    words = ["the", "of", "and", "red", "reed", "Été", "cat", "cats", "xyz", "fred", "10", "a-b"]
    rows = [(k, " ".join(draw.choices(words, weights=range(12, 0, -1), k=draw.randint(0, 25)))) for k in range(40)]
    rows += [(None, "the red cats"), (100, None), (101, "never seen beforehand red"), rows[3], (k := 7, "other text of an id")]
    monkeypatch.setattr(hmm_lm, "OWN_CLASSES", n_own)
    monkeypatch.setattr(hmm_lm, "COMMON_WORDS", 9)  # some words meet their counts in the shuffle
    monkeypatch.setattr(hmm_lm, "BLOCK_BYTES", 300)
    seen, train = [], hmm_lm.train
    monkeypatch.setattr(hmm_lm, "train", lambda *args: seen.append(train(*args)) or seen[-1])
    found = hmm_lm.score_documents(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), states=STATES, rounds=ROUNDS).collect()
    want, likelihoods = plain(rows, n_own, 9)
    got = sorted((repr(r.doc_id), r.score) for r in found)
    assert [i for i, _ in got] == [i for i, _ in want]
    assert np.allclose([s for _, s in got], [s for _, s in want], atol=1e-9)
    assert np.allclose(seen[0][1], likelihoods) and likelihoods == sorted(likelihoods)
