"""Training counts of documents that are computed in segments are those of whole documents."""

import numpy as np

from tidebook.llm import hmm_lm


def test_states_are_carried_over_cuts():
    draw = np.random.default_rng(2)
    model = hmm_lm.Model(draw.dirichlet([1] * 3), draw.dirichlet([1] * 3, 3), draw.dirichlet([1] * 5, 3))
    lengths = np.array([300, 2 * hmm_lm.SEGMENT, 100, hmm_lm.SEGMENT + 1, hmm_lm.SEGMENT, 7, 1])
    obs = draw.integers(0, 5, lengths.sum()).astype("int32")
    starts = np.cumsum(lengths) - lengths
    got = hmm_lm.document_counts(model, obs, starts, lengths)
    whole = [hmm_lm.expected_counts(model, obs[None, a : a + n].astype("int64"), np.array([n])) for a, n in zip(starts, lengths)]
    for x, y in zip(got, map(sum, zip(*whole))):
        assert np.allclose(x, y)
    assert np.isclose(got[0].sum(), len(lengths)) and np.isclose(got[1].sum(), (lengths - 1).sum())  # a start for each document


def test_five_rounds():
    assert hmm_lm.ROUNDS == 5
