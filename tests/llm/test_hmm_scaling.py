"""Transfer matrices are scaled every few steps; likelihoods are those of the plain forward recursion."""

import numpy as np
import pytest

from ledgerpulse.llm import hmm


def test_few_scalings_and_the_same_likelihood(monkeypatch):
    rng = np.random.default_rng(1)
    unigram = 10.0 ** -rng.uniform(0, 9, 500)
    model = hmm.HiddenMarkovModel.initial(unigram / unigram.sum(), 4)
    ids = [rng.integers(0, 500, n) for n in (1, 3, 4, 5, 63, 64, 65, 200)]
    scaled = []
    real = hmm.HiddenMarkovModel._scaled
    monkeypatch.setattr(hmm.HiddenMarkovModel, "_scaled", staticmethod(lambda m: (scaled.append(1), real(m))[1]))
    found = model.log10(ids)
    assert len(scaled) <= hmm.SEGMENT // hmm.RESCALE + 1
    for x, value in zip(ids, found):
        state, total = model.start, 0.0
        for t, k in enumerate(x):
            state = (state if t == 0 else state @ model.move) * model.emit[k]
            total += np.log10(state.sum())
            state = state / state.sum()
        assert abs(total - value) < 1e-9 * abs(total)


def _plain(model, x):
    """log10 likelihood, expected moves and states by the textbook recursion, a step at a time."""
    states, scales, behind = [], [], np.ones(len(model.start))
    for t, k in enumerate(x):
        a = (states[-1] @ model.move if t else model.start) * model.emit[k]
        scales.append(a.sum())
        states.append(a / a.sum())
    moves, gammas = np.zeros_like(model.move), np.zeros((len(x), len(model.start)))
    for t in range(len(x) - 1, -1, -1):
        gammas[t] = states[t] * behind
        ahead = model.emit[x[t]] * behind / scales[t]
        if t:
            moves += model.move * np.outer(states[t - 1], ahead)
        behind = model.move @ ahead
    return np.log10(scales).sum(), moves, gammas


@pytest.mark.parametrize("whole,batch", [(4096, 4096), (4096, 2), (100, 4096), (64, 1)])
def test_texts_go_together_and_need_no_matrices(monkeypatch, whole, batch):
    rng = np.random.default_rng(2)
    unigram = 10.0 ** -rng.uniform(0, 9, 500)
    model = hmm.HiddenMarkovModel.initial(unigram / unigram.sum(), 4)
    texts = [rng.integers(0, 500, n) for n in (200, 1, 64, 3, 129, 1, 65, 700, 100, 101)]
    monkeypatch.setattr(hmm, "WHOLE", whole, raising=False)
    monkeypatch.setattr(hmm, "BATCH", batch)
    cut = []
    real = hmm.HiddenMarkovModel._transfer
    monkeypatch.setattr(hmm.HiddenMarkovModel, "_transfer", lambda m, symbols, begins: (cut.append((symbols >= 0).sum()), real(m, symbols, begins))[1])
    likely, (starts, moves, emits) = model.log10(texts), model.expected(texts)
    assert sum(cut) == 2 * sum(len(x) for x in texts if len(x) > whole)
    plain = [_plain(model, x) for x in texts]
    np.testing.assert_allclose(likely, [p[0] for p in plain], rtol=1e-12)
    np.testing.assert_allclose(starts, sum(p[2][0] for p in plain), rtol=1e-9)
    np.testing.assert_allclose(moves, sum(p[1] for p in plain), rtol=1e-9)
    expected = np.zeros_like(model.emit)
    for x, p in zip(texts, plain):
        np.add.at(expected, x, p[2])
    np.testing.assert_allclose(emits, expected, rtol=1e-9, atol=1e-15)
