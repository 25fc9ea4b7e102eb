import pickle
from itertools import product

import numpy as np
import pytest

from quern.llm.crf import CRF, Steps, forward_backward, in_blocks, minimise, viterbi


def brute(scores, trans, start, end):
    n, w = scores.shape
    paths = list(product(range(w), repeat=n))
    v = np.array([scores[np.arange(n), p].sum() + sum(trans[a, b] for a, b in zip(p, p[1:])) + start[p[0]] + end[p[-1]] for p in paths])
    z = np.exp(v - v.max())
    post = np.zeros((n, w))
    for p, x in zip(paths, z / z.sum()):
        post[np.arange(n), p] += x
    return np.array(paths[v.argmax()]), post, v.max() + np.log(z.sum())


@pytest.mark.parametrize("lengths", [[1], [4, 1, 3], [2, 2, 5, 1], []])
def test_chain_same_as_enumeration(lengths):
    rng = np.random.default_rng(3)
    lengths = np.array(lengths, np.int64)
    scores = rng.normal(size=(lengths.sum(), 3)) * 2
    trans, start, end = rng.normal(size=(3, 3)), rng.normal(size=3), rng.normal(size=3)
    labels = viterbi(scores, Steps(lengths), trans, start, end)
    post, total, pairs = forward_backward(scores, Steps(lengths), trans, start, end, pairs=True)
    want, at = 0.0, 0
    for n in lengths:
        path, p, z = brute(scores[at : at + n], trans, start, end)
        assert labels[at : at + n].tolist() == path.tolist()
        assert np.allclose(post[at : at + n], p)
        want, at = want + z, at + n
    assert total == pytest.approx(want) and pairs.sum() == pytest.approx(sum(max(0, n - 1) for n in lengths))


def test_minimise():
    x = minimise(lambda v: (((v - 3) ** 2 * [1, 10, 100]).sum(), 2 * (v - 3) * np.array([1, 10, 100])), np.zeros(3), 100)
    assert np.allclose(x, 3, atol=1e-2)


def test_learns_and_travels():
    model = CRF(("o", "x"), lambda t: [t], lambda t: [t], reach=2)
    seqs = [["a", "b", "c"], ["c", "b", "a"], ["b"], ["a", "b"], ["c", "c", "b"]]
    gold = [[0, 1, 0], [0, 0, 0], [0], [0, 1], [0, 0, 0]]  # b after a
    model.fit(seqs, gold, rounds=80, l2=0.01)
    tokens, lengths = [t for s in seqs for t in s], np.array([len(s) for s in seqs])
    rows = model.index().rows(tokens)
    assert model.decode(rows, lengths).tolist() == [v for g in gold for v in g]
    again = CRF.__new__(CRF)
    again.__setstate__({**model.__getstate__(), "features": None, "near": None})
    assert set(pickle.loads(pickle.dumps(model.vocabulary))) == set(again.vocabulary)
    assert model.posterior(rows, lengths).sum(1) == pytest.approx(1)
    assert model.decode(np.zeros(0, np.int64), np.zeros(0, np.int64)).tolist() == []


@pytest.mark.parametrize("block", [1, 2, 3, 7])
def test_blocks_change_nothing(block):
    rng = np.random.default_rng(5)
    lengths = np.array([5, 1, 40, 7, 8, 23, 2], np.int64)
    scores = rng.normal(size=(lengths.sum(), 4)) * 2
    trans, start, end = rng.normal(size=(4, 4)), rng.normal(size=4), rng.normal(size=4)
    trans[1, 2] = start[3] = -1e4
    whole = Steps(lengths)
    steps, enter, leave = in_blocks(scores, lengths, trans, start, end, True, block)
    assert viterbi(scores, steps, trans, enter, leave).tolist() == viterbi(scores, whole, trans, start, end).tolist()
    trans[1, 2] = start[3] = -3
    steps, enter, leave = in_blocks(scores, lengths, trans, start, end, False, block)
    assert np.allclose(forward_backward(scores, steps, trans, enter, leave)[0], forward_backward(scores, whole, trans, start, end)[0])
