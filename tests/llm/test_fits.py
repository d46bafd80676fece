"""The two fits against objectives written out plainly, by finite differences."""

from itertools import product
from math import exp, log, prod

import numpy as np
import pytest

from priorframe.llm import line_crf, toxicity


def slopes(objective, at, h=1e-5):
    at = np.array(at, float)
    out = []
    for i in range(len(at)):
        up, down = at.copy(), at.copy()
        up[i] += h
        down[i] -= h
        out.append((objective(up) - objective(down)) / (2 * h))
    return np.array(out)


def noisy_or_objective(docs, labels, words):
    """Mean log chance of the document labels; a document is a list of sentences of word numbers."""

    def value(p):
        total = 0.0
        for doc, y in zip(docs, labels):
            clean = prod(1 - 1 / (1 + exp(-(p[words] + sum(p[w] for w in s)))) for s in doc)
            total += log(1 - clean) if y else log(clean)
        return total / len(docs)

    return value


def toxic_sample():
    rng = np.random.default_rng(5)
    docs, labels = [], []
    for i in range(60):
        y = i % 2
        doc = [sorted(set(rng.integers(0, 5, 3).tolist())) for _ in range(int(rng.integers(1, 4)))]
        if y and rng.random() < 0.8 or rng.random() < 0.15:
            doc[0] = sorted({*doc[0], 5})
        docs.append(doc)
        labels.append(y)
    flat = [np.array([w for s in d for w in [*s, -1]]) for d in docs]
    return docs, labels, flat


def test_toxicity_moves_along_the_slope_and_ends_where_it_is_flat():
    docs, labels, flat = toxic_sample()
    value = noisy_or_objective(docs, labels, 6)
    first, bias = toxicity.fit(flat, labels, 6, rounds=1, l1=0.0)
    assert (np.sign([*first, bias + 4.0]) == np.sign(slopes(value, [0.0] * 6 + [-4.0]))).all()
    weights, bias = toxicity.fit(flat, labels, 6, rounds=6000, l1=0.0)
    assert np.abs(slopes(value, [*weights, bias])).max() < 2e-3
    assert weights.argmax() == 5
    # With a penalty, a weight is 0 only where the slope is below it, and elsewhere the slope is the penalty.
    weights, bias = toxicity.fit(flat, labels, 6, rounds=6000, l1=0.01)
    slope = slopes(value, [*weights, bias])
    for w, g in zip(weights, slope[:6]):
        assert abs(g) < 0.013 if w == 0 else abs(g - 0.01 * np.sign(w)) < 3e-3


def test_document_scores_are_noisy_or():
    of = {"bad": 3.0, "worse": 5.0, "fine": -1.0}
    for text in ("bad day. fine day!\nworse", "all fine", "", "bad bad bad", "x. y. z. worse worse"):
        z = [-2.0 + sum(sum(of.get(f, 0.0) for f in toxicity.features(w)) for w in set(s)) for s in toxicity.sentences(text)]
        score, parts = toxicity.document_score(text, toxicity.Weights(of, -2.0))
        assert parts == pytest.approx([1 / (1 + exp(-v)) for v in z])
        assert score == pytest.approx(1 - prod(1 - 1 / (1 + exp(-v)) for v in z))


def chain_objective(chains, labels, ridge):
    """Weighted log chance of the label paths by all paths of each chain; classes weigh alike by lines."""
    lines = [sum(len(c) for c, y in zip(chains, labels) if y == k) for k in (0, 1)]
    share = [0.5 * sum(lines) / n for n in lines]
    k = len(line_crf.FEATURES)

    def value(p):
        w, m = p[:k], p[k:].reshape(2, 2)

        def path(chain, ys):
            own = sum(w[i] for b, y in zip(chain, ys) if y for i in range(k) if b >> i & 1)
            return own + sum(m[a, b] for a, b in zip(ys, ys[1:]))

        total = 0.0
        for chain, y in zip(chains, labels):
            every = np.logaddexp.reduce([path(chain, ys) for ys in product((0, 1), repeat=len(chain))])
            total += share[y] * (path(chain, [y] * len(chain)) - every)
        return total - ridge / 2 * float((p**2).sum())

    return value


def test_line_field_ends_where_its_objective_is_flat():
    rng = np.random.default_rng(3)
    k = len(line_crf.FEATURES)
    chains, labels = [], []
    for i in range(24):
        y = i % 2
        odds = np.where(np.arange(k) % 2 == y, 0.6, 0.3)
        chains.append([int(sum(1 << j for j in range(k) if rng.random() < odds[j])) for _ in range(1 + i % 4)])
        labels.append(y)
    value = chain_objective(chains, labels, 1.0)
    weights, moves = line_crf.fit(chains, labels, rounds=4000)
    slope = slopes(value, [*weights, *moves.ravel()])
    assert np.abs(slope).max() < 0.02
    start = np.abs(slopes(value, np.zeros(k + 4))).max()
    assert start > 1 and value(np.array([*weights, *moves.ravel()])) > value(np.zeros(k + 4))


def test_viterbi_is_the_best_of_all_paths():
    rng = np.random.default_rng(9)
    k = len(line_crf.FEATURES)
    for _ in range(40):
        weights, moves = rng.normal(size=k), rng.normal(size=(2, 2))
        chain = [int(v) for v in rng.integers(0, 1 << k, int(rng.integers(1, 7)))]

        def worth(ys):
            own = sum(weights[i] for b, y in zip(chain, ys) if y for i in range(k) if b >> i & 1)
            return own + sum(moves[a, b] for a, b in zip(ys, ys[1:]))

        best = max(product((0, 1), repeat=len(chain)), key=worth)
        assert line_crf.Decoder(weights.tolist(), moves.tolist()).labels(chain) == [bool(y) for y in best]
