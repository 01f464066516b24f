"""Trees of op1 and machines of op8 against plain loops."""

import math

import numpy as np
import pyarrow as pa
import pytest

from tickwave.llm import language_id as L
from tickwave.llm import quality_classifier as Q
from tickwave.llm import words as W

RNG = np.random.default_rng(8)
X = RNG.normal(size=(400, 5)).round(2)
Y = ((X[:, 1] > 0.3) & (X[:, 3] < 0.5) | (RNG.random(400) < 0.1)).astype(float)


def walk(m, x):
    z = m.start
    for node in m.root:
        while m.feature[node] >= 0:
            node = m.left[node] + (1 if x[m.feature[node]] > m.split[node] else 0)
        z += m.value[node]
    return 1 / (1 + math.exp(-z))


def test_vector_walk_equals_nodes():
    m = Q.fit_trees(X, Y, trees=15)
    assert len(m.root) == 15 and (m.feature >= 0).sum() > 15
    assert m.score(X) == pytest.approx([walk(m, x) for x in X], abs=1e-12)


def test_first_split_is_the_best_one():
    """Every feature and bin edge tried on the rows themselves."""
    m = Q.fit_trees(X, Y, trees=1, depth=1, bins=16)
    p = Y.mean()
    g, w = Y - p, np.full(len(Y), p * (1 - p))
    best = []
    for f in range(X.shape[1]):
        for edge in np.unique(np.quantile(X[:, f], np.linspace(0, 1, 17)[1:-1])):
            low = X[:, f] <= edge
            if min(w[low].sum(), w[~low].sum()) >= 5:
                best.append((sum(g[s].sum() ** 2 / (w[s].sum() + 1) for s in (low, ~low)), f, edge))
    _, f, edge = max(best)
    root = m.root[0]
    assert (m.feature[root], m.split[root]) == (f, edge)
    for child, side in ((0, X[:, f] <= edge), (1, X[:, f] > edge)):
        assert m.value[m.left[root] + child] == pytest.approx(0.15 * g[side].sum() / (w[side].sum() + 1))


def plain_features(text):
    """Letters and bytes beyond ASCII, lower-cased; a run of others is one blank."""
    kept = []
    for i, b in enumerate((text or "").encode()):
        if b >= 128 or chr(b).isalpha():
            kept.append(b + 32 if 65 <= b <= 90 else b)
        elif not i or kept[-1] != 32:
            kept.append(32)
    counts = {}
    for g in range(L.GRAMS):
        for i in range(len(kept) - g):
            code = 0
            for b in kept[i:i + g + 1]:
                code = (code * 256 + b + 1) % (1 << 32)
            h = W.mix(np.array([code + (g << 40)], np.uint64))[0]
            k = (int(h) >> 40) % L.FEATURES
            counts[k] = counts.get(k, 0) + 1
    v = {k: 1 + math.log(n) for k, n in counts.items()}
    norm = math.sqrt(sum(x * x for x in v.values()))
    return {k: x / norm for k, x in v.items()}


TEXTS = ["the cat sat on the mat", "Der Hund, die Katze!", "el perro y la gata", "", None, "  \n x", "Ünïcode ЖУК 漢字", "a1b2  c3"]


def test_features_equal_plain_ones():
    row, col, value = L.features(pa.array(TEXTS))
    for i, t in enumerate(TEXTS):
        got = dict(zip(col[row == i].tolist(), value[row == i].tolist()))
        assert got == pytest.approx(plain_features(t))


def test_votes_equal_plain_ones():
    known = [("the cat sat on the mat", "en"), ("a dog and the cat", "en"), ("der Hund und die Katze", "de"), ("die Maus und der Hund", "de"),
             ("el perro y la gata", "es"), ("la casa y el perro", "es")]
    row, col, value = L.features(pa.array([t for t, _ in known]))
    layer = L.fit_layer([(col[row == i], value[row == i]) for i in range(len(known))], [v for _, v in known])
    assert layer.classes == ["de", "en", "es"] and layer.pairs == [(0, 1), (0, 2), (1, 2)]
    texts = [t for t, _ in known] + ["the dog", "la gata", "und"]
    best, sure = layer.predict(*L.features(pa.array(texts)), len(texts))
    for i, t in enumerate(texts):
        margin = [sum(x * layer.weight[k][c] for c, x in plain_features(t).items()) + layer.bias[k] for k in range(3)]
        wins = [[(a, b)[int(m <= 0)] for (a, b), m in zip(layer.pairs, margin)].count(c) for c in range(3)]
        assert wins[best[i]] == max(wins)
        mine = [m if a == best[i] else -m for (a, b), m in zip(layer.pairs, margin) if best[i] in (a, b)]
        assert sure[i] == pytest.approx(min(1 / (1 + math.exp(-4 * m)) for m in mine))
    assert [layer.classes[c] for c in best[:6]] == [v for _, v in known]
