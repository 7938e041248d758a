"""Exact contributions against enumeration of all subsets of covariates."""
import itertools
import math

import numpy as np
import pyarrow as pa
import pytest

from brasa.operators.explain import ensemble_of, pattern_values, shapley_contributions


def random_tree(rng, depth, n_features, tree):
    """Node rows of a random tree with covers that add up."""
    rows = []

    def grow(level, cover):
        at = len(rows)
        rows.append(None)
        if level == depth or cover < 4 or (level > 1 and rng.random() < 0.2):
            rows[at] = (tree, at, rng.normal(), -1, -1, float(cover), 0, 0.0, False)
            return at
        feat, equal = int(rng.integers(n_features)), bool(rng.random() < 0.3)
        part = int(rng.integers(1, cover))
        left, right = grow(level + 1, part), grow(level + 1, cover - part)
        rows[at] = (tree, at, rng.normal(), left, right, float(cover), feat,
                    float(rng.integers(0, 2)) if equal else float(rng.normal()), equal)
        return at
    grow(0, 300)
    return rows


def ensemble(seed, depth, owner, n_trees=3):
    rng = np.random.default_rng(seed)
    rows = [r for t in range(n_trees) for r in random_tree(rng, depth, len(owner), t)]
    names = ["treeID", "id", "value", "left", "right", "cover", "feat", "thr", "equal"]
    table = pa.table({n: pa.array(list(c)) for n, c in zip(names, zip(*rows))})
    return ensemble_of(table, np.array([1.0, 0.1, 0.1][:n_trees]), np.asarray(owner)), rng


def expectation(tree, x, known, owner, at=0):
    if tree["left"][at] < 0:
        return tree["value"][at]
    left, right = tree["left"][at], tree["right"][at]
    f = tree["feat"][at]
    if owner[f] in known:
        yes = x[f] == tree["thr"][at] if tree["equal"][at] else x[f] <= tree["thr"][at]
        return expectation(tree, x, known, owner, left if yes else right)
    a, b = tree["cover"][left], tree["cover"][right]
    return (a * expectation(tree, x, known, owner, left) + b * expectation(tree, x, known, owner, right)) / tree["cover"][at]


def brute(ens, x):
    players = sorted(set(ens["owner"].tolist()))
    value = lambda s: sum(w * expectation(t, x, s, ens["owner"]) for t, w in zip(ens["trees"], ens["weights"]))
    known = {frozenset(s): value(set(s)) for k in range(len(players) + 1) for s in itertools.combinations(players, k)}
    d = len(players)
    phi = []
    for p in players:
        phi.append(sum(math.factorial(len(s)) * math.factorial(d - len(s) - 1) / math.factorial(d) * (known[s | {p}] - v)
                       for s, v in known.items() if p not in s))
    return known[frozenset()], phi, known[frozenset(players)]


@pytest.mark.parametrize("depth", [0, 1, 2, 4, 7])
@pytest.mark.parametrize("owner", [[0, 1, 2, 3], [0, 1, 1, 1, 2, 3, 3]])
def test_equals_enumeration(depth, owner):
    ens, rng = ensemble(depth * 10 + len(owner), depth, owner)
    X = np.where(rng.random((25, len(owner))) < 0.4, rng.integers(0, 2, (25, len(owner))), rng.normal(size=(25, len(owner))))
    base, phi = shapley_contributions(X, ens)
    for i, x in enumerate(X):
        b, want, total = brute(ens, x)
        assert abs(base - b) < 1e-9 and np.abs(phi[i] - want).max() < 1e-9
        assert abs(base + phi[i].sum() - total) < 1e-9


def test_deep_tree_adds_up():
    ens, rng = ensemble(4, 12, list(range(14)))
    X = rng.normal(size=(400, 14))
    base, phi = shapley_contributions(X, ens)
    total = [sum(w * expectation(t, x, set(range(14)), ens["owner"]) for t, w in zip(ens["trees"], ens["weights"])) for x in X]
    assert np.abs(base + phi.sum(axis=1) - total).max() < 1e-9


def test_pattern_values_of_one_player():
    out = pattern_values(np.array([[True], [False]]), np.array([0.25]))
    assert np.allclose(out, [[0.75], [-0.25]])
