"""Gradient boosted trees over small integer features, as counts in and a SQL expression out.

Training data are counts of feature combinations (their number is bounded by
the features' ranges, not by the rows), so Spark does the counting and the
trees are fitted to the counts. The model is a sum of CASE expressions.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 24
DEPTH = 3
RATE = 0.4
RIDGE = 2.0  # keeps leaves with little weight near zero

# A tree is a leaf (number) or (feature, threshold, tree below or at, tree above).
Tree = tuple | float


def _best_split(rows: list[tuple], n_features: int) -> tuple | None:
    """(gain, feature, threshold); rows are (features, gradient, curvature)."""
    grad, curve = sum(r[1] for r in rows), sum(r[2] for r in rows)
    best = None
    for f in range(n_features):
        by_value: dict[int, list[float]] = {}
        for x, g, h in rows:
            cell = by_value.setdefault(x[f], [0.0, 0.0])
            cell[0] += g
            cell[1] += h
        left_g = left_h = 0.0
        for value in sorted(by_value)[:-1]:
            left_g += by_value[value][0]
            left_h += by_value[value][1]
            right_g, right_h = grad - left_g, curve - left_h
            gain = left_g**2 / (left_h + RIDGE) + right_g**2 / (right_h + RIDGE) - grad**2 / (curve + RIDGE)
            if best is None or gain > best[0] + 1e-9:
                best = (gain, f, value)
    return best


def _grow(rows: list[tuple], n_features: int, depth: int) -> Tree:
    split = _best_split(rows, n_features) if depth else None
    if split is None or split[0] < 1e-6:
        return -RATE * sum(r[1] for r in rows) / (sum(r[2] for r in rows) + RIDGE)
    _, f, value = split
    below = [r for r in rows if r[0][f] <= value]
    above = [r for r in rows if r[0][f] > value]
    return (f, value, _grow(below, n_features, depth - 1), _grow(above, n_features, depth - 1))


def value_of(tree: Tree, x: tuple) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree


def fit(counts: dict[tuple, tuple[float, float]], rounds: int = ROUNDS, depth: int = DEPTH) -> tuple[float, list[Tree]]:
    """(first score, trees) of logistic boosting; counts: features -> (rows that hold, rows that don't)."""
    yes, no = sum(c[0] for c in counts.values()), sum(c[1] for c in counts.values())
    first = math.log((yes + 1) / (no + 1))
    score = dict.fromkeys(counts, first)
    trees: list[Tree] = []
    n_features = len(next(iter(counts), ()))
    for _ in range(rounds if counts else 0):
        rows = []
        for x, (a, b) in counts.items():
            p = 1 / (1 + math.exp(-score[x]))
            rows.append((x, (a + b) * p - a, (a + b) * p * (1 - p)))
        tree = _grow(rows, n_features, depth)
        trees.append(tree)
        for x in score:
            score[x] = max(-30.0, min(30.0, score[x] + value_of(tree, x)))
    return first, trees


def probability(model: tuple[float, list[Tree]], x: tuple) -> float:
    total = model[0] + sum(value_of(t, x) for t in model[1])
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))


def as_column(model: tuple[float, list[Tree]], features: list[Column]) -> Column:
    """The model's probability as an expression over feature columns."""

    def column(tree: Tree) -> Column:
        if not isinstance(tree, tuple):
            return F.lit(float(tree))
        f, value, below, above = tree
        return F.when(features[f] <= value, column(below)).otherwise(column(above))

    total = reduce(lambda a, b: a + b, [column(t) for t in model[1]], F.lit(float(model[0])))
    return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), total))))


def threshold(model: tuple[float, list[Tree]], counts: dict[tuple, tuple[float, float]], precision: float) -> float:
    """Lowest probability above which held-out rows hold at least at ``precision`` (2.0 if there is none).

    Groups of equal probability are taken from the highest down, as far as they
    more likely hold than not; the share of rows that hold is estimated with one
    row against added.
    """
    groups: dict[float, list[float]] = {}
    for x, (a, b) in counts.items():
        cell = groups.setdefault(round(probability(model, x), 9), [0.0, 0.0])
        cell[0] += a
        cell[1] += b
    yes = no = 0.0
    found = 2.0
    for p in sorted(groups, reverse=True):
        if p < 0.5:
            break
        yes += groups[p][0]
        no += groups[p][1]
        if yes / (yes + no + 1) >= precision:
            found = p - 1e-9
    return found
