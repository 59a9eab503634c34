"""Small gradient-boosted trees, fitted in numpy and scored as a column expression."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Split:
    """Rows whose feature is below the limit go left."""

    feature: int
    limit: float
    left: Split | float
    right: Split | float


@dataclass(frozen=True)
class Boosted:
    """Log-odds as a constant and a sum of trees; candidates of at least the threshold of their kind are taken."""

    constant: float
    trees: tuple[Split | float, ...]
    thresholds: tuple[float, ...]


def _grow(rows: np.ndarray, slope: np.ndarray, curve: np.ndarray, depth: int) -> Split | float:
    whole = slope.sum() ** 2 / (curve.sum() + 1)
    best, choice = 1e-6, None
    if depth:
        for feature, column in enumerate(rows.T):
            values = np.unique(column)
            for limit in (values[1:] + values[:-1]) / 2:
                left = column < limit
                gain = slope[left].sum() ** 2 / (curve[left].sum() + 1) + slope[~left].sum() ** 2 / (curve[~left].sum() + 1) - whole
                if gain > best:
                    best, choice = gain, (feature, float(limit), left)
    if choice is None:
        return float(slope.sum() / (curve.sum() + 1))
    feature, limit, left = choice
    parts = [_grow(rows[side], slope[side], curve[side], depth - 1) for side in (left, ~left)]
    return Split(feature, limit, *parts)


def _values(tree: Split | float, rows: np.ndarray) -> np.ndarray:
    if not isinstance(tree, Split):
        return np.full(len(rows), tree)
    return np.where(rows[:, tree.feature] < tree.limit, _values(tree.left, rows), _values(tree.right, rows))


def log_odds(model: Boosted, rows: np.ndarray) -> np.ndarray:
    return model.constant + sum(_values(tree, rows) for tree in model.trees)


def fit(
    rows: np.ndarray, wanted: np.ndarray, kinds: np.ndarray, count: int, trees: int = 20, depth: int = 3, rate: float = 0.4, precision: float = 0.99
) -> Boosted:
    """Boost on two thirds of the rows; the threshold of each of `count` kinds is calibrated on the rest."""
    share = float(np.clip(wanted.mean(), 0.01, 0.99))
    constant, grown = float(np.log(share / (1 - share))), []
    held = np.arange(len(rows)) % 3 == 2
    learn, target = rows[~held], wanted[~held]
    total = np.full(len(learn), constant)
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-total))
        tree = _scaled(_grow(learn, target - chance, chance * (1 - chance), depth), rate)
        grown.append(tree)
        total += _values(tree, learn)
    scores = log_odds(Boosted(constant, tuple(grown), ()), rows[held])
    limits = [calibrated(scores[kinds[held] == kind], wanted[held][kinds[held] == kind], precision) for kind in range(count)]
    return Boosted(constant, tuple(grown), tuple(limits))


def calibrated(scores: np.ndarray, wanted: np.ndarray, precision: float) -> float:
    """The lowest score from which on this share of the rows is wanted, and at least even odds; infinite where there is none.
    Rows of equal scores are taken or left together."""
    order = np.argsort(-scores, kind="stable")
    right = np.cumsum(wanted[order]) / np.arange(1, len(order) + 1)
    last = np.append(scores[order][1:] != scores[order][:-1], True)[: len(order)]
    good = np.flatnonzero((right >= precision) & last)
    return max(0.0, float(scores[order][good[-1]]) - 1e-9) if len(good) else float("inf")


def _scaled(tree: Split | float, rate: float) -> Split | float:
    if not isinstance(tree, Split):
        return tree * rate
    return Split(tree.feature, tree.limit, _scaled(tree.left, rate), _scaled(tree.right, rate))


def expression(model: Boosted, features: list[Column]) -> Column:
    """Log-odds of the model as a column of the feature columns."""

    def of(tree: Split | float) -> Column:
        if not isinstance(tree, Split):
            return F.lit(tree)
        return F.when(features[tree.feature] < tree.limit, of(tree.left)).otherwise(of(tree.right))

    total = F.lit(model.constant)
    for tree in model.trees:
        total = total + of(tree)
    return total
