"""Gradient boosting of small trees on counted cells.

Rows that agree in all (categorical) features form a cell, so the fit needs
no rows, only the cells with their numbers of rows and of positive rows.
A fitted model is a SQL expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Cell:
    values: tuple[int, ...]
    rows: int
    positive: int


@dataclass
class Tree:
    """A split "feature = value" with a leaf or tree on each side."""

    feature: int
    value: int
    yes: Tree | float
    no: Tree | float

    def at(self, values: tuple[int, ...]) -> float:
        side = self.yes if values[self.feature] == self.value else self.no
        return side.at(values) if isinstance(side, Tree) else side

    def column(self, features: list[Column]) -> Column:
        sides = [s.column(features) if isinstance(s, Tree) else F.lit(s) for s in (self.yes, self.no)]
        return F.when(features[self.feature] == self.value, sides[0]).otherwise(sides[1])


def _leaf(gradient: float, hessian: float, ridge: float) -> float:
    return -gradient / (hessian + ridge)


def _grow(cells: list[tuple], depth: int, ridge: float) -> Tree | float:
    """The tree that lowers the second-order loss most; ``cells`` holds
    (values, gradient, hessian)."""
    total_g, total_h = sum(c[1] for c in cells), sum(c[2] for c in cells)
    if not depth:
        return _leaf(total_g, total_h, ridge)
    sums: dict[tuple[int, int], list[float]] = {}
    for values, g, h in cells:
        for k, v in enumerate(values):
            s = sums.setdefault((k, v), [0.0, 0.0])
            s[0] += g
            s[1] += h

    def gain(split: tuple[int, int]) -> float:
        g, h = sums[split]
        parts = ((g, h), (total_g - g, total_h - h))
        return sum(x * x / (y + ridge) for x, y in parts) - total_g**2 / (total_h + ridge)

    best = max(sorted(sums), key=gain, default=None)
    if best is None or gain(best) <= 1e-9:
        return _leaf(total_g, total_h, ridge)
    sides = ([], [])
    for cell in cells:
        sides[cell[0][best[0]] != best[1]].append(cell)
    return Tree(*best, *(_grow(side, depth - 1, ridge) for side in sides))


@dataclass
class Boosted:
    """Trees whose sum is the log-odds of a positive."""

    start: float
    trees: list[Tree | float]

    @classmethod
    def fit(cls, cells: list[Cell], rounds: int = 40, depth: int = 3, rate: float = 0.3, ridge: float = 1.0) -> Boosted:
        rows, positive = sum(c.rows for c in cells), sum(c.positive for c in cells)
        start = math.log((positive + 0.5) / (rows - positive + 0.5))
        odds = {c: start for c in cells}
        trees: list[Tree | float] = []
        for _ in range(rounds):
            work = []
            for c in cells:
                p = 1 / (1 + math.exp(-odds[c]))
                work.append((c.values, c.rows * p - c.positive, c.rows * p * (1 - p)))
            tree = _shrunk(_grow(work, depth, ridge), rate)
            trees.append(tree)
            for c in cells:
                odds[c] += tree.at(c.values) if isinstance(tree, Tree) else tree
        return cls(start, trees)

    def probability(self, values: tuple[int, ...]) -> float:
        odds = self.start + sum(t.at(values) if isinstance(t, Tree) else t for t in self.trees)
        return 1 / (1 + math.exp(-odds))

    def column(self, features: list[Column]) -> Column:
        """The probability as an expression over feature columns."""
        odds = F.lit(self.start)
        for tree in self.trees:
            odds = odds + (tree.column(features) if isinstance(tree, Tree) else F.lit(tree))
        return 1 / (1 + F.exp(-odds))


def _shrunk(tree: Tree | float, rate: float) -> Tree | float:
    if isinstance(tree, Tree):
        return Tree(tree.feature, tree.value, _shrunk(tree.yes, rate), _shrunk(tree.no, rate))
    return round(tree * rate, 4)
