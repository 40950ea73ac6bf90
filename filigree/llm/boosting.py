"""Gradient-boosted trees over small integer features, in DataFrame functions only.

A level of a tree is one aggregate: the sums of gradients per node, feature and value,
which are few whatever the number of rows. The trees become one expression of nested
CASEs, so scoring is part of the plan of the rows that are scored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _best(cells: list, weight: float) -> dict[int, tuple[int, int]]:
    """Per node the feature and the value to split at, where that gains anything."""
    nodes: dict[int, dict[int, list]] = {}
    for c in cells:
        nodes.setdefault(c.node, {}).setdefault(c.feature, []).append((c.value, c.g, c.h))
    best = {}
    for node, features in nodes.items():
        found = (1e-6, None)
        for feature, values in sorted(features.items()):
            values.sort()
            g, h = sum(v[1] for v in values), sum(v[2] for v in values)
            left_g = left_h = 0.0
            for value, dg, dh in values[:-1]:
                left_g, left_h = left_g + dg, left_h + dh
                gain = (left_g ** 2 / (left_h + weight) + (g - left_g) ** 2 / (h - left_h + weight)
                        - g ** 2 / (h + weight))
                if gain > found[0]:
                    found = (gain, (feature, value))
        if found[1]:
            best[node] = found[1]
    return best


class Trees:
    """The log odds of a label: ``prior`` and the steps of the trees. A tree is its
    splits per level (node -> feature, value) and its leaves (node -> step)."""

    def __init__(self, prior: float):
        self.prior, self.trees = prior, []

    def score(self, get=F.col) -> Column:
        """As an expression; ``get`` gives the column of a feature."""
        total = F.lit(self.prior)
        for levels, leaves in self.trees:
            total = total + _cases(_node(levels, get), leaves, F.lit(0.0))
        return total


def _cases(at: Column, values: dict, other: Column) -> Column:
    return reduce(lambda e, x: e.when(at == x[0], x[1]), sorted(values.items(), key=lambda x: x[0]),
                  F.when(F.lit(False), other)).otherwise(other)


def _node(levels: list, get) -> Column:
    """The node a row ends in. Conditions are nested as the tree is."""
    def below(node: int, level: int) -> Column:
        split = levels[level].get(node) if level < len(levels) else None
        if not split:
            return F.lit(node)
        return F.when(get(split[0]) <= split[1], below(2 * node, level + 1)).otherwise(below(2 * node + 1, level + 1))
    return below(1, 0)


def fit(rows: DataFrame, features: list[str], label: str, trees: int = 8, depth: int = 3,
        rate: float = 0.5, weight: float = 1.0, times: str | None = None) -> Trees | None:
    """Learn ``label`` (0 or 1) from ``features`` (integers that are not NULL). None
    without rows of both labels. ``rows`` is read once per level. A row stands for as many
    as its column ``times`` says, if given."""
    many = F.lit(1) if times is None else F.col(times)
    n, ones = rows.agg(F.coalesce(F.sum(many), F.lit(0)), F.coalesce(F.sum(many * F.col(label)), F.lit(0))).first()
    if not 0 < ones < n:
        return None
    model = Trees(math.log(ones / (n - ones)))
    cells = F.array(*(F.struct(F.lit(i).alias("feature"), F.col(f).cast("int").alias("value"))
                      for i, f in enumerate(features)))
    for _ in range(trees):
        p, levels = 1 / (1 + F.exp(-model.score())), []
        sums = rows.select(*features, (many * (p - F.col(label))).alias("g"), (many * p * (1 - p)).alias("h"))
        while len(levels) < depth:
            split = _best(sums.select(_node(levels, F.col).alias("node"), "g", "h", F.explode(cells).alias("c")).groupBy(
                "node", "c.feature", "c.value").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect(), weight)
            if not split:
                break
            levels.append({node: (features[i], value) for node, (i, value) in split.items()})
        leaves = sums.groupBy(_node(levels, F.col).alias("node")).agg(
            F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
        model.trees.append((levels, {x.node: -rate * x.g / (x.h + weight) for x in leaves}))
    return model
