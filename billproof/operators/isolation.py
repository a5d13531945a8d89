"""Isolation forest: random-split trees grown on bounded samples, path lengths of all rows in column functions.

Trees are grown on the driver from a sample of at most trees * SAMPLE rows, picked by hash. A forest is four flat arrays;
a row walks them with higher-order functions, so scoring is one projection without Python.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 256  # rows a tree is grown on
TREES = 100


def expected_length(n: int) -> float:
    """Mean path length of an unsuccessful search among n values."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


@dataclass(frozen=True)
class Forest:
    """Nodes of all trees: the feature and value of a split (feature -1: a leaf), the left child (the right one follows), and
    the path length a leaf stands for. A row goes left when its value is at most the split's."""

    roots: list[int]
    feature: list[int]
    split: list[float]
    left: list[int]
    length: list[float]
    depth: int
    sample: int

    def score(self, mean_length: float) -> float:
        return 2 ** (-mean_length / max(expected_length(self.sample), 1e-12))


def grow(rows: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = 42) -> Forest:
    """A forest from the sample's rows: each tree takes rows of its own as far as they go, and draws anew after that."""
    rng = np.random.default_rng(seed)
    size = min(sample, len(rows))
    depth = max(1, math.ceil(math.log2(max(size, 2))))
    feature, split, left, length, roots = [], [], [], [], []
    order = rng.permutation(len(rows))

    def node() -> int:
        for column, value in ((feature, -1), (split, 0.0), (left, 0), (length, 0.0)):
            column.append(value)
        return len(feature) - 1

    for t in range(trees):
        if (t + 1) * size <= len(rows):
            own = rows[order[t * size : (t + 1) * size]]
        else:
            own = rows[rng.choice(len(rows), size, replace=False)]
        root = node()
        roots.append(root)
        todo = [(root, own, 0)]
        while todo:
            at, part, deep = todo.pop()
            low, high = part.min(axis=0, initial=np.inf), part.max(axis=0, initial=-np.inf)
            varied = np.flatnonzero(high > low)
            if deep == depth or len(part) <= 1 or not len(varied):
                length[at] = deep + expected_length(len(part))
                continue
            f = int(rng.choice(varied))
            value = float(rng.uniform(low[f], high[f]))
            value = value if value < high[f] else float(low[f])  # rounding must not empty the right side
            below = part[:, f] <= value
            feature[at], split[at], left[at] = f, value, node()
            node()
            todo += [(left[at], part[below], deep + 1), (left[at] + 1, part[~below], deep + 1)]
    return Forest(roots, feature, split, left, length, depth, size)


def sampled(df: DataFrame, columns: Sequence[str], n: int, most: int) -> np.ndarray:
    """At most `most` of the n rows, by a hash of the values, as a matrix."""
    values = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(f"v{i}") for i, c in enumerate(columns)]
    spread = F.pmod(F.xxhash64(F.lit("forest"), *[F.col(f"`{c}`") for c in df.columns]), F.lit(1 << 40))
    rows = df.select(*values, spread.alias("s")).where(F.col("s") < int(min(1.0, 1.25 * most / max(n, 1)) * (1 << 40)))
    found = rows.orderBy("s", *[f"v{i}" for i in range(len(columns))]).limit(most).drop("s").collect()
    return np.array([tuple(r) for r in found], float).reshape(-1, len(columns))


def _numbers(values: Sequence[float], kind: str) -> Column:
    """A constant array, folded by the optimizer."""
    return F.split(F.lit(" ".join(map(repr, values))), " ").cast(f"array<{kind}>")


def mean_path_length(forest: Forest, columns: Sequence[str]) -> Column:
    """Mean path length of a row over the trees; NULL counts as 0."""
    features, splits = _numbers(forest.feature, "int"), _numbers(forest.split, "double")
    lefts, lengths = _numbers(forest.left, "int"), _numbers(forest.length, "double")

    def walk(row: Column, root: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            f = F.get(features, at)
            return F.when(f < 0, at).otherwise(F.get(lefts, at) + F.when(F.get(row, f) <= F.get(splits, at), 0).otherwise(1))

        return F.get(lengths, F.aggregate(F.sequence(F.lit(1), F.lit(forest.depth)), root, step))

    own = F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in columns])
    total = F.transform(F.array(own), lambda row: F.aggregate(_numbers(forest.roots, "int"), F.lit(0.0), lambda sum_, root: sum_ + walk(row, root)))
    return F.get(total, F.lit(0)) / F.lit(float(len(forest.roots)))


def isolation_score(forest: Forest, columns: Sequence[str]) -> Column:
    """Between 0 and 1; the greater, the easier a row is set apart."""
    return F.pow(F.lit(2.0), -mean_path_length(forest, columns) / F.lit(max(expected_length(forest.sample), 1e-12)))
