"""K-means with several starts that advance in the same passes.

An iteration is one pass over the rows: a task finds the nearest centre of every start for blocks of rows and sends its sums by
start and centre, which are added up, so a pass returns starts * k rows whatever the size of the table. First centres are drawn
on the driver from a sample of at most SAMPLE rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .isolation import sampled

SAMPLE = 10_000
BLOCK = 8192  # rows whose distances a task holds at a time


@dataclass(frozen=True)
class Fit:
    centres: np.ndarray  # k, features
    cost: float  # sum of squared distances
    costs: list[float]  # of every start
    passes: int


def first_centres(rows: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k rows, each drawn with a chance that grows with the squared distance from those drawn before."""
    chosen = [rows[rng.integers(len(rows))]]
    while len(chosen) < k:
        away = np.min([((rows - c) ** 2).sum(axis=1) for c in chosen], axis=0)
        total = away.sum()
        chosen.append(rows[rng.choice(len(rows), p=away / total)] if total > 0 else rows[rng.integers(len(rows))])
    return np.array(chosen)


def _distances(centres: Column, features: Sequence[str]) -> Column:
    """Squared distances of a row from the centres (array of arrays)."""
    own = [F.col(f) for f in features]
    return F.transform(centres, lambda c: sum((own[i] - F.get(c, F.lit(i))) * (own[i] - F.get(c, F.lit(i))) for i in range(len(own))))


def _constant(centres: np.ndarray) -> Column:
    """Arrays of any depth as a constant that the optimizer folds."""
    kind = "double"
    for _ in range(centres.ndim):
        kind = f"array<{kind}>"
    return F.from_json(F.lit(json.dumps({"c": centres.tolist()})), f"c {kind}")["c"]


def nearest(centres: np.ndarray, features: Sequence[str]) -> Column:
    """Number of the nearest centre (ties: the smallest)."""
    away = _distances(_constant(centres), features)
    return F.get(F.transform(F.array(away), lambda d: F.array_position(d, F.array_min(d)).cast("int") - 1), F.lit(0))


def _sums(df: DataFrame, centres: np.ndarray) -> list:
    """For each start (starts, k, features) and centre that is some row's nearest: those rows' number, squared distances and
    feature sums."""
    features = df.columns
    starts, k, _ = centres.shape
    names = ["away", "n", *[f"s{i}" for i in range(len(features))]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((starts, k, len(names)))
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                rows = np.column_stack([part.column(i).to_numpy(zero_copy_only=False) for i in range(len(features))])
                for s in range(starts):
                    away = np.stack([((rows - c) ** 2).sum(axis=1) for c in centres[s]])
                    mine = away.argmin(axis=0)  # ties: the smallest number
                    total[s, :, 0] += np.bincount(mine, away[mine, np.arange(len(rows))], k)
                    total[s, :, 1] += np.bincount(mine, minlength=k)
                    for i in range(len(features)):
                        total[s, :, 2 + i] += np.bincount(mine, rows[:, i], k)
        met = np.argwhere(total[:, :, 1] > 0)
        found = total[met[:, 0], met[:, 1]]
        numbers = [pa.array(met[:, 0].astype("int32")), pa.array(met[:, 1].astype("int32"))]
        yield pa.RecordBatch.from_arrays([*numbers, *[pa.array(found[:, i]) for i in range(len(names))]], names=["start", "centre", *names])

    own = df.mapInArrow(run, ", ".join(["start int", "centre int", *[f"{n} double" for n in names]]))
    return own.groupBy("start", "centre").agg(*[F.sum(n).alias(n) for n in names]).collect()


def fit(df: DataFrame, k: int, seed: int = 42, starts: int = 10, rounds: int = 20, still: float = 1e-4) -> Fit:
    """The best of `starts` k-means runs over all columns of df, which is read once a pass. A start ends when no centre moves by
    more than `still` in any column, or after `rounds` moves."""
    features = df.columns
    sample = sampled(df, features, df.count(), SAMPLE)
    if not len(sample):
        return Fit(np.zeros((0, len(features))), 0.0, [], 0)
    rng = np.random.default_rng(seed)
    centres = np.stack([first_centres(sample, k, rng) for _ in range(starts)])
    live, costs, passes = np.arange(starts), np.zeros(starts), 0
    while len(live):
        passes += 1
        sums = _sums(df, centres[live])
        new, cost = centres[live].copy(), np.zeros(len(live))
        for r in sums:
            cost[r["start"]] += r["away"]
            new[r["start"], r["centre"]] = [r[f"s{i}"] / r["n"] for i in range(len(features))]
        moved = np.abs(new - centres[live]).max(axis=(1, 2)) > still
        costs[live] = cost
        if passes > rounds:
            break
        centres[live] = new
        live = live[moved]
    best = int(costs.argmin())
    return Fit(centres[best], float(costs[best]), costs.tolist(), passes)
