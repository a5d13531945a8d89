"""Embedding whitening by incremental eigendecomposition.

Entries become integers, so counts, sums and deviations are exact. Every partition deals its rows to a few streams; a row
is a centred rank-one update of its stream's spectrum (`spectra`). Streams, and then the partitions' spectra in a tree of
small groups, are combined by successive rank-one updates: the eigenpairs of one and the distance of the means. The
eigenvectors found that way span the space; a last distributed pass sums the centred rows' products in that basis and solves
the small projected problem (Rayleigh-Ritz), which gives the eigenpairs to double precision. A further pass measures the
covariance of the whitened rows. What leaves Spark is sums of the size of the dimensions, squared at the most.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, spectra, vectors

STREAMS = 8
FAN = 8  # states that one step of a tree combines
STEP = 2048  # rows of a matrix product
SAFE = 2**62


@dataclass(frozen=True)
class Grid:
    """Integer entries: x = floor(scale * entry) + offset."""

    scale: int = 64
    offset: int = 1_000_000

    def entries(self, rows: np.ndarray) -> np.ndarray:
        """Integers as int64; as Python's integers where that isn't wide enough."""
        found = np.floor(rows * self.scale)
        if not len(found) or np.abs(found).max() < 2**52:
            return found.astype(np.int64) + self.offset
        return np.array([[math.floor(x * self.scale) + self.offset if math.isfinite(x * self.scale) else int(x) * self.scale + self.offset for x in row] for row in rows.tolist()], object)


@dataclass(frozen=True)
class Fit:
    """What every later pass needs of the fit list: rows, length, exact sums of each dimension."""

    n: int
    length: int
    sums: tuple[int, ...]
    grid: Grid

    def away(self, x: np.ndarray) -> np.ndarray:
        """n * x - sum, exact."""
        middle = [s // self.n for s in self.sums]
        rest = [s - m * self.n for s, m in zip(self.sums, middle)]
        if x.dtype != object and max((abs(m) for m in middle), default=0) < SAFE // 2:
            from_middle = x - np.array(middle, np.int64)
            if len(x) == 0 or int(np.abs(from_middle).max()) * self.n + self.n < SAFE:
                return from_middle * self.n - np.array(rest, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.away(x) / self.n).astype(float)


def deviations(away: np.ndarray) -> list[int | None]:
    """Exact sums of squares; null where they pass 64 bits."""
    if away.dtype != object and (not away.size or float(np.abs(away).max()) ** 2 * away.shape[1] < SAFE):
        return (away * away).sum(axis=1).tolist()
    found = [sum(a * a for a in row) for row in away.astype(object).tolist()]
    return [d if d < 2**63 else None for d in found]


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """key, v: rows whose vector is whole."""
    return df.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("v")).where(vectors.whole(F.col("v")))


def parts(batch: pa.RecordBatch, fit: Fit, step: int = STEP):
    """(keys, integer entries) of some rows of a batch at a time."""
    for at in range(0, batch.num_rows, step):
        some = batch.slice(at, step)
        yield some.column(0), fit.grid.entries(vectors.matrix(some.column(1), fit.length))


def list_of(df: DataFrame, grid: Grid) -> tuple[DataFrame, Fit]:
    """The fit list: vectors of the usual length (of the most rows; then the longest), with exact sums."""
    usual = df.groupBy(F.size("v").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    if usual is None or not usual["length"]:
        return df.limit(0), Fit(0, 0, (), grid)
    n, length = usual["count"], usual["length"]
    rows = df.where(F.size("v") == length)

    def state(batches) -> bytes | None:
        total = None
        for batch in batches:
            for _, x in parts(batch, Fit(n, length, (), grid)):
                fits = x.dtype != object and int(np.abs(x).max()) * len(x) < SAFE
                own = (x if fits else x.astype(object)).sum(axis=0).astype(object)
                total = own if total is None else total + own
        return None if total is None else written(total)

    def combine(states: list[bytes]) -> bytes:
        return written(np.sum([read(s) for s in states], axis=0))

    def written(total: np.ndarray) -> bytes:
        return " ".join(map(str, total)).encode()

    def read(state: bytes) -> np.ndarray:
        return np.array([int(t) for t in state.split()], object)

    return rows, Fit(n, length, tuple(read(combined(per_task(rows, state), "sums", combine))), grid)


def per_task(rows: DataFrame, state: Callable) -> DataFrame:
    """id, state: what `state` makes of the batches of each task with rows."""
    schema = pa.schema([("id", pa.int64()), ("state", pa.binary())])

    def run(batches: common.Batches) -> common.Batches:
        found = state(b for b in batches if b.num_rows)
        if found is not None:
            yield common.batch_of(schema, [[TaskContext.get().partitionId()], [found]])

    return rows.mapInArrow(run, "id long, state binary")


def combined(states: DataFrame, name: str, combine: Callable, fan: int = FAN) -> bytes | None:
    """All states in one, by a tree of groups of `fan` in the order of their ids. Every level is written to the shared folder."""
    schema = pa.schema([("id", pa.int64()), ("state", pa.binary())])

    def run(batches: common.Batches) -> common.Batches:
        now, held = None, []
        for batch in batches:
            for group, _, state in zip(*(c.to_pylist() for c in batch.columns)):
                if group != now and held:
                    yield common.batch_of(schema, [[now], [combine(held)]])
                    held = []
                now = group
                held.append(state)
        if held:
            yield common.batch_of(schema, [[now], [combine(held)]])

    level = common.stored(states, name)
    while (most := level.agg(F.max("id")).first()[0]) is not None and most > 0:
        dealt = level.select(F.floor(F.col("id") / fan).alias("of"), "id", "state").repartition("of").sortWithinPartitions("of", "id")
        level = common.stored(dealt.mapInArrow(run, "id long, state binary"), name)
    only = level.first()
    return None if only is None else bytes(only["state"])


def spectrum(rows: DataFrame, fit: Fit, streams: int = STREAMS) -> spectra.Streams | None:
    """The scatter spectrum of the fit list by rank-one updates. Entries are taken from the integer means."""
    middle = np.array([s // fit.n for s in fit.sums], object if max(map(abs, fit.sums)) // fit.n >= SAFE // 2 else np.int64)

    def state(batches) -> bytes | None:
        own, rest = spectra.Streams(streams, fit.length), np.zeros((0, fit.length))
        for batch in batches:
            for _, x in parts(batch, fit):
                rest = np.concatenate((rest, (x - middle).astype(float)))
                whole = len(rest) - len(rest) % streams
                for at in range(0, whole, streams):
                    own.update(rest[at : at + streams])
                rest = rest[whole:]
        if len(rest):
            own.update(rest)
        return own.one().packed() if own.n.any() else None

    def combine(states: list[bytes]) -> bytes:
        return spectra.together([spectra.unpacked(s, fit.length) for s in states]).one().packed()

    found = combined(per_task(rows, state), "spectra", combine)
    return None if found is None else spectra.unpacked(found, fit.length)


def products(rows: DataFrame, fit: Fit, basis: np.ndarray, name: str) -> np.ndarray:
    """Sums over the fit list of the outer products of (1, centred row in the basis)."""
    size = basis.shape[1] + 1
    sent = rows.sparkSession.sparkContext.broadcast(basis)

    def state(batches) -> bytes | None:
        total = None
        for batch in batches:
            for _, x in parts(batch, fit):
                y = np.append(np.ones((len(x), 1)), fit.centred(x) @ sent.value, axis=1)
                total = y.T @ y if total is None else total + y.T @ y
        return None if total is None else total.astype("<f8").tobytes()

    def combine(states: list[bytes]) -> bytes:
        return np.sum([np.frombuffer(s, "<f8") for s in states], axis=0).astype("<f8").tobytes()

    return np.frombuffer(combined(per_task(rows, state), name, combine), "<f8").reshape(size, size)


@dataclass(frozen=True)
class Whitening:
    """Eigenvalues of the covariance by falling size, unit eigenvectors as columns, and how far whitening is from the identity."""

    fit: Fit
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float

    @property
    def varied(self) -> np.ndarray:
        """Which components have a variance that is more than rounding."""
        return varied(self.values)


def varied(values: np.ndarray) -> np.ndarray:
    return values > len(values) * spectra.EPS * max(values.max(initial=0.0), 0.0)


def whitened(x: np.ndarray, fit: Fit, values: np.ndarray, basis: np.ndarray) -> np.ndarray:
    return fit.centred(x) @ (basis / np.sqrt(values))


def learn(rows: DataFrame, fit: Fit, components: int) -> Whitening:
    """The spectrum, refined by one Rayleigh-Ritz step, and a check of the whitened rows' covariance."""
    found = spectrum(rows, fit).vectors[0]
    total = None
    if np.isfinite(found).all():
        basis, _ = np.linalg.qr(found)
        total = products(rows, fit, basis, "ritz")
    if total is None or not np.isfinite(total).all():  # squares that pass the doubles
        return Whitening(fit, np.zeros(fit.length), np.eye(fit.length), 0.0)
    values, turn = np.linalg.eigh(total[1:, 1:] / fit.n)
    values, basis = values[::-1], basis @ turn[:, ::-1]
    basis = basis * np.where(basis[np.abs(basis).argmax(axis=0), np.arange(fit.length)] < 0, -1.0, 1.0)
    used = varied(values)[:components]
    error = 0.0
    if used.any():
        k = int(used.sum())
        total = products(rows, fit, basis[:, :k] / np.sqrt(values[:k]), "whitened")
        mean = total[0, 1:] / fit.n
        error = float(np.abs(total[1:, 1:] / fit.n - np.outer(mean, mean) - np.eye(k)).max())
    return Whitening(fit, values, basis, error)


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 32, grid: Grid = Grid()) -> DataFrame:  # noqa: B008
    """key, component int (from 1), n, deviation long, whitened, explained, identity_error double: for each row of the fit list
    and each of the first `components` components.

    The fit list is all rows whose vector is not null, holds no null or non-finite entry and has the usual length (that of the
    most rows; of equally many, the longest). Repeated rows and keys and null keys count like any other. Components without
    variance (constant or dependent dimensions, a single row) have null `whitened`, and `explained` is null where nothing
    varies at all; both are null where squares of entries pass the doubles. A deviation beyond 64 bits is null. No usable row gives an empty result. Other columns are not read.
    """
    rows, fit = list_of(usable(df, key, vector), grid)
    names = "key long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not fit.n:
        return df.sparkSession.createDataFrame([], names)
    found = learn(rows, fit, components)
    k = min(components, fit.length)
    good = found.varied[:k]
    trace = float(np.maximum(found.values, 0).sum())
    explained = [float(max(v, 0.0)) / trace if trace > 0 else None for v in found.values[:k]]
    sent = df.sparkSession.sparkContext.broadcast((fit, found.values[:k], found.vectors[:, :k]))
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
    schema = pa.schema([(n.split()[0], t) for n, t in zip(names.split(", "), types)])
    error = found.identity_error

    def run(batches: common.Batches) -> common.Batches:
        fit, values, basis = sent.value
        for batch in batches:
            for keys, x in parts(batch, fit, 512):
                away = fit.away(x)
                value = np.full((len(x), k), np.nan)
                value[:, good] = whitened(x, fit, values[good], basis[:, good])
                m = len(x)
                yield common.batch_of(schema, [
                    keys.take(pa.array(np.repeat(np.arange(m), k))), np.tile(np.arange(1, k + 1, dtype=np.int32), m), np.full(m * k, fit.n),
                    pa.array(deviations(away), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(value.ravel(), mask=np.tile(~good, m)), pa.array(explained * m, pa.float64()), np.full(m * k, error),
                ])

    return rows.mapInArrow(run, names)
