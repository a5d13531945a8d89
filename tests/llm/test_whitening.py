"""Rank-one spectra and whitening against direct decompositions."""

import math

import numpy as np
import pytest

from billproof.llm import queries, spectra, whitening


@pytest.mark.parametrize("kind", ["full", "ties", "dependent", "constant", "single", "wide", "graded"])
def test_rank_one_updates_equal_a_direct_decomposition(kind):
    rng = np.random.default_rng(7)
    x = {
        "full": lambda: 20 * rng.normal(size=(300, 12)), "ties": lambda: rng.integers(-1, 2, size=(200, 6)).astype(float),
        "dependent": lambda: rng.normal(size=(90, 1)) * np.ones((1, 5)), "constant": lambda: np.full((40, 4), 3.0), "single": lambda: np.ones((1, 3)),
        "wide": lambda: rng.normal(size=(5, 20)), "graded": lambda: rng.normal(size=(200, 6)) * 10.0 ** np.arange(6),
    }[kind]()
    for streams in (1, 8):
        own = spectra.Streams(streams, x.shape[1])
        for at in range(0, len(x), streams):
            own.update(x[at : at + streams])
        one = own.one()
        centred = x - x.mean(axis=0)
        scatter = centred.T @ centred
        size = max(np.abs(scatter).max(), 1.0)
        assert one.n[0] == len(x)
        assert np.abs(one.mean[0] - x.mean(axis=0)).max() < 1e-9 * max(1, np.abs(x).max())
        assert np.abs(one.values[0] - np.linalg.eigvalsh(scatter)).max() < 1e-12 * size * len(scatter)
        assert np.abs(one.vectors[0].T @ one.vectors[0] - np.eye(x.shape[1])).max() < 1e-12
        assert np.abs((one.vectors[0] * one.values[0]) @ one.vectors[0].T - scatter).max() < 1e-12 * size * len(scatter)
        again = spectra.unpacked(one.packed(), x.shape[1])
        assert (again.values == one.values).all() and (again.vectors == one.vectors).all()


def frame(spark, rows):
    return spark.createDataFrame([(k, v, 1, "x", 2) for k, v in rows], "vec_id long, embedding array<double>, label int, v string, state int")


def check(found, rows, components=32):
    """rows: usable (key, vector), in any order."""
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows], object)
    n, d = x.shape
    sums = x.sum(axis=0)
    away = x * n - sums
    centred = (away / n).astype(float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, d)
    got = {}
    for r in found:
        got.setdefault((r.key, r.deviation), {}).setdefault(r.component, []).append(r)
    assert len(found) == n * k
    signs = {}
    for (key, _), a, own in zip(rows, away, centred):
        mine = got[key, int((a * a).sum())]
        assert sorted(mine) == list(range(1, k + 1))
        for c in range(1, k + 1):
            r = mine[c][0]
            assert r.n == n and r.identity_error < 1e-9
            if values.sum() <= 0:
                assert r.whitened is None and r.explained is None
                continue
            assert abs(r.explained - values[c - 1] / values.sum()) < 1e-9
            if values[c - 1] < 1e-9 * values[0]:
                assert r.whitened is None
                continue
            want = own @ vectors[:, c - 1] / math.sqrt(values[c - 1])
            if abs(want) > 1e-6:
                signs.setdefault(c, set()).add(np.sign(want) == np.sign(r.whitened))
            assert abs(abs(r.whitened) - abs(want)) < 1e-6
    assert all(len(s) == 1 for s in signs.values())


BAD = [(900, None), (901, []), (902, [1.0] * 3), (903, [None] + [0.0] * 5), (904, [float("nan")] + [0.0] * 5), (905, [float("inf")] + [0.0] * 5)]


def test_whitened_rows_equal_a_direct_decomposition(spark):
    rng = np.random.default_rng(11)
    rows = [(int(k) if k % 7 else None, list(map(float, v))) for k, v in enumerate(rng.normal(size=(250, 6)) * [3, 2.5, 2, 1.5, 1, 0.5])]
    rows += rows[:20]  # repeated rows
    for partitions, components in ((1, 32), (5, 4), (21, 6)):
        found = whitening.whiten(frame(spark, rows + BAD).repartition(partitions), components=components).collect()
        check(found, rows, components)


def test_little_variance_and_few_rows(spark):
    rng = np.random.default_rng(12)
    flat = [(k, [float(a), 2.0, float(a)]) for k, a in enumerate(rng.normal(size=30))]
    check(whitening.whiten(frame(spark, flat)).collect(), flat)
    check(whitening.whiten(frame(spark, [(1, [0.5, 0.25])])).collect(), [(1, [0.5, 0.25])])
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, None), (2, [None])])).collect() == []


def test_huge_entries_stay_exact(spark):
    rows = [(1, [1e17, 1.0]), (2, [-3e18, 2.0]), (3, [5.0, -7.5])]
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    for r in whitening.whiten(frame(spark, rows)).collect():
        want = sum((3 * a - s) ** 2 for a, s in zip(x[r.key - 1], sums))
        assert r.deviation == (want if want < 2**63 else None)
    rows = [(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, 3.0])]
    found = whitening.whiten(frame(spark, rows)).collect()
    assert len(found) == 6 and all(r.whitened is None and r.explained is None and (r.deviation is None) == (r.key < 3) for r in found)


def test_query(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(queries.op11_embedding_whitening(spark, sf).withColumnRenamed("vec_id", "key").collect(), rows)
