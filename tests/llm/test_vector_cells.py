"""Embedding near-dedup against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from billproof.llm import queries, vector_cells, vectors


def usable(v):
    return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, least):
    """key, links, component, kept of each row by all pairs."""
    good = [i for i, (_, v) in enumerate(rows) if usable(v)]
    unit = {i: (lambda a: a / np.linalg.norm(a))(np.asarray(rows[i][1], float) / np.abs(rows[i][1]).max()) for i in good}
    near = {i: [] for i in range(len(rows))}
    for length in {len(u) for u in unit.values()}:
        own = [i for i in good if len(unit[i]) == length]
        hit = np.stack([unit[i] for i in own])
        hit = hit @ hit.T >= least
        for a, i in enumerate(own):
            near[i] = [own[b] for b in np.flatnonzero(hit[a]) if own[b] != i]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        if root[i] == i and near[i]:
            todo = [i]
            while todo:
                for j in near[todo.pop()]:
                    if root[j] != i:
                        root[j] = i
                        todo.append(j)
    found = []
    for i, (key, _) in enumerate(rows):
        keys = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        component = min(keys) if keys else None
        found.append((key, len(near[i]), component, key == component))
    return sorted(found, key=repr)


def answer(df):
    return sorted((tuple(r) for r in df.select("key", "n_links", "component_id", "kept").collect()), key=repr)


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(k, v, 1, "x", 2) for k, v in rows], f"vec_id long, embedding array<{kind}>, label int, v string, id int")


def f32(v):
    return [float(x) for x in np.asarray(v, np.float32)]


def some(seed, n, d, spread):
    """Directionless vectors, chains of neighbours at the edge of 0.95, dense groups and copies."""
    rng = np.random.default_rng(seed)
    out = list(rng.normal(size=(n, d)))
    for _ in range(6):
        at = rng.normal(size=d)
        for _ in range(8):  # each step turns by about the angle of 0.95
            turn = rng.normal(size=d)
            turn -= turn @ at / (at @ at) * at
            at = at + math.tan(math.acos(0.95) * rng.uniform(0.9, 1.1)) * np.linalg.norm(at) / np.linalg.norm(turn) * turn
            out.append(at)
    centre = rng.normal(size=d)
    out += list(centre + spread * rng.normal(size=(60, d)))
    out += [out[0]] * 20 + [3 * np.asarray(out[1])]
    return [(int(k), f32(v)) for k, v in zip(rng.permutation(len(out)), out)]


ODD = [(None, [1.0, 0.0]), (7001, None), (7002, []), (7003, [0.0, 0.0]), (7004, [1.0, None]), (7005, [float("nan"), 1.0]), (7006, [float("inf"), 1.0]), (7007, [2.0, 0.0]), (7007, [2.0, 0.0]), (7008, [-1.0, 0.0]), (7009, [-0.0, 1e-30]), (7010, [0.0, 1e30])]


@pytest.mark.parametrize("cells, chunk, stream", [(None, 4096, 65536), (9, 4096, 65536), (40, 16, 50), (1, 10, 30)])
def test_links_equal_all_pairs(spark, cells, chunk, stream):
    rows = some(3, 400, 8, 0.15) + ODD
    found = vector_cells.near_duplicates(frame(spark, rows).repartition(3), cells=cells, chunk=chunk, stream=stream)
    assert answer(found) == brute(rows, 0.95)


def test_doubles_and_other_cosines(spark):
    rows = some(4, 150, 5, 0.3)
    for least in (0.8, 0.99):
        assert answer(vector_cells.near_duplicates(frame(spark, rows, "double"), least=least, cells=12)) == brute(rows, least)


def test_null_keys_alone_and_no_rows(spark):
    assert answer(vector_cells.near_duplicates(frame(spark, [(None, [1.0, 0.0]), (None, [1.0, 0.0])]))) == [(None, 1, None, True)] * 2
    assert answer(vector_cells.near_duplicates(frame(spark, []))) == []
    assert answer(vector_cells.near_duplicates(frame(spark, [(1, None)]))) == [(1, 0, 1, True)]


def test_every_partner_shares_a_cell():
    """The guests' bound, on vectors without direction: no pair is missed by cells alone."""
    rng = np.random.default_rng(5)
    rows = vectors.units(rng.normal(size=(1500, 6)))
    centres = vector_cells.fit(rows, 25)
    home, guest = vector_cells.visits(rows, centres, vector_cells.borders(centres, 0.95))
    a, b = np.nonzero(np.triu(rows @ rows.T >= 0.95, 1))
    assert len(a) > 100
    assert all(home[i] == home[j] or guest[i, home[j]] or guest[j, home[i]] for i, j in zip(a, b))


def test_query_equals_all_pairs(spark, sf):
    want = brute([(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()], 0.95)
    assert answer(queries.op12_vector_near_dedup(spark, sf).select(F.col("vec_id").alias("key"), "n_links", "component_id", "kept")) == want
