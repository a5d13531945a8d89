"""Order statistics, splits, forests, clusters and series against brute force; replaced tables."""

import math
import random
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from billproof.operators import aggregates as A
from billproof.operators import clusters, isolation, selection, series
from billproof.operators import windows as W
from billproof.plans import dataset as D
from billproof.plans import segmentation as S
from billproof.sources import tables as T


@pytest.fixture
def passes(monkeypatch):
    """How often the digits of a selection were counted."""
    seen = []
    real = selection.stored
    monkeypatch.setattr(selection, "stored", lambda df, name: (seen.append(name), real(df, name))[1])
    return lambda: seen.count("ranks")


def test_codes_order_like_doubles(spark):
    rng = random.Random(3)
    values = [0.0, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, math.inf, 1.0, 0.1]
    values += [math.ldexp(rng.random(), rng.randint(-1074, 1023)) for _ in range(500)]
    values = values + [-v for v in values]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", selection.ordered_code(F.col("v")).alias("c"))
    found = rows.select("v", "c", selection.decoded(F.col("c")).alias("back")).collect()
    assert all(r.back == r.v for r in found)
    assert [r.v for r in sorted(found, key=lambda r: r.c)] == sorted(values)
    odd = spark.createDataFrame([(math.nan,), (None,)], "v double").select(selection.ordered_code(F.col("v")).alias("c")).collect()
    assert odd[0].c > max(r.c for r in found) and odd[1].c is None


def test_medians_in_four_passes(spark, passes):
    rng = random.Random(4)
    data = [(rng.choice([None, -0.5, 1e300]), rng.gauss(0, 1e-3), float(rng.randint(0, 3)), None, i) for i in range(1001)]
    df = spark.createDataFrame(data, "a double, b double, c double, d double, e long")
    found = D.exact_medians(df, ["a", "b", "c", "d", "e"])
    want = {n: (float(np.median([r[i] for r in data if r[i] is not None])) if n != "d" else None) for i, n in enumerate("abcde")}
    assert found == want
    assert passes() == 4
    assert D.exact_medians(df, []) == {} and D.exact_medians(df.where("e < 0"), ["a"]) == {"a": None}


def test_first_rows_of_each_group_whatever_the_ties(spark):
    rng = random.Random(5)
    data = [(rng.choice(["x", "y", None]), rng.randint(-3, 3), 7) for _ in range(500)] + [("hot", 1, 1)] * 300
    df = spark.createDataFrame(data, "g string, v long, same long").repartition(7)
    wanted = {"x": 0, "y": 41, None: 3, "hot": 299}
    quota = F.when(F.col("g") == "x", 0).when(F.col("g") == "y", 41).when(F.col("g") == "hot", 299).otherwise(3)
    found = selection.mark_first(df, ["g"], [F.col("v"), F.col("same")], lambda sizes: sizes.select("g", quota.alias("_quota")), "m").collect()
    assert sorted(((r.g, r.v, r.same) for r in found), key=repr) == sorted(data, key=repr)
    for g, n in wanted.items():
        own = [r for r in found if r.g == g]
        assert sum(r.m for r in own) == n
        assert sorted(r.v for r in own if r.m) == sorted(r.v for r in own)[:n]
    none = selection.mark_first(df.where("v > 9"), ["g"], [F.col("v")], lambda sizes: sizes.select("g", F.lit(1).alias("_quota")), "m")
    assert none.collect() == []


def test_split_of_equal_rows_and_many_labels(spark):
    data = [(i % 40 if i < 400 else None, "same") for i in range(433)]
    df = spark.createDataFrame(data, "y int, t string")
    for partitions in (1, 6):
        train, test = D.stratified_split(df.repartition(partitions), "y", 0.25, 9)
        sizes = {r.y: r["count"] for r in test.groupBy("y").count().collect()}
        assert sum(sizes.values()) == math.ceil(433 * 0.25) and train.count() == 433 - math.ceil(433 * 0.25)
        assert sizes[None] in (8, 9) and all(sizes[y] in (2, 3) for y in range(40))
    ids = spark.range(1000)
    one, two = (sorted(r.id for r in D.stratified_split(ids.repartition(p), None, 0.3, 9)[1].collect()) for p in (2, 5))
    assert one == two and len(one) == 300  # by the rows alone, however they are partitioned


def walked(forest, row):
    total = 0.0
    for at in forest.roots:
        while forest.feature[at] >= 0:
            at = forest.left[at] + (row[forest.feature[at]] > forest.split[at])
        total += forest.length[at]
    return total / len(forest.roots)


def test_path_lengths_equal_a_walk(spark):
    rng = np.random.default_rng(6)
    rows = np.round(rng.normal(size=(300, 3)), 2)
    rows[:, 2] = 1.5
    forest = isolation.grow(rows, trees=20, sample=64)
    assert len(forest.roots) == 20 and set(forest.feature) == {-1, 0, 1}
    data = [*map(tuple, rows.tolist()), (None, 99.0, -1.0), (float("inf"), 0.0, 0.0)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    for r in df.withColumn("m", isolation.mean_path_length(forest, ["a", "b", "c"])).collect():
        assert abs(r.m - walked(forest, [0.0 if v is None else v for v in (r.a, r.b, r.c)])) < 1e-9
    assert isolation.grow(np.zeros((0, 2)), trees=3).feature == [-1, -1, -1]


@pytest.mark.parametrize("n", [1, 12, 13, 997])
def test_outliers_flag_the_share_exactly(spark, n):
    df = spark.createDataFrame([(i, float(i % 5), 1.0) for i in range(n)], "id long, faturamento_atual double, score_anomalia double")
    found = S.outliers(df, trees=10)
    assert found.where(F.col("anomalia_iso") == S.ANOMALY).count() == math.ceil(0.08 * n) and found.count() == n


def test_planted_outliers_are_found(spark):
    rng = np.random.default_rng(8)
    rows = rng.normal(size=(2000, 4))
    far = rng.choice(2000, 100, replace=False)
    rows[far, rng.integers(0, 4, 100)] += 12 * rng.choice([-1, 1], 100)
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(rows)], "id long, a double, b double, c double, d double")
    flagged = {r.id for r in S.outliers(df, columns=list("abcd")).where(F.col("anomalia_iso") == S.ANOMALY).collect()}
    assert len(flagged & set(far.tolist())) >= 90


def test_starts_share_their_passes(spark, monkeypatch):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    rng = np.random.default_rng(9)
    rows = np.concatenate([rng.normal(size=(60, 2)) + 6 * np.array(c) for c in ((0, 0), (0, 1), (1, 0), (2, 2), (3, 0), (1, 3))])
    df = spark.createDataFrame([tuple(map(float, r)) for r in rows], "a double, b double")
    found = clusters.fit(df, 6, seed=1)
    assert len(found.costs) == 10 and found.cost == min(found.costs) and found.passes <= 21
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="v").transform(df)
    best = min(KMeans(k=6, seed=s, featuresCol="v").fit(vectors).summary.trainingCost for s in range(10))
    assert found.cost <= best * 1.0001
    near = ((rows[:, None] - found.centres[None]) ** 2).sum(axis=2)
    assert abs(near.min(axis=1).sum() - found.cost) < 1e-6 * found.cost
    out = df.withColumn("cluster", clusters.nearest(found.centres, ["a", "b"])).collect()
    assert [r.cluster for r in out] == near.argmin(axis=1).tolist()


def test_series_of_many_ranges(spark):
    rng = random.Random(10)
    data = [(k, rng.randint(0, 40), float(rng.randint(0, 9))) for k in ("a", "a", "a", None, "b") for _ in range(120)] + [("one", 1, 2.0)] + [("a", 7, 7.0)] * 90
    df = spark.createDataFrame(data, "k string, o int, v double").repartition(5)
    found = series.in_order(df, ["k"], "o", ["v"], files=13).collect()
    for k in {d[0] for d in data}:
        own = sorted((r for r in found if r.k == k), key=lambda r: r._x)
        want = sorted((o, v) for kk, o, v in data if kk == k)
        assert [r._x for r in own] == list(range(len(want))) and [(r.o, r.v) for r in own] == want
        assert [None if r._prev is None else (r._prev.o, r._prev.v) for r in own] == [None, *want[:-1]]


def test_trend_and_changes_without_lists(spark):
    n = 200_000
    df = spark.range(n).select(F.col("id").alias("t"), (F.col("id") * 3 + 1).cast("double").alias("y"))
    trend = A.linear_trend(df.repartition(9), [], "t", {"y": "y"}).first()
    assert abs(trend.slope_y - 3) < 1e-9 and trend.r2_y == 1.0
    change = W.month_over_month(df.where("t < 4"), "t", {"y": "pct"}).collect()
    assert sorted((r.t, r.pct) for r in change) == [(1, 300.0), (2, 75.0), (3, 42.9)]
    plan = A.linear_trend(df, [], "t", {"y": "y"})._jdf.queryExecution().toString()
    assert "collect_list" not in plan


def test_overwrite_replaces_content_and_schema(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    T.overwrite(rows("a int, p string", [(1, "x"), (2, "y")]), path, ["p"])
    T.overwrite(rows("b string", [("z",)]), path)
    assert spark.read.parquet(path).columns == ["b"] and [r.b for r in spark.read.parquet(path).collect()] == ["z"]
    T.overwrite(spark.read.parquet(path).select("b", F.lit(1).alias("n")), path)  # from its own rows
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [("z", 1)]
    with pytest.raises(Exception):
        T.overwrite(rows("n int", [(0,)]).select(F.expr("raise_error('no')").alias("n")), path)
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [("z", 1)]
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith("_")] == ["t"]


def test_readers_never_meet_half_a_table(spark, tmp_path):
    path, seen, stop = str(tmp_path / "t"), set(), threading.Event()
    T.overwrite(spark.range(4000).repartition(8), path)

    def read():
        while not stop.is_set():
            try:
                seen.add(spark.read.parquet(path).count())
            except Exception:  # between listing and reading the table was replaced, or it was between the renames
                pass

    reader = threading.Thread(target=read)
    reader.start()
    for n in (5000, 6000, 7000):
        T.overwrite(spark.range(n).repartition(8), path)
    stop.set()
    reader.join()
    assert seen <= {4000, 5000, 6000, 7000}
