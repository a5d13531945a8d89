"""Hot keys, oversized groups and plan shapes."""

import statistics

import pytest
from pyspark.sql import functions as F

from billproof.operators import aggregates as A
from billproof.operators import joins as J
from billproof.operators import windows as W
from billproof.plans import dataset as D
from billproof.plans import rules as P
import __spark_entry__ as entry
from oracle import compare, connect


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def skewed(spark):
    """A third of the rows share one key, some keys are NULL."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 97)).alias("k"), "id"
    )


@pytest.fixture
def dim(spark):
    return spark.range(120).select(F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"), (F.col("id") * 2).alias("v"))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, shuffled, skewed, dim, how):
    salted = J.skew_join(skewed, dim, ["k"], how, split="salt", hot_rows=100, salts=7)
    expected = skewed.join(dim, ["k"], how)
    assert salted.columns == expected.columns
    assert bag(salted) == bag(expected)
    assert "_salt" in plan(salted)


def test_salt_spreads_the_hot_key(spark, shuffled, skewed, dim):
    spread = skewed.repartition(8)
    joined = J.skew_join(spread, dim, ["k"], "left", split="salt", hot_rows=100, salts=8)
    parts = joined.where("k = 'hot'").groupBy(F.spark_partition_id()).count().count()
    plain = spread.join(dim, ["k"], "left").where("k = 'hot'").groupBy(F.spark_partition_id()).count().count()
    assert plain == 1 and parts > 1


def test_lookup_cascade_on_skewed_rows(spark, shuffled, skewed, dim):
    doubled = dim.unionByName(dim.withColumn("v", F.col("v") + 1000))
    out = J.lookup_cascade(skewed.withColumn("k2", F.lit("k5")), doubled, [("k", "k"), ("k2", "k")], {"v": "v"}, matched="m", split="salt", hot_rows=100)
    assert out.count() == 3000
    assert {r.m for r in out.where("k IS NULL").collect()} == {2}
    assert out.where("k = 'hot' AND v = 0 AND m = 1").count() == 1000


def test_any_over_keeps_null_keys_apart(rows):
    df = rows("a string, c int", [("x", 1), ("x", 0), (None, 1), (None, 0), ("", 0), ("y", 0)])
    out = W.any_over(df, {"a": F.col("a")}, F.col("c") == 1, "f", "SIM", "NAO")
    assert sorted((r.a or ("<null>" if r.a is None else "<blank>"), r.f) for r in out.collect()) == [
        ("<blank>", "NAO"), ("<null>", "SIM"), ("<null>", "SIM"), ("x", "SIM"), ("x", "SIM"), ("y", "NAO"),
    ]


def test_concat_parts_loses_nothing(spark):
    df = spark.range(2000).select(F.when(F.col("id") < 1500, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 20)).alias("k"), F.concat(F.lit("t"), F.col("id") % 300).alias("t"))
    whole = {r.k: r.s for r in A.concat_parts(df, ["k"], {"s": F.col("t")}).collect()}
    parts = A.concat_parts(df, ["k"], {"s": F.col("t")}, limit=500).collect()
    hot = [r for r in parts if r.k == "hot"]
    assert len(hot) > 5 and {r._parts for r in hot} == {max(r._part for r in hot) + 1}
    assert sorted(" | ".join(r.s for r in hot).split(" | ")) == sorted(whole["hot"].split(" | "))
    assert all(r._parts == 1 and r.s == whole[r.k] for r in parts if r.k != "hot")


def test_concat_parts_deals_out_copies(spark):
    df = spark.range(5000).select(F.lit("hot").alias("k"), F.when(F.col("id") < 4900, "same").otherwise(F.concat(F.lit("t"), "id")).alias("t"))
    parts = A.concat_parts(df, ["k"], {"s": F.col("t")}, limit=2000).collect()
    assert len(parts) > 10 and max(len(r.s) for r in parts) < 12000
    texts = " | ".join(r.s for r in parts).split(" | ")
    assert texts.count("same") == 4900 and len(texts) == 5000
    once = A.concat_parts(df, ["k"], {"s": F.col("t")}, limit=2000, distinct=["s"]).collect()
    assert sum(r.s.count("same") for r in once) == 1


@pytest.mark.parametrize("values", [[5.0, 1.0, 3.0], [1.0, 2.0, 3.0, 10.0], [7.0] * 9 + [1.0], [float(i * i % 1009) for i in range(5000)], [2.5]])
def test_exact_median(rows, values):
    df = rows("v double", [(v,) for v in values] + [(None,)]).repartition(4)
    assert D.exact_medians(df, ["v"])["v"] == statistics.median(values)
    assert D.exact_medians(rows("v double", [(None,)]), ["v"]) == {"v": None}


def test_stratified_split_is_exact_and_repeatable(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 7 == 0, None).otherwise("b").alias("y"))
    train, test = D.stratified_split(df, "y", 0.2, 42, ["id"])
    again = D.stratified_split(df.repartition(9), "y", 0.2, 42, ["id"])[1]
    assert bag(train.unionByName(test)) == bag(df)
    assert bag(test) == bag(again)
    for r in df.groupBy("y").count().collect():
        n = test.where(F.col("y").eqNullSafe(F.lit(r.y))).count()
        assert r["count"] * 2 // 10 <= n <= -(-r["count"] * 2 // 10)  # shared out by largest remainder
    assert test.count() == 1000
    whole = D.stratified_split(df, None, 0.25, 1)[1]
    assert whole.count() == 1250


def test_surrogate_is_dense_and_ordered(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("k"), "id").repartition(6)
    out = W.surrogate(df, ["k", "id"], "n", start=2).orderBy("n").collect()
    assert [r.n for r in out] == list(range(2, 3002))
    assert [(r.k, r.id) for r in out] == sorted((r.k, r.id) for r in out)


def test_or_join_plans_no_nested_loop(spark, sf):
    assert "NestedLoop" not in plan(entry.queries()["j11_or_join"](spark, sf))


def test_first_last_needs_one_shuffle(spark, sf):
    text = plan(W.first_last(spark.range(10).select((F.col("id") % 3).alias("id"), F.col("id").alias("o")), ["id"], "o", {"o": "a"}, {"o": "b"}))
    assert text.count("Exchange hashpartitioning") == 1 and "Window" not in text


@pytest.mark.parametrize("name", ["n7_explode_findings", "d16_status_table", "d14_check_registration_similarity", "d22_account_rollup", "d29_migration_status", "f8_parse_items"])
def test_no_python_workers(spark, sf, name):
    text = plan(entry.queries()[name](spark, sf))
    assert not any(word in text for word in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct"))


def test_cycle_filters_reach_the_scan(spark, tmp_path):
    from billproof.functions.dates import in_cycle

    path = str(tmp_path / "t")
    spark.range(10).select(F.timestamp_seconds("id").alias("ts"), F.lit(19700101).alias("d"), F.lit("1970-01-01").alias("s"), F.lit("01/01/1970").alias("b")).write.parquet(path)
    df = spark.read.parquet(path)
    for column, encoding in (("ts", "ts"), ("d", "int"), ("s", "iso"), ("b", "br")):
        kept = df.where(in_cycle(F.col(column), "1970-01", encoding))
        pushed = plan(kept).split("PushedFilters: ")[1].split("]")[0]
        assert column in pushed.replace("IsNotNull(" + column + ")", ""), pushed
        assert kept.count() == 10
        assert df.where(in_cycle(F.col(column), "1970-02", encoding)).count() == 0


def test_item_cycle_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).select(F.lit("2026-07").alias("CICLO")).write.parquet(path)
    text = plan(P.select_cycle(spark.read.parquet(path), "202607"))
    assert "Contains" in text.split("PushedFilters: ")[1]


@pytest.mark.parametrize(
    "name", ["j2_lookup", "j3_lookup_cascade", "j5_two_roles", "j10_flag_exists", "j8_keep_existing", "u7_set_difference", "w4_any_over", "d3_rate_reference", "d16_status_table", "d26_tag_detail", "s12_upsert"]
)
def test_queries_on_salted_joins(spark, sf, shuffled, monkeypatch, name):
    monkeypatch.setattr(J, "HOT_ROWS", 40)
    monkeypatch.setattr(J, "SALTS", 3)
    assert compare(spark, connect(sf), entry.queries()[name], entry.oracle_sql()[name], sf) is None


def test_split_total_by_largest_remainder(spark):
    from billproof.plans import dataset as D

    rows = spark.createDataFrame([(i, "abc"[i % 3] if i < 27 else "d") for i in range(31)], "id long, y string")
    train, test = D.stratified_split(rows, "y", 0.2, 1)
    assert {r.y: r["count"] for r in test.groupBy("y").count().collect()} == {"a": 2, "b": 2, "c": 2, "d": 1}
    assert train.count() == 24


def test_outliers_resolve_ties(spark):
    from billproof.plans import segmentation as S

    rows = spark.createDataFrame([(i, 10.0 if i < 100 else i / 1e4) for i in range(1000)], "id long, faturamento_atual double")
    counts = {r.anomalia_iso: r["count"] for r in S.outliers(rows, columns=["faturamento_atual"]).groupBy("anomalia_iso").count().collect()}
    assert counts == {S.ANOMALY: 80, S.NORMAL: 920}


def test_one_row_tables_are_checked(spark):
    import pytest

    from billproof.operators import joins as J

    rows = spark.range(5)
    with pytest.raises(Exception, match="more than one row"):
        J.cross_one_row(rows, rows.withColumnRenamed("id", "x")).collect()
    assert J.cross_one_row(rows, rows.where("id = 3").withColumnRenamed("id", "x")).count() == 5


def _scans(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.count("FileScan"), len([x for x in text.split("\n") if "Exchange" in x and "BroadcastExchange" not in x])


@pytest.mark.parametrize("name", ["d25_detail", "d26_tag_detail"])
def test_details_read_the_hub_in_place(spark, sf, name):
    """One scan, and no exchange of the hub's rows."""
    assert _scans(entry.queries()[name](spark, sf)) == (1, 0)


def test_grains_from_one_fact(spark, sf):
    assert _scans(entry.queries()["d31_vanished"](spark, sf))[0] == 4  # two tables for each of two systems
    assert _scans(entry.queries()["d38_diagnose"](spark, sf))[0] <= 2  # the ordered months


def test_a_hot_account_lies_in_many_buckets(spark, rows):
    from billproof.plans import findings as P

    hub = spark.range(4000).select(
        F.concat(F.lit("f"), F.col("id") % 500).alias("FATURA"), F.lit("hot").alias("ID_CONTA_CONTRATO"), F.lit("VALIDACAO_NFCOM").alias("REGRA"),
        *[F.lit(None).cast("string").alias(c) for c in ("STATUS", "SUBSTATUS", "OBSERVACAO", "SEGMENTO", "Tipo_Servico", "Desc_Servico", "Tipo_Imposto", "Produto", "DADOS_BILLING", "DADOS_CONTRATO", "DADOS_TABELA_VERDADE", "VALOR_BILLING", "VALOR_CONTRATO")],
        F.lit("L").alias("ID_Lote"), F.lit("NG").alias("CRM"),
    )
    table = P.prepare_hub(hub, rows("ID_CONTA string", [("hot",)]), "L", buckets=8)
    sizes = [r["count"] for r in table.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1200
    assert P.detail_of(table, __import__("datetime").date(2026, 1, 1)).count() == 500
