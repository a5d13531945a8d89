"""Segmentation, model and dataset queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from billproof.operators.joins import cross_one_row
from billproof.plans import dataset as D
from billproof.plans import segmentation as S

from . import query
from .fixtures import table
from .item_fixture import _sql_choice

SEV = _sql_choice(["critica", "ALTA ", "media", "Baixa", "SEM_HISTORICO", None], "CAST(o_orderkey % 6 AS INT)")
DISP = _sql_choice(["DISPERSAO_NEGATIVA", "DISPERSAO_POSITIVA", None], "CAST(o_custkey % 3 AS INT)")
CLS = _sql_choice(["anomalia_ml", "ALERTA_X", "NORMAL", "critico_1", "ANOMALIA_Z"], "CAST(o_orderkey % 5 AS INT)")
BASE = {
    "id": "o_orderkey",
    "faturamento_atual": "replace(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS {s}), '.', ',')",
    "faturamento_mes_anterior": "CASE WHEN o_orderkey % 9 = 0 THEN 'x' ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS {s}) END",
    "score_anomalia": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE concat(CAST(o_orderkey % 4 AS {s}), ',5') END",
    "qtde_meses_historico": "CAST(o_orderkey % 13 AS {s})",
    "SEGMENTO": "concat(' ', lower(c_mktsegment))",
    "UF": "n_name",
    "severidade": SEV,
    "tipo_dispersao_mes_anterior": DISP,
    "classificacao_final": CLS,
    "flag_anomalia": "CASE WHEN o_orderkey % 8 < 2 THEN 's' ELSE 'N' END",
    "cluster": "CAST(o_custkey % 6 AS INT)",
}
BASE_SQL = (
    "b0 AS (SELECT " + ", ".join(f"{e.format(s='VARCHAR')} AS {n}" for n, e in BASE.items())
    + " FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey), b AS (SELECT id, cluster, "
    + ", ".join(f"COALESCE(TRY_CAST(trim(replace({c}, ',', '.')) AS DOUBLE), 0) AS {c}" for c in ("faturamento_atual", "faturamento_mes_anterior", "score_anomalia", "qtde_meses_historico"))
    + ", " + ", ".join(f"upper(trim(COALESCE({c}, 'N/A'))) AS {c}" for c in ("SEGMENTO", "UF", "severidade", "tipo_dispersao_mes_anterior", "classificacao_final", "flag_anomalia"))
    + " FROM b0)"
)


def base(spark, sf):
    joined = (
        table(spark, sf, "orders")
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return S.prepare_base(joined.select(*[F.expr(e.format(s="STRING")).alias(n) for n, e in BASE.items()]))


def rounded(df, digits, *columns):
    return df.select(*[F.round(c, digits).alias(c) if c in columns else F.col(c) for c in df.columns])


@query("p20_prepare_base", f"WITH {BASE_SQL} SELECT id, faturamento_atual, faturamento_mes_anterior, score_anomalia, SEGMENTO, severidade, flag_anomalia FROM b")
def p20(spark, sf):
    return base(spark, sf).select("id", "faturamento_atual", "faturamento_mes_anterior", "score_anomalia", "SEGMENTO", "severidade", "flag_anomalia")


@query(
    "m1_standardise",
    f"""WITH {BASE_SQL}, m AS (SELECT AVG(faturamento_atual) AS a, stddev_pop(faturamento_atual) AS s, AVG(score_anomalia) AS a2, stddev_pop(score_anomalia) AS s2 FROM b)
SELECT id, ROUND((faturamento_atual - a) / s, 6) AS faturamento_atual, ROUND((score_anomalia - a2) / s2, 6) AS score_anomalia FROM b, m""",
)
def m1(spark, sf):
    out = D.standardise(base(spark, sf), ["faturamento_atual", "score_anomalia"])
    return rounded(out.select("id", "faturamento_atual", "score_anomalia"), 6, "faturamento_atual", "score_anomalia")


@query("m2_kmeans", "SELECT 6 AS grupos, COUNT(*) AS registros FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey")
def m2(spark, sf):
    out, _ = S.kmeans(base(spark, sf).drop("cluster"))
    return out.agg(F.countDistinct("cluster").alias("grupos"), F.count(F.lit(1)).alias("registros"))


@query(
    "m2_separable_groups",
    "SELECT o_orderkey % 6 AS grupo, COUNT(*) AS registros, 1 AS clusters, 6 AS clusters_no_total FROM orders GROUP BY o_orderkey % 6",
)
def m2_separable(spark, sf):
    """Six groups that lie far apart: every one is found whole, and no two share a cluster."""
    c = F.col
    g = (c("o_orderkey") % 6).alias("grupo")
    spread = c("o_totalprice").cast("double") / 1e6
    rows = table(spark, sf, "orders").select(
        g, ((c("o_orderkey") % 6) * 10 + spread).alias("faturamento_atual"), (F.pmod((c("o_orderkey") % 6) * 5, F.lit(7)) * 10 - spread).alias("score_anomalia")
    )
    found, _ = S.kmeans(rows)
    total = found.select(F.countDistinct("cluster").cast("int").alias("clusters_no_total"))
    return cross_one_row(found.groupBy("grupo").agg(F.count(F.lit(1)).alias("registros"), F.countDistinct("cluster").cast("int").alias("clusters")), total)


@query(
    "m3_outliers",
    f"""WITH {BASE_SQL}, m AS (SELECT AVG(faturamento_atual) AS a, stddev_pop(faturamento_atual) AS s, AVG(faturamento_mes_anterior) AS a2, stddev_pop(faturamento_mes_anterior) AS s2 FROM b)
SELECT id, ROUND(power((faturamento_atual - a) / s, 2) + power((faturamento_mes_anterior - a2) / s2, 2), 6) AS score_distancia FROM b, m""",
)
def m3(spark, sf):
    out = S.distance_score(base(spark, sf), ["faturamento_atual", "faturamento_mes_anterior"])
    return rounded(out.select("id", "score_distancia"), 6, "score_distancia")


@query(
    "m3_outlier_share",
    f"""WITH {BASE_SQL}, t AS (SELECT COUNT(*) AS n, CAST(ceil(0.08 * COUNT(*)) AS BIGINT) AS f FROM b)
SELECT '⚠️ ANOMALIA' AS anomalia_iso, f AS n FROM t UNION ALL SELECT 'NORMAL', n - f FROM t""",
)
def m3_share(spark, sf):
    return S.outliers(base(spark, sf)).groupBy("anomalia_iso").agg(F.count(F.lit(1)).alias("n"))


@query(
    "m3_planted_outliers",
    """SELECT COUNT(CASE WHEN o_orderkey % 25 = 0 THEN 1 END) AS plantados, TRUE AS achados_noventa_por_cento, CAST(ceil(0.08 * COUNT(*)) AS BIGINT) AS marcados FROM orders""",
)
def m3_planted(spark, sf):
    """A twenty-fifth of the rows lies far outside in one feature or the other; nine tenths of them or more are flagged."""
    c = F.col
    planted = c("o_orderkey") % 25 == 0
    usual = c("o_totalprice").cast("double")
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(planted & (c("o_orderkey") % 2 == 0), usual * 20 + 5e6).otherwise(usual).alias("faturamento_atual"),
        F.when(planted & (c("o_orderkey") % 2 == 1), -usual * 30 - 7e6).otherwise(F.pmod(c("o_custkey") * 37, F.lit(1000)).cast("double")).alias("media_faturamento_6m"),
    )
    out = S.outliers(rows)
    flagged = c("anomalia_iso") == S.ANOMALY
    found = F.count_if(flagged & planted) >= 0.9 * F.count_if(planted)
    return out.agg(F.count_if(planted).alias("plantados"), found.alias("achados_noventa_por_cento"), F.count_if(flagged).alias("marcados"))


@query("m4_severity_model")
def m4(spark, sf):
    rows = base(spark, sf)
    model, test, _ = S.fit_severity(rows, key=["id"])
    return S.predict_severity(model, test).groupBy("severidade", "severidade_prevista").agg(F.count(F.lit(1)).alias("n"))


SEPARABLE_SQL = """l AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 20 = 0 THEN 'CRITICA' WHEN o_orderkey % 5 < 2 THEN 'ALTA' WHEN o_orderkey % 5 = 2 THEN 'MEDIA' ELSE 'BAIXA' END AS severidade FROM orders)"""


def separable(spark, sf):
    """Labels that two features tell, besides one that says nothing."""
    c = F.col
    label = F.expr("CASE WHEN o_orderkey % 20 = 0 THEN 'CRITICA' WHEN o_orderkey % 5 < 2 THEN 'ALTA' WHEN o_orderkey % 5 = 2 THEN 'MEDIA' ELSE 'BAIXA' END")
    noise = F.pmod(c("o_custkey") * 31, F.lit(100)) / 100
    return table(spark, sf, "orders").select(
        c("o_orderkey").alias("id"),
        label.alias("severidade"),
        (F.when(label.isin("CRITICA", "ALTA"), 10.0).otherwise(0.0) + noise).alias("faturamento_atual"),
        (F.when(label.isin("CRITICA", "MEDIA"), 10.0).otherwise(0.0) - noise).alias("score_anomalia"),
        c("o_totalprice").cast("double").alias("media_faturamento_6m"),
    )


@query(
    "m4_held_out_recall",
    f"WITH {SEPARABLE_SQL} SELECT severidade, TRUE AS noventa_por_cento FROM l GROUP BY severidade",
)
def m4_held_out(spark, sf):
    """Recall of every severity on the rows that were kept out of training."""
    model, test, _ = S.fit_severity(separable(spark, sf), key=["id"], trees=20)
    hit = F.avg(F.when(F.col("severidade") == F.col("severidade_prevista"), 1.0).otherwise(0.0))
    return S.predict_severity(model, test).groupBy("severidade").agg((hit >= 0.9).alias("noventa_por_cento"))


@query(
    "m4_importances",
    """SELECT * FROM (VALUES ('faturamento_atual', TRUE, 1.0::DOUBLE), ('score_anomalia', TRUE, 1.0::DOUBLE), ('media_faturamento_6m', FALSE, 1.0::DOUBLE)) v(variavel, decide, soma)
WHERE (SELECT COUNT(*) FROM orders) >= 200""",
)
def m4_importances(spark, sf):
    """The features that tell the labels have nearly all the weight, and the weights sum to one."""
    _, _, found = S.fit_severity(separable(spark, sf), key=["id"], trees=20)
    total = found.agg(F.round(F.sum("importancia"), 6).alias("soma"))
    return cross_one_row(found.select("variavel", (F.col("importancia") > 0.2).alias("decide")), total)


@query(
    "m4_class_weights",
    f"""WITH {BASE_SQL}, s AS (SELECT severidade, COUNT(*) AS n FROM b GROUP BY 1), t AS (SELECT SUM(n) AS t, COUNT(*) AS k FROM s)
SELECT severidade, ROUND(CAST(t AS DOUBLE) / (k * n), 6) AS peso, n FROM s, t""",
)
def m4_weights(spark, sf):
    out = S.class_weights(base(spark, sf).select("severidade"), "severidade", "peso")
    return out.groupBy("severidade").agg(F.round(F.max("peso"), 6).alias("peso"), F.count(F.lit(1)).alias("n"))


@query(
    "m5_label_encoding",
    f"""WITH {BASE_SQL}, l AS (SELECT severidade, CAST(row_number() OVER (ORDER BY severidade) - 1 AS DOUBLE) AS codigo FROM (SELECT DISTINCT severidade FROM b) d)
SELECT b.id, l.codigo, l.severidade AS decodificado FROM b JOIN l ON l.severidade = b.severidade""",
)
def m5(spark, sf):
    encoded, model = S.label_encode(base(spark, sf).select("id", "severidade"), "severidade", "codigo")
    return S.label_decode(encoded, "codigo", "decodificado", model.labels).select("id", "codigo", "decodificado")


@query(
    "m6_split_counts",
    f"""WITH {BASE_SQL} SELECT severidade, CAST(ceil(COUNT(*) * 0.2) AS BIGINT) AS n_test, COUNT(*) - CAST(ceil(COUNT(*) * 0.2) AS BIGINT) AS n_train FROM b GROUP BY 1""",
)
def m6(spark, sf):
    marked = D.split_column(base(spark, sf), "severidade", 0.2, 42, ["id"], "teste")
    return marked.groupBy("severidade").agg(F.count_if("teste").alias("n_test"), F.count_if(~F.col("teste")).alias("n_train"))


@query(
    "g20_priority_panel",
    f"""WITH {BASE_SQL}, g AS (SELECT UF, COUNT(*) AS volume_contratos, SUM(faturamento_atual) AS imp, AVG(faturamento_atual) AS tk, COUNT(CASE WHEN flag_anomalia = 'S' THEN 1 END) AS ocorrencias_atencao,
    COUNT(CASE WHEN severidade = 'CRITICA' THEN 1 END) AS ocorrencias_criticas, COUNT(CASE WHEN tipo_dispersao_mes_anterior = 'DISPERSAO_NEGATIVA' THEN 1 END) AS disp_negativa FROM b GROUP BY UF),
h AS (SELECT *, ROUND(ocorrencias_atencao / volume_contratos * 100, 1) AS pct_atencao, ROUND(ocorrencias_criticas / volume_contratos * 100, 1) AS pct_critica FROM g)
SELECT UF, volume_contratos, ROUND(imp, 2) AS impacto_financeiro, ROUND(tk, 4) AS ticket_medio, ocorrencias_atencao, ocorrencias_criticas, disp_negativa, pct_atencao, pct_critica,
  ROUND(pct_critica * 0.5::DOUBLE + pct_atencao * 0.3::DOUBLE + imp / (SELECT greatest(MAX(imp), 1) FROM g) * 100 * 0.2::DOUBLE, 1) AS indice_prioridade FROM h""",
)
def g20(spark, sf):
    out = S.priority_by(base(spark, sf), "UF", None)
    return rounded(rounded(out, 2, "impacto_financeiro"), 4, "ticket_medio")


@query(
    "g21_cluster_profile",
    f"""WITH {BASE_SQL}, g AS (SELECT cluster, COUNT(*) AS registros, ROUND(AVG(faturamento_atual), 2) AS media_faturamento, ROUND(AVG(score_anomalia), 2) AS score_medio,
  ROUND(AVG(CASE WHEN flag_anomalia = 'S' THEN 1.0::DOUBLE ELSE 0 END) * 100, 1) AS pct_anomalia, ROUND(AVG(CASE WHEN severidade = 'CRITICA' THEN 1.0::DOUBLE ELSE 0 END) * 100, 1) AS pct_critico,
  ROUND(AVG(CASE WHEN tipo_dispersao_mes_anterior = 'DISPERSAO_NEGATIVA' THEN 1.0::DOUBLE ELSE 0 END) * 100, 1) AS disp_neg_pct FROM b GROUP BY cluster)
SELECT *, CASE WHEN pct_critico > 30 OR score_medio > 2 THEN '🔴 ALTO' WHEN pct_anomalia > 20 OR disp_neg_pct > 40 THEN '🟡 MÉDIO' ELSE '🟢 BAIXO' END AS risco FROM g""",
)
def g21(spark, sf):
    return S.cluster_profile(base(spark, sf))


@query(
    "g21_attached_risk",
    f"""WITH {BASE_SQL}, g AS (SELECT cluster, COUNT(*) AS registros, ROUND(AVG(faturamento_atual), 2) AS media_faturamento, ROUND(AVG(score_anomalia), 2) AS score_medio,
  ROUND(AVG(CASE WHEN flag_anomalia = 'S' THEN 1.0::DOUBLE ELSE 0 END) * 100, 1) AS pct_anomalia, ROUND(AVG(CASE WHEN severidade = 'CRITICA' THEN 1.0::DOUBLE ELSE 0 END) * 100, 1) AS pct_critico,
  ROUND(AVG(CASE WHEN tipo_dispersao_mes_anterior = 'DISPERSAO_NEGATIVA' THEN 1.0::DOUBLE ELSE 0 END) * 100, 1) AS disp_neg_pct FROM b GROUP BY cluster)
SELECT b.id, b.cluster, CASE WHEN pct_critico > 30 OR score_medio > 2 THEN '🔴 ALTO' WHEN pct_anomalia > 20 OR disp_neg_pct > 40 THEN '🟡 MÉDIO' ELSE '🟢 BAIXO' END AS risco_cluster FROM b JOIN g ON g.cluster = b.cluster""",
)
def g21_attached(spark, sf):
    rows = base(spark, sf)
    return S.attach_risk(rows, S.cluster_profile(rows)).select("id", "cluster", "risco_cluster")


@query(
    "m2_cluster_risk",
    """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN '🔴 ALTO' WHEN o_orderkey % 3 = 1 THEN '🟡 MÉDIO' ELSE '🟢 BAIXO' END AS risco_cluster FROM orders""",
)
def m2_risk(spark, sf):
    """The groups that k-means finds, profiled, and their risk on every row."""
    c = F.col
    g = c("o_orderkey") % 3
    rows = table(spark, sf, "orders").select(
        c("o_orderkey").alias("id"),
        (g * 100 + c("o_totalprice").cast("double") / 1e6).alias("faturamento_atual"),
        F.when(g == 0, 3.0).otherwise(1.0).alias("score_anomalia"),
        F.when(g == 1, "S").otherwise("N").alias("flag_anomalia"),
        F.lit("BAIXA").alias("severidade"),
        F.lit("ESTAVEL").alias("tipo_dispersao_mes_anterior"),
    )
    found, _ = S.kmeans(rows, k=3)
    return S.attach_risk(found, S.cluster_profile(found)).select("id", "risco_cluster")


@query(
    "g22_severity_distribution",
    f"""WITH {BASE_SQL}, o AS (SELECT * FROM (VALUES (0, 'CRITICA'), (1, 'ALTA'), (2, 'MEDIA'), (3, 'BAIXA'), (4, 'SEM_HISTORICO')) v(position, severidade))
SELECT position, o.severidade, COUNT(b.id) AS volume FROM o LEFT JOIN b ON b.severidade = o.severidade GROUP BY 1, 2""",
)
def g22(spark, sf):
    return S.severity_distribution(base(spark, sf))


@query(
    "g22_top_motives",
    f"""WITH {BASE_SQL} SELECT CASE classificacao_final WHEN 'ANOMALIA_ML' THEN 'SINAL FORA DO PADRÃO' ELSE classificacao_final END AS motivo, COUNT(*) AS volume FROM b
WHERE regexp_matches(classificacao_final, 'CRITICO|ANOMALIA|ALERTA') GROUP BY classificacao_final ORDER BY 2 DESC, classificacao_final LIMIT 8""",
)
def g22_motives(spark, sf):
    return S.top_motives(base(spark, sf))


@query(
    "g22_executive_summary",
    f"""WITH {BASE_SQL} SELECT COUNT(*) AS total, COUNT(CASE WHEN severidade IN ('CRITICA', 'ALTA') THEN 1 END) AS carteira_prioritaria,
  COUNT(CASE WHEN tipo_dispersao_mes_anterior = 'DISPERSAO_NEGATIVA' THEN 1 END) AS queda_faturamento, COUNT(CASE WHEN tipo_dispersao_mes_anterior = 'DISPERSAO_POSITIVA' THEN 1 END) AS alta_faturamento,
  COUNT(CASE WHEN faturamento_atual = 0 THEN 1 END) AS sem_faturamento FROM b""",
)
def g22_summary(spark, sf):
    return S.executive_summary(base(spark, sf))


RAW_SQL = """raw AS (SELECT DISTINCT l_orderkey AS order_key, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END AS qtd,
  CASE WHEN l_linenumber = 4 THEN NULL ELSE l_tax END AS tax_rate, CASE WHEN l_linenumber = 5 THEN NULL ELSE l_returnflag END AS species FROM lineitem),
md AS (SELECT median(qtd) AS mq, median(tax_rate) AS mt FROM raw),
mo AS (SELECT species AS ms FROM raw WHERE species IS NOT NULL GROUP BY species ORDER BY COUNT(*) DESC, species LIMIT 1),
im AS (SELECT order_key, COALESCE(qtd, mq) AS qtd, COALESCE(tax_rate, mt) AS tax_rate, COALESCE(species, ms) AS species FROM raw, md, mo)"""


def raw(spark, sf):
    c = F.col
    return table(spark, sf, "lineitem").select(
        c("l_orderkey").alias(" Order-Key"),
        F.when(c("l_linenumber") != 3, c("l_quantity")).alias("Qtd"),
        F.when(c("l_linenumber") != 4, c("l_tax")).alias("Tax  Rate"),
        F.when(c("l_linenumber") != 5, c("l_returnflag")).alias("SPECIES"),
    )


@query("g19_impute", f"WITH {RAW_SQL} SELECT order_key, qtd, tax_rate, species FROM im")
def g19(spark, sf):
    from billproof.functions.columns import normalize_columns

    unique = normalize_columns(raw(spark, sf)).distinct()
    out = D.impute(unique, ["qtd", "tax_rate"], ["species"])
    return out


@query(
    "d39_clean_dataset",
    f"""WITH {RAW_SQL}, st AS (SELECT AVG(qtd) AS a, stddev_pop(qtd) AS s, AVG(tax_rate) AS a2, stddev_pop(tax_rate) AS s2 FROM im)
SELECT ROUND((qtd - a) / s, 6) AS qtd, ROUND((tax_rate - a2) / s2, 6) AS tax_rate, species FROM im, st""",
)
def d39(spark, sf):
    config = D.DatasetConfig(["order key", "qtd", "tax rate", "species"], "Order Key", "Species")
    return rounded(D.clean(raw(spark, sf), config), 6, "qtd", "tax_rate")


@query(
    "d39_prepare_split",
    f"""WITH {RAW_SQL}, c AS (SELECT species, COUNT(*) AS n, floor(COUNT(*) * 0.2) AS low, COUNT(*) * 0.2 - floor(COUNT(*) * 0.2) AS r FROM im GROUP BY species),
q AS (SELECT species, n, CAST(low + CASE WHEN row_number() OVER (ORDER BY r DESC, species) <= ceil(SUM(n) OVER () * 0.2) - SUM(low) OVER () THEN 1 ELSE 0 END AS BIGINT) AS t FROM c)
SELECT species, t AS n_test, n - t AS n_train FROM q""",
)
def d39_split(spark, sf):
    marked = D.marked(raw(spark, sf), D.DatasetConfig(["qtd"], "order_key", "species"))
    return marked.groupBy("species").agg(F.count_if("_test").alias("n_test"), F.count_if(~F.col("_test")).alias("n_train"))
