"""Revenue queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from billproof.operators import aggregates as A
from billproof.operators import joins as J
from billproof.operators import windows as W
from billproof.plans import revenue as R

from . import query
from .fixtures import (
    FACT_SQL,
    MONTH_NEW,
    MONTH_OLD,
    POST,
    PRE,
    START_NEW,
    STATS_SQL,
    STOPPED,
    WINDOW,
    fact,
    quoted,
)

D = "CAST(100 AS DOUBLE)"


def stats(spark, sf):
    return R.customer_stats(fact(spark, sf), STOPPED, MONTH_OLD, MONTH_NEW)


def rounded(df, *columns, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if c in columns else F.col(c) for c in df.columns])


def as_double(df, *columns):
    return df.select(*[F.col(c).cast("double").alias(c) if c in columns else F.col(c) for c in df.columns])


@query(
    "g1_revenue_fact",
    f"""WITH {FACT_SQL}
SELECT SISTEMA, CPF_CNPJ, ANO_MES, FATURA, QTD_CONTRATO, CAST(VALOR_FATURADO AS DOUBLE) AS VALOR_FATURADO FROM fact""",
)
def g1(spark, sf):
    return as_double(fact(spark, sf), "VALOR_FATURADO")


@query(
    "g2_customer_month",
    f"""WITH {FACT_SQL}
SELECT CPF_CNPJ, ANO_MES, CAST(VALOR AS DOUBLE) AS VALOR, CAST(QTD_CONTRATO AS BIGINT) AS QTD_CONTRATO FROM cm""",
)
def g2(spark, sf):
    return as_double(R.customer_month(fact(spark, sf)), "VALOR")


@query(
    "g3_distinct_customers_per_system",
    f"""WITH {FACT_SQL}
SELECT SISTEMA, COUNT(DISTINCT CPF_CNPJ) AS clientes, COUNT(DISTINCT FATURA) AS faturas,
       COUNT(DISTINCT ANO_MES) AS meses FROM fact GROUP BY SISTEMA""",
)
def g3(spark, sf):
    return fact(spark, sf).groupBy("SISTEMA").agg(
        F.count_distinct("CPF_CNPJ").alias("clientes"),
        F.count_distinct("FATURA").alias("faturas"),
        F.count_distinct("ANO_MES").alias("meses"),
    )


@query(
    "g9_overlap_months",
    f"""WITH {FACT_SQL}
SELECT CPF_CNPJ, ANO_MES, string_agg(DISTINCT SISTEMA, ' | ' ORDER BY SISTEMA) AS sistemas
FROM fact GROUP BY CPF_CNPJ, ANO_MES HAVING COUNT(DISTINCT SISTEMA) > 1""",
)
def g9(spark, sf):
    both = A.overlap(fact(spark, sf), ["CPF_CNPJ", "ANO_MES"], "SISTEMA")
    return both.select("CPF_CNPJ", "ANO_MES", F.concat_ws(" | ", "members").alias("sistemas"))


@query(
    "g13_pivot_system",
    f"""WITH {FACT_SQL}
SELECT CPF_CNPJ, ANO_MES,
  CAST(COALESCE(SUM(CASE WHEN SISTEMA = 'SIMETRA' THEN VALOR_FATURADO END), 0) AS DOUBLE) AS RECEITA_SIMETRA,
  CAST(COALESCE(SUM(CASE WHEN SISTEMA = 'NG' THEN VALOR_FATURADO END), 0) AS DOUBLE) AS RECEITA_NG
FROM fact GROUP BY CPF_CNPJ, ANO_MES""",
)
def g13(spark, sf):
    names = {"SIMETRA": "RECEITA_SIMETRA", "NG": "RECEITA_NG"}
    wide = A.pivot_sum(fact(spark, sf), ["CPF_CNPJ", "ANO_MES"], "SISTEMA", names, F.col("VALOR_FATURADO"))
    return as_double(wide, *names.values())


@query(
    "g14_two_level_pivot",
    f"""WITH {FACT_SQL}, lvl AS (
  SELECT ANO_MES, SISTEMA, CPF_CNPJ, SUM(VALOR_FATURADO) AS R FROM fact GROUP BY 1, 2, 3)
SELECT ANO_MES, CAST(COALESCE(MAX(CASE WHEN SISTEMA = 'SIMETRA' THEN R END), 0) AS DOUBLE) AS MAIOR_SIMETRA,
       CAST(COALESCE(MAX(CASE WHEN SISTEMA = 'NG' THEN R END), 0) AS DOUBLE) AS MAIOR_NG
FROM lvl GROUP BY ANO_MES""",
)
def g14(spark, sf):
    level = fact(spark, sf).groupBy("ANO_MES", "SISTEMA", "CPF_CNPJ").agg(F.sum("VALOR_FATURADO").alias("R"))
    wide = level.groupBy("ANO_MES").pivot("SISTEMA", ["SIMETRA", "NG"]).agg(F.max("R"))
    return wide.select(
        "ANO_MES",
        F.coalesce(F.col("SIMETRA").cast("double"), F.lit(0.0)).alias("MAIOR_SIMETRA"),
        F.coalesce(F.col("NG").cast("double"), F.lit(0.0)).alias("MAIOR_NG"),
    )


@query(
    "g15_trend_summary",
    f"""WITH {STATS_SQL}
SELECT TENDENCIA, COUNT(CPF_CNPJ) AS QTD_CNPJ, ROUND(SUM(TOTAL_FATURADO), 2) AS FATURAMENTO_TOTAL
FROM stats GROUP BY TENDENCIA""",
)
def g15(spark, sf):
    return rounded(R.trend_summary(stats(spark, sf)), "FATURAMENTO_TOTAL", digits=2)


@query(
    "g16_grand_total",
    f"""WITH {FACT_SQL}
SELECT CAST(SUM(VALOR_FATURADO) AS DOUBLE) AS TOTAL, COUNT(*) AS FATURAS FROM fact""",
)
def g16(spark, sf):
    return A.grand_total(
        fact(spark, sf), {"TOTAL": F.sum("VALOR_FATURADO").cast("double"), "FATURAS": F.count(F.lit(1))}
    )


KPI_SQL = """SELECT {by}, CAST(SUM(VALOR_FATURADO) AS DOUBLE) AS TOTAL, CAST(SUM(QTD_CONTRATO) AS BIGINT) AS CONTRATOS,
  COUNT(DISTINCT FATURA) AS FATURAS, COUNT(DISTINCT CPF_CNPJ) AS CNPJS_ATIVOS,
  CAST(SUM(VALOR_FATURADO) AS DOUBLE) / SUM(QTD_CONTRATO) AS TICKET_MEDIO
FROM fact WHERE VALOR_FATURADO > 0 GROUP BY {by}"""


@query("g17_monthly_kpi", f"WITH {FACT_SQL}\n" + KPI_SQL.format(by="ANO_MES"))
def g17(spark, sf):
    return R.monthly_kpi(fact(spark, sf))


@query("g17_monthly_kpi_by_system", f"WITH {FACT_SQL}\n" + KPI_SQL.format(by="ANO_MES, SISTEMA"))
def g17_by_system(spark, sf):
    return R.monthly_kpi(fact(spark, sf), ["ANO_MES", "SISTEMA"])


@query(
    "g18_linear_trend",
    f"""WITH {FACT_SQL}, kpi AS ({KPI_SQL.format(by="ANO_MES")}),
x AS (SELECT *, row_number() OVER (ORDER BY ANO_MES) - 1 AS i FROM kpi)
SELECT ROUND(regr_slope(TOTAL, i), 4) AS slope_total, ROUND(regr_r2(TOTAL, i), 3) AS r2_total,
       ROUND(regr_slope(CONTRATOS, i), 4) AS slope_contratos, ROUND(regr_r2(CONTRATOS, i), 3) AS r2_contratos,
       ROUND(regr_slope(TICKET_MEDIO, i), 4) AS slope_ticket, ROUND(regr_r2(TICKET_MEDIO, i), 3) AS r2_ticket,
       ROUND(regr_slope(CNPJS_ATIVOS, i), 4) AS slope_cnpjs, ROUND(regr_r2(CNPJS_ATIVOS, i), 3) AS r2_cnpjs
FROM x""",
)
def g18(spark, sf):
    out = R.kpi_trend(R.monthly_kpi(fact(spark, sf)))
    return rounded(out, *[c for c in out.columns if c.startswith("slope_")], digits=4)


@query(
    "w1_first_last",
    f"""WITH {FACT_SQL}
SELECT CPF_CNPJ, MIN(ANO_MES) AS PRIMEIRO_MES, CAST(arg_min(VALOR, ANO_MES) AS DOUBLE) AS PRIMEIRO_VALOR,
       MAX(ANO_MES) AS ULTIMO_MES, CAST(arg_max(VALOR, ANO_MES) AS DOUBLE) AS ULTIMO_VALOR
FROM cm GROUP BY CPF_CNPJ""",
)
def w1(spark, sf):
    out = W.first_last(
        R.customer_month(fact(spark, sf)),
        ["CPF_CNPJ"],
        "ANO_MES",
        {"ANO_MES": "PRIMEIRO_MES", "VALOR": "PRIMEIRO_VALOR"},
        {"ANO_MES": "ULTIMO_MES", "VALOR": "ULTIMO_VALOR"},
    )
    return as_double(out, "PRIMEIRO_VALOR", "ULTIMO_VALOR")


LAG_SQL = """lagged AS (
  SELECT CPF_CNPJ, ANO_MES, CAST(VALOR AS DOUBLE) AS VALOR,
         lag(CAST(VALOR AS DOUBLE)) OVER (PARTITION BY CPF_CNPJ ORDER BY ANO_MES) AS VALOR_ANTERIOR FROM cm
)"""


def _lagged(spark, sf):
    month = as_double(R.customer_month(fact(spark, sf)).drop("QTD_CONTRATO"), "VALOR")
    return W.lag_change(month, ["CPF_CNPJ"], "ANO_MES", "VALOR", "VALOR_ANTERIOR", "VARIACAO", "VARIACAO_PCT")


@query(
    "w2_lag_change",
    f"""WITH {FACT_SQL}, {LAG_SQL}
SELECT CPF_CNPJ, ANO_MES, VALOR, VALOR_ANTERIOR, VALOR - VALOR_ANTERIOR AS VARIACAO,
  CASE WHEN VALOR_ANTERIOR > 0 THEN (VALOR - VALOR_ANTERIOR) / VALOR_ANTERIOR * {D} END AS VARIACAO_PCT FROM lagged""",
)
def w2(spark, sf):
    return _lagged(spark, sf)


@query(
    "w3_worst_change",
    f"""WITH {FACT_SQL}, {LAG_SQL}, r AS (
  SELECT *, VALOR - VALOR_ANTERIOR AS VARIACAO,
         row_number() OVER (PARTITION BY CPF_CNPJ ORDER BY VALOR - VALOR_ANTERIOR, ANO_MES) AS rn
  FROM lagged WHERE VALOR - VALOR_ANTERIOR < 0)
SELECT CPF_CNPJ, ANO_MES, VALOR, VALOR_ANTERIOR, VARIACAO FROM r WHERE rn = 1""",
)
def w3(spark, sf):
    return W.worst_change(_lagged(spark, sf).drop("VARIACAO_PCT"), ["CPF_CNPJ"], "ANO_MES", "VARIACAO")


def _month_series(spark, sf):
    kpi = R.monthly_kpi(fact(spark, sf))
    return kpi.select("ANO_MES", F.round("TOTAL", 2).alias("TOTAL"), F.col("CONTRATOS").cast("double").alias("CONTRATOS"))


MOM_SQL = f"""kpi AS ({KPI_SQL.format(by="ANO_MES")}),
l AS (SELECT ANO_MES, TOTAL, CAST(CONTRATOS AS DOUBLE) AS CONTRATOS, lag(TOTAL) OVER (ORDER BY ANO_MES) AS pt,
      lag(CAST(CONTRATOS AS DOUBLE)) OVER (ORDER BY ANO_MES) AS pc FROM kpi),
mom AS (SELECT ANO_MES, ROUND((TOTAL - pt) / pt * {D}, 1) AS mm_fat, ROUND((CONTRATOS - pc) / pc * {D}, 1) AS mm_con
        FROM l WHERE pt IS NOT NULL)"""


@query("w7_month_over_month", f"WITH {FACT_SQL}, {MOM_SQL} SELECT ANO_MES, mm_fat, mm_con FROM mom")
def w7(spark, sf):
    return W.month_over_month(_month_series(spark, sf), "ANO_MES", {"TOTAL": "mm_fat", "CONTRATOS": "mm_con"})


@query(
    "w7_worst_month",
    f"""WITH {FACT_SQL}, {MOM_SQL}
SELECT ANO_MES AS pior_mes, mm_fat AS pior_pct FROM mom ORDER BY mm_fat, ANO_MES LIMIT 1""",
)
def w7_worst(spark, sf):
    mom = W.month_over_month(_month_series(spark, sf), "ANO_MES", {"TOTAL": "mm_fat"})
    return W.worst_period(mom, "ANO_MES", "mm_fat", "pior_mes", "pior_pct")


SPLIT_SQL = f"""sp AS (SELECT AVG(CASE WHEN ANO_MES <= '{MONTH_OLD}' THEN TOTAL END) AS pre_fat,
  AVG(CASE WHEN ANO_MES > '{MONTH_OLD}' THEN TOTAL END) AS post_fat,
  AVG(CASE WHEN ANO_MES <= '{MONTH_OLD}' THEN CONTRATOS END) AS pre_con,
  AVG(CASE WHEN ANO_MES > '{MONTH_OLD}' THEN CONTRATOS END) AS post_con FROM l)"""


@query(
    "w8_split_mean",
    f"""WITH {FACT_SQL}, {MOM_SQL}, {SPLIT_SQL}
SELECT ROUND(pre_fat, 4) AS pre_fat, ROUND(post_fat, 4) AS post_fat, ROUND((post_fat - pre_fat) / pre_fat * {D}, 6) AS pct_fat,
       ROUND(pre_con, 4) AS pre_con, ROUND(post_con, 4) AS post_con, ROUND((post_con - pre_con) / pre_con * {D}, 6) AS pct_con
FROM sp""",
)
def w8(spark, sf):
    out = W.split_mean(_month_series(spark, sf), "ANO_MES", MONTH_OLD, {"TOTAL": "fat", "CONTRATOS": "con"})
    return out.select(
        *[F.round(c, 6 if c.startswith("pct") else 4).alias(c) for c in out.columns]
    )


STAT_COLUMNS = (
    "CPF_CNPJ, TOTAL_FATURADO, MESES_ATIVOS, MEDIA_MENSAL, CAST(TOTAL_CONTRATOS AS BIGINT) AS TOTAL_CONTRATOS, "
    "PRIMEIRO_MES, PRIMEIRO_VALOR, ULTIMO_MES, ULTIMO_VALOR, TENDENCIA"
)


@query("d28_trend_class", f"WITH {STATS_SQL} SELECT {STAT_COLUMNS} FROM stats")
def d28(spark, sf):
    return R.trend_class(fact(spark, sf), STOPPED)


@query(
    "d29_migration_status",
    f"""WITH {STATS_SQL} SELECT {STAT_COLUMNS}, VAR_PCT, ERA_SIMETRA_FEV, FOI_NG_MAR, MESES_DUPLICADOS, STATUS_MIGRACAO
FROM stats""",
)
def d29(spark, sf):
    return stats(spark, sf)


@query(
    "d29_migration_summary",
    f"""WITH {STATS_SQL}
SELECT STATUS_MIGRACAO, COUNT(CPF_CNPJ) AS QTD, ROUND(SUM(TOTAL_FATURADO), 2) AS FATURAMENTO_TOTAL,
       ROUND(AVG(TOTAL_FATURADO), 4) AS TICKET_MEDIO_CNPJ FROM stats WHERE ERA_SIMETRA_FEV GROUP BY STATUS_MIGRACAO""",
)
def d29_summary(spark, sf):
    out = rounded(R.migration_summary(stats(spark, sf)), "FATURAMENTO_TOTAL", digits=2)
    return rounded(out, "TICKET_MEDIO_CNPJ", digits=4)


@query(
    "d29_duplicated_revenue",
    f"""WITH {FACT_SQL}, dup AS (SELECT CPF_CNPJ, ANO_MES FROM fact GROUP BY 1, 2 HAVING COUNT(DISTINCT SISTEMA) > 1)
SELECT COALESCE(CAST(SUM(VALOR_FATURADO) AS DOUBLE), 0) AS TOTAL FROM fact JOIN dup USING (CPF_CNPJ, ANO_MES)""",
)
def d29_duplicated(spark, sf):
    return R.duplicated_revenue(fact(spark, sf))


IMPACT_SQL = f"""pp AS (
  SELECT CPF_CNPJ,
    CAST(SUM(CASE WHEN ANO_MES IN ({quoted(PRE)}) THEN VALOR END) AS DOUBLE) AS TOTAL_PRE,
    SUM(CASE WHEN ANO_MES IN ({quoted(PRE)}) THEN QTD_CONTRATO END) AS CONTRATOS_PRE,
    COUNT(CASE WHEN ANO_MES IN ({quoted(PRE)}) THEN 1 END) AS MESES_PRE,
    CAST(SUM(CASE WHEN ANO_MES IN ({quoted(POST)}) THEN VALOR END) AS DOUBLE) AS TOTAL_POS,
    SUM(CASE WHEN ANO_MES IN ({quoted(POST)}) THEN QTD_CONTRATO END) AS CONTRATOS_POS,
    COUNT(CASE WHEN ANO_MES IN ({quoted(POST)}) THEN 1 END) AS MESES_POS
  FROM cm GROUP BY CPF_CNPJ
), im AS (
  SELECT CPF_CNPJ, TOTAL_PRE / MESES_PRE AS MEDIA_PRE, TOTAL_PRE / CAST(CONTRATOS_PRE AS DOUBLE) AS TICKET_PRE,
         TOTAL_POS / MESES_POS AS MEDIA_POS, TOTAL_POS / CAST(CONTRATOS_POS AS DOUBLE) AS TICKET_POS,
         CAST(CONTRATOS_PRE AS DOUBLE) / MESES_PRE AS MCP, CAST(CONTRATOS_POS AS DOUBLE) / MESES_POS AS MCO
  FROM pp WHERE MESES_PRE > 0 AND MESES_POS > 0
), iv AS (
  SELECT *, MEDIA_POS - MEDIA_PRE AS VAR_MEDIA_ABS, (MEDIA_POS - MEDIA_PRE) / MEDIA_PRE * {D} AS VAR_MEDIA_PCT,
         (MCO - MCP) / MCP * {D} AS VAR_CONTRATO_PCT, (TICKET_POS - TICKET_PRE) / TICKET_PRE * {D} AS VAR_TICKET_PCT
  FROM im WHERE MEDIA_POS - MEDIA_PRE < 0
)"""


@query(
    "d30_impact",
    f"""WITH {FACT_SQL}, {IMPACT_SQL}
SELECT CPF_CNPJ, MEDIA_PRE, MEDIA_POS, VAR_MEDIA_ABS, VAR_MEDIA_PCT, VAR_CONTRATO_PCT, VAR_TICKET_PCT,
  CASE WHEN abs(VAR_CONTRATO_PCT) >= abs(VAR_TICKET_PCT) THEN 'Redução de contratos'
       WHEN abs(VAR_TICKET_PCT) > abs(VAR_CONTRATO_PCT) THEN 'Redução de ticket' ELSE 'Mista' END AS CAUSA
FROM iv""",
)
def d30(spark, sf):
    return R.impact(fact(spark, sf), WINDOW).select(
        "CPF_CNPJ", "MEDIA_PRE", "MEDIA_POS", "VAR_MEDIA_ABS", "VAR_MEDIA_PCT", "VAR_CONTRATO_PCT", "VAR_TICKET_PCT", "CAUSA"
    )


@query(
    "d30_impact_total",
    f"WITH {FACT_SQL}, {IMPACT_SQL} SELECT ROUND(COALESCE(SUM(VAR_MEDIA_ABS), 0), 4) AS PERDA_ESTIMADA FROM iv",
)
def d30_total(spark, sf):
    return rounded(R.impact_total(R.impact(fact(spark, sf), WINDOW)), "PERDA_ESTIMADA", digits=4)


POST_GONE = POST[1:]
GONE_SQL = f"""gone AS (SELECT CPF_CNPJ FROM stats WHERE STATUS_MIGRACAO = 'SUMIU'),
gp AS (SELECT CPF_CNPJ, CAST(SUM(VALOR_FATURADO) AS DOUBLE) AS TOTAL_PRE, SUM(QTD_CONTRATO) AS CONTRATOS_PRE,
         COUNT(DISTINCT ANO_MES) AS MESES_PRE, MAX(ANO_MES) AS ULTIMO_MES_PRE
       FROM fact WHERE CPF_CNPJ IN (SELECT CPF_CNPJ FROM gone) AND ANO_MES IN ({quoted(PRE)}) GROUP BY CPF_CNPJ),
gs AS (SELECT CPF_CNPJ, CAST(SUM(VALOR_FATURADO) AS DOUBLE) AS TOTAL_POS, SUM(QTD_CONTRATO) AS CONTRATOS_POS,
         COUNT(DISTINCT ANO_MES) AS MESES_POS, MAX(ANO_MES) AS ULTIMO_MES_POS,
         string_agg(DISTINCT SISTEMA, ',' ORDER BY SISTEMA) AS SISTEMAS_POS
       FROM fact WHERE CPF_CNPJ IN (SELECT CPF_CNPJ FROM gone) AND ANO_MES IN ({quoted(POST_GONE)}) GROUP BY CPF_CNPJ),
gv AS (SELECT CPF_CNPJ, ULTIMO_MES_PRE, TOTAL_PRE, TOTAL_PRE / MESES_PRE AS MEDIA_MENSAL_PRE,
         CAST(CONTRATOS_PRE AS BIGINT) AS CONTRATOS_PRE, COALESCE(TOTAL_POS, 0) AS TOTAL_POS,
         COALESCE(TOTAL_POS / MESES_POS, 0) AS MEDIA_MENSAL_POS, CAST(COALESCE(CONTRATOS_POS, 0) AS BIGINT) AS CONTRATOS_POS,
         COALESCE(MESES_POS, 0) AS MESES_POS, ULTIMO_MES_POS, SISTEMAS_POS
       FROM gp LEFT JOIN gs USING (CPF_CNPJ))"""


@query(
    "d31_vanished",
    f"""WITH {STATS_SQL}, {GONE_SQL}
SELECT *, CASE WHEN TOTAL_POS > 0 THEN 'Reapareceu (outro sistema)' ELSE 'Zerou completamente' END AS STATUS_ATUAL,
  MEDIA_MENSAL_PRE - MEDIA_MENSAL_POS AS PERDA_MENSAL,
  (MEDIA_MENSAL_PRE - MEDIA_MENSAL_POS) / MEDIA_MENSAL_PRE * {D} AS PERDA_PCT FROM gv""",
)
def d31(spark, sf):
    out = R.vanished(fact(spark, sf), PRE, POST_GONE, MONTH_OLD, MONTH_NEW)
    joined = F.when(F.col("SISTEMAS_POS").isNotNull(), F.concat_ws(",", "SISTEMAS_POS"))
    return out.withColumn("SISTEMAS_POS", joined)


@query(
    "d31_vanished_summary",
    f"""WITH {STATS_SQL}, {GONE_SQL}
SELECT (SELECT COUNT(*) FROM gone) AS SUMIRAM, (SELECT COUNT(*) FROM gs) AS REAPARECERAM,
  (SELECT COUNT(*) FROM gone) - (SELECT COUNT(*) FROM gs) AS ZERARAM,
  ROUND((SELECT COALESCE(SUM(TOTAL_PRE), 0) FROM gp), 2) AS TOTAL_PRE, ROUND((SELECT COALESCE(SUM(TOTAL_POS), 0) FROM gs), 2) AS TOTAL_POS,
  ROUND((SELECT COALESCE(SUM(TOTAL_PRE), 0) FROM gp) - (SELECT COALESCE(SUM(TOTAL_POS), 0) FROM gs), 2) AS PERDA_TOTAL""",
)
def d31_summary(spark, sf):
    out = R.vanished_summary(fact(spark, sf), PRE, POST_GONE, MONTH_OLD, MONTH_NEW)
    return rounded(out, "TOTAL_PRE", "TOTAL_POS", "PERDA_TOTAL", digits=2)


@query(
    "d32_worst_fall",
    f"""WITH {STATS_SQL}, {LAG_SQL}, r AS (
  SELECT *, VALOR - VALOR_ANTERIOR AS VARIACAO_MES,
         row_number() OVER (PARTITION BY CPF_CNPJ ORDER BY VALOR - VALOR_ANTERIOR, ANO_MES) AS rn
  FROM lagged WHERE VALOR - VALOR_ANTERIOR < 0)
SELECT r.CPF_CNPJ, s.TENDENCIA, r.ANO_MES AS MES_MAIOR_QUEDA, r.VALOR_ANTERIOR, r.VALOR, r.VARIACAO_MES,
  r.VARIACAO_MES / r.VALOR_ANTERIOR * {D} AS QUEDA_PERCENTUAL, s.MESES_ATIVOS, s.TOTAL_FATURADO
FROM r JOIN stats s ON s.CPF_CNPJ = r.CPF_CNPJ WHERE rn = 1 ORDER BY r.VARIACAO_MES, r.CPF_CNPJ LIMIT 100""",
)
def d32(spark, sf):
    return R.worst_fall(fact(spark, sf), STOPPED)


@query(
    "d32_first_to_last_falls",
    f"""WITH {STATS_SQL}
SELECT CPF_CNPJ, PRIMEIRO_VALOR, ULTIMO_VALOR, PRIMEIRO_VALOR - ULTIMO_VALOR AS QUEDA_ABSOLUTA,
  (PRIMEIRO_VALOR - ULTIMO_VALOR) / PRIMEIRO_VALOR * {D} AS QUEDA_PERCENTUAL
FROM stats WHERE MESES_ATIVOS >= 2 AND PRIMEIRO_VALOR - ULTIMO_VALOR > 0
ORDER BY PRIMEIRO_VALOR - ULTIMO_VALOR DESC, CPF_CNPJ LIMIT 100""",
)
def d32_first_last(spark, sf):
    return R.first_to_last_falls(stats(spark, sf)).select(
        "CPF_CNPJ", "PRIMEIRO_VALOR", "ULTIMO_VALOR", "QUEDA_ABSOLUTA", "QUEDA_PERCENTUAL"
    )


TWO_SQL = f"""two0 AS (
  SELECT CPF_CNPJ,
    CAST(SUM(CASE WHEN SISTEMA = 'SIMETRA' THEN VALOR_FATURADO END) AS DOUBLE) AS TOTAL_SIMETRA,
    CAST(SUM(CASE WHEN SISTEMA = 'SIMETRA' THEN QTD_CONTRATO END) AS BIGINT) AS CONTRATOS_SIMETRA,
    MIN(CASE WHEN SISTEMA = 'SIMETRA' THEN ANO_MES END) AS PRIMEIRO_MES_SIMETRA,
    MAX(CASE WHEN SISTEMA = 'SIMETRA' THEN ANO_MES END) AS ULTIMO_MES_SIMETRA,
    COUNT(DISTINCT CASE WHEN SISTEMA = 'SIMETRA' THEN ANO_MES END) AS MESES_SIMETRA,
    CAST(SUM(CASE WHEN SISTEMA = 'NG' THEN VALOR_FATURADO END) AS DOUBLE) AS TOTAL_NG,
    CAST(SUM(CASE WHEN SISTEMA = 'NG' THEN QTD_CONTRATO END) AS BIGINT) AS CONTRATOS_NG,
    MIN(CASE WHEN SISTEMA = 'NG' THEN ANO_MES END) AS PRIMEIRO_MES_NG,
    MAX(CASE WHEN SISTEMA = 'NG' THEN ANO_MES END) AS ULTIMO_MES_NG,
    COUNT(DISTINCT CASE WHEN SISTEMA = 'NG' THEN ANO_MES END) AS MESES_NG
  FROM fact GROUP BY CPF_CNPJ HAVING COUNT(DISTINCT SISTEMA) = 2
), two1 AS (SELECT *, TOTAL_SIMETRA / MESES_SIMETRA AS MEDIA_SIMETRA, TOTAL_NG / MESES_NG AS MEDIA_NG FROM two0),
two2 AS (SELECT *, MEDIA_NG - MEDIA_SIMETRA AS VAR_MEDIA_ABS, (MEDIA_NG - MEDIA_SIMETRA) / MEDIA_SIMETRA * {D} AS VAR_MEDIA_PCT,
           ULTIMO_MES_SIMETRA >= '{START_NEW}' AS DUPLICIDADE FROM two1),
two AS (SELECT *, CASE WHEN DUPLICIDADE THEN 'Duplicidade ativa' WHEN VAR_MEDIA_PCT > 10 THEN 'Cresceu na migração'
          WHEN VAR_MEDIA_PCT < -10 THEN 'Perdeu valor' ELSE 'Manteve valor' END AS STATUS FROM two2)"""


def two(spark, sf):
    return R.two_system(fact(spark, sf), START_NEW)


@query("d33_two_system", f"WITH {FACT_SQL}, {TWO_SQL} SELECT * FROM two")
def d33(spark, sf):
    return two(spark, sf)


@query(
    "d33_two_system_summary",
    f"""WITH {FACT_SQL}, {TWO_SQL}
SELECT STATUS, COUNT(*) AS QTD_CNPJ, ROUND(SUM(TOTAL_SIMETRA), 2) AS TOTAL_SIMETRA, ROUND(SUM(TOTAL_NG), 2) AS TOTAL_NG,
  ROUND(AVG(VAR_MEDIA_PCT), 6) AS VAR_MEDIA_PCT_MEDIA FROM two GROUP BY STATUS""",
)
def d33_summary(spark, sf):
    out = rounded(R.two_system_summary(two(spark, sf)), "TOTAL_SIMETRA", "TOTAL_NG", digits=2)
    return rounded(out, "VAR_MEDIA_PCT_MEDIA")


@query("d33_lost_value", f"WITH {FACT_SQL}, {TWO_SQL} SELECT CPF_CNPJ, TOTAL_SIMETRA, TOTAL_NG, VAR_MEDIA_ABS FROM two WHERE STATUS = 'Perdeu valor'")
def d33_lost(spark, sf):
    return R.lost_value(two(spark, sf)).select("CPF_CNPJ", "TOTAL_SIMETRA", "TOTAL_NG", "VAR_MEDIA_ABS")


@query("d33_active_duplicates", f"WITH {FACT_SQL}, {TWO_SQL} SELECT CPF_CNPJ, ULTIMO_MES_SIMETRA, ULTIMO_MES_NG, TOTAL_SIMETRA FROM two WHERE DUPLICIDADE")
def d33_duplicates(spark, sf):
    return R.active_duplicates(two(spark, sf)).select("CPF_CNPJ", "ULTIMO_MES_SIMETRA", "ULTIMO_MES_NG", "TOTAL_SIMETRA")


GAP = """CAST((CAST(substr(PRIMEIRO_MES_NG, 1, 4) AS INT) - CAST(substr(ULTIMO_MES_SIMETRA, 1, 4) AS INT)) * 12
  + CAST(substr(PRIMEIRO_MES_NG, 6, 2) AS INT) - CAST(substr(ULTIMO_MES_SIMETRA, 6, 2) AS INT) AS INT)"""
TRANSITION_SQL = f"""tr AS (SELECT *, CASE WHEN GAP_MESES = 1 THEN 'Transição direta (1 mês)' WHEN GAP_MESES <= 0 THEN 'Sobreposição (simultâneo)'
  WHEN GAP_MESES <= 3 THEN 'Gap curto (2-3 meses)' ELSE 'Gap longo (4+ meses)' END AS TIPO_TRANSICAO
FROM (SELECT *, {GAP} AS GAP_MESES FROM two WHERE NOT DUPLICIDADE) t)"""


@query(
    "d34_transition",
    f"""WITH {FACT_SQL}, {TWO_SQL}, {TRANSITION_SQL}
SELECT CPF_CNPJ, STATUS, ULTIMO_MES_SIMETRA, PRIMEIRO_MES_NG, GAP_MESES, TIPO_TRANSICAO, MEDIA_SIMETRA, MEDIA_NG,
  VAR_MEDIA_ABS, VAR_MEDIA_PCT FROM tr""",
)
def d34(spark, sf):
    return R.transition(two(spark, sf))


@query(
    "d34_transition_summary",
    f"""WITH {FACT_SQL}, {TWO_SQL}, {TRANSITION_SQL}
SELECT TIPO_TRANSICAO, STATUS, COUNT(*) AS QTD, ROUND(AVG(VAR_MEDIA_PCT), 6) AS VAR_MEDIA_PCT_MEDIA FROM tr GROUP BY 1, 2""",
)
def d34_summary(spark, sf):
    return rounded(R.transition_summary(R.transition(two(spark, sf))), "VAR_MEDIA_PCT_MEDIA")


MATRIX_SQL = f"""mx0 AS (
  SELECT CPF_CNPJ, ANO_MES, CAST(COALESCE(SUM(CASE WHEN SISTEMA = 'SIMETRA' THEN VALOR_FATURADO END), 0) AS DOUBLE) AS SIMETRA,
         CAST(COALESCE(SUM(CASE WHEN SISTEMA = 'NG' THEN VALOR_FATURADO END), 0) AS DOUBLE) AS NG
  FROM fact WHERE CPF_CNPJ IN (SELECT CPF_CNPJ FROM chosen) GROUP BY CPF_CNPJ, ANO_MES
), mx1 AS (
  SELECT *, SIMETRA + NG AS TOTAL, lag(SIMETRA + NG) OVER (PARTITION BY CPF_CNPJ ORDER BY ANO_MES) AS TOTAL_ANTERIOR,
    CASE WHEN SIMETRA > 0 AND NG > 0 THEN 'SIMETRA + NG' WHEN SIMETRA > 0 THEN 'SIMETRA' WHEN NG > 0 THEN 'NG'
         ELSE 'SEM FATURAMENTO' END AS SISTEMA_ATIVO,
    CASE WHEN ANO_MES IN ({quoted(PRE)}) THEN 'PRE' ELSE 'POS' END AS PERIODO FROM mx0
), mx AS (SELECT *, TOTAL - TOTAL_ANTERIOR AS VAR_MES_ABS,
    CASE WHEN TOTAL_ANTERIOR > 0 THEN (TOTAL - TOTAL_ANTERIOR) / TOTAL_ANTERIOR * {D} END AS VAR_MES_PCT FROM mx1)"""


@query(
    "d35_month_matrix",
    f"WITH {FACT_SQL}, {TWO_SQL}, chosen AS (SELECT CPF_CNPJ FROM two), {MATRIX_SQL} SELECT * FROM mx",
)
def d35(spark, sf):
    return R.month_matrix(fact(spark, sf), two(spark, sf).select("CPF_CNPJ"), PRE)


DESTINY_SQL = f"""de0 AS (
  SELECT CPF_CNPJ, MAX(CASE WHEN o AND pre THEN ANO_MES END) AS ULTIMO_MES_SIM_PRE,
    COUNT(DISTINCT CASE WHEN o AND pre THEN ANO_MES END) AS MESES_SIM_PRE,
    CAST(SUM(CASE WHEN o AND pre THEN VALOR_FATURADO END) AS DOUBLE) AS RECEITA_SIM_PRE,
    CAST(SUM(CASE WHEN o AND pre THEN QTD_CONTRATO END) AS BIGINT) AS CONTRATOS_SIM_PRE,
    MIN(CASE WHEN n AND post THEN ANO_MES END) AS PRIMEIRO_MES_NG, MAX(CASE WHEN n AND post THEN ANO_MES END) AS ULTIMO_MES_NG,
    COUNT(DISTINCT CASE WHEN n AND post THEN ANO_MES END) AS MESES_NG_POS,
    CAST(COALESCE(SUM(CASE WHEN n AND post THEN VALOR_FATURADO END), 0) AS DOUBLE) AS RECEITA_NG_POS,
    CAST(COALESCE(SUM(CASE WHEN n AND post THEN QTD_CONTRATO END), 0) AS BIGINT) AS CONTRATOS_NG_POS,
    COUNT(CASE WHEN n THEN 1 END) AS LINHAS_NG_TOTAL,
    CAST(COALESCE(SUM(CASE WHEN n THEN VALOR_FATURADO END), 0) AS DOUBLE) AS RECEITA_NG_TOTAL,
    bool_or(n) AS EXISTE_NO_NG,
    COUNT(DISTINCT CASE WHEN o AND post THEN ANO_MES END) AS MESES_SIM_POS,
    CAST(COALESCE(SUM(CASE WHEN o AND post THEN VALOR_FATURADO END), 0) AS DOUBLE) AS RECEITA_SIM_POS,
    CAST(COALESCE(SUM(CASE WHEN o AND post THEN QTD_CONTRATO END), 0) AS BIGINT) AS CONTRATOS_SIM_POS,
    MAX(CASE WHEN o AND post THEN ANO_MES END) AS ULTIMO_MES_SIM_POS
  FROM (SELECT *, SISTEMA = 'SIMETRA' AS o, SISTEMA = 'NG' AS n, ANO_MES IN ({quoted(PRE)}) AS pre,
          ANO_MES IN ({quoted(POST)}) AS post FROM fact) f
  GROUP BY CPF_CNPJ
), de1 AS (
  SELECT *, RECEITA_SIM_PRE / MESES_SIM_PRE AS MEDIA_SIM_PRE,
    CASE WHEN MESES_NG_POS > 0 THEN RECEITA_NG_POS / MESES_NG_POS ELSE 0 END AS MEDIA_NG_POS,
    CASE WHEN MESES_SIM_POS > 0 THEN RECEITA_SIM_POS / MESES_SIM_POS ELSE 0 END AS MEDIA_SIM_POS
  FROM de0 WHERE ULTIMO_MES_SIM_PRE >= '{MONTH_OLD}'
), de2 AS (SELECT *, MEDIA_NG_POS + MEDIA_SIM_POS AS MEDIA_TOTAL_POS, MEDIA_NG_POS + MEDIA_SIM_POS - MEDIA_SIM_PRE AS VAR_ABS FROM de1),
de AS (SELECT *, VAR_ABS / MEDIA_SIM_PRE * {D} AS VAR_PCT, MEDIA_NG_POS / MEDIA_SIM_PRE * {D} AS COBERTURA_NG_PCT,
  CASE WHEN NOT EXISTE_NO_NG AND MESES_SIM_POS > 0 THEN 'Continua faturando no Simetra'
       WHEN NOT EXISTE_NO_NG THEN 'Ja faturou no Simetra e nao faturou no NG'
       WHEN MESES_NG_POS > 0 AND MESES_SIM_POS > 0 THEN 'Fatura nos 2 sistemas'
       WHEN MESES_NG_POS > 0 AND MEDIA_NG_POS >= MEDIA_SIM_PRE THEN 'Migrou - Ganhou receita'
       WHEN MESES_NG_POS > 0 THEN 'Migrou - Perdeu receita' ELSE 'Indefinido' END AS DESTINO FROM de2)"""


def destinies(spark, sf):
    return R.destiny(fact(spark, sf), WINDOW, MONTH_OLD)


@query("d36_destiny", f"WITH {FACT_SQL}, {DESTINY_SQL} SELECT * FROM de")
def d36(spark, sf):
    return destinies(spark, sf)


@query(
    "d36_destiny_summary",
    f"""WITH {FACT_SQL}, {DESTINY_SQL}
SELECT DESTINO, COUNT(*) AS QTD_CNPJ, ROUND(SUM(RECEITA_SIM_PRE), 2) AS RECEITA_PRE_TOTAL, ROUND(SUM(RECEITA_NG_POS), 2) AS RECEITA_NG_TOTAL,
  ROUND(SUM(RECEITA_SIM_POS), 2) AS RECEITA_SIM_POS_TOTAL, ROUND(AVG(COBERTURA_NG_PCT), 6) AS COBERTURA_NG_MEDIA_PCT,
  ROUND(AVG(VAR_PCT), 6) AS VAR_MEDIA_PCT, ROUND(SUM(RECEITA_NG_POS) + SUM(RECEITA_SIM_POS), 2) AS RECEITA_TOTAL_POS,
  ROUND(SUM(RECEITA_SIM_PRE) - (SUM(RECEITA_NG_POS) + SUM(RECEITA_SIM_POS)), 2) AS PERDA_TOTAL FROM de GROUP BY DESTINO""",
)
def d36_summary(spark, sf):
    out = R.destiny_summary(destinies(spark, sf))
    money = [c for c in out.columns if c.endswith("TOTAL") or c.endswith("TOTAL_POS")]
    return rounded(rounded(out, *money, digits=2), "COBERTURA_NG_MEDIA_PCT", "VAR_MEDIA_PCT")


@query(
    "d36_gone_customers",
    f"""WITH {FACT_SQL}, {DESTINY_SQL}
SELECT CPF_CNPJ, ULTIMO_MES_SIM_PRE, MESES_SIM_PRE, RECEITA_SIM_PRE, MEDIA_SIM_PRE, CONTRATOS_SIM_PRE FROM de
WHERE DESTINO = 'Ja faturou no Simetra e nao faturou no NG'""",
)
def d36_gone(spark, sf):
    return R.gone_customers(destinies(spark, sf))


@query(
    "j14_matrix_with_destiny",
    f"""WITH {FACT_SQL}, {DESTINY_SQL}, chosen AS (SELECT CPF_CNPJ FROM de), {MATRIX_SQL}
SELECT mx.CPF_CNPJ, DESTINO, PERIODO, ANO_MES, SISTEMA_ATIVO, SIMETRA, NG, TOTAL, RECEITA_SIM_PRE
FROM mx JOIN de ON de.CPF_CNPJ = mx.CPF_CNPJ""",
)
def j14(spark, sf):
    who = destinies(spark, sf).select("CPF_CNPJ", "DESTINO", "RECEITA_SIM_PRE")
    return R.month_matrix(fact(spark, sf), who, PRE, with_change=False).select(
        "CPF_CNPJ", "DESTINO", "PERIODO", "ANO_MES", "SISTEMA_ATIVO", "SIMETRA", "NG", "TOTAL", "RECEITA_SIM_PRE"
    )


@query(
    "d37_leak_check",
    f"""WITH {FACT_SQL}, only_new AS (SELECT DISTINCT CPF_CNPJ FROM fact WHERE SISTEMA = 'NG'
    AND CPF_CNPJ NOT IN (SELECT CPF_CNPJ FROM fact WHERE SISTEMA = 'SIMETRA'))
SELECT COUNT(*) AS VAZAMENTO FROM (SELECT DISTINCT CPF_CNPJ FROM fact WHERE SISTEMA = 'SIMETRA' AND ANO_MES IN ({quoted(PRE)})) b
WHERE CPF_CNPJ IN (SELECT CPF_CNPJ FROM only_new)""",
)
def d37(spark, sf):
    return R.leak_check(fact(spark, sf), PRE)


@query(
    "d38_diagnose",
    f"""WITH {FACT_SQL}, {MOM_SQL}, {SPLIT_SQL}, x AS (SELECT *, row_number() OVER (ORDER BY ANO_MES) - 1 AS i FROM kpi),
t AS (SELECT regr_slope(TOTAL, i) AS st, regr_slope(CONTRATOS, i) AS sc, regr_slope(TICKET_MEDIO, i) AS sk,
        ROUND(regr_r2(TOTAL, i), 3) AS r2_total, ROUND(regr_r2(CONTRATOS, i), 3) AS r2_contratos,
        ROUND(regr_r2(TICKET_MEDIO, i), 3) AS r2_ticket, ROUND(regr_r2(CNPJS_ATIVOS, i), 3) AS r2_cnpjs FROM x),
p AS (SELECT (post_fat - pre_fat) / pre_fat * {D} AS pf, (post_con - pre_con) / pre_con * {D} AS pc FROM sp),
wf AS (SELECT ANO_MES AS m, mm_fat AS v FROM mom ORDER BY mm_fat, ANO_MES LIMIT 1),
wc AS (SELECT ANO_MES AS m, mm_con AS v FROM mom ORDER BY mm_con, ANO_MES LIMIT 1)
SELECT CASE WHEN st < 0 THEN 'QUEDA' WHEN st > 0 THEN 'CRESCIMENTO' ELSE 'ESTÁVEL' END AS DIRECAO,
  CASE WHEN sc < 0 AND sk >= 0 THEN '{R.DX_CONTRACTS}' WHEN sk < 0 AND sc >= 0 THEN '{R.DX_TICKET}'
       WHEN sc < 0 AND sk < 0 THEN '{R.DX_MIXED}' ELSE '{R.DX_GROWTH}' END AS CAUSA,
  CASE WHEN pf < -5 THEN 'caiu' WHEN pf > 5 THEN 'cresceu' ELSE 'estável' END AS FATURAMENTO_POS,
  CASE WHEN pc < -5 THEN 'caiu' WHEN pc > 5 THEN 'cresceu' END AS CONTRATOS_POS,
  CASE WHEN abs(pf) > 2 AND abs(pc) > 2 THEN CASE WHEN pf < pc - 3 THEN '{R.DX_LESS_TICKET}' WHEN pc < pf - 3 THEN '{R.DX_CONCENTRATED}'
       ELSE '{R.DX_EXIT}' END END AS LEITURA,
  CASE WHEN wf.v < -5 THEN wf.m END AS PIOR_MES_FATURAMENTO, CASE WHEN wc.v < -5 THEN wc.m END AS PIOR_MES_CONTRATOS,
  ROUND(pf, 6) AS pct_fat, ROUND(pc, 6) AS pct_con, wf.v AS pior_fat_pct, wc.v AS pior_con_pct, r2_total, r2_contratos, r2_ticket, r2_cnpjs
FROM t, p, wf, wc""",
)
def d38(spark, sf):
    out = R.diagnose(R.monthly_kpi(fact(spark, sf)), MONTH_OLD)
    return rounded(out, "pct_fat", "pct_con")


@query(
    "k1_ordered_impact",
    f"""WITH {FACT_SQL}, {IMPACT_SQL} SELECT CPF_CNPJ, VAR_MEDIA_ABS FROM iv ORDER BY VAR_MEDIA_ABS, CPF_CNPJ""",
)
def k1(spark, sf):
    return R.impact(fact(spark, sf), WINDOW).select("CPF_CNPJ", "VAR_MEDIA_ABS").orderBy("VAR_MEDIA_ABS", "CPF_CNPJ")


@query(
    "k2_top_customers",
    f"""WITH {STATS_SQL} SELECT CPF_CNPJ, TOTAL_FATURADO, TENDENCIA FROM stats
ORDER BY TOTAL_FATURADO DESC, CPF_CNPJ LIMIT 100""",
)
def k2(spark, sf):
    top = W.top_n(stats(spark, sf), [F.desc("TOTAL_FATURADO"), F.col("CPF_CNPJ")], 100)
    return top.select("CPF_CNPJ", "TOTAL_FATURADO", "TENDENCIA")


@query(
    "k3_problem_customers",
    f"""WITH {STATS_SQL}, top AS (SELECT * FROM stats ORDER BY TOTAL_FATURADO DESC, CPF_CNPJ LIMIT 100)
SELECT CPF_CNPJ, TOTAL_FATURADO, TENDENCIA, STATUS_MIGRACAO, MESES_DUPLICADOS FROM top
WHERE TENDENCIA IN ('PAROU', 'QUEDA') OR STATUS_MIGRACAO = 'SUMIU' OR MESES_DUPLICADOS > 0
ORDER BY TOTAL_FATURADO DESC, CPF_CNPJ LIMIT 20""",
)
def k3(spark, sf):
    return R.problem_customers(stats(spark, sf)).select(
        "CPF_CNPJ", "TOTAL_FATURADO", "TENDENCIA", "STATUS_MIGRACAO", "MESES_DUPLICADOS"
    )


@query(
    "j1_inner_join",
    f"""WITH {FACT_SQL} SELECT DISTINCT a.CPF_CNPJ FROM fact a JOIN fact b ON a.CPF_CNPJ = b.CPF_CNPJ
WHERE a.SISTEMA = 'SIMETRA' AND b.SISTEMA = 'NG'""",
)
def j1(spark, sf):
    f = fact(spark, sf)
    old = f.where("SISTEMA = 'SIMETRA'").select("CPF_CNPJ").distinct()
    new = f.where("SISTEMA = 'NG'").select("CPF_CNPJ").distinct()
    return old.join(new, "CPF_CNPJ", "inner")


@query(
    "j10_flag_exists",
    f"""WITH {FACT_SQL} SELECT CPF_CNPJ, ANO_MES, FATURA,
  CPF_CNPJ IN (SELECT CPF_CNPJ FROM fact WHERE SISTEMA = 'NG' AND ANO_MES = '{MONTH_NEW}') AS FOI_NG_MAR
FROM fact WHERE SISTEMA = 'SIMETRA'""",
)
def j10(spark, sf):
    f = fact(spark, sf)
    there = f.where((F.col("SISTEMA") == "NG") & (F.col("ANO_MES") == MONTH_NEW)).select("CPF_CNPJ")
    old = f.where("SISTEMA = 'SIMETRA'").select("CPF_CNPJ", "ANO_MES", "FATURA")
    return J.flag_exists(old, there, {"CPF_CNPJ": "CPF_CNPJ"}, "FOI_NG_MAR")


@query(
    "j13_assemble",
    f"""WITH {FACT_SQL}, b AS (SELECT DISTINCT CPF_CNPJ FROM fact),
o AS (SELECT CPF_CNPJ, CAST(SUM(VALOR_FATURADO) AS DOUBLE) AS OLD_TOTAL FROM fact WHERE SISTEMA = 'SIMETRA' GROUP BY 1),
n AS (SELECT CPF_CNPJ, CAST(SUM(VALOR_FATURADO) AS DOUBLE) AS NEW_TOTAL, COUNT(*) AS NEW_ROWS FROM fact WHERE SISTEMA = 'NG' GROUP BY 1)
SELECT b.CPF_CNPJ, COALESCE(OLD_TOTAL, 0) AS OLD_TOTAL, COALESCE(NEW_TOTAL, 0) AS NEW_TOTAL, COALESCE(NEW_ROWS, 0) AS NEW_ROWS
FROM b LEFT JOIN o ON o.CPF_CNPJ = b.CPF_CNPJ LEFT JOIN n ON n.CPF_CNPJ = b.CPF_CNPJ""",
)
def j13(spark, sf):
    f = fact(spark, sf)
    total = F.sum("VALOR_FATURADO").cast("double")
    old = f.where("SISTEMA = 'SIMETRA'").groupBy("CPF_CNPJ").agg(total.alias("OLD_TOTAL"))
    new = f.where("SISTEMA = 'NG'").groupBy("CPF_CNPJ").agg(total.alias("NEW_TOTAL"), F.count(F.lit(1)).alias("NEW_ROWS"))
    fill = {"OLD_TOTAL": 0.0, "NEW_TOTAL": 0.0, "NEW_ROWS": 0}
    return J.assemble(f.select("CPF_CNPJ").distinct(), "CPF_CNPJ", [old, new], fill)
