"""Inputs of the registered queries, derived from the given tables by Spark, and the same derivations as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billproof.plans.revenue import Window2, revenue_fact

PRE = ("1997-12", "1998-01", "1998-02")
POST = ("1998-03", "1998-04", "1998-05", "1998-06", "1998-07")
WINDOW = Window2(PRE, POST)
STOPPED = "2001-03"
MONTH_OLD, MONTH_NEW = "1998-02", "1998-03"
START_NEW = "1998-03"
LOT = "2026-07"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def months(spark: SparkSession, sf: str) -> list[str]:
    """Every month from the first order to the last."""
    found = table(spark, sf, "orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")).first()
    if found["a"] is None:
        return ["1970-01"]
    low, high = (12 * d.year + d.month - 1 for d in (found["a"], found["b"]))
    return [f"{n // 12}-{n % 12 + 1:02d}" for n in range(low, high + 1)]


# -- revenue fact ---------------------------------------------------------------------------------------------


def sold_lines(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice")
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))


def old_layout(spark: SparkSession, sf: str) -> DataFrame:
    return sold_lines(spark, sf).where("o_orderstatus = 'F'").select(
        F.col("o_custkey").cast("string").alias("A1_CGC"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("FT_EMISSAO"),
        F.concat(F.lit(" A-"), F.col("o_orderkey")).alias("C5_X_SIMET"),
        F.col("l_suppkey").alias("C6_CONTRT"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("FT_VALCONT"),
    )


def new_layout(spark: SparkSession, sf: str) -> DataFrame:
    return sold_lines(spark, sf).where("o_orderstatus <> 'F'").select(
        F.col("o_custkey").cast("string").alias("CPF_CNPJ"),
        F.date_format("o_orderdate", "yyyy-MM").alias("MESANO"),
        F.col("o_orderkey").cast("string").alias("FATURA_NUMERO"),
        F.col("l_suppkey").alias("idcontrato"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("ReceitaBruta"),
        F.when(F.col("o_orderstatus") == "O", "NG").otherwise("ADAPTER").alias("crm"),
    )


def fact(spark: SparkSession, sf: str) -> DataFrame:
    return revenue_fact(old_layout(spark, sf), new_layout(spark, sf), months(spark, sf), amount_type="decimal(18,2)")


FACT_SQL = """
fact AS (
  SELECT CASE o_orderstatus WHEN 'F' THEN 'SIMETRA' ELSE 'NG' END AS SISTEMA,
         CAST(o_custkey AS VARCHAR) AS CPF_CNPJ,
         strftime(o_orderdate, '%Y-%m') AS ANO_MES,
         CAST(o_orderkey AS VARCHAR) AS FATURA,
         CASE o_orderstatus WHEN 'F' THEN COUNT(DISTINCT l_suppkey) ELSE COUNT(l_suppkey) END AS QTD_CONTRATO,
         SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS VALOR_FATURADO
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  WHERE o_orderstatus IN ('F', 'O')
  GROUP BY o_orderstatus, o_custkey, strftime(o_orderdate, '%Y-%m'), o_orderkey
), cm AS (
  SELECT CPF_CNPJ, ANO_MES, SUM(VALOR_FATURADO) AS VALOR, SUM(QTD_CONTRATO) AS QTD_CONTRATO
  FROM fact WHERE VALOR_FATURADO > 0 GROUP BY CPF_CNPJ, ANO_MES
)"""

STATS_SQL = (
    FACT_SQL
    + f""", base AS (
  SELECT CPF_CNPJ, CAST(SUM(VALOR) AS DOUBLE) AS TOTAL_FATURADO, COUNT(*) AS MESES_ATIVOS,
         CAST(SUM(VALOR) AS DOUBLE) / COUNT(*) AS MEDIA_MENSAL, SUM(QTD_CONTRATO) AS TOTAL_CONTRATOS,
         MIN(ANO_MES) AS PRIMEIRO_MES, CAST(arg_min(VALOR, ANO_MES) AS DOUBLE) AS PRIMEIRO_VALOR,
         MAX(ANO_MES) AS ULTIMO_MES, CAST(arg_max(VALOR, ANO_MES) AS DOUBLE) AS ULTIMO_VALOR
  FROM cm GROUP BY CPF_CNPJ
), dup AS (
  SELECT CPF_CNPJ, COUNT(*) AS MESES_DUPLICADOS FROM (
    SELECT CPF_CNPJ, ANO_MES FROM fact GROUP BY CPF_CNPJ, ANO_MES HAVING COUNT(DISTINCT SISTEMA) > 1
  ) t GROUP BY CPF_CNPJ
), stats0 AS (
  SELECT b.*,
    CASE WHEN MESES_ATIVOS = 1 THEN 'DADOS INSUFICIENTES' WHEN ULTIMO_MES <= '{STOPPED}' THEN 'PAROU'
         WHEN ULTIMO_VALOR > PRIMEIRO_VALOR * CAST(1.10 AS DOUBLE) THEN 'CRESCIMENTO'
         WHEN ULTIMO_VALOR < PRIMEIRO_VALOR * CAST(0.90 AS DOUBLE) THEN 'QUEDA' ELSE 'ESTÁVEL' END AS TENDENCIA,
    b.CPF_CNPJ IN (SELECT CPF_CNPJ FROM fact WHERE SISTEMA = 'SIMETRA' AND ANO_MES = '{MONTH_OLD}') AS ERA_SIMETRA_FEV,
    b.CPF_CNPJ IN (SELECT CPF_CNPJ FROM fact WHERE SISTEMA = 'NG' AND ANO_MES = '{MONTH_NEW}') AS FOI_NG_MAR,
    COALESCE(d.MESES_DUPLICADOS, 0) AS MESES_DUPLICADOS
  FROM base b LEFT JOIN dup d ON d.CPF_CNPJ = b.CPF_CNPJ
), stats AS (
  SELECT *, CASE WHEN ERA_SIMETRA_FEV AND FOI_NG_MAR THEN 'MIGROU' WHEN ERA_SIMETRA_FEV THEN 'SUMIU' ELSE 'N/A' END
              AS STATUS_MIGRACAO,
         CASE WHEN PRIMEIRO_VALOR > 0 THEN (ULTIMO_VALOR - PRIMEIRO_VALOR) / PRIMEIRO_VALOR * CAST(100 AS DOUBLE) END AS VAR_PCT
  FROM stats0
)"""
)
