"""Standing-table queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from billproof.operators import aggregates as A
from billproof.operators import updates as X
from billproof.plans import rule_catalogue as K
from billproof.plans import standing as S
from billproof.plans import standing_layout as L

from . import query
from .fixtures import quoted, table
from .item_fixture import CFOP_CHOICES, _sql_choice

AT = dt.datetime(2026, 7, 31, 12, 0, 0)
MONEY = "CAST(l_extendedprice AS DECIMAL(18,2))"
TAX = "CAST(CAST(l_tax AS DECIMAL(4,2)) * 100 AS DECIMAL(8,4))"
VALUE = f"CASE WHEN l_linenumber = 7 THEN CAST(0 AS DECIMAL(18,2)) WHEN l_linenumber = 6 THEN NULL ELSE {MONEY} END"
CFOP = _sql_choice(CFOP_CHOICES, "CAST(l_suppkey % 12 AS INT)")
UF = _sql_choice([*K.STATES[:25]], "CAST(c_nationkey AS INT)")
NOTE = "CASE WHEN l_orderkey % 19 = 0 THEN '-' WHEN l_orderkey % 19 = 1 THEN NULL ELSE CAST(l_orderkey AS {s}) END"
CLASS = "CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE lpad(CAST(l_partkey % 60 AS {s}), 6, '0') END"
SERVICE = f"CASE WHEN l_partkey % 5 = 0 THEN {MONEY} END"
ICMS = f"CASE WHEN l_partkey % 3 = 0 THEN {MONEY} WHEN l_partkey % 3 = 1 THEN CAST(0 AS DECIMAL(18,2)) END"

# Source columns of each system: expressions both engines understand ({s} is the text type).
NG = {
    "FATURA_DATA_EMISSAO": "{br}", "NF_DATA_EMISSAO": "{br}", "DATA_INICIO_COBRANCA": "{iso}", "DATA_FIM_COBRANCA": "{br}",
    "CATEGORIA_FISCAL": "CASE WHEN l_partkey % 5 = 0 THEN 'ISS' ELSE ' ICMS ' END", "NF_NUMERO": NOTE, "POSICAO_ITEM": "l_linenumber",
    "CONTA_NUMERO": "CAST(o_custkey AS {s})", "NF_ITEM_COD_SAP": "CAST(l_partkey AS {s})", "NF_ITEM_VALOR": VALUE, "CFOP": CFOP,
    "ICMS_CST": "CASE WHEN l_returnflag = 'A' THEN '0' WHEN l_returnflag = 'N' THEN '40' END", "ICMS_ALIQUOTA": TAX,
    "ICMS_BASE_CALCULO": f"CASE WHEN l_linenumber = 3 THEN CAST(0 AS DECIMAL(18,2)) ELSE {MONEY} END",
    "ICMS_VALOR_IMPOSTO": ICMS, "ISS_VALOR_IMPOSTO": SERVICE, "PIS_ALIQUOTA": "CAST(0.65 AS DECIMAL(8,4))", "PIS_VALOR_IMPOSTO": MONEY,
    "FUST_VALOR_IMPOSTO": ICMS, "FUNTTEL_VALOR_IMPOSTO": MONEY, "NF_UF": f"lower({UF})", "CCLASS": CLASS,
    "CANCELADA": "CASE WHEN l_orderkey % 23 = 0 THEN ' sim' WHEN l_orderkey % 23 = 1 THEN NULL ELSE 'NAO' END",
    "STATUS_NFCOM": "CASE WHEN l_orderkey % 29 = 0 THEN 'SUBSTITUIÇÃO' ELSE 'NORMAL' END", "CHAVE_ACESSO_NFCOM": "CASE WHEN l_linenumber = 2 THEN '-' ELSE 'K' END",
    "FATURA_NUMERO": "CAST(l_orderkey AS {s})", "NF_VALOR": "CAST(" + MONEY + " AS {s})", "NF_ITEM_DESCRICAO": "concat('item ', l_returnflag)",
}
ADAPTER = {
    "DATA_EMISSAO_NOTA": "o_orderdate", "TipoNF": "'ADP'", "NUMERO_NF": NOTE, "Ordem": "l_linenumber", "CONTRATO": "CAST(o_custkey AS {s})",
    "ITEM_CODE_SAP": "CAST(l_partkey AS {s})", "ValorItemFiltro": VALUE, "NumeroCFOP": CFOP, "CST": "'0'", "ValorICMS": ICMS, "ValorISS": SERVICE,
    "PIS": "CAST(1.65 AS DECIMAL(8,4))", "ValorPIS": MONEY, "codigoClassificacao": CLASS, "CPF_CNPJ": "CAST(o_custkey AS {s})",
    "NotaCancelada": "CASE WHEN l_orderkey % 23 = 0 THEN 'SIM' ELSE 'NAO' END", "ValorFuntel": MONEY,
    "idcontrato": "CAST(o_custkey AS {s})", "FATURA_NUMERO": "CAST(l_orderkey AS {s})", "NF_ITEM_COD_SAP": "CAST(l_partkey AS {s})",
    "NF_ITEM_DESCRICAO": "concat('item ', l_returnflag)", "POSICAO_ITEM": "l_linenumber", "CFOP": CFOP, "ICMS_ALIQUOTA": TAX,
    "PIS_ALIQUOTA": "CAST(1.65 AS DECIMAL(8,4))", "NF_UF": UF, "NF_ITEM_VALOR": VALUE,
}
SIMETRA = {
    "FT_EMISSAO": "CAST({ymd} AS INT)", "TIPO_PROD": "'SIM'", "FT_NFISCAL": NOTE, "FT_ITEM": "l_linenumber", "COD_CNTR": "CAST(o_custkey AS {s})",
    "B1_COD": "CAST(l_partkey AS {s})", "FT_TOTAL": VALUE, "FT_CFOP": CFOP, "FT_ALIQICM": TAX, "FT_VALICM": ICMS, "FT_VALPIS": MONEY,
    "FT_VALIMP5": ICMS, "FT_ALIQPIS": "CAST(NULL AS DECIMAL(8,4))", "FT_ESTADO": UF, "B1_XCCLASS": CLASS,
    "FT_DTCANC": "CASE WHEN l_orderkey % 23 = 0 THEN '20260101' WHEN l_orderkey % 23 = 1 THEN ' ' END",
}
SPARK = {"s": "STRING", "br": "date_format(o_orderdate, 'dd/MM/yyyy')", "iso": "date_format(o_orderdate, 'yyyy-MM-dd')", "ymd": "date_format(o_orderdate, 'yyyyMMdd')"}
DUCK = {"s": "VARCHAR", "br": "strftime(o_orderdate, '%d/%m/%Y')", "iso": "strftime(o_orderdate, '%Y-%m-%d')", "ymd": "strftime(o_orderdate, '%Y%m%d')"}
STATUS = {"NG": "O", "ADAPTER": "P", "SIMETRA": "F"}


def source(spark, sf, system):
    columns = {"NG": NG, "ADAPTER": ADAPTER, "SIMETRA": SIMETRA}[system]
    orders = table(spark, sf, "orders").where(F.col("o_orderstatus") == STATUS[system])
    sold = orders.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))  # first: the lines then move once
    rows = table(spark, sf, "lineitem").join(sold, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(*[F.expr(e.format(**SPARK)).alias(n) for n, e in columns.items()])


def standing(spark, sf, cycle=None):
    parts = [source(spark, sf, s) for s in ("NG", "ADAPTER", "SIMETRA")]
    return S.build_standing(*parts, cycle, AT, strict=False)


def _raw_sql(system):
    columns = {"NG": NG, "ADAPTER": ADAPTER, "SIMETRA": SIMETRA}[system]
    body = ", ".join(f"{e.format(**DUCK)} AS {n}" for n, e in columns.items())
    return (
        f"raw_{system} AS (SELECT {body}, o_orderdate AS od FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey "
        f"WHERE o_orderstatus = '{STATUS[system]}')"
    )


def _mapped_sql(system):
    """Target columns that the checks look at."""
    get = {
        "NG": dict(nf="NF_NUMERO", pos="POSICAO_ITEM", ct="CONTA_NUMERO", pr="NF_ITEM_COD_SAP", val="NF_ITEM_VALOR", cfop="CFOP", cst="ICMS_CST",
                   ia="ICMS_ALIQUOTA", iv="ICMS_VALOR_IMPOSTO", sv="ISS_VALOR_IMPOSTO", pa="PIS_ALIQUOTA", pv="PIS_VALOR_IMPOSTO", fv="FUST_VALOR_IMPOSTO",
                   tv="FUNTTEL_VALOR_IMPOSTO", uf="upper(trim(NF_UF))", cc="CCLASS", canc="trim(CANCELADA)", doc="NULL", chave="CHAVE_ACESSO_NFCOM",
                   ini="CAST(od AS DATE)", em="CAST(od AS DATE)", cat="trim(CATEGORIA_FISCAL)"),
        "ADAPTER": dict(nf="NUMERO_NF", pos="Ordem", ct="CONTRATO", pr="ITEM_CODE_SAP", val="ValorItemFiltro", cfop="NumeroCFOP", cst="CST", ia="NULL",
                        iv="ValorICMS", sv="ValorISS", pa="PIS", pv="ValorPIS", fv="NULL", tv="ValorFuntel", uf="NULL", cc="codigoClassificacao",
                        canc="NotaCancelada", doc="CPF_CNPJ", chave="NULL", ini="NULL", em="CAST(od AS DATE)", cat="TipoNF"),
        "SIMETRA": dict(nf="FT_NFISCAL", pos="FT_ITEM", ct="COD_CNTR", pr="B1_COD", val="FT_TOTAL", cfop="FT_CFOP", cst="NULL", ia="FT_ALIQICM",
                        iv="FT_VALICM", sv="NULL", pa="FT_ALIQPIS", pv="FT_VALPIS", fv="FT_VALIMP5", tv="NULL", uf="FT_ESTADO", cc="B1_XCCLASS",
                        canc="CASE WHEN trim(FT_DTCANC) <> '' THEN 'SIM' ELSE 'NAO' END", doc="NULL", chave="NULL", ini="NULL", em="CAST(od AS DATE)", cat="TIPO_PROD"),
    }[system]
    m, r, v = "DECIMAL(18,2)", "DECIMAL(8,4)", "VARCHAR"
    return (
        f"SELECT '{system}' AS sistema_origem, strftime(od, '%Y%m') AS ciclo_faturamento, {get['cat']} AS categoria_fiscal, {get['nf']} AS nf_numero, {get['pos']} AS posicao_item, "
        f"{get['ct']} AS id_contrato, {get['pr']} AS cod_produto, CAST({get['val']} AS {m}) AS nf_item_valor, trim({get['cfop']}) AS cfop, CAST({get['cst']} AS {v}) AS icms_cst, "
        f"CAST({get['ia']} AS {r}) AS icms_aliquota, CAST({get['iv']} AS {m}) AS icms_valor, CAST({get['sv']} AS {m}) AS iss_valor, CAST({get['pa']} AS {r}) AS pis_aliquota, "
        f"CAST({get['pv']} AS {m}) AS pis_valor, CAST(NULL AS {m}) AS cofins_valor, CAST({get['fv']} AS {m}) AS fust_valor, CAST({get['tv']} AS {m}) AS funttel_valor, "
        f"CAST({get['uf']} AS {v}) AS uf_dest, {get['cc']} AS cclass, {get['canc']} AS cancelada, CAST({get['doc']} AS {v}) AS cpf_cnpj, CAST({get['chave']} AS {v}) AS chave_acesso_nfcom, "
        f"CAST({get['ini']} AS DATE) AS data_inicio_cobranca, {get['em']} AS data_emissao FROM raw_{system}"
    )


def _joined(*columns):
    return "concat_ws('|', " + ", ".join(f"COALESCE(trim(CAST({c} AS VARCHAR)), '')" for c in columns) + ")"


_HASHED = [c if c not in ("cofins_aliquota", "fust_aliquota", "funttel_aliquota") else "NULL" for c in L.HASHED]
STANDING_SQL = (
    ", ".join(_raw_sql(s) for s in STATUS)
    + ", united AS ("
    + " UNION ALL ".join(_mapped_sql(s) for s in STATUS)
    + f"""), standing AS (SELECT *, COALESCE(iss_valor > 0, FALSE) AS ind_sem_cst, COALESCE(nf_item_valor = 0, TRUE) AS faturamento_zerado,
  nf_numero IS NULL OR trim(nf_numero) IN ('', '-', 'NaN', 'nan', '0') AS fatura_sem_numero, COALESCE(upper(trim(cancelada)) = 'SIM', FALSE) AS ind_cancelada,
  md5({_joined(*L.KEYED)}) AS id_registro, sha256({_joined(*_HASHED)}) AS hash_registro FROM united)"""
)
STANDING_SELECT = [
    "id_registro", "hash_registro", "sistema_origem", "ciclo_faturamento", "categoria_fiscal", "nf_numero", "posicao_item", "id_contrato", "cod_produto", "cfop", "icms_cst",
    "uf_dest", "cclass", "cancelada", "cpf_cnpj", "ind_sem_cst", "faturamento_zerado", "fatura_sem_numero", "ind_cancelada",
]
_AMOUNTS = ["nf_item_valor", "icms_aliquota", "icms_valor", "iss_valor", "pis_aliquota", "fust_valor"]


def as_double(df, *columns):
    return df.select(*[F.col(c).cast("double").alias(c) if c in columns else F.col(c) for c in df.columns])


@query(
    "d1_build_standing",
    f"WITH {STANDING_SQL} SELECT {', '.join(STANDING_SELECT)}, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _AMOUNTS)
    + ", CAST(data_emissao AS VARCHAR) AS data_emissao, CAST(data_inicio_cobranca AS VARCHAR) AS data_inicio_cobranca FROM standing",
)
def d1(spark, sf):
    out = standing(spark, sf).select(*STANDING_SELECT, *_AMOUNTS, *[F.col(c).cast("string").alias(c) for c in ("data_emissao", "data_inicio_cobranca")])
    return as_double(out, *_AMOUNTS)


@query(
    "p8_cycle_filter",
    f"WITH {STANDING_SQL} SELECT id_registro, sistema_origem, ciclo_faturamento FROM standing WHERE ciclo_faturamento = '199803'",
)
def p8(spark, sf):
    return standing(spark, sf, "1998-03").select("id_registro", "sistema_origem", "ciclo_faturamento")


@query(
    "p17_derived_flags",
    f"WITH {STANDING_SQL} SELECT sistema_origem, ind_sem_cst, faturamento_zerado, fatura_sem_numero, ind_cancelada, COUNT(*) AS n FROM standing GROUP BY 1, 2, 3, 4, 5",
)
def p17(spark, sf):
    return A.distribution(standing(spark, sf), ["sistema_origem", *L.FLAGS])


@query("p18_cancelled", f"WITH {STANDING_SQL} SELECT nf_numero, posicao_item, cancelada FROM standing WHERE sistema_origem = 'SIMETRA'")
def p18(spark, sf):
    return S.extract(source(spark, sf, "SIMETRA"), "SIMETRA", None, strict=False).select("nf_numero", "posicao_item", "cancelada")


@query("f5_keys_and_hashes", f"WITH {STANDING_SQL} SELECT COUNT(DISTINCT id_registro) AS chaves, COUNT(DISTINCT hash_registro) AS hashes, COUNT(*) AS n FROM standing")
def f5(spark, sf):
    return standing(spark, sf).agg(
        F.count_distinct("id_registro").alias("chaves"), F.count_distinct("hash_registro").alias("hashes"), F.count(F.lit(1)).alias("n")
    )


_R = "ROUND(CAST(SUM(COALESCE({c}, 0)) AS DOUBLE), 2)"


@query(
    "q6_report_systems",
    f"""WITH {STANDING_SQL} SELECT sistema_origem, COUNT(*) AS total_itens, COUNT(DISTINCT id_contrato) AS contratos, COUNT(DISTINCT nf_numero) AS notas,
  COUNT(CASE WHEN faturamento_zerado THEN 1 END) AS zerados_pb000, COUNT(CASE WHEN fatura_sem_numero THEN 1 END) AS sem_nf,
  COUNT(CASE WHEN ind_cancelada THEN 1 END) AS canceladas, COUNT(CASE WHEN ind_sem_cst THEN 1 END) AS itens_iss, COUNT(CASE WHEN NOT ind_sem_cst THEN 1 END) AS itens_icms,
  {_R.format(c='nf_item_valor')} AS valor_r, {_R.format(c='icms_valor')} AS icms_r, {_R.format(c='iss_valor')} AS iss_r, {_R.format(c='pis_valor')} AS pis_r,
  {_R.format(c='cofins_valor')} AS cofins_r, {_R.format(c='fust_valor')} AS fust_r, {_R.format(c='funttel_valor')} AS funttel_r FROM standing GROUP BY 1""",
)
def q6_systems(spark, sf):
    out = S.report_systems(standing(spark, sf))
    return as_double(out, *[c for c in out.columns if c.endswith("_r")])


@query(
    "q6_report_cfop",
    f"""WITH {STANDING_SQL} SELECT sistema_origem, uf_dest, cfop, icms_cst, ind_sem_cst, COUNT(*) AS qtd, ROUND(CAST(SUM(nf_item_valor) AS DOUBLE), 2) AS valor_r,
  CASE WHEN cfop IS NULL THEN '⚪ sem CFOP' WHEN ind_sem_cst THEN '🟡 ISS/indSemCST' WHEN cfop NOT IN ({quoted(K.CFOPS)}) THEN '🔴 CFOP_INVALIDO'
    WHEN uf_dest = 'SP' AND substr(cfop, 1, 1) = '6' THEN '🔴 deveria 5xxx (intra)' WHEN uf_dest <> 'SP' AND substr(cfop, 1, 1) = '5' THEN '🔴 deveria 6xxx (inter)'
    ELSE '✅ OK' END AS status
FROM standing GROUP BY 1, 2, 3, 4, 5 ORDER BY qtd DESC, sistema_origem NULLS FIRST, uf_dest NULLS FIRST, cfop NULLS FIRST, icms_cst NULLS FIRST, ind_sem_cst NULLS FIRST LIMIT 200""",
)
def q6_cfop(spark, sf):
    return as_double(S.report_cfop(standing(spark, sf)), "valor_r")


@query(
    "q6_report_taxes",
    f"""WITH {STANDING_SQL} SELECT sistema_origem, COUNT(CASE WHEN icms_valor > 0 AND iss_valor > 0 THEN 1 END) AS icms_iss_simult,
  COUNT(CASE WHEN NOT ind_sem_cst AND icms_aliquota = 0 THEN 1 END) AS icms_aliq_zero, COUNT(CASE WHEN NOT ind_sem_cst AND icms_cst IS NULL THEN 1 END) AS icms_sem_cst,
  COUNT(CASE WHEN ind_sem_cst AND (pis_valor > 0 OR cofins_valor > 0) THEN 1 END) AS pis_cofins_indev_iss, COUNT(*) AS total FROM standing GROUP BY 1""",
)
def q6_taxes(spark, sf):
    return S.report_taxes(standing(spark, sf))


@query(
    "q6_report_funds",
    f"""WITH {STANDING_SQL} SELECT sistema_origem, CASE WHEN ind_sem_cst THEN 'ISS/SVA' ELSE 'ICMS' END AS tipo,
  COUNT(CASE WHEN NOT ind_sem_cst AND fust_valor = 0 THEN 1 END) AS fust_zero_icms, COUNT(CASE WHEN ind_sem_cst AND fust_valor > 0 THEN 1 END) AS fust_indevido_iss,
  COUNT(CASE WHEN NOT ind_sem_cst AND funttel_valor = 0 THEN 1 END) AS funttel_zero_icms, COUNT(CASE WHEN ind_sem_cst AND funttel_valor > 0 THEN 1 END) AS funttel_indevido_iss,
  {_R.format(c='fust_valor')} AS total_fust_r, {_R.format(c='funttel_valor')} AS total_funttel_r, COUNT(*) AS total FROM standing GROUP BY 1, 2""",
)
def q6_funds(spark, sf):
    return as_double(S.report_funds(standing(spark, sf)), "total_fust_r", "total_funttel_r")


@query(
    "q6_report_zero",
    f"""WITH {STANDING_SQL} SELECT sistema_origem, COUNT(DISTINCT id_contrato) AS contratos, COUNT(CASE WHEN faturamento_zerado THEN 1 END) AS itens_zerados,
  COUNT(CASE WHEN fatura_sem_numero THEN 1 END) AS sem_nf_numero FROM standing WHERE faturamento_zerado OR fatura_sem_numero GROUP BY 1""",
)
def q6_zero(spark, sf):
    return S.report_zero(standing(spark, sf))


def _pct(cond):
    return f"ROUND(COUNT(CASE WHEN {cond} THEN 1 END) * 100.0::DOUBLE / COUNT(*), 1)"


COVERAGE_SQL = f"""WITH {STANDING_SQL} SELECT sistema_origem, COUNT(*) AS total, {_pct("cfop <> ''")} AS pct_cfop, {_pct("cclass <> ''")} AS pct_cclass,
  {_pct("uf_dest IS NOT NULL")} AS pct_uf, {_pct("cpf_cnpj <> ''")} AS pct_cpf_cnpj, {_pct("icms_aliquota IS NOT NULL")} AS pct_icms_aliq,
  {_pct("icms_cst IS NOT NULL")} AS pct_icms_cst, {_pct("pis_aliquota IS NOT NULL")} AS pct_pis, {_pct("fust_valor IS NOT NULL")} AS pct_fust,
  {_pct("chave_acesso_nfcom NOT IN ('', '-', '0')")} AS pct_chave_nfcom FROM standing GROUP BY 1"""


@query("g6_coverage", COVERAGE_SQL)
def g6(spark, sf):
    return S.report_coverage(standing(spark, sf))


def standing_v1(spark, sf):
    return S.build_standing_v1(source(spark, sf, "NG"), source(spark, sf, "ADAPTER"), "2026-07", "2026-06", AT, strict=False)


V1_SQL = f"""{_raw_sql("NG")}, {_raw_sql("ADAPTER")}, v1 AS (
  SELECT 'NG' AS sistema_origem, '202607' AS ciclo_faturamento, CONTA_NUMERO AS id_conta_contrato, FATURA_NUMERO AS fatura_numero, NF_ITEM_COD_SAP AS nf_item_cod_sap,
    NF_ITEM_DESCRICAO AS nf_item_descricao, CASE WHEN upper(trim(NF_NUMERO)) IN ('', 'NULL', 'NAN', 'NONE', '-') THEN NULL ELSE trim(NF_NUMERO) END AS nf_numero,
    CAST(POSICAO_ITEM AS VARCHAR) AS posicao_item, CCLASS AS cclass, CASE WHEN upper(trim(CFOP)) IN ('', 'NULL', 'NAN', 'NONE', '-') THEN NULL ELSE trim(CFOP) END AS cfop,
    ICMS_CST AS cst_icms, CAST(ICMS_ALIQUOTA AS DOUBLE) AS icms_aliquota, CAST(PIS_ALIQUOTA AS DOUBLE) AS pis_aliquota, CAST(NF_VALOR AS DOUBLE) AS nf_valor, NF_UF AS nf_uf
  FROM raw_NG WHERE upper(trim(CANCELADA)) = 'NAO' AND trim(STATUS_NFCOM) <> 'SUBSTITUIÇÃO' AND NOT (upper(trim(CATEGORIA_FISCAL)) = 'ICMS' AND ICMS_BASE_CALCULO = 0)
  UNION ALL
  SELECT 'ADAPTER', '202606', idcontrato, FATURA_NUMERO, NF_ITEM_COD_SAP, NF_ITEM_DESCRICAO, NULL, CAST(POSICAO_ITEM AS VARCHAR), NULL,
    CASE WHEN upper(trim(CFOP)) IN ('', 'NULL', 'NAN', 'NONE', '-') THEN NULL ELSE trim(CFOP) END, NULL, CAST(ICMS_ALIQUOTA AS DOUBLE), CAST(PIS_ALIQUOTA AS DOUBLE), NULL, NF_UF
  FROM raw_ADAPTER)"""
V1_SELECT = [
    "sistema_origem", "ciclo_faturamento", "id_conta_contrato", "fatura_numero", "nf_item_cod_sap", "nf_numero", "posicao_item", "cclass", "cfop", "cst_icms",
    "icms_aliquota", "pis_aliquota", "nf_valor", "nf_uf",
]


@query("p2_standing_v1", f"WITH {V1_SQL} SELECT {', '.join(V1_SELECT)} FROM v1")
def p2(spark, sf):
    return standing_v1(spark, sf).select(*V1_SELECT)


@query(
    "p9_exclusions",
    f"""WITH {_raw_sql("NG")} SELECT FATURA_NUMERO, POSICAO_ITEM FROM raw_NG WHERE upper(trim(CANCELADA)) = 'NAO' AND trim(STATUS_NFCOM) <> 'SUBSTITUIÇÃO'
  AND NOT (upper(trim(CATEGORIA_FISCAL)) = 'ICMS' AND ICMS_BASE_CALCULO = 0)""",
)
def p9(spark, sf):
    return S.billable_ng(source(spark, sf, "NG")).select("FATURA_NUMERO", "POSICAO_ITEM")


@query(
    "q6_report_v1_summary",
    f"""WITH {V1_SQL} SELECT sistema_origem, ciclo_faturamento, COUNT(*) AS registros, COUNT(DISTINCT id_conta_contrato) AS contratos, COUNT(DISTINCT fatura_numero) AS faturas,
  COUNT(DISTINCT nf_item_cod_sap) AS produtos, COUNT(CASE WHEN cclass IS NULL THEN 1 END) AS sem_cclass, COUNT(CASE WHEN cfop IS NULL THEN 1 END) AS sem_cfop,
  COUNT(CASE WHEN cst_icms IS NULL THEN 1 END) AS sem_cst, COUNT(CASE WHEN nf_uf IS NULL THEN 1 END) AS sem_uf FROM v1 GROUP BY 1, 2""",
)
def q6_v1(spark, sf):
    return S.report_v1_summary(standing_v1(spark, sf))


@query(
    "q6_report_without_class",
    f"""WITH {V1_SQL} SELECT nf_item_cod_sap, nf_item_descricao, COUNT(*) AS ocorrencias, COUNT(DISTINCT fatura_numero) AS faturas FROM v1
WHERE sistema_origem = 'ADAPTER' AND cclass IS NULL GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 50""",
)
def q6_without_class(spark, sf):
    return S.report_without_class(standing_v1(spark, sf))


@query(
    "q6_report_classes",
    f"""WITH {V1_SQL} SELECT cclass, substr(cclass, 1, 1) AS grupo_cclass, cfop, cst_icms, COUNT(*) AS ocorrencias, ROUND(AVG(icms_aliquota), 4) AS icms_medio,
  ROUND(AVG(pis_aliquota), 4) AS pis_medio FROM v1 WHERE sistema_origem = 'NG' GROUP BY cclass, cfop, cst_icms
ORDER BY 5 DESC, cclass NULLS FIRST, cfop NULLS FIRST, cst_icms NULLS FIRST LIMIT 30""",
)
def q6_classes(spark, sf):
    return S.report_classes(standing_v1(spark, sf))


DIGESTS = ["id_registro", "hash_registro"]  # hex texts; as bytes they take half the room and have the same order


@query(
    "d1_standing_merge",
    f"""WITH {STANDING_SQL}, k AS (SELECT id_registro, ciclo_faturamento, sistema_origem, MIN(hash_registro) AS h FROM standing GROUP BY 1, 2, 3)
SELECT id_registro, ciclo_faturamento, sistema_origem, h AS hash_registro, CASE WHEN ciclo_faturamento > '199912' THEN 'insert' WHEN sistema_origem = 'NG' THEN 'update' ELSE 'keep' END AS acao FROM k""",
)
def d1_merge(spark, sf):
    from billproof.operators.joins import unique_by

    rows = standing(spark, sf).select(*S.MERGE_KEYS, "hash_registro").withColumns({c: F.unhex(c) for c in DIGESTS})
    # whether a row is stored follows from its keys; as a value it is no filter below the exchange, so that both sides share one
    fresh = unique_by(rows.withColumn("_stored", F.col("ciclo_faturamento") <= "199912"), S.MERGE_KEYS)
    stored, fresh = fresh.where("_stored").drop("_stored"), fresh.drop("_stored")
    stored = X.update_where(stored, F.col("sistema_origem") == "NG", {"hash_registro": F.lit("old").cast("binary")})
    merged = X.upsert_changed(stored, fresh, S.MERGE_KEYS, "hash_registro", check=False)
    return merged.select(*S.MERGE_KEYS, "hash_registro", F.col("_action").alias("acao")).withColumns({c: F.lower(F.hex(c)) for c in DIGESTS})
