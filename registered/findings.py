"""Findings queries: account, detail and tag roll-ups, and the generic operators they use."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from billproof.operators import aggregates as A
from billproof.operators import joins as J
from billproof.operators import quality as Q
from billproof.operators import sets as U
from billproof.operators import updates as X
from billproof.operators import windows as W
from billproof.plans import findings as P
from billproof.plans import rules as RU
from billproof.session import stored

from . import query
from .fixtures import LOT, quoted, table
from .item_fixture import _sql_choice, exploded_sql, items, master, taxes

AS_OF = dt.datetime(2026, 7, 31, 12, 0, 0)
RULE_CHOICES = [
    "VALIDACAO_NFCOM", "VALIDACAO_IMPOSTOS", "VALOR_OFERTA", "VALOR FATURA", "VALOR ZERADO", "PRE BILLING",
    "PRE-BILLING", "DIVERGENCIA_CONTRATO_PRODUTO", "GAP_FATURAMENTO", "BATIMENTO_PRODUTOS_FATURA", "ENDERECO_LEGAL",
    "VALIDACAO_ENCARGOS_MULTA_JUROS", "DADOS_CADASTRAIS", None,
]
CRM_CHOICES = ["NG", "ADAPTER", "AN", " SIMETRA(AN)", "SIMETRA", None]

HUB = {
    "FATURA": "CAST(l_orderkey AS {s})",
    "ID_CONTA_CONTRATO": "CAST(o_custkey AS {s})",
    "REGRA": _sql_choice(RULE_CHOICES, "CAST(l_partkey % 14 AS INT)"),
    "STATUS": "CASE WHEN l_quantity < 10 THEN 'INCORRETO' WHEN l_quantity < 20 THEN 'ALERTA' ELSE 'CORRETO' END",
    "SUBSTATUS": "CASE WHEN l_quantity < 10 THEN 'BLOQUEANTE' WHEN l_quantity < 20 THEN 'ALERTA' ELSE 'OK' END",
    "OBSERVACAO": "CASE WHEN l_suppkey % 7 = 0 THEN NULL WHEN l_suppkey % 7 = 1 THEN ' ' "
    "ELSE concat('TAG_', CAST(l_suppkey % 5 AS {s}), ': texto ', CAST(l_linenumber AS {s})) END",
    "DADOS_BILLING": "CASE WHEN l_linenumber = 3 THEN NULL ELSE concat('B', CAST(l_linenumber AS {s})) END",
    "DADOS_CONTRATO": "CASE WHEN l_suppkey % 3 = 0 THEN NULL WHEN l_suppkey % 3 = 1 THEN '' ELSE concat('C', CAST(l_suppkey AS {s})) END",
    "DADOS_TABELA_VERDADE": "concat('V', CAST(l_linenumber AS {s}))",
    "Produto": "CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE concat('P', CAST(l_partkey % 5 AS {s})) END",
    "Tipo_Servico": "'SCM'",
    "Desc_Servico": "CASE WHEN l_linenumber = 1 THEN NULL ELSE 'servico' END",
    "Tipo_Imposto": "'ICMS'",
    "ID_Lote": f"'{LOT}'",
    "CRM": _sql_choice(CRM_CHOICES, "CAST(l_suppkey % 6 AS INT)"),
    "VALOR_BILLING": "CASE WHEN l_linenumber = 2 THEN '' WHEN l_linenumber = 5 THEN 'abc' "
    "ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS {s}) END",
    "VALOR_CONTRATO": "CASE WHEN l_linenumber = 4 THEN NULL ELSE CAST(CAST(l_quantity AS INT) AS {s}) END",
    "SEGMENTO": "CASE WHEN o_custkey % 3 = 0 THEN NULL WHEN o_custkey % 3 = 1 THEN 'B2B' ELSE 'B2C' END",
    "FAIXA": "CASE WHEN l_partkey % 3 = 0 THEN NULL WHEN l_partkey % 3 = 1 THEN ' ' ELSE '0-100 ' END",
}
HUB_SQL = (
    "hub AS (SELECT " + ", ".join(f"{e.format(s='VARCHAR')} AS {n}" for n, e in HUB.items())
    + " FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
)
CUSTOMER = {
    "IDCONTA": "CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS {s}) END",
    "IDCONTRATO": "CASE WHEN c_custkey % 3 <= 1 THEN CAST(c_custkey + 1 AS {s}) END",
    "CODIGOCLIENTE": "CAST(c_custkey + 2 AS {s})",
    "nome": "CASE WHEN c_custkey % 10 = 7 THEN ' ' ELSE c_name END",
    "CPF_CNPJ": "CASE WHEN c_custkey % 11 = 5 THEN NULL ELSE CAST(c_custkey * 7 AS {s}) END",
}
CUSTOMER_SQL = "cli AS (SELECT " + ", ".join(f"{e.format(s='VARCHAR')} AS {n}" for n, e in CUSTOMER.items()) + " FROM customer)"


def hub(spark, sf):
    joined = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(*[F.expr(e.format(s="STRING")).alias(n) for n, e in HUB.items()])


def customers(spark, sf):
    return table(spark, sf, "customer").select(*[F.expr(e.format(s="STRING")).alias(n) for n, e in CUSTOMER.items()])


SYS = "CASE WHEN upper(trim(CRM)) IN ('AN', 'SIMETRA(AN)') THEN 'SIMETRA' ELSE trim(CRM) END"
IN_TEXT = "COALESCE(trim(split_part(OBSERVACAO, ':', 1)), REGRA)"
TAG_ACCOUNT = (
    f"CASE WHEN REGRA IN ({quoted(P.RULES_TAG_IN_TEXT)}) THEN {IN_TEXT} "
    f"WHEN REGRA IN ({quoted(P.RULES_TAG_PRODUCT)}) THEN COALESCE(Produto, REGRA) ELSE REGRA END"
)
TAG_DETAIL = (
    f"CASE WHEN REGRA IN ({quoted(P.RULES_TAG_IN_TEXT)}) THEN {IN_TEXT} "
    f"WHEN REGRA IN ({quoted(P.RULES_TAG_RANGE)}) THEN COALESCE(Produto, REGRA) || CASE WHEN trim(FAIXA) <> '' THEN ' - ' || trim(FAIXA) ELSE '' END "
    f"WHEN REGRA IN ({quoted(P.RULES_TAG_PRODUCT)}) THEN COALESCE(Produto, REGRA) ELSE REGRA END"
)
BAD = "STATUS IN ('INCORRETO', 'ALERTA')"
PRE = "upper(trim(REGRA)) IN ('PRE-BILLING', 'PRE BILLING')"

ACCOUNT_SQL = f"""{HUB_SQL}, {CUSTOMER_SQL},
prep AS (SELECT *, {SYS} AS sysn, {TAG_ACCOUNT} AS tag0 FROM hub),
notes AS (SELECT *, CASE WHEN {BAD} AND trim(OBSERVACAO) <> '' THEN tag0 || ': ' || OBSERVACAO WHEN {BAD} THEN tag0 END AS note FROM prep),
agg AS (SELECT ID_CONTA_CONTRATO, sysn,
    MAX(CASE WHEN STATUS = 'INCORRETO' THEN 1 ELSE 0 END) AS wrong, MAX(CASE WHEN STATUS = 'ALERTA' THEN 1 ELSE 0 END) AS alert,
    string_agg(DISTINCT CASE WHEN {BAD} THEN REGRA END, ' | ' ORDER BY CASE WHEN {BAD} THEN REGRA END) AS problems,
    string_agg(note, ' | ' ORDER BY note) AS notes,
    string_agg(DISTINCT FATURA, ' | ' ORDER BY FATURA) AS invoices,
    MAX(COALESCE(SEGMENTO, 'NAO IDENTIFICADO')) AS SEGMENTO,
    MAX(CASE WHEN {PRE} AND upper(trim(sysn)) IN ('NG', 'ADAPTER') THEN 1 ELSE 0 END) AS pre,
    MAX(CASE WHEN STATUS = 'INCORRETO' AND upper(trim(REGRA)) = 'PRE-BILLING' THEN 1 ELSE 0 END) AS prew,
    CAST(SUM(COALESCE(TRY_CAST(NULLIF(trim(VALOR_BILLING), '') AS DECIMAL(28,6)), 0)) AS DOUBLE) AS VALOR
  FROM notes GROUP BY ID_CONTA_CONTRATO, sysn),
w AS (SELECT ID_CONTA_CONTRATO, sysn, SUM(CASE WHEN upper(trim(REGRA)) = 'PRE-BILLING' THEN 2 ELSE 1 END) AS ordem
      FROM (SELECT DISTINCT ID_CONTA_CONTRATO, sysn, REGRA FROM prep) t GROUP BY ID_CONTA_CONTRATO, sysn),
named AS (SELECT * FROM cli WHERE trim(nome) <> ''),
a1 AS (SELECT IDCONTA AS k, arg_min(nome, CPF_CNPJ || nome) AS nome, MIN(CPF_CNPJ) AS doc FROM named WHERE IDCONTA IS NOT NULL GROUP BY 1),
accounts AS (SELECT COALESCE(invoices, '') AS FATURA, agg.ID_CONTA_CONTRATO AS ID_CONTA,
    COALESCE(n1.nome, n2.nome, n3.nome) AS NOME_CLIENTE, COALESCE(n1.CPF_CNPJ, n2.CPF_CNPJ, n3.CPF_CNPJ) AS CPF_CNPJ,
    agg.sysn AS SISTEMA, SEGMENTO,
    CASE WHEN pre = 1 AND upper(trim(agg.sysn)) IN ('NG', 'ADAPTER') THEN 'SIM' ELSE 'NAO' END AS POSSUI_PREBILLING,
    CASE WHEN wrong = 1 THEN 'INCORRETO' WHEN alert = 1 THEN 'ALERTA' ELSE 'CORRETO' END AS STATUS,
    CASE WHEN wrong = 1 OR alert = 1 THEN 'PENDENTE' ELSE 'VALIDADO' END AS STATUS_VALIDACAO,
    CASE WHEN prew = 1 THEN 'PRE-BILLING' END AS ANALISTA,
    CASE WHEN wrong = 1 AND notes <> '' THEN notes END AS OBSERVACAO,
    CASE WHEN wrong = 1 AND problems <> '' THEN problems END AS PROBLEMA, VALOR,
    CAST(CASE WHEN agg.sysn IS NULL THEN 0 ELSE ordem END AS INT) AS Ordem_Status,
    CASE WHEN VALOR > 0 THEN 'SIM' ELSE 'NAO' END AS Valor_Positive, '{LOT}' AS ID_LOTE
  FROM agg JOIN w ON w.ID_CONTA_CONTRATO IS NOT DISTINCT FROM agg.ID_CONTA_CONTRATO AND w.sysn IS NOT DISTINCT FROM agg.sysn
  LEFT JOIN named n1 ON n1.IDCONTA = agg.ID_CONTA_CONTRATO LEFT JOIN named n2 ON n2.IDCONTRATO = agg.ID_CONTA_CONTRATO
  LEFT JOIN named n3 ON n3.CODIGOCLIENTE = agg.ID_CONTA_CONTRATO
  WHERE wrong = 1 OR alert = 1)"""


def accounts(spark, sf):
    return P.account_rollup(hub(spark, sf), customers(spark, sf), LOT, AS_OF)


ACCOUNT_SELECT = [c for c in P.ACCOUNT_COLUMNS if c not in ("CRIADO_EM", "RESUMO", "DATA_ABERTURA_CHAMADO", "DT_EMISSAO")]


@query("d22_account_rollup", f"WITH {ACCOUNT_SQL} SELECT {', '.join(ACCOUNT_SELECT)} FROM accounts")
def d22(spark, sf):
    return accounts(spark, sf).select(*ACCOUNT_SELECT)


@query("d23_norm_system", f"WITH {HUB_SQL} SELECT {SYS} AS sistema, COUNT(*) AS n FROM hub GROUP BY 1")
def d23(spark, sf):
    return A.distribution(hub(spark, sf).select(P.norm_system(F.col("CRM")).alias("sistema")), ["sistema"])


@query("d24_tags", f"WITH {HUB_SQL} SELECT REGRA, {TAG_ACCOUNT} AS tag_conta, {TAG_DETAIL} AS tag_detalhe, COUNT(*) AS n FROM hub GROUP BY 1, 2, 3")
def d24(spark, sf):
    tags = hub(spark, sf).select(
        "REGRA",
        P.tag_expr(F.col("Produto"), with_range=False).alias("tag_conta"),
        P.tag_expr(F.col("Produto")).alias("tag_detalhe"),
    )
    return A.distribution(tags, ["REGRA", "tag_conta", "tag_detalhe"])


RELEVANT_SQL = f"""{ACCOUNT_SQL}, rel AS (SELECT * FROM hub WHERE REGRA IN ({quoted(P.RULES_DIRECT)})
  UNION ALL SELECT * FROM hub WHERE REGRA NOT IN ({quoted(P.RULES_DIRECT)}) AND ID_CONTA_CONTRATO IN (SELECT ID_CONTA FROM accounts)),
marked AS (SELECT *, CASE WHEN MAX(CASE WHEN {PRE} AND upper(trim(CRM)) IN ('NG', 'ADAPTER') THEN 1 ELSE 0 END)
    OVER (PARTITION BY ID_CONTA_CONTRATO, upper(trim(CRM))) = 1 THEN 'SIM' ELSE 'NAO' END AS pb, {TAG_DETAIL} AS tag0 FROM rel)"""

_RESUMO = "CASE WHEN trim(OBSERVACAO) <> '' THEN tag0 || ' | ' || OBSERVACAO ELSE tag0 END"
_CONTRACT = "CASE WHEN trim(DADOS_CONTRATO) <> '' THEN DADOS_CONTRATO END"
DETAIL_SQL = f"""{RELEVANT_SQL}, det AS (SELECT FATURA, ID_CONTA_CONTRATO AS ID_CONTA,
    CASE WHEN upper(trim(CRM)) IN ('AN', 'SIMETRA(AN)') THEN 'SIMETRA' ELSE COALESCE(trim(CRM), 'NAO_IDENTIFICADO') END AS SISTEMA,
    REGRA, STATUS, SUBSTATUS, OBSERVACAO,
    COALESCE(CASE WHEN REGRA = 'DIVERGENCIA_CONTRATO_PRODUTO' THEN DADOS_CONTRATO WHEN REGRA = 'BATIMENTO_PRODUTOS_FATURA' THEN VALOR_CONTRATO
      WHEN REGRA IN ('VALOR FATURA', 'VALOR ZERADO') THEN VALOR_BILLING ELSE DADOS_BILLING END, DADOS_BILLING, VALOR_BILLING, VALOR_CONTRATO) AS DADOS_KENAN,
    CASE WHEN REGRA = 'DIVERGENCIA_CONTRATO_PRODUTO' THEN DADOS_TABELA_VERDADE WHEN REGRA IN ('VALOR FATURA', 'VALOR ZERADO')
      THEN COALESCE(VALOR_CONTRATO, DADOS_TABELA_VERDADE) ELSE COALESCE({_CONTRACT}, DADOS_TABELA_VERDADE) END AS DADOS_TABELA_VERDADE,
    ID_Lote AS ID_LOTE, COALESCE(SEGMENTO, 'NAO IDENTIFICADO') AS SEGMENTO, pb AS POSSUI_PREBILLING, Tipo_Servico AS TIPO_SERVICO,
    Desc_Servico AS DESCRICAO_SERVICO, Tipo_Imposto AS TIPO_IMPOSTO,
    CASE WHEN {BAD} THEN 'PENDENTE' ELSE 'VALIDADO' END AS STATUS_VALIDACAO, CASE WHEN {BAD} THEN tag0 END AS TAG, {_RESUMO} AS RESUMO,
    CASE STATUS WHEN 'INCORRETO' THEN 3 WHEN 'ALERTA' THEN 2 ELSE 1 END AS _Ordem_Status_DET,
    CASE STATUS WHEN 'INCORRETO' THEN 4 WHEN 'ALERTA' THEN 3 ELSE 1 END AS _Prioridade_Final_da_Fatura,
    REGRA || '_' || STATUS AS _FILTRA_PAGE, FAIXA FROM marked)"""
TAGS_SQL = f"""{RELEVANT_SQL}, det AS (SELECT FATURA, ID_CONTA_CONTRATO AS ID_CONTA, COALESCE(CRM, 'NAO_IDENTIFICADO') AS SISTEMA,
    REGRA, STATUS, SUBSTATUS, OBSERVACAO,
    COALESCE(CASE WHEN REGRA = 'BATIMENTO_PRODUTOS_FATURA' THEN VALOR_CONTRATO
      WHEN REGRA IN ('VALOR FATURA', 'VALOR ZERADO') THEN VALOR_BILLING ELSE DADOS_BILLING END, DADOS_BILLING, VALOR_BILLING, VALOR_CONTRATO) AS DADOS_KENAN,
    CASE WHEN REGRA IN ('DIVERGENCIA_CONTRATO_PRODUTO', 'VALOR FATURA', 'VALOR ZERADO')
      THEN COALESCE(VALOR_CONTRATO, DADOS_TABELA_VERDADE) ELSE COALESCE({_CONTRACT}, DADOS_TABELA_VERDADE) END AS DADOS_TABELA_VERDADE,
    ID_Lote AS ID_LOTE, COALESCE(SEGMENTO, 'NAO IDENTIFICADO') AS SEGMENTO, pb AS POSSUI_PREBILLING, Tipo_Servico AS TIPO_SERVICO,
    Desc_Servico AS DESCRICAO_SERVICO, Tipo_Imposto AS TIPO_IMPOSTO, 'PENDENTE' AS STATUS_VALIDACAO, tag0 AS TAG, {_RESUMO} AS RESUMO,
    REGRA || '_' || STATUS AS _FILTRA_PAGE_TAG, FAIXA FROM marked WHERE {BAD})"""


def _deduped(columns) -> str:
    """First row per finding key, in the order of the remaining columns (NULL first)."""
    rest = [c for c in columns if c not in P.DEDUP_KEY]
    order = ", ".join(f"{c} NULLS FIRST" for c in rest)
    return (
        f"SELECT {', '.join(columns)} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(P.DEDUP_KEY)} ORDER BY {order}) AS rn FROM det) t "
        "WHERE rn = 1"
    )


_DATES = ("DATA_ABERTURA_CHAMADO", "DT_EMISSAO", "ANALISTA")
DETAIL_SELECT = [c for c in P.DETAIL_COLUMNS if c not in _DATES]
TAG_SELECT = [c for c in P.TAG_COLUMNS if c not in _DATES]


def prepared(spark, sf):
    return P.prepare_hub(hub(spark, sf), accounts(spark, sf), LOT)


@query("d25_detail", f"WITH {DETAIL_SQL} {_deduped(DETAIL_SELECT)}")
def d25(spark, sf):
    return P.detail_of(prepared(spark, sf), AS_OF.date()).select(*DETAIL_SELECT)


@query("d26_tag_detail", f"WITH {TAGS_SQL} {_deduped(TAG_SELECT)}")
def d26(spark, sf):
    return P.tag_detail_of(prepared(spark, sf), AS_OF.date()).select(*TAG_SELECT)


OLD_TABLE = {
    "FATURA": "FATURA", "REGRA": "REGRA", "STATUS": "STATUS", "OBSERVACAO": "OBSERVACAO",
    "TAG": "COALESCE(Produto, REGRA)", "RESUMO": "Produto",
}
_FIX = f"REGRA IN ({quoted(P.RULES_TAG_IS_RULE)}) AND {BAD} AND (TAG IS NULL OR TAG <> REGRA)"
_OLD_SQL = f"{HUB_SQL}, old AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in OLD_TABLE.items()) + " FROM hub)"


def old_table(spark, sf):
    return hub(spark, sf).select(*[F.expr(e).alias(n) for n, e in OLD_TABLE.items()])


@query(
    "d27_retro_tag_fix",
    f"""WITH {_OLD_SQL} SELECT FATURA, REGRA, STATUS, OBSERVACAO, CASE WHEN {_FIX} THEN REGRA ELSE TAG END AS TAG,
  CASE WHEN {_FIX} THEN CASE WHEN trim(OBSERVACAO) <> '' THEN REGRA || ' | ' || OBSERVACAO ELSE REGRA END ELSE RESUMO END AS RESUMO FROM old""",
)
def d27(spark, sf):
    return P.retro_tag_fix(old_table(spark, sf))


@query("s15_rows_to_fix", f"WITH {_OLD_SQL} SELECT REGRA, COUNT(*) AS n FROM old WHERE {_FIX} GROUP BY REGRA")
def s15(spark, sf):
    return A.distribution(old_table(spark, sf).where(P.needs_tag_fix()), ["REGRA"])


@query(
    "g7_any_flag",
    f"""WITH {HUB_SQL} SELECT ID_CONTA_CONTRATO, MAX(CASE WHEN STATUS = 'INCORRETO' THEN 1 ELSE 0 END) AS tem_incorreto,
  MAX(CASE WHEN STATUS = 'ALERTA' THEN 1 ELSE 0 END) AS tem_alerta FROM hub GROUP BY 1""",
)
def g7(spark, sf):
    return hub(spark, sf).groupBy("ID_CONTA_CONTRATO").agg(
        A.any_flag(F.col("STATUS") == "INCORRETO").alias("tem_incorreto"),
        A.any_flag(F.col("STATUS") == "ALERTA").alias("tem_alerta"),
    )


@query(
    "g8_concat_texts",
    f"""WITH {HUB_SQL} SELECT ID_CONTA_CONTRATO, string_agg(OBSERVACAO, ' | ' ORDER BY OBSERVACAO) AS observacoes,
  string_agg(DISTINCT REGRA, ' | ' ORDER BY REGRA) AS regras FROM hub GROUP BY 1""",
)
def g8(spark, sf):
    rows = hub(spark, sf)
    keys = ["ID_CONTA_CONTRATO"]
    notes = A.concat_parts(rows, keys, {"observacoes": F.col("OBSERVACAO")})  # an account above the limit has several rows
    rules = rows.groupBy(*keys).agg(A.set_text(F.col("REGRA")).alias("regras"))
    out = rules.join(notes.select(*keys, "observacoes"), keys, "left")
    return out.select(*keys, "observacoes", F.nullif("regras", F.lit("")).alias("regras"))


@query(
    "g10_text_sum",
    f"""WITH {HUB_SQL} SELECT ID_CONTA_CONTRATO, CAST(SUM(COALESCE(TRY_CAST(NULLIF(trim(VALOR_BILLING), '') AS DECIMAL(28,6)), 0)) AS DOUBLE) AS valor
FROM hub GROUP BY 1""",
)
def g10(spark, sf):
    total = A.text_sum(F.col("VALOR_BILLING"), "decimal(28,6)").cast("double").alias("valor")
    return hub(spark, sf).groupBy("ID_CONTA_CONTRATO").agg(total)


@query(
    "g11_weighted_distinct",
    f"""WITH {HUB_SQL} SELECT ID_CONTA_CONTRATO, CAST(SUM(CASE WHEN upper(trim(REGRA)) = 'PRE-BILLING' THEN 2 ELSE 1 END) AS INT) AS ordem
FROM (SELECT DISTINCT ID_CONTA_CONTRATO, REGRA FROM hub) t GROUP BY 1""",
)
def g11(spark, sf):
    return A.weighted_distinct(hub(spark, sf), ["ID_CONTA_CONTRATO"], F.col("REGRA"), {"PRE-BILLING": 2}, 1, "ordem")


@query(
    "g12_drop_duplicates",
    f"""WITH {HUB_SQL}, d AS (SELECT FATURA, REGRA, STATUS, DADOS_BILLING, row_number() OVER (PARTITION BY FATURA, REGRA
  ORDER BY STATUS NULLS FIRST, DADOS_BILLING NULLS FIRST) AS rn FROM hub) SELECT FATURA, REGRA, STATUS, DADOS_BILLING FROM d WHERE rn = 1""",
)
def g12(spark, sf):
    return J.unique_by(hub(spark, sf).select("FATURA", "REGRA", "STATUS", "DADOS_BILLING"), ["FATURA", "REGRA"])


@query("g23_group_by_expression", f"WITH {HUB_SQL} SELECT substr(FATURA, 1, 1) AS inicio, STATUS, COUNT(*) AS n FROM hub GROUP BY 1, 2")
def g23(spark, sf):
    return hub(spark, sf).groupBy(F.substring("FATURA", 1, 1).alias("inicio"), "STATUS").agg(F.count(F.lit(1)).alias("n"))


@query(
    "g5_conditional_distinct_pct",
    f"""WITH {HUB_SQL} SELECT REGRA, COUNT(DISTINCT FATURA) AS fat, ROUND(COUNT(DISTINCT CASE WHEN STATUS = 'CORRETO' THEN FATURA END) * 100.0::DOUBLE
  / NULLIF(COUNT(DISTINCT FATURA), 0), 2) AS pct_ok FROM hub GROUP BY REGRA""",
)
def g5(spark, sf):
    from billproof.functions.numbers import safe_pct

    ok = A.distinct_where(F.col("STATUS") == "CORRETO", F.col("FATURA"))
    return hub(spark, sf).groupBy("REGRA").agg(
        F.count_distinct("FATURA").alias("fat"), safe_pct(ok, F.count_distinct("FATURA")).alias("pct_ok")
    )


@query(
    "w4_any_over",
    f"""WITH {HUB_SQL} SELECT FATURA, REGRA, CRM, CASE WHEN MAX(CASE WHEN {PRE} AND upper(trim(CRM)) IN ('NG', 'ADAPTER') THEN 1 ELSE 0 END)
  OVER (PARTITION BY ID_CONTA_CONTRATO, upper(trim(CRM))) = 1 THEN 'SIM' ELSE 'NAO' END AS possui FROM hub""",
)
def w4(spark, sf):
    system = F.upper(F.trim("CRM"))
    has = F.upper(F.trim("REGRA")).isin(*P.PREBILLING) & system.isin(*P.PREBILLING_SYSTEMS)
    marked = W.any_over(hub(spark, sf), {"a": F.col("ID_CONTA_CONTRATO"), "s": system}, has, "possui", "SIM", "NAO")
    return marked.select("FATURA", "REGRA", "CRM", "possui")


@query(
    "j2_lookup",
    """WITH d AS (SELECT p_brand, MIN(p_type) AS p_type FROM part GROUP BY p_brand)
SELECT l_orderkey, l_linenumber, p.p_brand AS marca, d.p_type AS tipo FROM lineitem l LEFT JOIN part p ON p_partkey = l_partkey
LEFT JOIN d ON d.p_brand = p.p_brand""",
)
def j2(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = table(spark, sf, "part")
    with_brand = J.lookup(lines, parts, {"l_partkey": "p_partkey"}, {"p_brand": "marca"})
    return J.lookup(with_brand, parts, {"marca": "p_brand"}, {"p_type": "tipo"}).drop("l_partkey")


@query(
    "j3_lookup_cascade",
    f"""WITH {CUSTOMER_SQL}, n AS (SELECT * FROM cli WHERE trim(nome) <> '')
SELECT o_orderkey, COALESCE(a.nome, b.nome, c.nome) AS nome, COALESCE(a.CPF_CNPJ, b.CPF_CNPJ, c.CPF_CNPJ) AS doc,
  CASE WHEN a.nome IS NOT NULL THEN 1 WHEN b.nome IS NOT NULL THEN 2 WHEN c.nome IS NOT NULL THEN 3 END AS tentativa
FROM orders LEFT JOIN n a ON a.IDCONTA = CAST(o_custkey AS VARCHAR) LEFT JOIN n b ON b.IDCONTRATO = CAST(o_custkey AS VARCHAR)
LEFT JOIN n c ON c.CODIGOCLIENTE = CAST(o_custkey AS VARCHAR)""",
)
def j3(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("k"))
    named = customers(spark, sf).where(F.trim("nome") != "")
    tries = [("k", "IDCONTA"), ("k", "IDCONTRATO"), ("k", "CODIGOCLIENTE")]
    return J.lookup_cascade(orders, named, tries, {"nome": "nome", "CPF_CNPJ": "doc"}, matched="tentativa").drop("k")


@query("j8_keep_existing", "SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def j8(spark, sf):
    returned = table(spark, sf, "lineitem").where("l_returnflag = 'R'")
    return J.keep_existing(table(spark, sf, "orders").select("o_orderkey"), returned, {"o_orderkey": "l_orderkey"})


@query("j9_keep_missing", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 20)")
def j9(spark, sf):
    large = table(spark, sf, "lineitem").where("l_quantity > 20")
    return J.keep_missing(table(spark, sf, "orders").select("o_orderkey"), large, {"o_orderkey": "l_orderkey"})


@query("u7_set_difference", "SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 49")
def u7(spark, sf):
    used = table(spark, sf, "lineitem").where("l_quantity > 49")
    return J.keep_missing(table(spark, sf, "part").select("p_partkey").distinct(), used, {"p_partkey": "l_partkey"})


@query(
    "j4_conditional_left_join",
    """SELECT o_orderkey, c_name AS nome FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND o_orderstatus = 'F'""",
)
def j4(spark, sf):
    orders, cust = table(spark, sf, "orders"), table(spark, sf, "customer")
    on = (F.col("o_custkey") == F.col("c_custkey")) & (F.col("o_orderstatus") == "F")
    return orders.join(cust, on, "left").select("o_orderkey", F.col("c_name").alias("nome"))


@query(
    "j5_two_roles",
    """SELECT l_orderkey, l_linenumber, a.n_name AS nacao_cliente, b.n_name AS nacao_fornecedor FROM lineitem
JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN nation a ON a.n_nationkey = c_nationkey LEFT JOIN nation b ON b.n_nationkey = s_nationkey""",
)
def j5(spark, sf):
    base = (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select("l_orderkey", "l_linenumber", "c_nationkey", "s_nationkey")
    )
    nation = table(spark, sf, "nation")
    first, second = J.prefixed(nation, "a_"), J.prefixed(nation, "b_")
    out = J.lookup(base, first, {"c_nationkey": "a_n_nationkey"}, {"a_n_name": "nacao_cliente"}, hot_base=base)
    out = J.lookup(out, second, {"s_nationkey": "b_n_nationkey"}, {"b_n_name": "nacao_fornecedor"}, hot_base=base)
    return out.drop("c_nationkey", "s_nationkey")


@query(
    "j11_or_join",
    """SELECT o_orderkey, o_orderstatus, n_name FROM orders JOIN nation ON (o_orderstatus = 'F' AND n_nationkey = o_custkey % 25)
  OR (o_orderstatus <> 'F' AND n_nationkey = o_orderkey % 25)""",
)
def j11(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", (F.col("o_custkey") % 25).alias("by_cust"), (F.col("o_orderkey") % 25).alias("by_order")
    )
    old = F.col("o_orderstatus") == "F"
    joined = J.join_by_branch(orders, table(spark, sf, "nation"), [(old, "by_cust", "n_nationkey"), (~old, "by_order", "n_nationkey")])
    return joined.select("o_orderkey", "o_orderstatus", "n_name")


@query(
    "j12_computed_key",
    """SELECT o_orderkey, c_custkey, c_name FROM orders JOIN customer ON 'SIMETRA(' || o_orderstatus || ')' = 'SIMETRA(' || CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'O' END || ')'
  AND o_custkey = c_custkey""",
)
def j12(spark, sf):
    """The written system name and the customer code together are the key."""
    wrapped = lambda c: F.concat(F.lit("SIMETRA("), c, F.lit(")"))
    o = table(spark, sf, "orders").select("o_orderkey", wrapped(F.col("o_orderstatus")).alias("crm"), F.col("o_custkey").alias("k"))
    own = F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("O")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", wrapped(own).alias("crm"), F.col("c_custkey").alias("k"))
    return J.skew_join(o, c, ["crm", "k"], "inner").select("o_orderkey", "c_custkey", "c_name")


@query("u1_union_all", "SELECT c_custkey AS k FROM customer UNION ALL SELECT s_suppkey FROM supplier")
def u1(spark, sf):
    return U.union_strict(
        table(spark, sf, "customer").select(F.col("c_custkey").alias("k")),
        table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k")),
    )


@query(
    "u2_union_by_name",
    "SELECT c_custkey AS k, c_name AS n FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT p_partkey, p_name FROM part",
)
def u2(spark, sf):
    return U.union_strict(
        table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("n")),
        table(spark, sf, "supplier").select(F.col("s_name").alias("n"), F.col("s_suppkey").alias("k")),
        table(spark, sf, "part").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("n")),
    )


@query(
    "u3_union_strict",
    f"""WITH {HUB_SQL} SELECT FATURA, REGRA FROM hub WHERE STATUS = 'ALERTA' UNION ALL SELECT FATURA, REGRA FROM hub WHERE STATUS = 'INCORRETO'""",
)
def u3(spark, sf):
    rows = hub(spark, sf)
    return U.union_strict(*[rows.where(F.col("STATUS") == s).select("FATURA", "REGRA") for s in P.BAD])


@query(
    "u4_priority_union",
    """WITH u AS (SELECT c_custkey AS k, c_name AS nome, 1 AS p FROM customer UNION ALL SELECT s_suppkey, s_name, 3 FROM supplier
  UNION ALL SELECT p_partkey, p_name, 2 FROM part),
r AS (SELECT k, nome, row_number() OVER (PARTITION BY k ORDER BY p DESC, nome) AS rn FROM u) SELECT k, nome FROM r WHERE rn = 1""",
)
def u4(spark, sf):
    side = lambda t, k, n: table(spark, sf, t).select(F.col(k).alias("k"), F.col(n).alias("nome"))
    sources = [(side("customer", "c_custkey", "c_name"), 1), (side("part", "p_partkey", "p_name"), 2), (side("supplier", "s_suppkey", "s_name"), 3)]
    return U.priority_union(sources, "k")


@query("u5_distinct_keys", "SELECT o_custkey AS k FROM orders UNION SELECT l_suppkey FROM lineitem UNION SELECT c_nationkey FROM customer")
def u5(spark, sf):
    return U.distinct_keys(
        [
            (table(spark, sf, "orders"), F.col("o_custkey")),
            (table(spark, sf, "lineitem"), F.col("l_suppkey")),
            (table(spark, sf, "customer"), F.col("c_nationkey").cast("bigint")),
        ],
        "k",
    )


@query(
    "u6_split_apply",
    f"""WITH {HUB_SQL} SELECT FATURA, REGRA FROM hub WHERE REGRA IN ({quoted(P.RULES_DIRECT)}) UNION ALL
SELECT FATURA, REGRA FROM hub WHERE REGRA NOT IN ({quoted(P.RULES_DIRECT)}) AND FATURA IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'O')""",
)
def u6(spark, sf):
    keys = table(spark, sf, "orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").cast("string").alias("k"))
    rows = hub(spark, sf).select("FATURA", "REGRA")
    return U.split_apply(rows, F.col("REGRA").isin(*P.RULES_DIRECT), lambda df: J.keep_existing(df, keys, {"FATURA": "k"}))


@query(
    "s12_upsert",
    """SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN 'novo ' || c_name ELSE c_name END AS nome FROM customer
UNION ALL SELECT s_suppkey + 1000000, s_name FROM supplier""",
)
def s12(spark, sf):
    target = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("nome"))
    changed = target.where("k % 2 = 0").select("k", F.concat(F.lit("novo "), F.col("nome")).alias("nome"))
    new = table(spark, sf, "supplier").select((F.col("s_suppkey") + 1000000).alias("k"), F.col("s_name").alias("nome"))
    return X.upsert(target, changed.unionByName(new), ["k"])


@query(
    "s13_upsert_changed",
    """SELECT k, nome, hash, acao FROM (
  SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN 'novo' ELSE c_name END AS nome, CASE WHEN c_custkey % 3 = 0 THEN md5('novo') ELSE md5(c_name) END AS hash,
    CASE WHEN c_custkey % 3 = 0 THEN 'update' WHEN c_custkey % 3 = 1 THEN 'keep' ELSE 'none' END AS acao FROM customer
  UNION ALL SELECT s_suppkey + 1000000, s_name, md5(s_name), 'insert' FROM supplier) t""",
)
def s13(spark, sf):
    target = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("nome"), F.md5("c_name").alias("hash"))
    changed = target.where("k % 3 = 0").select("k", F.lit("novo").alias("nome"), F.md5(F.lit("novo")).alias("hash"))
    same = target.where("k % 3 = 1").withColumn("nome", F.upper("nome"))
    new = table(spark, sf, "supplier").select((F.col("s_suppkey") + 1000000).alias("k"), F.col("s_name").alias("nome"), F.md5("s_name").alias("hash"))
    out = X.upsert_changed(target, changed.unionByName(same).unionByName(new), ["k"], "hash")
    return out.withColumnRenamed("_action", "acao")


@query("s18_evolve", "SELECT c_custkey AS id, c_name, c_mktsegment, CAST(NULL AS VARCHAR) AS nota FROM customer")
def s18(spark, sf):
    return X.evolve(
        table(spark, sf, "customer"), rename={"c_custkey": "id", "ausente": "x"}, drop=["c_acctbal", "c_nationkey", "ausente"], add={"nota": "string", "c_name": "int"}
    )


@query("s22_latest_lot", "SELECT MAX(strftime(o_orderdate, '%Y-%m')) AS ultimo FROM orders")
def s22(spark, sf):
    from billproof.sources.readers import latest_lot_df

    return latest_lot_df(table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("lot")), "lot", "ultimo")


@query("q1_parity", "SELECT 'row_count' AS \"check\", (SELECT COUNT(*) FROM orders) AS source_rows, (SELECT COUNT(DISTINCT l_orderkey) FROM lineitem) AS target_rows, "
       "(SELECT COUNT(*) FROM orders) = (SELECT COUNT(DISTINCT l_orderkey) FROM lineitem) AS ok")  # fmt: skip
def q1(spark, sf):
    return Q.parity(table(spark, sf, "orders"), table(spark, sf, "lineitem").select("l_orderkey").distinct())


_CHECKS = {
    "analista_prebilling_ou_nulo": "ANALISTA IS NOT NULL AND ANALISTA <> 'PRE-BILLING'",
    "ruim_pendente": f"{BAD} AND STATUS_VALIDACAO <> 'PENDENTE'",
    "valor_nao_nulo": "VALOR IS NULL",
    "correto_sem_problema": "STATUS = 'CORRETO' AND PROBLEMA IS NOT NULL",
    "incorreto_com_problema": "STATUS = 'INCORRETO' AND (PROBLEMA IS NULL OR PROBLEMA = '')",
}


@query(
    "q2_account_checks",
    f"WITH {ACCOUNT_SQL} " + " UNION ALL ".join(
        f"SELECT '{n}' AS \"check\", COUNT(CASE WHEN {c} THEN 1 END) AS violations, COUNT(CASE WHEN {c} THEN 1 END) = 0 AS ok FROM accounts"
        for n, c in _CHECKS.items()
    ),
)
def q2(spark, sf):
    return Q.check(accounts(spark, sf), P.account_checks())


@query("p15_rule_filter", f"WITH {HUB_SQL} SELECT FATURA, REGRA, STATUS FROM hub WHERE {BAD} AND REGRA IN ({quoted(P.RULES_DIRECT)})")
def p15(spark, sf):
    return hub(spark, sf).where(F.col("STATUS").isin(*P.BAD) & F.col("REGRA").isin(*P.RULES_DIRECT)).select("FATURA", "REGRA", "STATUS")


@query("p12_label_chain", f"WITH {HUB_SQL} SELECT FATURA, CASE STATUS WHEN 'INCORRETO' THEN 4 WHEN 'ALERTA' THEN 3 ELSE 1 END AS prioridade FROM hub")
def p12(spark, sf):
    from billproof.functions.text import label_chain

    s = F.col("STATUS")
    return hub(spark, sf).select("FATURA", label_chain([(s == "INCORRETO", 4), (s == "ALERTA", 3)], 1).alias("prioridade"))


_FISCAL = f"REGRA IN ({quoted(P.RULES_TAG_IN_TEXT)})"


@query(
    "q6_report_fiscal_status",
    f"""WITH {HUB_SQL} SELECT CRM, REGRA, STATUS, SUBSTATUS, COUNT(*) AS n, COUNT(DISTINCT ID_CONTA_CONTRATO) AS cli, COUNT(DISTINCT FATURA) AS fat FROM hub WHERE {_FISCAL} GROUP BY 1, 2, 3, 4""",
)
def q6_fiscal(spark, sf):
    return P.report_fiscal_status(hub(spark, sf), LOT)


@query(
    "q6_report_fiscal_texts",
    f"""WITH {HUB_SQL} SELECT REGRA, SUBSTATUS, OBSERVACAO, COUNT(*) AS n, COUNT(DISTINCT ID_CONTA_CONTRATO) AS cli FROM hub WHERE {_FISCAL} AND STATUS = 'INCORRETO' GROUP BY 1, 2, 3""",
)
def q6_texts(spark, sf):
    return P.report_fiscal_texts(hub(spark, sf), LOT)


@query(
    "q6_report_text_like",
    f"""WITH {HUB_SQL} SELECT OBSERVACAO, COUNT(*) AS n, COUNT(DISTINCT ID_CONTA_CONTRATO) AS cli FROM hub WHERE REGRA = 'VALIDACAO_IMPOSTOS' AND OBSERVACAO LIKE '%TAG!_3%' ESCAPE '!'
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
)
def q6_like(spark, sf):
    return P.report_text_like(hub(spark, sf), LOT, "VALIDACAO_IMPOSTOS", "TAG_3")


def _share(status):
    return f"ROUND(COUNT(DISTINCT CASE WHEN STATUS = '{status}' THEN FATURA END) * 100.0::DOUBLE / NULLIF(COUNT(DISTINCT FATURA), 0), 2)"


@query(
    "q6_report_executive",
    f"""WITH {HUB_SQL} SELECT COUNT(DISTINCT FATURA) AS fat, COUNT(DISTINCT ID_CONTA_CONTRATO) AS cli, COUNT(CASE WHEN STATUS = 'CORRETO' THEN 1 END) AS ok,
  COUNT(CASE WHEN STATUS = 'INCORRETO' THEN 1 END) AS incorreto, COUNT(CASE WHEN STATUS = 'ALERTA' THEN 1 END) AS alerta, COUNT(CASE WHEN REGRA = 'VALIDACAO_IMPOSTOS' THEN 1 END) AS impostos,
  COUNT(CASE WHEN REGRA = 'VALIDACAO_NFCOM' THEN 1 END) AS nfcom, {_share('CORRETO')} AS pct_ok, {_share('INCORRETO')} AS pct_incorreto, {_share('ALERTA')} AS pct_alerta FROM hub WHERE {_FISCAL}""",
)
def q6_executive(spark, sf):
    return P.report_executive(hub(spark, sf), LOT)


@query(
    "q6_report_accounts",
    f"""WITH {ACCOUNT_SQL} SELECT STATUS, STATUS_VALIDACAO, Ordem_Status, COUNT(*) AS faturas, COUNT(DISTINCT ID_CONTA) AS contas, ROUND(SUM(VALOR), 2) AS valor_total,
  COUNT(CASE WHEN PROBLEMA IS NOT NULL THEN 1 END) AS com_problema, COUNT(CASE WHEN Valor_Positive = 'SIM' THEN 1 END) AS com_valor FROM accounts GROUP BY 1, 2, 3""",
)
def q6_accounts(spark, sf):
    return P.report_accounts(accounts(spark, sf))


@query("q6_top_problems", f"WITH {ACCOUNT_SQL} SELECT PROBLEMA, COUNT(*) AS qtd FROM accounts WHERE PROBLEMA IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def q6_problems(spark, sf):
    return P.top_problems(accounts(spark, sf))


@query(
    "q6_report_details",
    f"""WITH {DETAIL_SQL}, u AS ({_deduped(DETAIL_SELECT)}) SELECT REGRA, STATUS, SUBSTATUS, STATUS_VALIDACAO, COUNT(*) AS linhas, COUNT(DISTINCT FATURA) AS faturas,
  COUNT(DISTINCT ID_CONTA) AS contas FROM u GROUP BY 1, 2, 3, 4""",
)
def q6_details(spark, sf):
    return P.report_details(P.detail(hub(spark, sf), accounts(spark, sf), LOT, AS_OF.date()))


@query(
    "q6_report_tags",
    f"""WITH {TAGS_SQL}, u AS ({_deduped(TAG_SELECT)}) SELECT REGRA, STATUS, TAG, STATUS_VALIDACAO, COUNT(*) AS linhas, COUNT(DISTINCT FATURA) AS faturas FROM u GROUP BY 1, 2, 3, 4""",
)
def q6_tags(spark, sf):
    return P.report_tags(P.tag_detail(hub(spark, sf), accounts(spark, sf), LOT, AS_OF.date()))


@query(
    "q3_schema_check",
    f"WITH {ACCOUNT_SQL} " + " UNION ALL ".join(
        f"SELECT '{x}' AS coluna, TRUE AS presente, COUNT({x}) AS preenchidas FROM accounts" for x in ACCOUNT_SELECT
    ) + " UNION ALL SELECT 'COLUNA_NOVA', FALSE, 0",
)
def q3(spark, sf):
    """Every wanted column: is it there, and in how many rows is it filled?"""
    out, wanted = accounts(spark, sf), [*ACCOUNT_SELECT, "COLUNA_NOVA"]
    missing, _ = Q.schema_diff(out, wanted)
    counts = out.agg(*[(F.lit(0).cast("long") if x in missing else F.count(x)).alias(x) for x in wanted])
    parts = [F.struct(F.lit(x).alias("coluna"), F.lit(x not in missing).alias("presente"), F.col(x).alias("preenchidas")) for x in wanted]
    return counts.select(F.explode(F.array(*parts)).alias("p")).select("p.*")


@query("q4_not_empty", f"WITH {HUB_SQL} SELECT COUNT(*) AS n FROM hub WHERE ID_Lote = '{LOT}'")
def q4(spark, sf):
    return Q.assert_not_empty(P.select_lot(hub(spark, sf), LOT), "findings").agg(F.count(F.lit(1)).alias("n"))


def _checks_sql(rows: str, checks: dict) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS \"check\", COUNT(CASE WHEN {c} THEN 1 END) AS violations, COUNT(CASE WHEN {c} THEN 1 END) = 0 AS ok FROM {rows}" for n, c in checks.items()
    )


@query(
    "q2_detail_checks",
    f"WITH {DETAIL_SQL}, u AS ({_deduped(DETAIL_SELECT)}) "
    + _checks_sql("u", {
        "status_validacao": f"({BAD} AND STATUS_VALIDACAO <> 'PENDENTE') OR (STATUS = 'CORRETO' AND STATUS_VALIDACAO <> 'VALIDADO')",
        "ruim_com_tag": f"{BAD} AND (TAG IS NULL OR TAG = '')",
        "filtra_page": "REGRA || '_' || STATUS IS NULL",
    }),
)
def q2_details(spark, sf):
    return Q.check(P.detail_of(prepared(spark, sf), AS_OF.date()), P.detail_checks())


@query(
    "q2_tag_checks",
    f"WITH {TAGS_SQL}, u AS ({_deduped(TAG_SELECT)}) "
    + _checks_sql("u", {
        "somente_ruins": f"NOT ({BAD})",
        "tag_preenchida": "TAG IS NULL OR TAG = ''",
        "status_validacao": f"{BAD} AND STATUS_VALIDACAO <> 'PENDENTE'",
        "analista_nulo": "FALSE",  # the tag table has no analyst
    }),
)
def q2_tags(spark, sf):
    return Q.check(P.tag_detail_of(prepared(spark, sf), AS_OF.date()), P.tag_checks())


# -- the chain: rules -> hub -> accounts -> details and tags -----------------------------------------------------------

RULES_HUB_SQL = exploded_sql("item_id, FATURA_NUMERO, sistem_origem") + """, hub AS (SELECT COALESCE(FATURA_NUMERO, '') AS FATURA, CAST(item_id AS VARCHAR) AS ID_CONTA_CONTRATO, regra AS REGRA, status AS STATUS,
  substatus AS SUBSTATUS, observacao AS OBSERVACAO, CAST(NULL AS VARCHAR) AS Produto, COALESCE(sistem_origem, '') AS CRM, 'NFCOM' AS SEGMENTO, CAST(NULL AS VARCHAR) AS VALOR_BILLING FROM findings)"""
CHAIN_ACCOUNTS_SQL = ACCOUNT_SQL.replace(HUB_SQL, RULES_HUB_SQL)


def rules_hub(spark, sf):
    """The findings of the rule job in the hub's layout, every item an account."""
    rows = items(spark, sf).withColumn("ID_CLIENTE", F.col("item_id").cast("string"))
    return RU.to_hub(RU.findings(rows, master(spark, sf), taxes(spark, sf), LOT), LOT, F.lit(AS_OF))


@query("d22_accounts_from_rules", f"WITH {CHAIN_ACCOUNTS_SQL} SELECT {', '.join(ACCOUNT_SELECT)} FROM accounts")
def d22_chain(spark, sf):
    return P.account_rollup(rules_hub(spark, sf), customers(spark, sf), LOT, AS_OF).select(*ACCOUNT_SELECT)


CHAIN_SELECT = ["FATURA", "ID_CONTA", "REGRA", "STATUS", "SUBSTATUS", "OBSERVACAO", "STATUS_VALIDACAO", "TAG", "RESUMO"]
_CHAIN_TAG = "COALESCE(trim(split_part(OBSERVACAO, ':', 1)), REGRA)"
_CHAIN_ROWS = f"""SELECT DISTINCT FATURA, ID_CONTA_CONTRATO AS ID_CONTA, REGRA, STATUS, SUBSTATUS, OBSERVACAO, CASE WHEN {BAD} THEN 'PENDENTE' ELSE 'VALIDADO' END AS STATUS_VALIDACAO,
  {{tag}} AS TAG, CASE WHEN trim(OBSERVACAO) <> '' THEN {_CHAIN_TAG} || ' | ' || OBSERVACAO ELSE {_CHAIN_TAG} END AS RESUMO FROM hub"""


def _chain(spark, sf):
    hub_rows = stored(rules_hub(spark, sf), "hub")
    found = P.account_rollup(hub_rows, customers(spark, sf), LOT, AS_OF, saved=True)
    return P.prepare_hub(hub_rows, found, LOT, saved=True)


@query("d25_details_from_rules", f"WITH {RULES_HUB_SQL} {_CHAIN_ROWS.format(tag=f'CASE WHEN {BAD} THEN {_CHAIN_TAG} END')}")
def d25_chain(spark, sf):
    return P.detail_of(_chain(spark, sf), AS_OF.date()).select(*CHAIN_SELECT)


@query("d26_tags_from_rules", f"WITH {RULES_HUB_SQL} {_CHAIN_ROWS.format(tag=_CHAIN_TAG)} WHERE {BAD}")
def d26_chain(spark, sf):
    return P.tag_detail_of(_chain(spark, sf), AS_OF.date()).select(*CHAIN_SELECT)
