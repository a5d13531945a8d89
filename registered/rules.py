"""Rule queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from billproof.functions.numbers import diverges, rate
from billproof.operators import aggregates as A
from billproof.operators import joins as J
from billproof.plans import rule_catalogue as K
from billproof.plans import rules as P

from . import query
from .fixtures import LOT, quoted, table
from .item_fixture import PREPARED_SQL, _off, exploded_sql, flags_sql, items, master, taxes

TAX_TAGS = [r.tag for r in P.RULES if r.category == K.TAXES]
INVOICE_TAGS = [r.tag for r in P.RULES if r.category == K.INVOICE]


def prepared(spark, sf):
    """Prepared items; item_id is carried through the customer column."""
    base = items(spark, sf).withColumn("ID_CLIENTE", F.col("item_id").cast("string"))
    return P.prepare_items(base, master(spark, sf), taxes(spark, sf), LOT)


def with_id(df, *columns):
    return df.select(F.col("ID_CLIENTE").cast("bigint").alias("item_id"), *columns)


@query(
    "d2_derive_tag",
    f"""WITH {PREPARED_SQL} SELECT item_id, tagc AS tag_cst, tagr AS tag_raw, tag, icms, mapped, mcst AS cst_mestre, mtag AS tag_mestre
FROM prepared""",
)
def d2(spark, sf):
    c = F.col
    return with_id(
        prepared(spark, sf),
        c("x_tag_cst").alias("tag_cst"),
        c("x_tag_raw").alias("tag_raw"),
        c("x_tag").alias("tag"),
        c("x_icms").alias("icms"),
        c("x_mapped").alias("mapped"),
        c("x_m_cst").alias("cst_mestre"),
        c("x_m_tag").alias("tag_mestre"),
    )


@query(
    "d3_rate_reference",
    f"""WITH {PREPARED_SQL} SELECT item_id, CAST(ri AS DOUBLE) AS icms_uf, CAST(rc AS DOUBLE) AS confaz_uf, CAST(re AS DOUBLE) AS estadual_uf,
  CAST(icmsref AS DOUBLE) AS icms_ref, CAST(fustref AS DOUBLE) AS fust_ref, CAST(ftlref AS DOUBLE) AS funttel_ref FROM prepared""",
)
def d3(spark, sf):
    names = {
        "x_rate_icms": "icms_uf", "x_rate_confaz": "confaz_uf", "x_rate_estadual": "estadual_uf",
        "x_icms_ref": "icms_ref", "x_fust_ref": "fust_ref", "x_funttel_ref": "funttel_ref",
    }
    return with_id(prepared(spark, sf), *[F.col(a).cast("double").alias(b) for a, b in names.items()])


@query(
    "j6_state_rates",
    f"""WITH {PREPARED_SQL} SELECT state, CAST(ri AS DOUBLE) AS icms, CAST(rc AS DOUBLE) AS confaz FROM rates
WHERE ri IS NOT NULL OR rc IS NOT NULL""",
)
def j6(spark, sf):
    out = P.state_rates(taxes(spark, sf))
    return out.select(
        "state", F.col("x_rate_icms").cast("double").alias("icms"), F.col("x_rate_confaz").cast("double").alias("confaz")
    )


@query(
    "j7_cross_one_row",
    "SELECT l_orderkey, l_linenumber, 1.65::DOUBLE AS pis_nc, 7.6::DOUBLE AS cofins_nc FROM lineitem",
)
def j7(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    pair = P.non_cumulative(taxes(spark, sf)).select(
        F.col("x_pis_nc").cast("double").alias("pis_nc"), F.col("x_cofins_nc").cast("double").alias("cofins_nc")
    )
    return J.cross_one_row(lines, pair)


@query(
    "d4_tolerant_divergence",
    f"""SELECT l_orderkey, l_linenumber, {_off("CAST(l_tax AS DECIMAL(8,4))", "CAST(l_quantity / 10 AS DECIMAL(8,4))")} AS diverge
FROM lineitem""",
)
def d4(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", diverges(rate(F.col("l_tax")), rate(F.col("l_quantity") / 10)).alias("diverge")
    )


def _flag_query(name, tags):
    sql = f"WITH {flags_sql(tags)} SELECT item_id, " + ", ".join(f"COALESCE({t}, FALSE) AS {t}" for t in tags) + " FROM flags"

    @query(name, sql)
    def run(spark, sf):
        flagged = P.rule_flags(prepared(spark, sf), [r for r in P.RULES if r.tag in tags])
        return with_id(flagged, *[F.coalesce(F.col(t), F.lit(False)).alias(t) for t in tags])

    return run


_flag_query("d5_tax_rules", TAX_TAGS)
_flag_query("d6_invoice_rules", INVOICE_TAGS)

ALL_TAGS = [*TAX_TAGS, *INVOICE_TAGS]


@query(
    "d7_rule_counts",
    f"WITH {flags_sql(ALL_TAGS)} "
    + " UNION ALL ".join(
        f"SELECT '{tag}' AS tag, '{category}' AS categoria, '{severity}' AS severidade, COUNT(CASE WHEN {tag} THEN 1 END) AS n FROM flags"
        for tag, category, severity, _ in K.RULE_TEXTS
    ),
)
def d7(spark, sf):
    flagged = P.rule_flags(prepared(spark, sf))
    counts = flagged.agg(*[F.count_if(F.col(r.tag)).alias(r.tag) for r in P.RULES])
    rows = [
        F.struct(F.lit(r.tag).alias("tag"), F.lit(r.category).alias("categoria"), F.lit(r.severity).alias("severidade"), F.col(r.tag).alias("n"))
        for r in P.RULES
    ]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


@query(
    "n7_explode_findings",
    f"WITH {exploded_sql('item_id')} SELECT item_id, regra, status, substatus, observacao FROM findings",
)
def n7(spark, sf):
    exploded = P.explode_findings(P.rule_flags(prepared(spark, sf)))
    return with_id(exploded, "regra", "status", "substatus", "observacao")


_BILLED = (
    "concat_ws(' | ', 'TAG_VALIDADA: ' || COALESCE(tag, ''), 'TAG_CST: ' || tagc, 'TAG_RAW: ' || tagr, 'TAG_MESTRE: ' || COALESCE(mtag, ''), "
)
_BILLED_TAXES = _BILLED + ", ".join(
    f"'{t}: ' || COALESCE(CAST({t}_STANDING AS VARCHAR), '')" for t in ("ICMS", "PIS", "COFINS", "FUST", "FUNTTEL")
) + ", 'CST: ' || COALESCE(xcst, ''), 'REGIME: ' || COALESCE(REGIME_TRIB, ''))"


def _show(c):
    return f"CASE WHEN lower(trim({c})) IN ('nan','none','null') THEN '' ELSE COALESCE(trim({c}), '') END"


_BILLED_INVOICE = (
    _BILLED
    + ", ".join(f"'{label}: ' || {_show(c)}" for label, c in [
        ("CCLASS", "CCLASS"), ("CFOP", "CFOP"), ("UF_DEST", "UF_DEST"), ("CST", "xcst"), ("GRUPO_CCLASS", "GRUPO_CCLASS"), ("FATURA", "FATURA_NUMERO"),
    ])
    + ")"
)


@query(
    "d8_findings_report",
    f"""WITH {exploded_sql("item_id, FATURA_NUMERO, sistem_origem, CCLASS, CFOP, " + _BILLED_TAXES + " AS bt_text, " + _BILLED_INVOICE + " AS bn_text")}
SELECT COALESCE(FATURA_NUMERO, '') AS fatura_numero, CAST(item_id AS VARCHAR) AS id_cliente, regra, status, substatus, observacao,
  CASE WHEN regra = 'VALIDACAO_IMPOSTOS' THEN bt_text ELSE bn_text END AS dados_billing FROM findings""",
)
def d8(spark, sf):
    base = items(spark, sf).withColumn("ID_CLIENTE", F.col("item_id").cast("string"))
    out = P.findings(base, master(spark, sf), taxes(spark, sf), LOT)
    return out.select("fatura_numero", "id_cliente", "regra", "status", "substatus", "observacao", "dados_billing")


def _fired(category):
    mine = [(t, s) for t, c, s, _ in K.RULE_TEXTS if c == category]
    count = " + ".join(f"CASE WHEN {t} THEN 1 ELSE 0 END" for t, _ in mine)
    names = ", ".join(f"CASE WHEN {t} THEN '{t}[{s}]' END" for t, s in mine)
    return f"CASE WHEN {count} > 0 THEN 'REGRAS_DISPARADAS(' || ({count}) || '): ' || concat_ws(' | ', {names}) || ' | ' ELSE '' END"


def _v(c):
    return f"COALESCE(CAST({c} AS VARCHAR), '')"


_TRUTH_TAXES = (
    _fired(K.TAXES)
    + f""" || CASE WHEN xcst = '0' THEN 'ICMS_CST_0 (aliq nominal UF): ' || {_v('ri')} WHEN xcst = '51' THEN 'ICMS_CST_51 (diferimento CONFAZ): ' || {_v('rc')} || ' — ICMS nao destacado'
  WHEN xcst = '40' THEN 'ICMS_CST_40 (isento estadual): ' || {_v('re')} || ' — aliq=0% nacional' ELSE 'ICMS_CST_0 (UF): ' || {_v('ri')} || ' | ICMS_ESPERADO_STANDING: ' || ICMS_ESPERADO END
  || ' | PIS_CUMUL: 0.65 | PIS_NC: 1.65 | COFINS_CUMUL: 3.0 | COFINS_NC: 7.6 | FUST_RN004: ' || fustref || ' | FUNTTEL_RN004: ' || ftlref || ' | CST_MESTRE: ' || {_v('mcst')} || ' | TAG_JOIN: ' || {_v('mtag')}"""
)
_TRUTH_INVOICE = (
    _fired(K.INVOICE)
    + f""" || 'UF_EMISSORA: ' || COALESCE(UF_EMIT_PARAMETRIZADA, 'SP') || ' | CFOPS_VALIDOS: 5301-5307,5933,6301-6307,6933,1205,7301 | REGRA_CFOP: mesma UF=5xxx outra UF=6xxx | TAG_JOIN: '
  || {_v('mtag')} || ' | CST_MESTRE: ' || {_v('mcst')} || ' | GRUPOS_FIN: 100,110 (indSemCST sem CFOP)'"""
)


@query(
    "d8_truth_text",
    f"""WITH {exploded_sql("item_id, " + _TRUTH_TAXES + " AS tt_text, " + _TRUTH_INVOICE + " AS tn_text")}
SELECT CAST(item_id AS VARCHAR) AS id_cliente, regra, observacao, CASE WHEN regra = 'VALIDACAO_IMPOSTOS' THEN tt_text ELSE tn_text END AS dados_tabela_verdade FROM findings""",
)
def d8_truth(spark, sf):
    base = items(spark, sf).withColumn("ID_CLIENTE", F.col("item_id").cast("string"))
    out = P.findings(base, master(spark, sf), taxes(spark, sf), LOT)
    return out.select("id_cliente", "regra", "observacao", "dados_tabela_verdade")


@query(
    "d9_finding_keys",
    f"""WITH {exploded_sql("item_id, FATURA_NUMERO, sistem_origem, CCLASS, CFOP, ICMS_STANDING, fustref")}
SELECT CAST(item_id AS VARCHAR) AS id_cliente, substatus,
  md5(concat_ws('|', sistem_origem, COALESCE(FATURA_NUMERO, ''), CAST(item_id AS VARCHAR), COALESCE(CCLASS, ''), COALESCE(CFOP, ''), regra, '{LOT}')) AS id_validacao,
  sha256(concat_ws('|', status, substatus, observacao)) AS hash_registro,
  CAST(ICMS_STANDING AS DOUBLE) AS icms_standing, CAST(fustref AS DOUBLE) AS fust_rn004 FROM findings""",
)
def d9(spark, sf):
    base = items(spark, sf).withColumn("ID_CLIENTE", F.col("item_id").cast("string"))
    out = P.findings(base, master(spark, sf), taxes(spark, sf), LOT)
    return out.select(
        "id_cliente",
        "substatus",
        "id_validacao",
        "hash_registro",
        F.col("icms_standing").cast("double").alias("icms_standing"),
        F.col("fust_rn004").cast("double").alias("fust_rn004"),
    )


@query(
    "g4_conditional_counts",
    f"""WITH {PREPARED_SQL} SELECT sistem_origem, COUNT(CASE WHEN mapped THEN 1 END) AS mapeados, COUNT(CASE WHEN icms THEN 1 END) AS com_icms,
  COUNT(CASE WHEN bi > 0 THEN 1 END) AS com_aliquota, COUNT(*) AS total FROM prepared GROUP BY sistem_origem""",
)
def g4(spark, sf):
    return prepared(spark, sf).groupBy("sistem_origem").agg(
        A.count_where(F.col("x_mapped")).alias("mapeados"),
        A.count_where(F.col("x_icms")).alias("com_icms"),
        A.count_where(rate(F.col("ICMS_STANDING")) > 0).alias("com_aliquota"),
        F.count(F.lit(1)).alias("total"),
    )


@query(
    "j15_valid_codes",
    f"""WITH {PREPARED_SQL} SELECT CFOP, COALESCE(CFOP IN ({quoted(K.CFOPS)}), FALSE) AS cfop_valido, COUNT(*) AS n FROM prepared GROUP BY CFOP""",
)
def j15(spark, sf):
    marked = J.valid_codes(prepared(spark, sf).select("CFOP"), "CFOP", K.CFOPS, "cfop_valido")
    return A.distribution(marked, ["CFOP", "cfop_valido"])


@query(
    "q5_distribution",
    f"""WITH {exploded_sql("item_id")} SELECT regra, status, substatus, COUNT(*) AS n FROM findings GROUP BY regra, status, substatus""",
)
def q5(spark, sf):
    exploded = P.explode_findings(P.rule_flags(prepared(spark, sf)))
    return A.distribution(exploded, ["regra", "status", "substatus"])
