"""Billed items, fiscal master and tax table derived from the given tables, and the prepared items as SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from billproof.plans import rule_catalogue as K

from .fixtures import LOT, quoted, table

CFOP_CHOICES = ["5301", "5302", "6301", "6302", "5933", "6933", "5101", None, "", "5301.0", "1205", "nan"]
GROUP_CHOICES = ["10", "20", "30", "60", "80", "130", "13", "120", "100", "110", None]
MASTER_TAGS = ["ICMS_CST_0", "ICMS", "ICMS_CONFAZ", "ICMS_ESTADUAL", "ICMS_CST_40", "SEM", "PIS_COFINS", "OUTRO"]
MASTER_CSTS = ["0", "40", "41", "51", None, "20", "40.0"]
PIS = ["0.65", "1.65", "0.0165", None, "2.00"]
COFINS = ["3.0", "7.6", "0.076", None, "5", "3.0", "7.6"]
FUST = ["1.0", "0.01", None]
FUNTTEL = ["0.5", "0.005", None, "1"]
REGIMES = ["SIMPLES NACIONAL", "LUCRO REAL", None, "Lucro Presumido", "simples nacional", "LUCRO REAL"]


def _sql_choice(values, index: str) -> str:
    cases = " ".join(
        f"WHEN {i} THEN {'NULL' if v is None else chr(39) + v + chr(39)}" for i, v in enumerate(values)
    )
    return f"CASE {index} {cases} END"


# One expression list for both engines: the dialects agree on everything used here.
def _item_expressions() -> dict[str, str]:
    cclass = "CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE lpad(CAST(l_partkey % 60 AS {s}), 6, '0') END"
    return {
        "CICLO": f"'{LOT}'",
        "CCLASS": cclass,
        "CCLASS_7D": "CASE WHEN l_partkey % 10 = 3 THEN concat('0', CAST((l_partkey + 1) % 60 AS {s})) "
        "ELSE lpad(CAST(l_partkey % 60 AS {s}), 7, '0') END",
        "CFOP": _sql_choice(CFOP_CHOICES, "CAST(l_suppkey % 12 AS INT)"),
        "UF_DEST": "CASE WHEN l_orderkey % 53 = 0 THEN NULL WHEN l_orderkey % 53 = 1 THEN 'XX' "
        "WHEN l_orderkey % 53 = 2 THEN ' sp ' ELSE " + _sql_choice(K.STATES, "CAST(c_nationkey AS INT)") + " END",
        "UF_EMIT_PARAMETRIZADA": "CASE WHEN l_orderkey % 4 = 0 THEN NULL ELSE 'SP' END",
        "CST_ICMS": "CASE WHEN l_linenumber = 5 THEN NULL WHEN l_linenumber = 6 THEN '0.0' WHEN l_linenumber = 7 THEN '20' "
        "WHEN l_returnflag = 'A' THEN '0' WHEN l_returnflag = 'N' THEN '40' ELSE '51' END",
        "ICMS_STANDING": "CASE WHEN l_linenumber = 4 THEN NULL WHEN l_linenumber % 2 = 0 THEN CAST(l_tax AS DECIMAL(8,4)) "
        "ELSE CAST(CAST(l_tax AS DECIMAL(4,2)) * 100 AS DECIMAL(8,4)) END",
        "PIS_STANDING": _sql_choice(PIS, "CAST(l_orderkey % 5 AS INT)"),
        "COFINS_STANDING": _sql_choice(COFINS, "CAST(l_orderkey % 7 AS INT)"),
        "FUST_STANDING": _sql_choice(FUST, "CAST(l_orderkey % 3 AS INT)"),
        "FUNTTEL_STANDING": _sql_choice(FUNTTEL, "CAST(l_orderkey % 4 AS INT)"),
        "ICMS_ESPERADO": "'7'",
        "PIS_ESPERADO": "'1.65'",
        "COFINS_ESPERADO": "'7.6'",
        "FUST_ESPERADO": "'1'",
        "FUNTTEL_ESPERADO": "'0.5'",
        "REGIME_TRIB": _sql_choice(REGIMES, "CAST(l_orderkey % 6 AS INT)"),
        "GRUPO_CCLASS": _sql_choice(GROUP_CHOICES, "CAST(l_partkey % 11 AS INT)"),
        "FATURA_NUMERO": "CASE WHEN l_orderkey % 41 = 0 THEN NULL WHEN l_orderkey % 41 = 1 THEN 'NaN' "
        "ELSE CAST(l_orderkey AS {s}) END",
        "ID_CLIENTE": "CAST(o_custkey AS {s})",
        "sistem_origem": "CASE WHEN l_linestatus = 'F' THEN 'NG' ELSE 'ADAPTER' END",
        "TIPO_FAT": "CASE WHEN l_orderkey % 29 = 0 THEN 'Substituição' ELSE 'Normal' END",
        "MUNICIPIO_PRESTACAO": "CASE WHEN l_orderkey % 31 = 0 THEN NULL WHEN l_orderkey % 31 = 1 THEN 'Nao informado' ELSE c_name END",
        "MUNICIPIO_DEST": "CASE WHEN l_orderkey % 37 = 0 THEN NULL WHEN l_orderkey % 37 = 1 THEN 'none' ELSE n_name END",
        "TIPO_SERVICO_ESPERADO_CCLASS": "'SCM'",
        "TIPO_IMPOSTO_MESTRE": "'ICMS'",
        '"IMPACTO_ICMS_ESTIMADO_R$"': "CAST(l_extendedprice AS DECIMAL(18,2))",
        "item_id": "l_orderkey * 10 + l_linenumber",
    }


def items(spark, sf):
    joined = (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return joined.select(
        *[F.expr(e.format(s="STRING")).alias(name.strip('"')) for name, e in _item_expressions().items()]
    )


def master(spark, sf):
    code = "CAST(p_partkey % 60 AS INT)"
    return table(spark, sf, "part").where("p_partkey % 60 < 48").select(
        F.expr(f"lpad(CAST({code} AS STRING), 5, '0')").alias("CCLASS_NFCON"),
        F.expr(_sql_choice(MASTER_CSTS, f"{code} % 7")).alias("CST"),
        F.expr(_sql_choice(MASTER_TAGS, f"{code} % 8")).alias("TAX_UF_MUNICIPIO"),
    )


def taxes(spark, sf):
    nation = table(spark, sf, "nation").select(
        F.expr(_sql_choice(K.STATES, "n_nationkey")).alias("ESTADO"), F.col("n_nationkey").alias("k")
    )

    def rows(kind, rate_sql, pis="CAST(NULL AS DOUBLE)", cofins="CAST(NULL AS DOUBLE)"):
        return nation.select(
            "ESTADO",
            F.lit(kind).alias("TIPO_IMPOSTO"),
            F.expr(rate_sql).cast("double").alias("ALIQUOTA"),
            F.expr(pis).alias("PIS"),
            F.expr(cofins).alias("COFINS"),
        )

    return (
        rows(" icms", "k % 9")
        .unionByName(rows("ICMS_CST_51", "k % 2"))
        .unionByName(rows("ICMS_ESTADUAL", "0"))
        .unionByName(rows("PIS_COFINS", "0", "CAST(1.65 AS DOUBLE)", "CAST(7.6 AS DOUBLE)"))
    )


def _blank(column: str, tokens) -> str:
    return f"({column} IS NULL OR trim({column}) IN ({quoted(tokens)}))"


_NAME = ("", "NULL", "NAN", "NONE")

ITEMS_SQL = (
    "items AS (SELECT "
    + ", ".join(f"{e.format(s='VARCHAR')} AS {n}" for n, e in _item_expressions().items())
    + " FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey "
    "JOIN nation ON c_nationkey = n_nationkey)"
)

PREPARED_SQL = f"""{ITEMS_SQL},
master AS (SELECT DISTINCT CAST(CAST(p_partkey % 60 AS INT) AS VARCHAR) AS k,
    {_sql_choice(MASTER_CSTS, "CAST(p_partkey % 60 AS INT) % 7")} AS cst,
    {_sql_choice(MASTER_TAGS, "CAST(p_partkey % 60 AS INT) % 8")} AS tag FROM part WHERE p_partkey % 60 < 48),
rates AS (SELECT {_sql_choice(K.STATES, "n_nationkey")} AS state,
    CASE WHEN n_nationkey % 9 > 0 THEN CAST(n_nationkey % 9 AS DECIMAL(8,4)) END AS ri,
    CASE WHEN n_nationkey % 2 > 0 THEN CAST(n_nationkey % 2 AS DECIMAL(8,4)) END AS rc,
    CAST(NULL AS DECIMAL(8,4)) AS re FROM nation),
cleaned AS (SELECT items.* EXCLUDE (CFOP), regexp_replace(trim(CFOP), '\\.0$', '') AS CFOP,
    regexp_replace(trim(CCLASS), '^0+([0-9])', '\\1') AS xc, regexp_replace(trim(CCLASS_7D), '^0+([0-9])', '\\1') AS x7,
    regexp_replace(trim(CST_ICMS), '\\.0$', '') AS xcst FROM items),
c1 AS (SELECT *, {_blank("xcst", ("", "nan", "null", "None", "NaN"))} AS blank FROM cleaned),
c2 AS (SELECT *, CASE WHEN blank THEN 'SEM_IMPOSTO_CST_NULO' ELSE 'ICMS_CST_' || xcst END AS tagc FROM c1),
c3 AS (SELECT c2.*, COALESCE(a.k, b.k) IS NOT NULL AS mapped, COALESCE(a.cst, b.cst) AS mcst, COALESCE(a.tag, b.tag) AS mtag
       FROM c2 LEFT JOIN master a ON a.k = xc LEFT JOIN master b ON b.k = x7),
c4 AS (SELECT *, CASE WHEN tagc IN ({quoted(K.VALID_TAGS)}) THEN tagc WHEN mtag IN ({quoted(K.VALID_TAGS)}) THEN mtag ELSE tagc END AS tagr FROM c3),
c5 AS (SELECT *, CASE WHEN tagr IN ({quoted(K.VALID_TAGS)}) THEN tagr END AS tag FROM c4),
c6 AS (SELECT *, (tag IS NOT NULL AND (tag LIKE 'ICMS\\_CST\\_%' ESCAPE '\\' OR tag IN ('ICMS','ICMS_CONFAZ','ICMS_ESTADUAL')))
    OR (mtag IS NOT NULL AND (mtag LIKE 'ICMS\\_CST\\_%' ESCAPE '\\' OR mtag IN ('ICMS','ICMS_CONFAZ','ICMS_ESTADUAL'))) AS icms,
    upper(trim(UF_DEST)) AS ufd, upper(trim(COALESCE(UF_EMIT_PARAMETRIZADA, 'RS'))) AS ufe FROM c5),
c7 AS (SELECT c6.*, ri, rc, re, CASE WHEN xcst = '0' THEN ri WHEN xcst = '51' THEN rc WHEN xcst = '40' THEN re
         ELSE COALESCE(ri, CAST(ICMS_ESPERADO AS DECIMAL(8,4))) END AS icmsref,
       CAST(CASE WHEN icms THEN 1 ELSE 0 END AS DECIMAL(8,4)) AS fustref,
       CAST(CASE WHEN icms THEN 0.5 ELSE 0 END AS DECIMAL(8,4)) AS ftlref
     FROM c6 LEFT JOIN rates ON state = ufd),
prepared AS (SELECT *, CAST(ICMS_STANDING AS DECIMAL(8,4)) AS bi, COALESCE(CAST(PIS_STANDING AS DECIMAL(8,4)), 0) AS bp,
    COALESCE(CAST(COFINS_STANDING AS DECIMAL(8,4)), 0) AS bc, COALESCE(CAST(FUST_STANDING AS DECIMAL(8,4)), 0) AS bf,
    COALESCE(CAST(FUNTTEL_STANDING AS DECIMAL(8,4)), 0) AS bt, upper(trim(REGIME_TRIB)) LIKE '%SIMPLES%' AS simples,
    NOT {_blank("CFOP", ("", "null", "nan", "None"))} AS hascfop FROM c7)"""


def _off(billed: str, expected: str) -> str:
    return f"({billed} IS NOT NULL AND {expected} IS NOT NULL AND abs({billed} - {expected}) > 0.005 AND abs({billed} * 100 - {expected}) > 0.005)"


_PIS_OFF = _off("bp", "0.65") + " AND " + _off("bp", "1.65")
_COF_OFF = _off("bc", "3.0") + " AND " + _off("bc", "7.6")
_CFOPS, _SVC, _COM = quoted(K.CFOPS), quoted(K.CFOPS_SERVICE), quoted(K.CFOPS_COMMUNICATION)
_STATES = quoted(K.STATES)
_UF_MISSING = f"(UF_DEST IS NULL OR upper(trim(UF_DEST)) IN ({quoted(_NAME)}))"

RULE_SQL = {
    "CST_INCOMPATIVEL_TRIBUTO": "mapped AND icms AND NOT blank AND mtag IS NOT NULL AND tagc <> CASE mtag WHEN 'ICMS' THEN 'ICMS_CST_0' "
    "WHEN 'ICMS_CONFAZ' THEN 'ICMS_CST_51' WHEN 'ICMS_ESTADUAL' THEN 'ICMS_CST_40' ELSE mtag END",
    "CST_ICMS_NULO": "mapped AND icms AND blank AND NOT (regexp_replace(trim(mcst), '\\.0$', '') IN ('40', '41'))",
    "ICMS_DIVERGENTE": f"mapped AND icms AND NOT blank AND {_off('bi', 'icmsref')}",
    "PIS_DIVERGENTE": f"mapped AND NOT simples AND icms AND {_PIS_OFF}",
    "COFINS_DIVERGENTE": f"mapped AND NOT simples AND icms AND {_COF_OFF}",
    "PIS_COFINS_SIMPLES_ALERTA": f"mapped AND simples AND (({_PIS_OFF}) OR ({_COF_OFF}))",
    "FUST_INCORRETO": f"mapped AND {_off('bf', 'fustref')}",
    "FUNTTEL_INCORRETO": f"mapped AND {_off('bt', 'ftlref')}",
    "ICMS_SEM_ALIQUOTA": "icms AND NOT (xcst IN ('40','41','50','51','60')) AND (bi IS NULL OR bi = 0)",
    "CCLASS_NAO_MAPEADO": "NOT mapped",
    "CFOP_INVALIDO": f"icms AND hascfop AND CFOP NOT IN ({_CFOPS})",
    "CFOP_INCOMPATIVEL_UF": f"icms AND hascfop AND CFOP IN ({_CFOPS}) AND ufd IN ({_STATES}) AND "
    "((ufd = ufe AND substr(CFOP, 1, 1) = '6') OR (ufd <> ufe AND substr(CFOP, 1, 1) = '5'))",
    "CFOP_ICMS_COM_ISS": f"hascfop AND mapped AND GRUPO_CCLASS IN ('10','20','30','40','70') AND CFOP IN ({_SVC})",
    "CFOP_SVA_COM_ICMS": f"hascfop AND mapped AND GRUPO_CCLASS IN ('60','80','130','590') AND CFOP IN ({_COM})",
    "CFOP_933_COM_CST": f"CFOP IN ({_SVC}) AND NOT blank",
    "ITEM_FINANCEIRO_COM_CFOP": "mapped AND GRUPO_CCLASS IN ('100','110') AND hascfop",
    "UF_DEST_INVALIDA": f"{_UF_MISSING} OR ufd NOT IN ({_STATES})",
    "FATURA_SEM_NUMERO": f"FATURA_NUMERO IS NULL OR upper(trim(FATURA_NUMERO)) IN ({quoted(_NAME)})",
    "CFOP_AUSENTE": "icms AND NOT blank AND NOT hascfop",
    "INDSEMCST_COM_CFOP": f"mapped AND NOT icms AND hascfop AND CFOP NOT IN ({_SVC}) AND GRUPO_CCLASS NOT IN ('100','110')",
    "COFATURAMENTO_COM_ICMS": "GRUPO_CCLASS IN ('130','13') AND bi IS NOT NULL AND bi > 0",
    "FAT_CENTRALIZADO_COM_ICMS": "GRUPO_CCLASS IN ('120','12') AND bi IS NOT NULL AND bi > 0",
    "MUNICIPIO_PRESTACAO_AUSENTE": "MUNICIPIO_PRESTACAO IS NULL OR upper(trim(MUNICIPIO_PRESTACAO)) IN "
    f"({quoted((*_NAME, 'NAO INFORMADO'))})",
    "TIPO_FAT_SUBSTITUICAO": "upper(trim(TIPO_FAT)) = 'SUBSTITUIÇÃO'",
    "MUNICIPIO_DEST_AUSENTE": f"NOT {_UF_MISSING} AND (MUNICIPIO_DEST IS NULL OR upper(trim(MUNICIPIO_DEST)) IN ({quoted(_NAME)}))",
    "CCLASS_7D_DIVERGENTE": "mapped AND x7 IS NOT NULL AND xc IS NOT NULL AND x7 <> xc",
}


def flags_sql(tags) -> str:
    return f"{PREPARED_SQL}, flags AS (SELECT *, " + ", ".join(f"({RULE_SQL[t]}) AS {t}" for t in tags) + " FROM prepared)"


def exploded_sql(extra: str) -> str:
    """Finding rows as SQL: one branch per rule, one OK branch per category. `extra`: further columns of the item."""
    parts = []
    for tag, category, severity, text in K.RULE_TEXTS:
        clean = text.replace("'", "''")
        parts.append(
            f"SELECT {extra}, '{category}' AS regra, '{K.STATUS_OF[severity]}' AS status, '{severity}' AS substatus, "
            f"'{tag}: {clean}' AS observacao FROM flags WHERE {tag}"
        )
    for category in (K.TAXES, K.INVOICE):
        none = " AND ".join(f"COALESCE(NOT {t}, TRUE)" for t, c, _, _ in K.RULE_TEXTS if c == category)
        parts.append(
            f"SELECT {extra}, '{category}' AS regra, 'CORRETO' AS status, 'OK' AS substatus, "
            f"'Validacoes aprovadas' AS observacao FROM flags WHERE {none}"
        )
    return flags_sql([t for t, *_ in K.RULE_TEXTS]) + ", findings AS (" + " UNION ALL ".join(parts) + ")"
