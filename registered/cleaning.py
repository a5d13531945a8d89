"""Cleaning, conversion and scalar-function queries over whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from billproof.functions import columns as C
from billproof.functions import dates as DT
from billproof.functions import numbers as N
from billproof.functions import text as T
from billproof.operators import windows as W

from . import query
from .fixtures import table

ACCENTS = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"
BASES = "AAAAAACEEEEIIIINOOOOOUUUUY"


def _norm(c):
    return (
        f"trim(regexp_replace(regexp_replace(translate(upper(replace({c}, 'ß', 'ss')), '{ACCENTS}', '{BASES}'), '[^A-Z0-9 ]', ' ', 'g'), ' +', ' ', 'g'))"
    )


@query("n1_normalise_text", f"SELECT doc_id, {_norm('text')} AS texto FROM documents")
def n1(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.norm_text(F.col("text")).alias("texto"))


_STREET = "CASE p_partkey % 5 WHEN 0 THEN 'Rua ' WHEN 1 THEN 'Av. ' WHEN 2 THEN 'PRAÇA  ' WHEN 3 THEN 'Ruas ' ELSE '' END"


@query(
    "n2_normalise_street",
    f"SELECT p_partkey, trim(regexp_replace({_norm(_STREET + ' || p_name')}, '^(' || '{'|'.join(T.STREET_TYPES)}' || ')\\b\\s*', '')) AS rua FROM part",
)
def n2(spark, sf):
    street = F.concat(F.expr(_STREET), F.col("p_name"))
    return table(spark, sf, "part").select("p_partkey", T.norm_street(street).alias("rua"))


@query(
    "p3_typed_casts",
    """SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS valor, CAST(CAST(l_tax AS DECIMAL(8,4)) AS DOUBLE) AS aliquota,
  upper(trim(' ' || l_returnflag || l_linestatus || ' ')) AS texto, TRY_CAST(l_returnflag AS INT) AS inteiro FROM lineitem""",
)
def p3(spark, sf):
    c = F.col
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        N.money(c("l_extendedprice")).cast("double").alias("valor"),
        N.rate(c("l_tax")).cast("double").alias("aliquota"),
        T.trimmed_upper(F.concat(F.lit(" "), "l_returnflag", "l_linestatus", F.lit(" "))).alias("texto"),
        c("l_returnflag").try_cast("int").alias("inteiro"),
    )


_DIRTY = "CASE o_orderkey % 8 WHEN 0 THEN 'nan' WHEN 1 THEN ' - ' WHEN 2 THEN 'None' WHEN 3 THEN '' WHEN 4 THEN NULL WHEN 5 THEN ' x ' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS {s}) END"


@query(
    "p4_null_tokens",
    f"""WITH d AS (SELECT o_orderkey, {_DIRTY.format(s='VARCHAR')} AS t FROM orders) SELECT o_orderkey,
  CASE WHEN t IS NULL OR upper(trim(t)) IN ('', 'NULL', 'NAN', 'NONE', '-') THEN NULL ELSE trim(t) END AS texto,
  CASE WHEN trim(t) IN ('', 'null', 'nan', 'None', 'NaN', 'NULL', 'none') THEN NULL ELSE TRY_CAST(trim(t) AS DOUBLE) END AS numero FROM d""",
)
def p4(spark, sf):
    dirty = F.expr(_DIRTY.format(s="STRING"))
    return table(spark, sf, "orders").select("o_orderkey", T.norm_str(dirty).alias("texto"), N.norm_dbl(dirty).alias("numero"))


@query("p5_blank_to_null", "SELECT o_orderkey, NULLIF(CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderpriority END, '') AS prioridade, o_custkey FROM orders")
def p5(spark, sf):
    blanked = F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.col("o_orderpriority"))
    return T.blank_to_null(table(spark, sf, "orders").select("o_orderkey", blanked.alias("prioridade"), "o_custkey"))


_DATE = "CASE o_orderkey % 4 WHEN 0 THEN {br} WHEN 1 THEN {iso} WHEN 2 THEN {ts} ELSE 'lixo' END"
_SPARK_DATE = _DATE.format(br="date_format(o_orderdate, 'dd/MM/yyyy')", iso="date_format(o_orderdate, 'yyyy-MM-dd')", ts="date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')")


@query("p6_tolerant_dates", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS dia FROM orders")
def p6(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", DT.to_date_safe(F.expr(_SPARK_DATE)).cast("string").alias("dia"))


@query(
    "p7_cycles",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS br, strftime(o_orderdate, '%Y%m') AS ts, strftime(o_orderdate, '%Y%m') AS inteiro, strftime(o_orderdate, '%Y%m') AS iso FROM orders",
)
def p7(spark, sf):
    d = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        DT.cycle_of(F.date_format(d, "dd/MM/yyyy"), "br").alias("br"),
        DT.cycle_of(d, "ts").alias("ts"),
        DT.cycle_of(F.date_format(d, "yyyyMMdd").cast("int"), "int").alias("inteiro"),
        DT.cycle_of(F.date_format(d, "yyyy-MM-dd"), "iso").alias("iso"),
    )


@query("s23_cycle_spellings", "SELECT strftime(o_orderdate, '%Y%m') AS ciclo, COUNT(*) AS n FROM orders GROUP BY 1")
def s23(spark, sf):
    return table(spark, sf, "orders").groupBy(DT.norm_cycle_col(F.date_format("o_orderdate", " yyyy-MM")).alias("ciclo")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "p10_code_cleaning",
    """SELECT p_partkey, regexp_replace(lpad(CAST(p_size AS VARCHAR), 4, '0'), '^0+([0-9])', '\\1') AS sem_zeros, CAST(p_size AS VARCHAR) AS sem_sufixo,
  regexp_replace(p_brand, '\\D', '', 'g') AS digitos, lpad(regexp_replace(p_brand, '\\D', '', 'g'), 8, '0') AS preenchido FROM part""",
)
def p10(spark, sf):
    c = F.col
    size = c("p_size").cast("string")
    return table(spark, sf, "part").select(
        "p_partkey",
        T.strip_leading_zeros(F.lpad(size, 4, "0")).alias("sem_zeros"),
        T.strip_decimal_suffix(F.concat(size, F.lit(".0"))).alias("sem_sufixo"),
        T.digits_only(c("p_brand")).alias("digitos"),
        T.pad_left(T.digits_only(c("p_brand")), 8).alias("preenchido"),
    )


@query("p11_clean_city", "SELECT n_nationkey, n_name AS cidade FROM nation")
def p11(spark, sf):
    return table(spark, sf, "nation").select("n_nationkey", T.clean_city(F.concat("n_name", F.lit("  - AN"))).alias("cidade"))


@query("p13_optional_columns", "SELECT c_custkey, c_mktsegment AS segmento, 'NAO IDENTIFICADO' AS produto FROM customer")
def p13(spark, sf):
    customer = table(spark, sf, "customer")
    return customer.select("c_custkey", C.col_or(customer, "c_mktsegment").alias("segmento"), C.col_or(customer, "Produto", "NAO IDENTIFICADO").alias("produto"))


@query("p14_prefixed_lookup", "SELECT n_nationkey AS r_n_nationkey, n_name AS r_n_name, n_regionkey AS r_n_regionkey FROM nation")
def p14(spark, sf):
    from billproof.operators.joins import prefixed

    return prefixed(table(spark, sf, "nation"), "r_")


@query("p16_ordered_projection", "SELECT c_name AS nome, CAST(c_custkey AS VARCHAR) AS id FROM customer")
def p16(spark, sf):
    mapping = {"id": F.col("c_custkey").cast("string"), "nome": F.col("c_name")}
    return C.project(table(spark, sf, "customer"), mapping, ["id", "nome"])


@query("p19_snake_case_names", "SELECT c_custkey AS cust_key, c_name AS nome_do_cliente FROM customer")
def p19(spark, sf):
    return C.normalize_columns(table(spark, sf, "customer").select(F.col("c_custkey").alias(" Cust-Key "), F.col("c_name").alias("Nome  do_Cliente!")))


@query(
    "f1_text_functions",
    """SELECT c_custkey, upper(trim(c_name)) AS maiusculo, concat_ws('-', c_name, c_mktsegment) AS junto, substr(c_name, 1, 5) AS parte, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS codigo,
  length(c_name) AS tamanho, split_part(c_name, '#', 2) AS depois, COALESCE(NULLIF(c_mktsegment, 'BUILDING'), 'outro') AS segmento FROM customer""",
)
def f1(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        T.trimmed_upper(F.col("c_name")).alias("maiusculo"),
        F.concat_ws("-", "c_name", "c_mktsegment").alias("junto"),
        F.substring("c_name", 1, 5).alias("parte"),
        T.pad_left(F.col("c_custkey").cast("string"), 8).alias("codigo"),
        F.length("c_name").alias("tamanho"),
        F.split("c_name", "#").getItem(1).alias("depois"),
        F.coalesce(F.nullif("c_mktsegment", F.lit("BUILDING")), F.lit("outro")).alias("segmento"),
    )


@query(
    "f2_pattern_functions",
    """SELECT doc_id, regexp_matches(text, '[0-9]{3}') AS tem_numero, starts_with(source, 's') AS comeca, contains(text, 'the') AS contem, length(regexp_replace(text, '[^a-z]', '', 'g')) AS minusculas FROM documents""",
)
def f2(spark, sf):
    c = F.col
    return table(spark, sf, "documents").select(
        "doc_id",
        c("text").rlike("[0-9]{3}").alias("tem_numero"),
        c("source").startswith("s").alias("comeca"),
        c("text").contains("the").alias("contem"),
        F.length(F.regexp_replace("text", "[^a-z]", "")).alias("minusculas"),
    )


@query("f3_try_casts", "SELECT event_id, TRY_CAST(event_type AS DOUBLE) AS numero, CAST(TRY_CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS valor, TRY_CAST('2024-01-0' || (event_id % 12) AS DATE) IS NOT NULL AS data_valida FROM events")
def f3(spark, sf):
    c = F.col
    return table(spark, sf, "events").select(
        "event_id",
        c("event_type").try_cast("double").alias("numero"),
        N.money(c("value")).cast("double").alias("valor"),
        F.concat(F.lit("2024-01-0"), c("event_id") % 12).try_cast("date").isNotNull().alias("data_valida"),
    )


@query(
    "f4_date_functions",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS periodo, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS dia, date_diff('month', date_trunc('month', o_orderdate), TIMESTAMP '2001-12-01') AS meses FROM orders",
)
def f4(spark, sf):
    period = DT.period_of(F.col("o_orderdate"))
    return table(spark, sf, "orders").select(
        "o_orderkey", period.alias("periodo"), F.col("o_orderdate").cast("date").cast("string").alias("dia"), DT.month_gap(F.lit("2001-12"), period).alias("meses")
    )


@query(
    "f6_guarded_arithmetic",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_tax > 0 THEN l_extendedprice / l_tax END AS razao, CASE WHEN l_discount > 0 THEN (l_tax - l_discount) / l_discount * 100.0::DOUBLE END AS variacao,
  abs(l_tax - l_discount) AS distancia FROM lineitem""",
)
def f6(spark, sf):
    c = F.col
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        N.guarded_ratio(c("l_extendedprice"), c("l_tax")).alias("razao"),
        N.pct_change(c("l_tax"), c("l_discount")).alias("variacao"),
        F.abs(c("l_tax") - c("l_discount")).alias("distancia"),
    )


@query("f7_arrays", "SELECT o_orderkey, unnest(string_split(o_orderpriority, '-')) AS parte FROM orders")
def f7(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.explode(F.split("o_orderpriority", "-")).alias("parte"))


_FLAG = "CASE o_orderkey % 6 WHEN 0 THEN ' sim' WHEN 1 THEN 'N' WHEN 2 THEN '1' WHEN 3 THEN 'falso' WHEN 4 THEN '?' END"


@query(
    "f10_parse_booleans",
    "SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN TRUE WHEN 2 THEN TRUE WHEN 1 THEN FALSE WHEN 3 THEN FALSE END AS tri, CASE o_orderkey % 6 WHEN 0 THEN TRUE WHEN 2 THEN TRUE WHEN 5 THEN NULL ELSE FALSE END AS bi FROM orders",
)
def f10(spark, sf):
    flag = F.expr(_FLAG)
    return table(spark, sf, "orders").select("o_orderkey", T.parse_bool(flag).alias("tri"), T.parse_bool(flag, "false").alias("bi"))


@query(
    "f11_currency_text",
    "SELECT o_orderkey, 'R$ ' || translate(format('{:,.2f}', CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE)), ',.', '.,') AS valor FROM orders",
)
def f11(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", N.fmt_brl(N.money(F.col("o_totalprice"))).alias("valor"))


@query(
    "f12_month_gap",
    "SELECT l_orderkey, l_linenumber, (year(l_shipdate) - year(o_orderdate)) * 12 + month(l_shipdate) - month(o_orderdate) AS meses FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
)
def f12(spark, sf):
    joined = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    gap = DT.month_gap(DT.period_of(F.col("l_shipdate")), DT.period_of(F.col("o_orderdate")))
    return joined.select("l_orderkey", "l_linenumber", gap.alias("meses"))


@query("w6_surrogate_id", "SELECT o_orderkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) + 1 AS id FROM orders")
def w6(spark, sf):
    return W.surrogate(table(spark, sf, "orders").select("o_custkey", "o_orderkey"), ["o_custkey", "o_orderkey"], "id", start=2).select("o_orderkey", "id")


@query("k4_preview", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def k4(spark, sf):
    return W.top_n(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), [F.col("o_orderkey")], 5)
