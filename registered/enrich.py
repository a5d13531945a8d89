"""Reference-table queries: JSON records, missing keys, registry ingest, postcode directory."""

from __future__ import annotations

from pyspark.sql import functions as F

from billproof.functions.documents import cnpj_valid
from billproof.plans import enrich as E
from billproof.sources import json_records as JR

from . import query
from .address import SOURCE_SQL, _digits, _key, places, registry, rows
from .fixtures import table

# Candidate company numbers, masked for some orders; about one in a hundred has valid check digits.
DOC = (
    "CASE WHEN o_orderkey % 4 = 0 THEN '11111111111111' WHEN o_orderkey % 4 = 1 THEN CAST(o_custkey AS {s}) "
    "WHEN o_orderkey % 4 = 2 THEN lpad(CAST(o_custkey * 7919 + o_orderkey % 50 AS {s}), 14, '0') "
    "ELSE concat('12.', lpad(CAST(o_custkey * 7919 + o_orderkey % 50 AS {s}), 12, '0')) END"
)
_W1 = (5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)
_W2 = (6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)
_DIGIT = lambda i: f"CAST(substr(dg, {i + 1}, 1) AS INT)"
_SUM = lambda ws: " + ".join(f"{_DIGIT(i)} * {w}" for i, w in enumerate(ws))
_CHECK = lambda ws: f"CASE WHEN ({_SUM(ws)}) % 11 < 2 THEN 0 ELSE 11 - ({_SUM(ws)}) % 11 END"
DOCS_SQL = f"""docs AS (SELECT *, {_digits('doc')} AS dg FROM (SELECT o_orderkey, o_custkey, {DOC.format(s='VARCHAR')} AS doc FROM orders) x),
given AS (SELECT *, CASE WHEN length(dg) <> 14 OR dg = repeat(substr(dg, 1, 1), 14) THEN FALSE
  ELSE {_DIGIT(12)} = {_CHECK(_W1)} AND {_DIGIT(13)} = {_CHECK(_W2)} END AS valido FROM docs)"""


def given_docs(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.expr(DOC.format(s="STRING")).alias("doc"))


@query("n3_company_check_digits", f"WITH {DOCS_SQL} SELECT o_orderkey, doc, valido FROM given")
def n3(spark, sf):
    return given_docs(spark, sf).drop("o_custkey").withColumn("valido", cnpj_valid(F.col("doc")))


@query(
    "d19_missing_documents",
    f"""WITH {DOCS_SQL}, done AS (SELECT DISTINCT {_digits('doc')} AS k FROM given WHERE o_orderkey % 8 = 0)
SELECT DISTINCT {_digits('doc')} AS cnpj FROM given WHERE valido AND {_digits('doc')} NOT IN (SELECT k FROM done)""",
)
def d19(spark, sf):
    docs = given_docs(spark, sf)
    done = docs.where("o_orderkey % 8 = 0").select(F.regexp_replace("doc", r"\D", "").alias("cnpj"), F.lit("ok").alias("status_consulta"))
    return E.missing_documents(docs.withColumnRenamed("doc", "CPF_CNPJ"), done)


@query(
    "d19_missing_postcodes",
    f"""WITH {SOURCE_SQL}, w AS (SELECT {_key('cep_instalacao')} AS cep FROM rws UNION SELECT {_key('cep_legal')} FROM rws UNION SELECT receita_cep FROM reg WHERE status_consulta = 'ok' AND length(receita_cep) = 8)
SELECT cep FROM w WHERE cep IS NOT NULL AND cep <> '00000000' AND cep NOT IN (SELECT cep FROM p)""",
)
def d19_postcodes(spark, sf):
    return E.missing_postcodes(rows(spark, sf), registry(spark, sf), places(spark, sf))


@query(
    "d40_document_report",
    f"""WITH {DOCS_SQL} SELECT doc AS cnpj_informado, {_digits('doc')} AS cnpj_normalizado, valido AS cnpj_valido,
  CASE WHEN NOT valido THEN 'nao_consultado_cnpj_invalido' WHEN o_custkey % 2 = 0 THEN 'ok' ELSE 'nao_consultado' END AS api_status,
  CASE WHEN valido AND o_custkey % 2 = 0 THEN 'Empresa ' || {_digits('doc')} END AS razao_social FROM given""",
)
def d40(spark, sf):
    docs = given_docs(spark, sf)
    none = F.lit(None).cast("string")
    digits = F.regexp_replace("doc", r"\D", "")
    known = docs.where("o_custkey % 2 = 0").select(
        digits.alias("cnpj"), F.concat(F.lit("Empresa "), digits).alias("razao_social"), F.lit("ok").alias("status_consulta"),
        *[none.alias(n) for n in ("nome_fantasia", "situacao_cadastral", "receita_uf", "receita_municipio")],
    )
    out = E.document_report(docs.withColumnRenamed("doc", "cnpj_informado"), known)
    return out.select("cnpj_informado", "cnpj_normalizado", "cnpj_valido", "api_status", "razao_social")


@query(
    "d40_document_summary",
    f"""WITH {DOCS_SQL} SELECT COUNT(*) AS total_cnpjs, COUNT(CASE WHEN valido THEN 1 END) AS validos, COUNT(CASE WHEN NOT valido THEN 1 END) AS invalidos FROM given""",
)
def d40_summary(spark, sf):
    none = F.lit(None).cast("string")
    registry = given_docs(spark, sf).where("false").select(*[none.alias(n) for n in ("cnpj", "razao_social", "status_consulta", "nome_fantasia", "situacao_cadastral", "receita_uf", "receita_municipio")])
    return E.document_summary(E.document_report(given_docs(spark, sf).withColumnRenamed("doc", "cnpj_informado"), registry))


JSON_ITEM = """concat('{"codServico":"S', CAST(user_id AS STRING), '","aliq":', CAST(CAST(value * 100 AS INT) AS STRING), ',"fimVigencia":""}')"""
DOCUMENT = (
    f"CASE event_id % 6 WHEN 0 THEN concat('[', {JSON_ITEM}, ',', {JSON_ITEM}, ']') WHEN 1 THEN concat('{{\"data\":[', {JSON_ITEM}, ']}}') "
    f"WHEN 2 THEN {JSON_ITEM} WHEN 3 THEN 'nao json' WHEN 4 THEN '[]' ELSE concat('{{\"itens\":[', {JSON_ITEM}, ',{{\"aliquota\":\"x\"}}]}}') END"
)


@query(
    "f8_parse_items",
    """WITH n AS (SELECT event_id, event_id % 6 AS m, 'S' || user_id AS cs, CASE WHEN trunc(value * 100) <> 0 THEN CAST(trunc(value * 100) AS DOUBLE) END AS al FROM events)
SELECT event_id, cs AS codigo_servico, al AS aliquota, 'ok' AS status FROM n WHERE m IN (0, 1, 2, 5) UNION ALL SELECT event_id, cs, al, 'ok' FROM n WHERE m = 0
UNION ALL SELECT event_id, NULL, NULL, CASE m WHEN 3 THEN 'json_invalido' WHEN 4 THEN 'sem_dados' ELSE 'ok' END FROM n WHERE m IN (3, 4, 5)""",
)
def f8(spark, sf):
    documents = table(spark, sf, "events").select("event_id", F.expr(DOCUMENT).alias("json"))
    return JR.parse_rates(documents).select("event_id", "codigo_servico", "aliquota", "status")


@query(
    "f8_event_properties",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events WHERE CAST(json_extract_string(props, '$.k') AS INT) <> 0
UNION ALL SELECT event_id, NULL FROM events WHERE CAST(json_extract_string(props, '$.k') AS INT) = 0""",
)
def f8_props(spark, sf):
    documents = table(spark, sf, "events").select("event_id", F.col("props").alias("json"))
    return JR.parse_items(documents, "json", {"k": ["chave", "k"]}, ["k"]).select("event_id", "k")


SECTION_DOCUMENT = (
    "CASE event_id % 3 WHEN 0 THEN concat('{\"dados\":[{\"nomeContrato\":\"C', CAST(user_id AS STRING), '\",\"aliquotas\":[{\"codigoTrecho\":\"a\",\"aliquota\":\"2.5\"},{\"codigoTrecho\":\"b\"}]}]}') "
    "WHEN 1 THEN concat('{\"dados\":[{\"codigoContrato\":\"D\",\"aliquota\":', CAST(user_id AS STRING), '}]}') ELSE '{\"dados\":[]}' END"
)


@query(
    "f8_section_rates",
    """SELECT event_id, 'C' || user_id AS nome_contrato, 'a' AS codigo_trecho, 2.5::DOUBLE AS aliquota, 'ok' AS status FROM events WHERE event_id % 3 = 0
UNION ALL SELECT event_id, 'C' || user_id, 'b', 0, 'ok' FROM events WHERE event_id % 3 = 0 UNION ALL SELECT event_id, 'D', NULL, CAST(user_id AS DOUBLE), 'ok' FROM events WHERE event_id % 3 = 1
UNION ALL SELECT event_id, NULL, NULL, NULL, 'sem_dados' FROM events WHERE event_id % 3 = 2""",
)
def f8_sections(spark, sf):
    documents = table(spark, sf, "events").select("event_id", F.expr(SECTION_DOCUMENT).alias("json"))
    return JR.parse_section_rates(documents).select("event_id", "nome_contrato", "codigo_trecho", "aliquota", "status")


NESTED_DOCUMENT = (
    "concat('{\"nomeEmpresarial\":\"E', CAST(event_id AS STRING), '\",\"telefones\":[{\"ddd\":\"51\",\"numero\":\"', CAST(user_id AS STRING), '\"}],\"capitalSocial\":\"10,5\",\"enderecos\":[{\"tipo\":\"X\",\"cep\":\"1\",\"uf\":\"RS\"}', "
    "CASE WHEN event_id % 2 = 0 THEN ',{\"tipo\":\"ESTABELECIMENTO\",\"cep\":\"9.000-000\",\"uf\":\"SP\"}' ELSE '' END, ']}')"
)


@query(
    "f9_nested_pick",
    """SELECT lpad(CAST(event_id AS VARCHAR), 14, '0') AS cnpj, CASE WHEN event_id % 5 = 0 THEN 'erro_http_404' ELSE 'ok' END AS status_consulta,
  CASE WHEN event_id % 5 <> 0 THEN 'E' || event_id END AS razao_social, CASE WHEN event_id % 5 <> 0 THEN '51' || user_id END AS telefone,
  CASE WHEN event_id % 5 <> 0 THEN 10.5::DOUBLE END AS capital_social, CASE WHEN event_id % 5 <> 0 AND event_id % 2 = 0 THEN '09000000' END AS receita_cep,
  CASE WHEN event_id % 5 <> 0 THEN CASE WHEN event_id % 2 = 0 THEN 'SP' ELSE 'RS' END END AS receita_uf FROM events""",
)
def f9(spark, sf):
    raw = table(spark, sf, "events").select(
        F.lpad(F.col("event_id").cast("string"), 14, "0").alias("cnpj"),
        F.when(F.col("event_id") % 5 == 0, 404).otherwise(200).alias("http_status"),
        F.expr(NESTED_DOCUMENT).alias("json"),
        F.lit("2026-07-01").alias("data_consulta"),
    )
    out = JR.normalise_registry(raw, "nested")
    return out.select("cnpj", "status_consulta", "razao_social", "telefone", "capital_social", "receita_cep", "receita_uf")


@query(
    "d20_first_provider_wins",
    """SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS cep, CASE WHEN c_custkey % 3 = 0 THEN 'ViaCEP' WHEN c_custkey % 3 = 1 THEN 'BrasilAPI' END AS fonte,
  CASE WHEN c_custkey % 3 <= 1 THEN c_name END AS cidade, CASE WHEN c_custkey % 3 <= 1 THEN 'ok' ELSE 'nao_encontrado' END AS status_consulta FROM customer""",
)
def d20(spark, sf):
    c = F.col
    base = table(spark, sf, "customer").select(F.lpad(c("c_custkey").cast("string"), 8, "0").alias("cep"), "c_custkey", "c_name")
    via = base.select(
        "cep", F.lit("ViaCEP").alias("provider"), F.lit(200).alias("http_status"),
        F.when(c("c_custkey") % 3 == 0, F.concat(F.lit('{"localidade":"'), c("c_name"), F.lit('"}'))).otherwise('{"erro": true}').alias("json"), F.lit("t").alias("data_consulta"),
    )
    other = base.select(
        "cep", F.lit("BrasilAPI").alias("provider"), F.when(c("c_custkey") % 3 == 2, 404).otherwise(200).alias("http_status"),
        F.concat(F.lit('{"cep":"1","city":"'), c("c_name"), F.lit('"}')).alias("json"), F.lit("t").alias("data_consulta"),
    )
    return JR.normalise_postcodes(via.unionByName(other)).select("cep", "fonte", "cidade", "status_consulta")


@query(
    "d21_ingest_registry",
    """SELECT cnpj, razao_social, opcao_simples, capital_social, cnae_principal_codigo FROM (
  SELECT lpad(CAST(c_custkey AS VARCHAR), 14, '0') AS cnpj, 'velho' AS razao_social, NULL::BOOLEAN AS opcao_simples, NULL::DOUBLE AS capital_social, NULL::BIGINT AS cnae_principal_codigo FROM customer WHERE c_custkey % 4 = 0
  UNION ALL SELECT lpad(CAST(c_custkey AS VARCHAR), 14, '0'), c_name, CASE c_custkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END, c_acctbal, c_custkey FROM customer
    WHERE c_custkey % 4 <> 0 AND c_custkey IN (SELECT o_custkey FROM orders)) t""",
)
def d21(spark, sf):
    c = F.col
    customer = table(spark, sf, "customer")
    dump = customer.select(
        F.concat(F.lit("."), c("c_custkey")).alias("CNPJ"),
        c("c_name").alias("RAZAO_SOCIAL"),
        F.expr("CASE c_custkey % 3 WHEN 0 THEN ' sim' WHEN 1 THEN 'N' ELSE '?' END").alias("OPCAO_SIMPLES"),
        c("c_acctbal").cast("string").alias("CAPITAL_SOCIAL"),
        F.concat(F.lit("a-"), c("c_custkey")).alias("CNAE_FISCAL"),
    )
    base = table(spark, sf, "orders").select(c("o_custkey").cast("string").alias("CPF_CNPJ"))
    cache = E.registry_from_dump(customer.where("c_custkey % 4 = 0").select(c("c_custkey").cast("string").alias("CNPJ"), F.lit("velho").alias("RAZAO_SOCIAL")))
    out = E.ingest_registry(dump, base, cache)
    return out.select("cnpj", "razao_social", "opcao_simples", "capital_social", "cnae_principal_codigo")


@query(
    "j16_postcode_directory",
    """WITH s AS (SELECT lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS cep, 1 AS pr, 'Rua ' || p_name AS logradouro, COALESCE(p_brand, '') AS bairro, n_name AS cidade FROM part JOIN nation ON n_nationkey = p_partkey % 25),
g AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS cep, 2, c_name, '', n_name FROM customer JOIN nation ON n_nationkey = c_nationkey),
b AS (SELECT lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS cep, 3, s_name, '', n_name FROM supplier JOIN nation ON n_nationkey = s_nationkey),
u AS (SELECT * FROM s UNION ALL SELECT * FROM g UNION ALL SELECT * FROM b), r AS (SELECT *, row_number() OVER (PARTITION BY cep ORDER BY pr DESC) AS rn FROM u)
SELECT cep, logradouro, bairro, cidade FROM r WHERE rn = 1""",
)
def j16(spark, sf):
    c = F.col
    text = lambda e: F.expr(e).cast("string")
    none = F.lit(None).cast("string")
    part = table(spark, sf, "part")
    street = part.select(
        text("p_partkey % 25").alias("LOC_NU"), text("p_partkey").alias("BAI_NU_INI"), F.lit("SP").alias("UFE_SG"), F.lit(" Rua ").alias("TLO_TX"),
        c("p_name").alias("LOG_NO"), none.alias("LOG_COMPLEMENTO"), F.lpad(text("p_partkey"), 8, "0").alias("CEP"),
    )
    locality = table(spark, sf, "nation").select(text("n_nationkey").alias("LOC_NU"), c("n_name").alias("LOC_NO"))
    district = part.select(text("p_partkey").alias("BAI_NU"), c("p_brand").alias("BAI_NO"))
    big = table(spark, sf, "customer").select(
        text("c_nationkey").alias("LOC_NU"), none.alias("BAI_NU"), F.lit("SP").alias("UFE_SG"), c("c_name").alias("GRU_ENDERECO"), c("c_name").alias("GRU_NO"), F.lpad(text("c_custkey"), 8, "0").alias("CEP")
    )
    box = table(spark, sf, "supplier").select(
        text("s_nationkey").alias("LOC_NU"), F.lit("SP").alias("UFE_SG"), c("s_name").alias("CPC_ENDERECO"), c("s_name").alias("CPC_NO"), F.lpad(text("s_suppkey"), 8, "0").alias("CEP")
    )
    return E.build_postcode_dim(street, locality, district, big, box).select("cep", "logradouro", "bairro", "cidade")
