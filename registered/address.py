"""Address, document and registration queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from billproof.functions.names import name_similarity
from billproof.functions.text import norm_text
from billproof.operators import aggregates as A
from billproof.plans import address as P
from billproof.plans import rule_catalogue as K
from billproof import schemas

from . import query
from .fixtures import LOT, table
from .item_fixture import _sql_choice

UF = _sql_choice([*K.STATES[:25]], "CAST(n_nationkey AS INT)")
CITY = "CASE WHEN o_orderkey % 5 = 0 THEN 'Outra - AN' WHEN o_orderkey % 5 = 1 THEN '' ELSE concat(lower(n_name), ' - AN') END"
ROWS = {
    "FATURA": "o_orderkey",
    "NUMERO_FATURA": "concat('N', CAST(o_orderkey AS {s}))",
    "ID_CLIENTE_CONTRATO": "CAST(o_custkey AS {s})",
    "SEGMENTO": "c_mktsegment",
    "cidade_instalacao": CITY,
    "bairro_instalacao": "CAST(NULL AS {s})",
    "cep_instalacao": "CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN lpad(CAST(n_nationkey * 1000 AS {s}), 8, '0') "
    "ELSE concat(lpad(CAST(n_nationkey AS {s}), 5, '0'), '-', lpad(CAST(o_custkey % 8 AS {s}), 3, '0')) END",
    "uf_instalacao": f"CASE WHEN o_orderkey % 7 = 0 THEN 'ZZ' WHEN o_orderkey % 7 = 1 THEN NULL ELSE {UF} END",
    "cidade_legal": f"CASE WHEN o_orderkey % 11 = 0 THEN 'Terceira' ELSE {CITY} END",
    "bairro_legal": "CAST(NULL AS {s})",
    "cep_legal": "CASE WHEN o_orderkey % 4 = 0 THEN lpad(CAST(n_nationkey * 1000 AS {s}), 8, '0') ELSE lpad(CAST(n_nationkey * 1000 + o_custkey % 8 AS {s}), 8, '0') END",
    "uf_legal": UF,
    "CPF_CNPJ": "CASE o_custkey % 8 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN '123' WHEN 3 THEN lpad(CAST(o_custkey AS {s}), 11, '0') "
    "WHEN 4 THEN lpad(CAST(o_custkey AS {s}), 11, '0') ELSE concat(substr(lpad(CAST(o_custkey AS {s}), 14, '0'), 1, 12), '-', substr(lpad(CAST(o_custkey AS {s}), 14, '0'), 13, 2)) END",
    "NOME_CLIENTE": "c_name",
    "INSCRICAO_ESTADUAL": "''",
    "PRODUTO": "o_orderpriority",
    "TIPO_SERVICO": "''",
    "DESCRICAO_SERVICO": "''",
    "TIPO_IMPOSTO": "''",
    "PROMOCAO": "''",
    "GRUPO_LOCALIDADE": "''",
    "ID_LOTE": f"'{LOT}'",
    "CRM": "CASE WHEN o_orderstatus = 'F' THEN 'SIMETRA' ELSE 'NG' END",
}
REGISTRY = {
    "cnpj": "lpad(CAST(c_custkey AS {s}), 14, '0')",
    "razao_social": "CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN replace(c_name, 'Customer', 'Cust') ELSE 'Outra Empresa Ltda' END",
    "situacao_cadastral": "CASE WHEN c_custkey % 5 = 0 THEN 'Baixada' WHEN c_custkey % 5 = 1 THEN NULL ELSE 'Ativa' END",
    "receita_cep": "CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE lpad(CAST(n_nationkey * 1000 + c_custkey % 8 AS {s}), 8, '0') END",
    "receita_logradouro": "CASE WHEN c_custkey % 2 = 0 THEN 'das Flores' END",
    "receita_municipio": "n_name",
    "receita_uf": UF,
    "status_consulta": "CASE WHEN c_custkey % 10 = 5 THEN 'timeout' ELSE 'ok' END",
}
PLACES = {
    "cep": "lpad(CAST(n_nationkey * 1000 + i AS {s}), 8, '0')",
    "logradouro": "CASE WHEN i % 2 = 0 THEN 'Rua das Flores' ELSE 'Av. Central' END",
    "bairro": "'Centro'",
    "cidade": "n_name",
    "uf": UF,
    "fonte": "'teste'",
    "status_consulta": "CASE WHEN i = 5 THEN 'nao_encontrado' ELSE 'ok' END",
}


def _select(columns, s):
    return ", ".join(f"{e.format(s=s)} AS {n}" for n, e in columns.items())


def rows(spark, sf):
    base = (
        table(spark, sf, "orders")
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return base.select(*[F.expr(e.format(s="STRING")).alias(n) for n, e in ROWS.items()])


def registry(spark, sf):
    base = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return base.select(*[F.expr(e.format(s="STRING")).alias(n) for n, e in REGISTRY.items()])


def places(spark, sf):
    base = table(spark, sf, "nation").select("*", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("i"))
    return base.select(*[F.expr(e.format(s="STRING")).alias(n) for n, e in PLACES.items()])


def enriched(spark, sf):
    return P.enrich(rows(spark, sf), registry(spark, sf), places(spark, sf))


def _norm(c):
    return f"COALESCE(trim(regexp_replace(regexp_replace(upper(trim({c})), '[^A-Z0-9 ]', ' ', 'g'), '\\s+', ' ', 'g')), '')"


def _clean(c):
    return f"trim(regexp_replace({c}, '\\s*-\\s*\\w+$', ''))"


def _digits(c):
    return f"regexp_replace({c}, '\\D', '', 'g')"


def _key(c):
    return f"lpad({_digits(c)}, 8, '0')"


def _diff(a, b):
    return f"({a} <> '' AND {b} <> '' AND {a} <> {b})"


SOURCE_SQL = f"""rws AS (SELECT {_select(ROWS, 'VARCHAR')} FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
reg AS (SELECT {_select(REGISTRY, 'VARCHAR')} FROM customer JOIN nation ON c_nationkey = n_nationkey),
plc AS (SELECT {_select(PLACES, 'VARCHAR')} FROM nation, (SELECT unnest(range(0, 7)) AS i) r),
r AS (SELECT cnpj, razao_social, situacao_cadastral, receita_cep, receita_logradouro, receita_municipio, receita_uf, {_norm('razao_social')} AS nn, {_norm('receita_municipio')} AS nc,
  {_norm('receita_uf')} AS nu FROM reg WHERE status_consulta = 'ok'),
p AS (SELECT *, {_norm('cidade')} AS nc, {_norm('uf')} AS nu FROM plc WHERE status_consulta = 'ok')"""

ENRICHED_SQL = f"""{SOURCE_SQL},
e0 AS (SELECT *, {_digits('CPF_CNPJ')} AS doc, CASE WHEN CPF_CNPJ IS NULL OR trim(CPF_CNPJ) = '' THEN 'NULO' WHEN length({_digits('CPF_CNPJ')}) = 14 THEN 'CNPJ'
    WHEN length({_digits('CPF_CNPJ')}) = 11 THEN 'CPF' ELSE 'INVALIDO' END AS tipo,
  {_key('cep_instalacao')} AS kci, {_key('cep_legal')} AS kcl, {_clean('cidade_instalacao')} AS cci, {_clean('cidade_legal')} AS ccl,
  {_norm('NOME_CLIENTE')} AS nnome, {_norm('uf_instalacao')} AS nui, {_norm('uf_legal')} AS nul FROM rws),
e1 AS (SELECT *, {_norm('cci')} AS nci, {_norm('ccl')} AS ncl FROM e0),
e2 AS (SELECT e1.*, r.cnpj AS r_cnpj, r.razao_social AS r_razao, r.situacao_cadastral AS r_sit, r.receita_cep AS r_cep, r.receita_municipio AS r_mun, r.receita_uf AS r_uf,
    COALESCE(r.nn, '') AS r_nn, COALESCE(r.nc, '') AS r_nc, COALESCE(r.nu, '') AS r_nu,
    a.cep AS a_cep, a.cidade AS a_cidade, a.uf AS a_uf, a.logradouro AS a_log, COALESCE(a.nc, '') AS a_nc, COALESCE(a.nu, '') AS a_nu,
    b.cep AS b_cep, b.cidade AS b_cidade, b.uf AS b_uf, b.logradouro AS b_log, COALESCE(b.nc, '') AS b_nc, COALESCE(b.nu, '') AS b_nu
  FROM e1 LEFT JOIN r ON r.cnpj = CASE WHEN tipo = 'CNPJ' THEN doc END LEFT JOIN p a ON a.cep = kci LEFT JOIN p b ON b.cep = kcl),
e3 AS (SELECT *, {_diff('nci', 'a_nc')} AS dci, {_diff('nui', 'a_nu')} AS dui, {_diff('ncl', 'b_nc')} AS dcl, {_diff('nul', 'b_nu')} AS dul,
    kci LIKE '%000' AS gi, kcl LIKE '%000' AS gl FROM e2)"""


def _note(g, dc, du, k, city, uf, p):
    return f"""CASE WHEN {p}_cep IS NULL THEN '[CEP] CEP não encontrado no cache: ' || {k}
    WHEN {g} AND ({dc} OR {du}) THEN 'CEP genérico — cidade/estado divergente: base ''' || {city} || '/' || {uf} || ''' x CEP ''' || COALESCE({p}_cidade, '') || '/' || COALESCE({p}_uf, '') || ''''
    WHEN {g} THEN 'CEP genérico — município confirmado: ' || COALESCE({p}_cidade, '') || '/' || COALESCE({p}_uf, '')
    ELSE concat_ws(' | ', CASE WHEN {dc} THEN 'Cidade divergente: base ''' || {city} || ''' x CEP ''' || COALESCE({p}_cidade, '') || '''' END,
      CASE WHEN {du} THEN 'UF divergente: base ''' || {uf} || ''' x CEP ''' || COALESCE({p}_uf, '') || '''' END) END"""


def _nothing(text):
    return f"NULLIF({text}, '')"


CHECKED_SQL = f"""{ENRICHED_SQL},
k1 AS (SELECT *, {_note('gi', 'dci', 'dui', 'kci', 'cci', 'uf_instalacao', 'a')} AS obs_i, {_note('gl', 'dcl', 'dul', 'kcl', 'ccl', 'uf_legal', 'b')} AS obs_l0 FROM e3),
k2 AS (SELECT *, CASE WHEN tipo = 'CNPJ' THEN concat_ws(' | ', NULLIF(obs_l0, ''), CASE WHEN r_cnpj IS NULL THEN '[CACHE] CNPJ não encontrado em tab_dados_receita' END,
    CASE WHEN r_cnpj IS NOT NULL AND {_diff("COALESCE(kcl, '')", "COALESCE(r_cep, '')")} THEN 'CEP divergente: base ''' || kcl || ''' x Receita ''' || r_cep || '''' END,
    CASE WHEN r_cnpj IS NOT NULL AND {_diff('ncl', 'r_nc')} THEN 'Cidade divergente: base ''' || ccl || ''' x Receita ''' || COALESCE(r_mun, '') || '''' END,
    CASE WHEN r_cnpj IS NOT NULL AND {_diff('nul', 'r_nu')} THEN 'UF divergente: base ''' || uf_legal || ''' x Receita ''' || COALESCE(r_uf, '') || '''' END) ELSE obs_l0 END AS obs_l,
  concat_ws(' | ', CASE WHEN r_cnpj IS NULL THEN '[CACHE] CNPJ não encontrado em tab_dados_receita. Execute a célula de populate.' END,
    CASE WHEN r_cnpj IS NOT NULL AND upper(r_sit) <> 'ATIVA' THEN 'Situação: ' || r_sit END,
    CASE WHEN r_cnpj IS NOT NULL AND {_diff('r_nn', 'nnome')} THEN 'Razão social divergente: base ''' || COALESCE(NOME_CLIENTE, '') || ''' x Receita ''' || COALESCE(r_razao, '') || '''' END) AS obs_c FROM k1),
ck AS (SELECT *, CASE WHEN gi AND (dci OR dui) THEN 'CepGenericoDiverge' WHEN gi THEN 'CepGenericoOk' WHEN obs_i IS NULL OR obs_i = '' THEN 'Confere' ELSE 'Divergente' END AS st_i,
  CASE WHEN gl AND (dcl OR dul) THEN 'CepGenericoDiverge' WHEN gl AND (obs_l IS NULL OR obs_l LIKE '%confirmado%') THEN 'CepGenericoOk'
    WHEN obs_l IS NULL OR obs_l = '' THEN 'Confere' ELSE 'Divergente' END AS st_l,
  CASE WHEN r_cnpj IS NULL AND tipo = 'CNPJ' THEN 'nao_carregado' WHEN obs_c = '' THEN 'Confere' ELSE 'Divergente' END AS st_c FROM k2)"""


def checked(spark, sf):
    return P.check_all(enriched(spark, sf))


@query("n5_document_type", f"WITH {ENRICHED_SQL} SELECT FATURA, tipo, doc FROM e3")
def n5(spark, sf):
    return enriched(spark, sf).select("FATURA", F.col("x_type").alias("tipo"), F.col("x_doc").alias("doc"))


@query("n8_generic_postcode", f"WITH {ENRICHED_SQL} SELECT FATURA, kcl AS cep, gl AS generico FROM e3")
def n8(spark, sf):
    from billproof.functions.documents import is_generic_cep

    cep = F.col("x_cep_cl")
    return enriched(spark, sf).select("FATURA", cep.alias("cep"), is_generic_cep(cep).alias("generico"))


@query("d11_check_installation", f"WITH {CHECKED_SQL} SELECT FATURA, obs_i AS obs, st_i AS estado FROM ck")
def d11(spark, sf):
    return P.check_address(enriched(spark, sf), P.INSTALLATION).select("FATURA", F.col("ci_obs").alias("obs"), F.col("ci_state").alias("estado"))


@query("d12_check_legal", f"WITH {CHECKED_SQL} SELECT FATURA, obs_l AS obs, st_l AS estado FROM ck")
def d12(spark, sf):
    return P.check_address(enriched(spark, sf), P.LEGAL).select("FATURA", F.col("cl_obs").alias("obs"), F.col("cl_state").alias("estado"))


@query("d13_check_registration", f"WITH {CHECKED_SQL} SELECT FATURA, obs_c AS obs, st_c AS estado FROM ck")
def d13(spark, sf):
    return P.check_registration(enriched(spark, sf)).select("FATURA", F.col("cad_obs").alias("obs"), F.col("cad_state").alias("estado"))


# The registered names of the fixture are equal, abbreviated by a prefix, or entirely different.
@query(
    "d14_check_registration_similarity",
    f"""WITH {ENRICHED_SQL}, s AS (SELECT *, CASE WHEN r_cnpj IS NOT NULL THEN CASE WHEN r_nn = nnome THEN 1 WHEN r_razao LIKE 'Cust%' THEN 1 ELSE 0 END END::DOUBLE AS cad_sim FROM e3),
t AS (SELECT *, CASE WHEN r_cnpj IS NULL AND tipo = 'CNPJ' THEN 'nao_carregado' WHEN cad_sim IS NULL THEN 'sem_dado' WHEN r_nn = nnome THEN 'Exato' WHEN cad_sim >= 0.75 THEN 'Alerta' ELSE 'Divergente' END AS estado FROM s)
SELECT FATURA, cad_sim, estado, concat_ws(' | ', CASE WHEN r_cnpj IS NULL THEN '{P.MSG_REGISTRY_POPULATE}' END, CASE WHEN upper(r_sit) <> 'ATIVA' THEN 'Situação: ' || r_sit END,
  CASE WHEN estado IN ('Alerta', 'Divergente') THEN CASE estado WHEN 'Alerta' THEN 'Razão social similar (100' ELSE 'Razão social divergente (0' END || '% palavras iguais): base '''
    || NOME_CLIENTE || ''' x Receita ''' || r_razao || '''' END) AS obs FROM t""",
)
def d14(spark, sf):
    out = P.check_registration_sim(enriched(spark, sf))
    return out.select("FATURA", "cad_sim", F.col("cad_obs").alias("obs"), F.col("cad_state").alias("estado"))


# Every word of the name is found again in "brand number name", which has two words more.
@query(
    "n6_name_similarity",
    "SELECT p_partkey, len(string_split(p_name, ' ')) / (len(string_split(p_name, ' ')) + 2)::DOUBLE AS sim FROM part",
)
def n6(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", norm_text(F.col("p_name")).alias("a"), norm_text(F.concat_ws(" ", "p_brand", "p_name")).alias("b"))
    return parts.select("p_partkey", name_similarity(F.col("a"), F.col("b")).alias("sim"))


@query(
    "d10_check_document",
    f"""WITH {ENRICHED_SQL} SELECT FATURA, 'INCORRETO' AS STATUS, 'ERRO' AS SUBSTATUS,
  CASE WHEN tipo = 'NULO' THEN 'CPF/CNPJ não encontrado' ELSE 'DOC(' || CPF_CNPJ || ') - Inválido' END AS OBSERVACAO FROM e3 WHERE tipo IN ('NULO', 'INVALIDO')""",
)
def d10(spark, sf):
    return P.check_document(enriched(spark, sf)).select("FATURA", "STATUS", "SUBSTATUS", "OBSERVACAO")


def _status(c, which):
    pick = 0 if which == "STATUS" else 1
    cases = " ".join(f"WHEN '{s}' THEN '{pair[pick]}'" for s, pair in P.STATUS_V5.items())
    return f"CASE {c} {cases} ELSE '{P.STATUS_DEFAULT[pick]}' END"


@query("d15_status_mapping", f"WITH {CHECKED_SQL} SELECT st_i AS estado, {_status('st_i', 'STATUS')} AS STATUS, {_status('st_i', 'SUBSTATUS')} AS SUBSTATUS, COUNT(*) AS n FROM ck GROUP BY 1, 2, 3")
def d15(spark, sf):
    state = F.col("ci_state")
    status, substatus = P.map_status(state, P.STATUS_V5)
    mapped = P.check_address(enriched(spark, sf), P.INSTALLATION).select(state.alias("estado"), status.alias("STATUS"), substatus.alias("SUBSTATUS"))
    return A.distribution(mapped, ["estado", "STATUS", "SUBSTATUS"])


def _bill(cep, city, uf):
    return (
        f"concat_ws(' | ', 'NOME: ' || COALESCE(NOME_CLIENTE, ''), 'DOC: ' || doc, 'CEP: ' || {cep}, 'CIDADE: ' || COALESCE({city}, ''), 'UF: ' || COALESCE({uf}, ''))"
    )


def _truth(cep, p):
    return f"concat_ws(' | ', 'CEP: ' || {cep}, 'LOGRADOURO: ' || COALESCE({p}_log, ''), 'CIDADE: ' || COALESCE({p}_cidade, ''), 'UF: ' || COALESCE({p}_uf, ''))"


STATUS_SQL = f"""{CHECKED_SQL}, stt AS (
  SELECT FATURA, 'ENDERECO_INSTALACAO' AS REGRA, {_status('st_i', 'STATUS')} AS STATUS, {_status('st_i', 'SUBSTATUS')} AS SUBSTATUS, obs_i AS OBSERVACAO,
    {_bill('kci', 'cidade_instalacao', 'uf_instalacao')} AS DADOS_BILLING, NULL AS DADOS_CONTRATO, {_truth('kci', 'a')} AS DADOS_TABELA_VERDADE, CRM FROM ck WHERE tipo NOT IN ('INVALIDO', 'NULO')
  UNION ALL SELECT FATURA, 'ENDERECO_LEGAL', {_status('st_l', 'STATUS')}, {_status('st_l', 'SUBSTATUS')}, obs_l, {_bill('kcl', 'cidade_legal', 'uf_legal')},
    CASE WHEN r_cnpj IS NOT NULL THEN 'RAZAO: ' || COALESCE(r_razao, '') || ' | CEP: ' || COALESCE(r_cep, '') || ' | CIDADE: ' || COALESCE(r_mun, '') || ' | /' || COALESCE(r_uf, '') END,
    {_truth('kcl', 'b')}, CRM FROM ck WHERE tipo = 'CNPJ'
  UNION ALL SELECT FATURA, 'DADOS_CADASTRAIS', CASE WHEN tipo = 'NULO' THEN 'INCORRETO' ELSE {_status('st_c', 'STATUS')} END, CASE WHEN tipo = 'NULO' THEN 'ERRO' ELSE {_status('st_c', 'SUBSTATUS')} END,
    CASE WHEN tipo = 'NULO' THEN 'CPF/CNPJ não encontrado' ELSE obs_c END, concat_ws(' | ', 'NOME: ' || COALESCE(NOME_CLIENTE, ''), 'DOC: ' || doc),
    CASE WHEN r_cnpj IS NOT NULL THEN 'RAZAO: ' || COALESCE(r_razao, '') || ' | SITUACAO: ' || COALESCE(r_sit, '') || ' | CEP: ' || COALESCE(r_cep, '') || ' | CIDADE: ' || COALESCE(r_mun, '') || ' | /' || COALESCE(r_uf, '') END,
    NULL, CRM FROM ck WHERE tipo IN ('CNPJ', 'NULO')
  UNION ALL SELECT FATURA, 'INVALIDO', 'INCORRETO', 'ERRO', 'DOC(' || CPF_CNPJ || ') - Inválido', 'DOC(' || CPF_CNPJ || ') - Inválido', NULL, NULL, CRM FROM ck WHERE tipo = 'INVALIDO')"""


@query("d16_status_table", f"WITH {STATUS_SQL} SELECT * FROM stt")
def d16(spark, sf):
    out = P.status_table(checked(spark, sf))
    return out.select("FATURA", "REGRA", "STATUS", "SUBSTATUS", "OBSERVACAO", "DADOS_BILLING", "DADOS_CONTRATO", "DADOS_TABELA_VERDADE", "CRM")


@query(
    "d16_address_table",
    f"""WITH {CHECKED_SQL} SELECT FATURA, 'ENDERECO_INSTALACAO' AS REGRA, doc AS Documento, tipo AS Tipo, kci AS CEP_Instalacao, NULL AS CEP_Legal, a_cidade AS Cidade_CEP,
  CASE WHEN a_cep IS NOT NULL AND nci = a_nc THEN 'Sim' ELSE 'Não' END AS Cidade_Confere, CASE WHEN a_cep IS NOT NULL AND nui = a_nu THEN 'Sim' ELSE 'Não' END AS UF_Confere,
  NULL AS CEP_Receita, st_i AS Status_Validacao FROM ck WHERE tipo NOT IN ('INVALIDO', 'NULO')
UNION ALL SELECT FATURA, 'ENDERECO_LEGAL', doc, tipo, NULL, kcl, b_cidade, CASE WHEN b_cep IS NOT NULL AND ncl = b_nc THEN 'Sim' ELSE 'Não' END,
  CASE WHEN b_cep IS NOT NULL AND nul = b_nu THEN 'Sim' ELSE 'Não' END, r_cep, st_l FROM ck WHERE tipo = 'CNPJ'
UNION ALL SELECT FATURA, 'DADOS_CADASTRAIS', doc, tipo, NULL, NULL, NULL, NULL, NULL, NULL, CASE WHEN tipo = 'NULO' THEN 'INCORRETO' ELSE st_c END FROM ck WHERE tipo IN ('CNPJ', 'NULO')
UNION ALL SELECT FATURA, 'INVALIDO', CPF_CNPJ, 'INVALIDO', NULL, NULL, NULL, NULL, NULL, NULL, 'INCORRETO' FROM ck WHERE tipo = 'INVALIDO'""",
)
def d16_address(spark, sf):
    out = P.address_table(checked(spark, sf))
    return out.select(
        "FATURA", "REGRA", "Documento", "Tipo", "CEP_Instalacao", "CEP_Legal", "Cidade_CEP", "Cidade_Confere", "UF_Confere", "CEP_Receita", "Status_Validacao"
    )


@query(
    "d16_registration_table",
    f"""WITH {ENRICHED_SQL} SELECT FATURA, 'DADOS_CADASTRAIS' AS REGRA, doc AS CNPJ, r_razao AS Razao_Social, r_sit AS Situacao_Cadastral, r_mun AS Municipio_Receita
FROM e3 WHERE tipo IN ('CNPJ', 'NULO')""",
)
def d16_registration(spark, sf):
    return P.registration_table(enriched(spark, sf)).select("FATURA", "REGRA", "CNPJ", "Razao_Social", "Situacao_Cadastral", "Municipio_Receita")


SHEET_SQL = f"""{SOURCE_SQL},
s0 AS (SELECT *, COALESCE({_digits('CPF_CNPJ')}, '') AS doc, CASE WHEN length({_digits('CPF_CNPJ')}) = 14 THEN 'CNPJ' WHEN length({_digits('CPF_CNPJ')}) = 11 THEN 'CPF' ELSE 'INVALIDO' END AS tipo,
  {_key("COALESCE(cep_instalacao, '')")} AS k, {_clean("COALESCE(cidade_instalacao, '')")} AS cc, {_norm('uf_instalacao')} AS nu FROM rws),
s1 AS (SELECT *, {_norm('cc')} AS ncc FROM s0),
s2 AS (SELECT s1.*, r.cnpj AS r_cnpj, r.razao_social AS r_razao, COALESCE(r.receita_cep, '') AS r_cep, r.receita_municipio AS r_mun, r.receita_uf AS r_uf, r.receita_logradouro AS r_log,
    COALESCE(r.nc, '') AS r_nc, COALESCE(r.nu, '') AS r_nu, COALESCE(t.status_consulta, 'nao_encontrado') AS falha, a.cep AS a_cep, a.cidade AS a_cidade, a.uf AS a_uf, COALESCE(a.nc, '') AS a_nc, COALESCE(a.nu, '') AS a_nu,
    q.cep AS q_cep, q.logradouro AS q_log, COALESCE(q.nc, '') AS q_nc, COALESCE(q.nu, '') AS q_nu, k LIKE '%000' AS g, COALESCE(r.receita_cep LIKE '%000', FALSE) AS rg
  FROM s1 LEFT JOIN r ON r.cnpj = CASE WHEN tipo = 'CNPJ' THEN doc END LEFT JOIN reg t ON t.cnpj = CASE WHEN tipo = 'CNPJ' THEN doc END LEFT JOIN p a ON a.cep = k LEFT JOIN p q ON q.cep = r.receita_cep),
s3 AS (SELECT *, a_cep IS NOT NULL AND a_nc <> '' AND ncc = a_nc AS cityok, r_nc <> '' AND r_nc = ncc AS same,
    CASE WHEN r_log IS NULL THEN '' ELSE 'DAS FLORES' END AS rs, CASE WHEN q_log = 'Rua das Flores' THEN 'DAS FLORES' WHEN q_log = 'Av. Central' THEN 'CENTRAL' ELSE '' END AS qs,
    substr(k, 1, 5) || '-' || substr(k, 6, 3) AS kd, substr(r_cep, 1, 5) || '-' || substr(r_cep, 6, 3) AS rd FROM s2),
s4 AS (SELECT *, CASE WHEN q_cep IS NULL THEN 'X' WHEN r_nu = q_nu AND r_nc = q_nc AND (rs = '' OR qs = '' OR rs = qs) THEN 'C' ELSE 'D' END AS cmp,
    concat_ws(' | ', CASE WHEN {_diff('ncc', 'a_nc')} THEN 'Cidade divergente: base ''' || cc || ''' x Correios ''' || COALESCE(a_cidade, '') || '''' END,
      CASE WHEN {_diff('nu', 'a_nu')} THEN 'UF divergente: base ''' || COALESCE(uf_instalacao, '') || ''' x Correios ''' || COALESCE(a_uf, '') || '''' END) AS pn FROM s3)"""

_COMPANY_TAIL = f"""CASE WHEN k <> r_cep THEN 'CEP divergente: base ''' || k || ''' x Receita ''' || r_cep || '''' END,
  CASE WHEN {_diff('ncc', 'r_nc')} THEN 'Cidade divergente: base ''' || cc || ''' x Receita ''' || COALESCE(r_mun, '') || '''' END,
  CASE WHEN {_diff('nu', 'r_nu')} THEN 'UF divergente: base ''' || COALESCE(uf_instalacao, '') || ''' x Receita ''' || COALESCE(r_uf, '') || '''' END,
  CASE cmp WHEN 'D' THEN 'Endereço Receita x Correios divergente' WHEN 'X' THEN 'CEP da Receita não encontrado nos Correios' END)"""
_MUN = "CASE WHEN same THEN 'Município confirmado: ' || COALESCE(r_mun, '') ELSE 'Município divergente: base ''' || cc || ''' x Receita ''' || COALESCE(r_mun, '') || '''' END"
CONFIRM_SQL = f"""{SHEET_SQL}, s5 AS (SELECT *, concat_ws(' | ', CASE WHEN g THEN '[CEP] CEP da base é genérico: ' || kd || ' (representa sede do município) | ' || {_MUN} END,
  CASE WHEN rg THEN '[CEP] CEP da Receita é genérico: ' || rd || ' (sede do município) | ' || {_MUN} END, {_COMPANY_TAIL} AS cn FROM s4)
SELECT FATURA, CASE WHEN g AND tipo = 'CPF' AND cityok THEN 'CEP genérico - município confirmado' WHEN g AND tipo = 'CPF' THEN 'CEP genérico - município divergente'
    WHEN tipo = 'INVALIDO' THEN 'Documento inválido' WHEN tipo = 'CPF' AND a_cep IS NULL THEN 'Erro CEP' WHEN tipo = 'CPF' THEN CASE WHEN pn = '' THEN 'Confere' ELSE 'Divergente' END
    WHEN r_cnpj IS NULL THEN 'Erro Receita: ' || falha WHEN cn = '' THEN 'Confere' ELSE 'Divergente' END AS Status_Validacao,
  CASE WHEN g AND tipo = 'CPF' THEN CASE WHEN cityok THEN 'CORRETO' ELSE 'INCORRETO' END WHEN tipo = 'INVALIDO' OR (tipo = 'CPF' AND a_cep IS NULL) THEN 'INCORRETO'
    WHEN tipo = 'CPF' THEN CASE WHEN pn = '' THEN 'CORRETO' ELSE 'INCORRETO' END WHEN r_cnpj IS NULL OR cn <> '' THEN 'INCORRETO' ELSE 'CORRETO' END AS STATUS,
  CASE WHEN g AND tipo = 'CPF' THEN '[CEP] CEP genérico: ' || kd || ' (representa sede do município) | ' || CASE WHEN cityok THEN 'Município confirmado: ' || a_cidade || '/' || a_uf
      ELSE 'Município divergente: base ''' || cc || ''' x CEP ''' || CASE WHEN a_cep IS NOT NULL THEN a_cidade || '/' || a_uf ELSE 'não identificada' END || '''' END
    WHEN tipo = 'INVALIDO' THEN '[DOC] Documento inválido' WHEN tipo = 'CPF' AND a_cep IS NULL THEN '[CEP] CEP não encontrado: ' || k WHEN tipo = 'CPF' THEN pn
    WHEN r_cnpj IS NULL THEN '[API] Erro na consulta Receita: ' || falha ELSE cn END AS OBSERVACAO FROM s5"""
REJECT_SQL = f"""{SHEET_SQL}, s5 AS (SELECT *, concat_ws(' | ', CASE WHEN rg THEN '[CEP] CEP da Receita é genérico: ' || rd || ' (sede do município)' END, {_COMPANY_TAIL} AS cn FROM s4)
SELECT FATURA, CASE WHEN g THEN 'CEP genérico' WHEN tipo = 'INVALIDO' THEN 'Documento inválido' WHEN tipo = 'CPF' AND a_cep IS NULL THEN 'Erro CEP'
    WHEN tipo = 'CPF' THEN CASE WHEN pn = '' THEN 'Confere' ELSE 'Divergente' END WHEN r_cnpj IS NULL THEN 'Erro Receita: ' || falha WHEN cn = '' THEN 'Confere' ELSE 'Divergente' END AS Status_Validacao,
  CASE WHEN g OR tipo = 'INVALIDO' OR (tipo = 'CPF' AND (a_cep IS NULL OR pn <> '')) OR (tipo = 'CNPJ' AND (r_cnpj IS NULL OR cn <> '')) THEN 'INCORRETO' ELSE 'CORRETO' END AS STATUS,
  CASE WHEN g THEN '[CEP] CEP genérico não aceito: ' || kd || ' (representa sede do município, não um endereço específico)' WHEN tipo = 'INVALIDO' THEN '[DOC] Documento inválido'
    WHEN tipo = 'CPF' AND a_cep IS NULL THEN '[CEP] CEP não encontrado: ' || k WHEN tipo = 'CPF' THEN pn WHEN r_cnpj IS NULL THEN '[API] Erro na consulta Receita: ' || falha ELSE cn END AS OBSERVACAO FROM s5"""


def _sheet(spark, sf, policy):
    out = P.check_row(rows(spark, sf), registry(spark, sf), places(spark, sf), policy)
    return out.select("FATURA", "Status_Validacao", "STATUS", "OBSERVACAO")


@query("d18_row_rules_confirm", f"WITH {CONFIRM_SQL}")
def d18_confirm(spark, sf):
    return _sheet(spark, sf, "confirm")


@query("d18_row_rules_reject", f"WITH {REJECT_SQL}")
def d18_reject(spark, sf):
    return _sheet(spark, sf, "reject")


@query(
    "d18_row_rules_note",
    f"""WITH {ENRICHED_SQL}, n1 AS (SELECT *, CASE WHEN a_cep IS NULL THEN '[CEP] CEP não encontrado no cache: ' || kci
  WHEN gi THEN '[CEP] CEP genérico: ' || substr(kci, 1, 5) || '-' || substr(kci, 6, 3) || ' (sede do município) | ' || CASE WHEN dci
    THEN 'Município divergente: base ''' || cci || ''' x CEP ''' || a_cidade || '''' ELSE 'Município confirmado: ' || a_cidade || '/' || a_uf END
  ELSE concat_ws(' | ', CASE WHEN dci THEN 'Cidade divergente: base ''' || cci || ''' x CEP ''' || a_cidade || '''' END, CASE WHEN dui THEN 'UF divergente: base ''' || uf_instalacao || ''' x CEP ''' || a_uf || '''' END) END AS obs FROM e3)
SELECT FATURA, obs, CASE WHEN obs IS NULL OR obs = '' THEN 'Confere' ELSE 'Divergente' END AS estado FROM n1""",
)
def d18_note(spark, sf):
    out = P.check_address(enriched(spark, sf), P.INSTALLATION, "note")
    return out.select("FATURA", F.col("ci_obs").alias("obs"), F.col("ci_state").alias("estado"))


@query(
    "d17_compare_addresses",
    f"""WITH {SHEET_SQL} SELECT FATURA, CASE cmp WHEN 'X' THEN 'CEP não encontrado nos Correios' WHEN 'C' THEN 'Confere' ELSE 'Divergente' END AS resultado FROM s4 WHERE r_cnpj IS NOT NULL""",
)
def d17(spark, sf):
    from billproof.operators.joins import lookup

    base = P.enrich(rows(spark, sf), registry(spark, sf), places(spark, sf)).where(F.col("r_cnpj").isNotNull())
    base = base.select("FATURA", "r_receita_uf", "r_receita_municipio", "r_receita_logradouro", "r_receita_cep")
    spots = P.postcode_lookup(places(spark, sf))
    both = lookup(base, spots, {"r_receita_cep": "key"}, {x: f"q_{x}" for x in spots.columns})
    c = F.col
    result = P.compare_addresses(
        (c("r_receita_uf"), c("q_uf")), (c("r_receita_municipio"), c("q_cidade")), (c("r_receita_logradouro"), c("q_logradouro")), c("q_key").isNotNull()
    )
    return both.select("FATURA", result.alias("resultado"))


BASE = {
    "crm": "CASE o_orderstatus WHEN 'F' THEN 'AN' WHEN 'O' THEN 'NG' ELSE 'ADAPTER' END", "idcontrato": "CAST(o_orderkey AS {s})", "codigocliente": "CAST(o_custkey AS {s})",
    "cidade": "concat('C', CAST(o_custkey % 9 AS {s}))", "bairro": "'B'", "cep": "CAST(o_custkey AS {s})", "uf": "'SP'", "nome_produto": "o_orderpriority",
}
BILLING = {
    "fatura_numero": "CASE WHEN l_linenumber = 2 THEN 'abc' ELSE concat('F-', CAST(l_orderkey * 10 + l_linenumber AS {s})) END",
    "CONTRATO": "CASE o_orderstatus WHEN 'O' THEN concat('A', CAST(o_orderkey AS {s})) ELSE CAST(o_orderkey AS {s}) END", "ID_CLIENTE": "CAST(o_custkey AS {s})", "segmento": "'B2B'",
    "CPF_CNPJ": "CAST(o_custkey AS {s})", "NOME_CLIENTE": "concat('N', CAST(o_custkey AS {s}))",
    "sistema_origem": "CASE o_orderstatus WHEN 'F' THEN 'SIMETRA(AN)' WHEN 'O' THEN 'NG' ELSE 'ADAPTER' END",
}
S2_SQL = f"""bc AS (SELECT {_select(BASE, 'VARCHAR')} FROM orders), ca AS (SELECT {_select(BILLING, 'VARCHAR')} FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
kk AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS CODIGOCLIENTE, CAST(o_orderkey AS VARCHAR) AS IDCONTRATO, 'A' || CAST(o_orderkey AS VARCHAR) AS IDCONTA FROM orders),
lg AS (SELECT CAST(o_orderkey AS VARCHAR) AS IDCONTRATO, 'L' || CAST(o_custkey AS VARCHAR) AS cidade FROM orders WHERE o_orderkey % 2 = 0)"""


def _source_tables(spark, sf):
    orders = table(spark, sf, "orders")
    lines = table(spark, sf, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    base = orders.select(*[F.expr(e.format(s="STRING")).alias(n) for n, e in BASE.items()])
    billing = lines.select(*[F.expr(e.format(s="STRING")).alias(n) for n, e in BILLING.items()])
    return base, billing


@query(
    "s2_customer_source",
    f"""WITH {S2_SQL}, j AS (SELECT ca.*, bc.cidade, bc.crm FROM bc JOIN ca ON bc.idcontrato = ca.CONTRATO WHERE bc.crm <> 'NG'
  UNION ALL SELECT ca.*, bc.cidade, bc.crm FROM bc JOIN ca ON bc.codigocliente = ca.ID_CLIENTE WHERE bc.crm = 'NG')
SELECT TRY_CAST({_digits('fatura_numero')} AS BIGINT) AS FATURA, fatura_numero AS NUMERO_FATURA, CONTRATO AS ID_CLIENTE_CONTRATO, cidade AS cidade_instalacao, crm AS crm_base FROM j""",
)
def s2(spark, sf):
    base, billing = _source_tables(spark, sf)
    base = base.withColumn("nome_produto", F.col("crm"))
    out = P.address_source(base, billing, LOT)
    return out.select("FATURA", "NUMERO_FATURA", "ID_CLIENTE_CONTRATO", "cidade_instalacao", F.col("PRODUTO").alias("crm_base"))


@query(
    "s2_customer_source_latest",
    f"""WITH {S2_SQL}, ng AS (SELECT TRY_CAST({_digits('ca.fatura_numero')} AS BIGINT) AS FATURA, ca.fatura_numero, ca.CONTRATO, bc.cidade, bc.cep, bc.nome_produto, ca.CPF_CNPJ FROM bc
    JOIN kk ON kk.CODIGOCLIENTE = bc.codigocliente AND kk.IDCONTRATO = bc.idcontrato JOIN ca ON kk.IDCONTA = ca.CONTRATO AND bc.codigocliente = ca.ID_CLIENTE WHERE bc.crm = 'NG' AND ca.sistema_origem = 'NG'),
  d AS (SELECT *, row_number() OVER (PARTITION BY CONTRATO, cidade, cep, CPF_CNPJ, nome_produto ORDER BY CASE WHEN FATURA IS NULL OR FATURA = 0 THEN 1 ELSE 0 END, FATURA DESC NULLS LAST, fatura_numero) AS rn FROM ng),
  u AS (SELECT FATURA, fatura_numero, CONTRATO, cidade, 'NG' AS CRM FROM d WHERE rn = 1
    UNION ALL SELECT TRY_CAST({_digits('ca.fatura_numero')} AS BIGINT), ca.fatura_numero, ca.CONTRATO, bc.cidade, ca.sistema_origem FROM bc JOIN ca ON bc.idcontrato = ca.CONTRATO AND bc.crm = ca.sistema_origem WHERE bc.crm = 'ADAPTER'
    UNION ALL SELECT TRY_CAST({_digits('ca.fatura_numero')} AS BIGINT), ca.fatura_numero, ca.CONTRATO, bc.cidade, ca.sistema_origem FROM bc JOIN ca ON bc.idcontrato = ca.CONTRATO AND ca.sistema_origem = 'SIMETRA(' || bc.crm || ')' WHERE ca.sistema_origem = 'SIMETRA(AN)')
SELECT FATURA, fatura_numero AS NUMERO_FATURA, CONTRATO AS ID_CLIENTE_CONTRATO, u.cidade AS cidade_instalacao, lg.cidade AS cidade_legal, CRM FROM u LEFT JOIN lg ON lg.IDCONTRATO = u.CONTRATO""",
)
def s2_latest(spark, sf):
    base, billing = _source_tables(spark, sf)
    orders = table(spark, sf, "orders")
    key = F.col("o_orderkey").cast("string")
    contracts = orders.select(F.col("o_custkey").cast("string").alias("CODIGOCLIENTE"), key.alias("IDCONTRATO"), F.concat(F.lit("A"), key).alias("IDCONTA"))
    none = F.lit(None).cast("string")
    legal = orders.where("o_orderkey % 2 = 0").select(
        key.alias("IDCONTRATO"), F.concat(F.lit("L"), F.col("o_custkey")).alias("cidade"), none.alias("bairro"), none.alias("cep"), none.alias("estado")
    )
    out = P.address_source_latest(base, billing, contracts, legal, LOT)
    return out.select("FATURA", "NUMERO_FATURA", "ID_CLIENTE_CONTRATO", "cidade_instalacao", "cidade_legal", "CRM")


@query(
    "w5_dedup_latest",
    f"""WITH {S2_SQL}, d AS (SELECT ID_CLIENTE, CONTRATO, fatura_numero, row_number() OVER (PARTITION BY ID_CLIENTE, CONTRATO ORDER BY
  CASE WHEN TRY_CAST({_digits('fatura_numero')} AS BIGINT) IS NULL THEN 1 ELSE 0 END, TRY_CAST({_digits('fatura_numero')} AS BIGINT) DESC, fatura_numero) AS rn FROM ca)
SELECT ID_CLIENTE, CONTRATO, fatura_numero FROM d WHERE rn = 1""",
)
def w5(spark, sf):
    from billproof.functions.text import digits_only
    from billproof.operators.windows import dedup_latest

    _, billing = _source_tables(spark, sf)
    number = digits_only(F.col("fatura_numero")).try_cast("bigint")
    return dedup_latest(billing, ["ID_CLIENTE", "CONTRATO"], number, [F.col("fatura_numero")]).select("ID_CLIENTE", "CONTRATO", "fatura_numero")
