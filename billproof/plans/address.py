"""Checks of customer documents, addresses and registered names against registry and postcode tables.

Reference records are normalised once on the (small) reference side, joined as lookups, and every message is a column
expression: no Python worker, no driver-side dictionaries.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import col_or, find_column
from ..functions.documents import dashed_cep, doc_type, is_generic_cep, postcode_key
from ..functions.names import name_similarity
from ..functions.text import clean_city, digits_only, label_chain, labelled, norm_street, norm_text
from ..operators.joins import join_by_branch, lookup, prefixed
from ..operators.sets import union_strict
from ..operators.windows import dedup_latest
from ..session import stored

# States of a check and the status / substatus written for them, newest and previous generation.
CONFIRMED, DIVERGENT, NOT_LOADED = "Confere", "Divergente", "nao_carregado"
GENERIC_OK, GENERIC_WRONG = "CepGenericoOk", "CepGenericoDiverge"
EXACT, SIMILAR, NO_DATA = "Exato", "Alerta", "sem_dado"
STATUS_V5 = {
    CONFIRMED: ("CORRETO", "OK"),
    GENERIC_OK: ("CORRETO", "ALERTA"),
    NOT_LOADED: ("PENDENTE", "CACHE_VAZIO"),
    GENERIC_WRONG: ("INCORRETO", "ERRO"),
}
STATUS_LATEST = STATUS_V5 | {NOT_LOADED: ("INCORRETO", "CNPJ NÂO ENCONTRADO")}
REGISTRATION_STATUS = {
    EXACT: ("CORRETO", "EXATO"),
    SIMILAR: ("CORRETO", "ALERTA"),
    DIVERGENT: ("INCORRETO", "DIVERGENTE"),
    NOT_LOADED: ("INCORRETO", "CNPJ NÃO ENCONTRADO"),
}
STATUS_DEFAULT = ("INCORRETO", "ERRO")
REGISTRATION_DEFAULT = ("CORRETO", "OK")

# Messages.
MSG_CEP_MISSING = "[CEP] CEP não encontrado no cache: "
MSG_REGISTRY_MISSING = "[CACHE] CNPJ não encontrado em tab_dados_receita"
MSG_REGISTRY_POPULATE = "[CACHE] CNPJ não encontrado em tab_dados_receita. Execute a célula de populate."
MSG_DOC_MISSING = "CPF/CNPJ não encontrado"
MSG_DOC_INVALID = "[DOC] Documento inválido"
MSG_NOT_IN_DIRECTORY = "CEP não encontrado nos Correios"

R_INSTALLATION, R_LEGAL, R_REGISTRATION, R_INVALID = "ENDERECO_INSTALACAO", "ENDERECO_LEGAL", "DADOS_CADASTRAIS", "INVALIDO"


# -- sources ------------------------------------------------------------------------------------------------------


def _customer_row(lot: str, legal: Mapping[str, Column] | None = None) -> dict[str, Column]:
    """Row layout from columns prefixed b_ (customer base) and c_ (billing)."""
    c = F.col
    blank = F.lit("")
    installation = {f"{n}_instalacao": c(f"b_{n}") for n in ("cidade", "bairro", "cep", "uf")}
    legal = legal or {f"{n}_legal": c(f"b_{n}") for n in ("cidade", "bairro", "cep", "uf")}
    number = digits_only(c("c_fatura_numero"))
    return (
        {
            "FATURA": number.try_cast("bigint"),
            "NUMERO_FATURA": c("c_fatura_numero"),
            "ID_CLIENTE_CONTRATO": F.coalesce(c("c_CONTRATO"), c("c_ID_CLIENTE")),
            "SEGMENTO": c("c_segmento"),
        }
        | installation
        | dict(legal)
        | {
            "CPF_CNPJ": c("c_CPF_CNPJ"),
            "NOME_CLIENTE": c("c_NOME_CLIENTE"),
            "INSCRICAO_ESTADUAL": blank,
            "PRODUTO": c("b_nome_produto"),
            "TIPO_SERVICO": blank,
            "DESCRICAO_SERVICO": blank,
            "TIPO_IMPOSTO": blank,
            "PROMOCAO": blank,
            "GRUPO_LOCALIDADE": blank,
            "ID_LOTE": F.lit(lot),
            "CRM": c("c_sistema_origem"),
        }
    )


def _rows(joined: DataFrame, lot: str, legal: Mapping[str, Column] | None = None) -> DataFrame:
    mapping = _customer_row(lot, legal)
    return joined.select(*[mapping[x].alias(x) for x in schemas.CUSTOMER_ROW])


def address_source(base: DataFrame, billing: DataFrame, lot: str, limit: int | None = None) -> DataFrame:
    """Customer rows: one system is joined by customer code, the others by contract. Legal = installation address.

    base: crm, idcontrato, codigocliente, cidade, bairro, cep, uf, nome_produto. billing: fatura_numero, CONTRATO,
    ID_CLIENTE, segmento, CPF_CNPJ, NOME_CLIENTE, sistema_origem.
    """
    new = F.col("b_crm") == "NG"
    branches = [(~new, "b_idcontrato", "c_CONTRATO"), (new, "b_codigocliente", "c_ID_CLIENTE")]
    joined = join_by_branch(prefixed(base, "b_"), prefixed(billing, "c_"), branches)
    out = _rows(joined, lot)
    return out if limit is None else out.limit(limit)


def address_source_latest(
    base: DataFrame, billing: DataFrame, contracts: DataFrame, legal: DataFrame, lot: str, limit: int | None = None
) -> DataFrame:
    """Newest source: three systems, latest invoice per customer and product, separate legal addresses.

    contracts: CODIGOCLIENTE, IDCONTRATO, IDCONTA of the new system. legal: IDCONTRATO, cidade, bairro, cep, estado.
    """
    c = F.col
    b, bill = prefixed(base, "b_"), prefixed(billing, "c_")
    accounts = prefixed(contracts.select("CODIGOCLIENTE", "IDCONTRATO", "IDCONTA").distinct(), "k_")
    # Both conditions of the source system become equalities on a computed key.
    wrapped = F.concat(F.lit("SIMETRA("), c("b_crm"), F.lit(")"))
    origin = c("c_sistema_origem")
    ng = (
        b.where("b_crm = 'NG'")
        .join(accounts, (c("k_CODIGOCLIENTE") == c("b_codigocliente")) & (c("k_IDCONTRATO") == c("b_idcontrato")))
        .join(bill, (c("k_IDCONTA") == c("c_CONTRATO")) & (c("b_codigocliente") == c("c_ID_CLIENTE")))
        .where((c("b_crm") == origin) | (origin == wrapped))
    )
    no_legal = {f"{n}_legal": F.lit(None).cast("string") for n in ("cidade", "bairro", "cep", "uf")}
    keys = [
        "ID_CLIENTE_CONTRATO", "SEGMENTO", "cidade_instalacao", "bairro_instalacao", "cep_instalacao",
        "uf_instalacao", "CPF_CNPJ", "NOME_CLIENTE", "PRODUTO", "CRM",
    ]
    latest = dedup_latest(_rows(ng, lot, no_legal), keys, c("FATURA"), [c("NUMERO_FATURA")])
    adapter = b.where("b_crm = 'ADAPTER'").join(bill, (c("b_idcontrato") == c("c_CONTRATO")) & (c("b_crm") == origin))
    old = b.join(
        bill.where(origin == "SIMETRA(AN)"), (c("b_idcontrato") == c("c_CONTRATO")) & (origin == wrapped)
    )
    united = union_strict(latest, _rows(adapter, lot, no_legal), _rows(old, lot, no_legal))
    kept = united.drop(*no_legal)
    fields = {"cidade": "cidade_legal", "bairro": "bairro_legal", "cep": "cep_legal", "estado": "uf_legal"}
    out = lookup(kept, legal, {"ID_CLIENTE_CONTRATO": "IDCONTRATO"}, fields).select(*schemas.CUSTOMER_ROW)
    return out if limit is None else out.limit(limit)


def rows_from_sheet(sheet: DataFrame) -> DataFrame:
    """Customer rows from a sheet with any of the known header spellings; the legal address falls back to the
    installation columns when the sheet has none."""
    found = {role: find_column(sheet.columns, names) for role, names in schemas.SHEET_HEADERS.items()}
    for role in ("CPF_CNPJ", "cep_instalacao"):
        if found[role] is None:
            raise ValueError(f"sheet has no column for {role}")
    if found["cep_legal"] is None:
        for part in ("cep", "cidade", "bairro", "uf"):
            found[f"{part}_legal"] = found[f"{part}_instalacao"]
    none = F.lit(None).cast("string")

    def pick(role: str) -> Column:
        return F.col(f"`{found[role]}`").cast("string") if found.get(role) else none

    extra = {"FATURA": digits_only(pick("FATURA")).try_cast("bigint"), "NUMERO_FATURA": pick("FATURA")}
    return sheet.select(
        *[(extra[x] if x in extra else pick(x)).alias(x) for x in schemas.CUSTOMER_ROW], pick("REGRA").alias("REGRA")
    )


# -- reference side -----------------------------------------------------------------------------------------------


def usable(records: DataFrame) -> DataFrame:
    """Reference records that were loaded successfully."""
    return records.where(F.col("status_consulta") == "ok")


def postcode_lookup(postcodes: DataFrame) -> DataFrame:
    c = F.col
    return usable(postcodes).select(
        postcode_key(c("cep")).alias("key"),
        "logradouro",
        "bairro",
        "cidade",
        "uf",
        "fonte",
        norm_text(c("cidade")).alias("n_city"),
        norm_text(c("uf")).alias("n_state"),
    )


def registry_lookup(registry: DataFrame, only_usable: bool = True) -> DataFrame:
    c = F.col
    have = [x for x in schemas.REGISTRY.fieldNames() if x in registry.columns]
    return (usable(registry) if only_usable else registry).select(
        *have,
        norm_text(c("razao_social")).alias("n_name"),
        norm_text(c("receita_municipio")).alias("n_city"),
        norm_text(c("receita_uf")).alias("n_state"),
    )


def enrich(rows: DataFrame, registry: DataFrame, postcodes: DataFrame) -> DataFrame:
    """Document type, normalised keys, and the three lookups: r_ registry (companies only), ci_ and cl_ postcodes."""
    c = F.col
    doc = digits_only(c("CPF_CNPJ"))
    kind = doc_type(c("CPF_CNPJ"))
    based = rows.select(
        "*",
        doc.alias("x_doc"),
        kind.alias("x_type"),
        F.when(kind == "CNPJ", doc).alias("x_company"),
        *[postcode_key(c(f"cep_{r}")).alias(f"x_cep_{p}") for r, p in (("instalacao", "ci"), ("legal", "cl"))],
        *[clean_city(c(f"cidade_{r}")).alias(f"x_city_{p}") for r, p in (("instalacao", "ci"), ("legal", "cl"))],
        *[norm_text(clean_city(c(f"cidade_{r}"))).alias(f"x_ncity_{p}") for r, p in (("instalacao", "ci"), ("legal", "cl"))],
        *[norm_text(c(f"uf_{r}")).alias(f"x_nstate_{p}") for r, p in (("instalacao", "ci"), ("legal", "cl"))],
        norm_text(c("NOME_CLIENTE")).alias("x_nname"),
    )
    companies = registry_lookup(registry)
    out = lookup(based, companies, {"x_company": "cnpj"}, {x: f"r_{x}" for x in companies.columns if x != "cnpj"} | {"cnpj": "r_cnpj"}, hot_base=based)
    places = postcode_lookup(postcodes)
    for prefix in ("ci", "cl"):
        out = lookup(out, places, {f"x_cep_{prefix}": "key"}, {x: f"{prefix}_{x}" for x in places.columns}, hot_base=based)
    return out


# -- checks -------------------------------------------------------------------------------------------------------


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _differ(a: Column, b: Column) -> Column:
    """Both known and different."""
    a, b = _text(a), _text(b)
    return (a != "") & (b != "") & (a != b)


def _versus(label: str, mine: Column, source: str, theirs: Column) -> Column:
    return F.concat(F.lit(f"{label}: base '"), mine, F.lit(f"' x {source} '"), _text(theirs), F.lit("'"))


@dataclass(frozen=True)
class Role:
    """Which address of the customer, and the prefix of its postcode lookup."""

    name: str
    prefix: str

    def x(self, part: str) -> Column:
        return F.col(f"x_{part}_{self.prefix}")

    def place(self, part: str) -> Column:
        return F.col(f"{self.prefix}_{part}")

    @property
    def state(self) -> Column:
        return F.col(f"uf_{self.name}")

    @property
    def city_differs(self) -> Column:
        return _differ(self.x("ncity"), self.place("n_city"))

    @property
    def state_differs(self) -> Column:
        return _differ(self.x("nstate"), self.place("n_state"))

    @property
    def generic(self) -> Column:
        return is_generic_cep(self.x("cep"))


INSTALLATION, LEGAL = Role("instalacao", "ci"), Role("legal", "cl")


def _postcode_note(role: Role, policy: str) -> Column:
    where = F.concat(_text(role.place("cidade")), F.lit("/"), _text(role.place("uf")))
    city = F.when(role.city_differs, _versus("Cidade divergente", role.x("city"), "CEP", role.place("cidade")))
    state = F.when(role.state_differs, _versus("UF divergente", role.state, "CEP", role.place("uf")))
    plain = F.concat_ws(" | ", city, state)
    missing = F.concat(F.lit(MSG_CEP_MISSING), role.x("cep"))
    if policy == "note":
        head = F.concat(F.lit("[CEP] CEP genérico: "), dashed_cep(role.x("cep")), F.lit(" (sede do município) | "))
        wrong = _versus("Município divergente", role.x("city"), "CEP", role.place("cidade"))
        generic = F.concat(head, F.when(role.city_differs, wrong).otherwise(F.concat(F.lit("Município confirmado: "), where)))
        return label_chain([(role.place("key").isNull(), missing), (role.generic, generic)], plain)
    wrong = F.concat(
        F.lit("CEP genérico — cidade/estado divergente: base '"), role.x("city"), F.lit("/"), role.state, F.lit("' x CEP '"), where, F.lit("'")
    )
    fine = F.concat(F.lit("CEP genérico — município confirmado: "), where)
    differs = role.city_differs | role.state_differs
    return label_chain([(role.place("key").isNull(), missing), (role.generic & differs, wrong), (role.generic, fine)], plain)


def _registry_notes(role: Role, policy: str) -> list[Column]:
    """Comparison of the legal address with the registry record."""
    known = F.col("r_cnpj").isNotNull()
    theirs = F.col("r_receita_cep")
    mine = role.x("cep")
    # The older generation compares the postcode even when the registry has none.
    cep_differs = (_text(mine) != _text(theirs)) if policy == "note" else _differ(mine, theirs)
    return [
        F.when(~known, F.lit(MSG_REGISTRY_MISSING)),
        F.when(known & cep_differs, _versus("CEP divergente", mine, "Receita", theirs)),
        F.when(known & _differ(role.x("ncity"), F.col("r_n_city")), _versus("Cidade divergente", role.x("city"), "Receita", F.col("r_receita_municipio"))),
        F.when(known & _differ(role.x("nstate"), F.col("r_n_state")), _versus("UF divergente", role.state, "Receita", F.col("r_receita_uf"))),
    ]


def check_address(enriched: DataFrame, role: Role, policy: str = "classify") -> DataFrame:
    """Adds <prefix>_obs and <prefix>_state for the installation or the legal address.

    policy 'classify': a generic postcode is its own state; 'note': any note, also on a generic postcode, is divergent.
    The legal address of a company is also compared with the registry.
    """
    if policy not in ("classify", "note"):
        raise ValueError(f"unknown generic-postcode policy {policy!r}")
    note = _postcode_note(role, policy)
    if role.prefix == "cl":
        own = F.when(note != "", note)
        note = F.when(F.col("x_type") == "CNPJ", F.concat_ws(" | ", own, *_registry_notes(role, policy))).otherwise(note)
    noted = enriched.withColumn(f"{role.prefix}_obs", note)
    obs = F.col(f"{role.prefix}_obs")
    empty = obs.isNull() | (obs == "")
    if policy == "note":
        return noted.withColumn(f"{role.prefix}_state", F.when(empty, CONFIRMED).otherwise(DIVERGENT))
    differs = role.city_differs | role.state_differs
    fine = role.generic if role.prefix == "ci" else role.generic & (obs.isNull() | obs.contains("confirmado"))
    state = label_chain([(role.generic & differs, GENERIC_WRONG), (fine, GENERIC_OK), (empty, CONFIRMED)], DIVERGENT)
    return noted.withColumn(f"{role.prefix}_state", state)


def _situation_note() -> Column:
    situation = F.col("r_situacao_cadastral")
    return F.when(F.col("r_cnpj").isNotNull() & (F.upper(situation) != "ATIVA"), F.concat(F.lit("Situação: "), situation))


def _name_pair(head: Column) -> Column:
    return F.concat(
        head,
        _text(F.col("NOME_CLIENTE")),
        F.lit("' x Receita '"),
        _text(F.col("r_razao_social")),
        F.lit("'"),
    )


def check_registration(enriched: DataFrame) -> DataFrame:
    """Adds cad_obs and cad_state: registry record missing, not active, or registered under another name."""
    known = F.col("r_cnpj").isNotNull()
    name = F.when(known & _differ(F.col("r_n_name"), F.col("x_nname")), _name_pair(F.lit("Razão social divergente: base '")))
    obs = F.concat_ws(" | ", F.when(~known, F.lit(MSG_REGISTRY_POPULATE)), _situation_note(), name)
    state = label_chain([(~known & (F.col("x_type") == "CNPJ"), NOT_LOADED), (F.col("cad_obs") == "", CONFIRMED)], DIVERGENT)
    return enriched.withColumn("cad_obs", obs).withColumn("cad_state", state)


def check_registration_sim(enriched: DataFrame, threshold: float = 0.75) -> DataFrame:
    """Like check_registration, with word-level similarity of the names: exact, similar from `threshold` on, divergent."""
    known = F.col("r_cnpj").isNotNull()
    scored = enriched.withColumn("cad_sim", name_similarity(_text(F.col("r_n_name")), F.col("x_nname")))
    state = label_chain(
        [
            (~known & (F.col("x_type") == "CNPJ"), NOT_LOADED),
            (F.col("cad_sim").isNull(), NO_DATA),
            (F.col("r_n_name") == F.col("x_nname"), EXACT),
            (F.col("cad_sim") >= threshold, SIMILAR),
        ],
        DIVERGENT,
    )
    classed = scored.withColumn("cad_state", state)
    own = F.col("cad_state")
    head = F.concat(
        F.when(own == SIMILAR, F.lit("Razão social similar (")).otherwise(F.lit("Razão social divergente (")),
        F.format_number(F.col("cad_sim") * 100, 0),
        F.lit("% palavras iguais): base '"),
    )
    obs = F.concat_ws(
        " | ", F.when(~known, F.lit(MSG_REGISTRY_POPULATE)), _situation_note(), F.when(own.isin(SIMILAR, DIVERGENT), _name_pair(head))
    )
    return classed.withColumn("cad_obs", obs)


def check_document(enriched: DataFrame) -> DataFrame:
    """Rows with a missing or invalid document, with status and text."""
    c = F.col
    bad = enriched.where(c("x_type").isin("NULO", "INVALIDO"))
    text = F.when(c("x_type") == "NULO", F.lit(MSG_DOC_MISSING)).otherwise(
        F.concat(F.lit("DOC("), c("CPF_CNPJ"), F.lit(") - Inválido"))
    )
    return bad.withColumns({"STATUS": F.lit("INCORRETO"), "SUBSTATUS": F.lit("ERRO"), "OBSERVACAO": text})


def map_status(
    state: Column, status_map: Mapping[str, tuple[str, str]], default: tuple[str, str] = STATUS_DEFAULT
) -> tuple[Column, Column]:
    """(STATUS, SUBSTATUS) of a check state."""
    status = label_chain([(state == s, pair[0]) for s, pair in status_map.items()], default[0])
    substatus = label_chain([(state == s, pair[1]) for s, pair in status_map.items()], default[1])
    return status, substatus


def check_all(enriched: DataFrame, policy: str = "classify", similarity: float | None = None) -> DataFrame:
    """All three checks. similarity: threshold of the name similarity, None for plain comparison."""
    checked = check_address(check_address(enriched, INSTALLATION, policy), LEGAL, policy)
    return check_registration(checked) if similarity is None else check_registration_sim(checked, similarity)


# -- outputs ------------------------------------------------------------------------------------------------------


def _dims() -> dict[str, Column]:
    names = {
        "Produto": "PRODUTO", "Tipo_Servico": "TIPO_SERVICO", "Desc_Servico": "DESCRICAO_SERVICO",
        "Tipo_Imposto": "TIPO_IMPOSTO", "Promocao": "PROMOCAO", "Grupo_Localidade": "GRUPO_LOCALIDADE",
        "ID_Lote": "ID_LOTE", "CRM": "CRM",
    }
    return {target: F.col(source) for target, source in names.items()}


def _ids() -> dict[str, Column]:
    return {
        "FATURA": F.col("FATURA"),
        "NUMERO_FATURA": F.col("NUMERO_FATURA"),
        "ID_CONTA_CONTRATO": F.col("ID_CLIENTE_CONTRATO"),
        "SEGMENTO": F.col("SEGMENTO"),
    }


def _confirmed(role: Role, part: str) -> Column:
    mine, theirs = role.x(f"n{part}"), role.place(f"n_{part}")
    return F.when(role.place("key").isNotNull() & (mine == theirs), "Sim").otherwise("Não")


def _per_rule(checked: DataFrame, branches: list[tuple[Column, str, dict[str, Column]]], order: list[str]) -> DataFrame:
    """One row per customer row and applicable rule, out of a single pass over the enriched rows.

    branches: (condition, rule, rule-specific text columns). Absent columns are NULL.
    """
    ids, dims = _ids(), _dims()
    own = ["REGRA", *[n for n in order if n not in ids and n not in dims and n != "REGRA"]]
    none = F.lit(None).cast("string")
    structs = []
    for condition, rule, columns in branches:
        values = columns | {"REGRA": F.lit(rule)}
        structs.append(F.when(condition, F.struct(*[values.get(n, none).cast("string").alias(n) for n in own])))
    common = [*[e.alias(n) for n, e in ids.items()], *[e.alias(n) for n, e in dims.items()]]
    rows = checked.select(*common, F.explode(F.array(*structs)).alias("_r")).where(F.col("_r").isNotNull())
    return rows.select(*[F.col(f"_r.{n}").alias(n) if n in own else F.col(n) for n in order])


# Layouts of the address report and of the status table.
ADDRESS_COLUMNS = [
    "FATURA", "NUMERO_FATURA", "ID_CONTA_CONTRATO", "REGRA", "SEGMENTO", "Documento", "Tipo", "CEP_Instalacao",
    "CEP_Legal", "Logradouro_CEP", "Bairro_CEP", "Cidade_CEP", "UF_CEP", "Cidade_Confere", "UF_Confere", "Fonte_CEP",
    "CEP_Receita", "Cidade_Receita", "UF_Receita", "Razao_Social", "Situacao_Cadastral", "Status_Validacao",
    "Observacao", "Produto", "Tipo_Servico", "Desc_Servico", "Tipo_Imposto", "Promocao", "Grupo_Localidade",
    "ID_Lote", "CRM",
]
STATUS_COLUMNS = [
    "FATURA", "NUMERO_FATURA", "ID_CONTA_CONTRATO", "REGRA", "SEGMENTO", "STATUS", "SUBSTATUS", "OBSERVACAO",
    "DADOS_BILLING", "DADOS_CONTRATO", "DADOS_TABELA_VERDADE", "Produto", "Tipo_Servico", "Desc_Servico",
    "Tipo_Imposto", "Promocao", "Grupo_Localidade", "ID_Lote", "CRM",
]
REGISTRATION_COLUMNS = {
    "Razao_Social": "razao_social", "Nome_Fantasia": "nome_fantasia", "Situacao_Cadastral": "situacao_cadastral",
    "Data_Situacao_Cadastral": "data_situacao_cadastral", "Motivo_Situacao": "motivo_situacao_cadastral",
    "Natureza_Juridica": "natureza_juridica", "Data_Inicio_Atividade": "data_inicio_atividade",
    "CNAE_Principal_Codigo": "cnae_principal_codigo", "CNAE_Principal_Descricao": "cnae_principal_descricao",
    "Porte": "porte", "Capital_Social": "capital_social", "Simples_Nacional": "opcao_simples", "MEI": "opcao_mei",
    "Email": "email", "Telefone": "telefone", "CEP_Receita": "receita_cep",
    "Logradouro_Receita": "receita_logradouro", "Numero_Receita": "receita_numero",
    "Complemento_Receita": "receita_complemento", "Bairro_Receita": "receita_bairro",
    "Municipio_Receita": "receita_municipio", "UF_Receita": "receita_uf", "Data_Consulta_Receita": "data_consulta",
}


def _invalid_note() -> Column:
    return F.concat(F.lit("DOC("), F.col("CPF_CNPJ"), F.lit(") - Inválido"))


def _address_part(role: Role) -> dict[str, Column]:
    own = "CEP_Instalacao" if role.prefix == "ci" else "CEP_Legal"
    return {
        "Documento": F.col("x_doc"),
        "Tipo": F.col("x_type"),
        own: role.x("cep"),
        "Logradouro_CEP": role.place("logradouro"),
        "Bairro_CEP": role.place("bairro"),
        "Cidade_CEP": role.place("cidade"),
        "UF_CEP": role.place("uf"),
        "Cidade_Confere": _confirmed(role, "city"),
        "UF_Confere": _confirmed(role, "state"),
        "Fonte_CEP": role.place("fonte"),
        "Status_Validacao": F.col(f"{role.prefix}_state"),
        "Observacao": F.col(f"{role.prefix}_obs"),
    }


def _of_type(*types: str) -> Column:
    return F.col("x_type").isin(*types)


def address_table(checked: DataFrame) -> DataFrame:
    """One row per customer row and applicable rule, with the compared addresses."""
    c = F.col
    registry = {"Razao_Social": c("r_razao_social"), "Situacao_Cadastral": c("r_situacao_cadastral")}
    from_registry = registry | {"CEP_Receita": c("r_receita_cep"), "Cidade_Receita": c("r_receita_municipio"), "UF_Receita": c("r_receita_uf")}
    no_doc = c("x_type") == "NULO"
    registration = registry | {
        "Documento": c("x_doc"),
        "Tipo": c("x_type"),
        "Status_Validacao": F.when(no_doc, "INCORRETO").otherwise(c("cad_state")),
        "Observacao": F.when(no_doc, MSG_DOC_MISSING).otherwise(c("cad_obs")),
    }
    invalid = {"Documento": c("CPF_CNPJ"), "Tipo": F.lit(R_INVALID), "Status_Validacao": F.lit("INCORRETO"), "Observacao": _invalid_note()}
    branches = [
        (_of_type("CPF", "CNPJ"), R_INSTALLATION, _address_part(INSTALLATION)),
        (_of_type("CNPJ"), R_LEGAL, _address_part(LEGAL) | from_registry),
        (_of_type("CNPJ", "NULO"), R_REGISTRATION, registration),
        (_of_type("INVALIDO"), R_INVALID, invalid),
    ]
    return _per_rule(checked, branches, ADDRESS_COLUMNS)


def registration_table(checked: DataFrame) -> DataFrame:
    """The registry record of every company (empty for rows without a document)."""
    c = F.col
    ids = {k: v for k, v in _ids().items() if k != "SEGMENTO"} | {"REGRA": F.lit(R_REGISTRATION)}
    record = {name: col_or(checked, f"r_{source}", to=_registry_type(source)) for name, source in REGISTRATION_COLUMNS.items()}
    columns = ids | {"CNPJ": c("x_doc")} | record | {"SEGMENTO": c("SEGMENTO")} | _dims()
    return checked.where(_of_type("CNPJ", "NULO")).select(*[e.alias(n) for n, e in columns.items()])


def _registry_type(name: str) -> str:
    return schemas.REGISTRY[name].dataType.simpleString()


def _piece(label: str, value: Column) -> Column:
    """'label: value', left out of the payload when the value is NULL."""
    return F.concat(F.lit(f"{label}: "), value)


def _billing_text(role: Role | None) -> Column:
    pieces = [_piece("NOME", _text(F.col("NOME_CLIENTE"))), _piece("DOC", F.col("x_doc"))]
    if role:
        city = _text(F.col(f"cidade_{role.name}"))
        pieces += [_piece("CEP", role.x("cep")), _piece("CIDADE", city), _piece("UF", _text(role.state))]
    return F.concat_ws(" | ", *pieces)


def _truth_text(role: Role) -> Column:
    place = [("LOGRADOURO", "logradouro"), ("CIDADE", "cidade"), ("UF", "uf")]
    return F.concat_ws(" | ", _piece("CEP", role.x("cep")), *[_piece(label, _text(role.place(part))) for label, part in place])


def _contract_text(with_situation: bool) -> Column:
    c = F.col
    pairs = [("RAZAO", c("r_razao_social"))]
    if with_situation:
        pairs.append(("SITUACAO", c("r_situacao_cadastral")))
    pairs += [("CEP", c("r_receita_cep")), ("CIDADE", c("r_receita_municipio"))]
    tail = F.concat(F.lit("/"), _text(c("r_receita_uf")))
    return F.when(c("r_cnpj").isNotNull(), F.concat_ws(" | ", labelled(*pairs), tail))


def status_table(checked: DataFrame, status_map: Mapping[str, tuple[str, str]] = STATUS_V5, similarity: bool = False) -> DataFrame:
    """Findings of the address job in the hub's layout: one row per customer row and applicable rule.

    similarity=True: cad_state comes from check_registration_sim and has its own statuses.
    """
    c = F.col

    def part(role: Role) -> dict[str, Column]:
        status, substatus = map_status(c(f"{role.prefix}_state"), status_map)
        out = {
            "STATUS": status,
            "SUBSTATUS": substatus,
            "OBSERVACAO": c(f"{role.prefix}_obs"),
            "DADOS_BILLING": _billing_text(role),
            "DADOS_TABELA_VERDADE": _truth_text(role),
        }
        return out | ({"DADOS_CONTRATO": _contract_text(False)} if role.prefix == "cl" else {})

    if similarity:
        status, substatus = map_status(c("cad_state"), REGISTRATION_STATUS, REGISTRATION_DEFAULT)
    else:
        status, substatus = map_status(c("cad_state"), status_map)
    no_doc = c("x_type") == "NULO"
    registration = {
        "STATUS": F.when(no_doc, "INCORRETO").otherwise(status),
        "SUBSTATUS": F.when(no_doc, "ERRO").otherwise(substatus),
        "OBSERVACAO": F.when(no_doc, MSG_DOC_MISSING).otherwise(c("cad_obs")),
        "DADOS_BILLING": _billing_text(None),
        "DADOS_CONTRATO": _contract_text(True),
    }
    invalid = {"STATUS": F.lit("INCORRETO"), "SUBSTATUS": F.lit("ERRO"), "OBSERVACAO": _invalid_note(), "DADOS_BILLING": _invalid_note()}
    branches = [
        (_of_type("CPF", "CNPJ"), R_INSTALLATION, part(INSTALLATION)),
        (_of_type("CNPJ"), R_LEGAL, part(LEGAL)),
        (_of_type("CNPJ", "NULO"), R_REGISTRATION, registration),
        (_of_type("INVALIDO"), R_INVALID, invalid),
    ]
    return _per_rule(checked, branches, STATUS_COLUMNS)


def address_outputs(
    rows: DataFrame, registry: DataFrame, postcodes: DataFrame, policy: str = "classify", similarity: float | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(address report, registration report, status table) of a lot. The look-ups are made once, for all three."""
    checked = stored(check_all(enrich(rows, registry, postcodes), policy, similarity), "checked")
    status = STATUS_V5 if similarity is None else STATUS_LATEST
    return address_table(checked), registration_table(checked), status_table(checked, status, similarity is not None)


# -- single-address sheets: older row rules -----------------------------------------------------------------------


def compare_addresses(state: tuple[Column, Column], city: tuple[Column, Column], street: tuple[Column, Column], found: Column) -> Column:
    """Registry against postcode directory: state, city and street without its type; a blank street always matches."""
    a, b = norm_street(street[0]), norm_street(street[1])
    same = (norm_text(state[0]) == norm_text(state[1])) & (norm_text(city[0]) == norm_text(city[1])) & ((a == "") | (b == "") | (a == b))
    return label_chain([(~found, MSG_NOT_IN_DIRECTORY), (same, CONFIRMED)], DIVERGENT)


def check_row(rows: DataFrame, registry: DataFrame, postcodes: DataFrame, policy: str = "confirm") -> DataFrame:
    """Row rules of the sheet jobs: one address per row, dispatch by document type.

    policy 'reject': a generic postcode is an error for every document. policy 'confirm': a person's generic postcode is
    accepted when the city agrees; for companies the note names the comparison with the registry.
    Adds Status_Validacao, STATUS, SUBSTATUS, OBSERVACAO, DADOS_BILLING, DADOS_CONTRATO, DADOS_TABELA_VERDADE.
    """
    if policy not in ("reject", "confirm"):
        raise ValueError(f"unknown generic-postcode policy {policy!r}")
    c = F.col
    kind = doc_type(c("CPF_CNPJ"), null_is_invalid=True)
    doc = digits_only(c("CPF_CNPJ"))
    cep = postcode_key(_text(c("cep_instalacao")))
    based = rows.select(
        "*",
        _text(doc).alias("x_doc"),
        kind.alias("x_type"),
        F.when(kind == "CNPJ", doc).alias("x_company"),
        cep.alias("x_cep"),
        clean_city(_text(c("cidade_instalacao"))).alias("x_city"),
        norm_text(clean_city(c("cidade_instalacao"))).alias("x_ncity"),
        norm_text(c("uf_instalacao")).alias("x_nstate"),
    )
    # Failed look-ups come along: their status is part of the message.
    companies, places = registry_lookup(registry, only_usable=False), postcode_lookup(postcodes)
    joined = lookup(based, companies, {"x_company": "cnpj"}, {x: f"r_{x}" for x in companies.columns if x != "cnpj"} | {"cnpj": "r_cnpj"}, hot_base=based)
    joined = lookup(joined, places, {"x_cep": "key"}, {x: f"p_{x}" for x in places.columns}, hot_base=based)
    joined = lookup(joined, places, {"r_receita_cep": "key"}, {x: f"q_{x}" for x in places.columns})
    person, company = c("x_type") == "CPF", c("x_type") == "CNPJ"
    generic, r_generic = is_generic_cep(c("x_cep")), F.coalesce(is_generic_cep(c("r_receita_cep")), F.lit(False))
    found, known = c("p_key").isNotNull(), F.coalesce(c("r_status_consulta") == "ok", F.lit(False))
    failure = F.coalesce(c("r_status_consulta"), F.lit("nao_encontrado"))
    place = F.concat(_text(c("p_cidade")), F.lit("/"), _text(c("p_uf")))
    # person: base against directory
    p_notes = F.concat_ws(
        " | ",
        F.when(_differ(c("x_ncity"), c("p_n_city")), _versus("Cidade divergente", c("x_city"), "Correios", c("p_cidade"))),
        F.when(_differ(c("x_nstate"), c("p_n_state")), _versus("UF divergente", _text(c("uf_instalacao")), "Correios", c("p_uf"))),
    )
    head = F.concat(F.lit("[CEP] CEP genérico: "), dashed_cep(c("x_cep")), F.lit(" (representa sede do município)"))
    city_ok = found & (_text(c("p_n_city")) != "") & (c("x_ncity") == c("p_n_city"))
    shown = F.when(found, place).otherwise(F.lit("não identificada"))
    p_generic = F.when(city_ok, F.concat(head, F.lit(" | Município confirmado: "), place)).otherwise(
        F.concat(head, F.lit(" | "), _versus("Município divergente", c("x_city"), "CEP", shown))
    )
    # company: base against registry, registry against directory
    same_city = (_text(c("r_n_city")) != "") & (c("r_n_city") == c("x_ncity"))

    def company_generic(text: str, code: Column, tail: str) -> Column:
        note = F.concat(F.lit(text), dashed_cep(code), F.lit(tail))
        confirmed = F.concat(note, F.lit(" | Município confirmado: "), _text(c("r_receita_municipio")))
        wrong = F.concat(note, F.lit(" | "), _versus("Município divergente", c("x_city"), "Receita", c("r_receita_municipio")))
        return F.when(same_city, confirmed).otherwise(wrong)

    r_cep = _text(c("r_receita_cep"))
    if policy == "confirm":
        generic_notes = [
            F.when(generic, company_generic("[CEP] CEP da base é genérico: ", c("x_cep"), " (representa sede do município)")),
            F.when(r_generic, company_generic("[CEP] CEP da Receita é genérico: ", r_cep, " (sede do município)")),
        ]
    else:
        generic_notes = [F.when(r_generic, F.concat(F.lit("[CEP] CEP da Receita é genérico: "), dashed_cep(r_cep), F.lit(" (sede do município)")))]
    against = compare_addresses(
        (c("r_receita_uf"), c("q_uf")), (c("r_receita_municipio"), c("q_cidade")), (col_or(joined, "r_receita_logradouro"), c("q_logradouro")), c("q_key").isNotNull()
    )
    c_notes = F.concat_ws(
        " | ",
        *generic_notes,
        F.when(c("x_cep") != r_cep, _versus("CEP divergente", c("x_cep"), "Receita", r_cep)),
        F.when(_differ(c("x_ncity"), c("r_n_city")), _versus("Cidade divergente", c("x_city"), "Receita", c("r_receita_municipio"))),
        F.when(_differ(c("x_nstate"), c("r_n_state")), _versus("UF divergente", _text(c("uf_instalacao")), "Receita", c("r_receita_uf"))),
        F.when(against == DIVERGENT, F.lit("Endereço Receita x Correios divergente")),
        F.when(against == MSG_NOT_IN_DIRECTORY, F.lit("CEP da Receita não encontrado nos Correios")),
    )
    rejected = F.concat(
        F.lit("[CEP] CEP genérico não aceito: "), dashed_cep(c("x_cep")), F.lit(" (representa sede do município, não um endereço específico)")
    )
    ok_if_empty = lambda notes: F.when(notes == "", CONFIRMED).otherwise(DIVERGENT)
    status_if_empty = lambda notes: F.when(notes == "", "CORRETO").otherwise("INCORRETO")
    cases: list[tuple[Column, Column, object, object]] = []  # condition, text, validation, status
    if policy == "reject":
        cases.append((generic, rejected, "CEP genérico", "INCORRETO"))
    else:
        cases.append((generic & person & city_ok, p_generic, "CEP genérico - município confirmado", "CORRETO"))
        cases.append((generic & person, p_generic, "CEP genérico - município divergente", "INCORRETO"))
    cases += [
        (~person & ~company, F.lit(MSG_DOC_INVALID), "Documento inválido", "INCORRETO"),
        (person & ~found, F.concat(F.lit("[CEP] CEP não encontrado: "), c("x_cep")), "Erro CEP", "INCORRETO"),
        (person, p_notes, ok_if_empty(p_notes), status_if_empty(p_notes)),
        (
            ~known,
            F.concat(F.lit("[API] Erro na consulta Receita: "), failure),
            F.concat(F.lit("Erro Receita: "), failure),
            "INCORRETO",
        ),
    ]
    checked = joined.select(
        "*",
        label_chain([(x[0], x[1]) for x in cases], c_notes).alias("OBSERVACAO"),
        label_chain([(x[0], x[2]) for x in cases], ok_if_empty(c_notes)).alias("Status_Validacao"),
        label_chain([(x[0], x[3]) for x in cases], status_if_empty(c_notes)).alias("STATUS"),
    )
    base_text = labelled(
        ("NOME", c("NOME_CLIENTE")),
        ("DOC", c("x_doc")),
        ("CEP", c("x_cep")),
        ("CIDADE", c("cidade_instalacao")),
        ("UF", c("uf_instalacao")),
        ("IE", F.coalesce(F.nullif(_text(c("INSCRICAO_ESTADUAL")), F.lit("")), F.lit("-"))),
    )
    person_ok = person & found & (F.lit(policy == "confirm") | ~generic)
    truth = labelled(("CEP", c("x_cep")), ("LOGRADOURO", c("p_logradouro")), ("BAIRRO", c("p_bairro")), ("CIDADE", c("p_cidade")), ("UF", c("p_uf")))
    contract = labelled(("RAZAO", c("r_razao_social")), ("SITUACAO", c("r_situacao_cadastral")), ("CEP", r_cep))
    return checked.select(
        *[f"`{x}`" for x in rows.columns],
        c("x_doc").alias("Documento"),
        c("x_type").alias("Tipo"),
        c("x_cep").alias("CEP_Informado"),
        "Status_Validacao",
        "STATUS",
        label_chain(
            [((c("STATUS") == "CORRETO") & c("Status_Validacao").startswith("CEP"), "ALERTA"), (c("STATUS") == "CORRETO", "OK")], "ERRO"
        ).alias("SUBSTATUS"),
        "OBSERVACAO",
        base_text.alias("DADOS_BILLING"),
        F.when(company & known & ~(generic & F.lit(policy == "reject")), contract).alias("DADOS_CONTRATO"),
        F.when(person_ok & ~generic, truth).alias("DADOS_TABELA_VERDADE"),
    )
