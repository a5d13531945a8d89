"""Reference records from JSON texts: list unwrapping, alternative field names, nested lists, provider layouts.

Works on tables of fetched documents (one JSON text per row). Texts are parsed once per row on the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import digits_only, null_tokens, pad_left
from ..operators.sets import priority_union

# Keys under which an envelope may hold its list.
LIST_KEYS = ["itens", "aliquotas", "data", "result", "results", "content"]

# Alternative field names of a rate item.
RATE_FIELDS = {
    "codigo_servico": ["codigoServico", "codigo_servico", "codServico"],
    "codigo_trecho": ["codigoTrecho", "codigo_trecho", "codTrecho"],
    "aliquota": ["aliquota", "aliq", "taxaIss"],
    "aliquota_efetiva": ["aliquotaEfetiva", "aliquota_efetiva", "aliqEfetiva"],
    "inicio_vigencia": ["inicioVigencia", "inicio_vigencia", "dtInicioVigencia"],
    "fim_vigencia": ["fimVigencia", "fim_vigencia", "dtFimVigencia"],
}
RATE_NUMBERS = ("aliquota", "aliquota_efetiva")
BAD_JSON, NO_DATA, NO_SECTIONS, OK = "json_invalido", "sem_dados", "sem_trechos", "ok"


def field(item: Column, names: Sequence[str]) -> Column:
    """First filled alternative of a field; empty texts and zero numbers count as not filled."""
    tried = [F.get_json_object(item, f"$.{n}") for n in names]
    return F.coalesce(*[F.when(~t.isin("", "0", "0.0", "false"), t) for t in tried])


def item_list(text: Column) -> Column:
    """Items of a document as raw JSON texts: a root list, the list under a known key, or the document itself."""
    under = [F.get_json_object(text, f"$.{k}") for k in LIST_KEYS]
    lists = [F.when(F.ltrim(t).startswith("["), t) for t in [text, *under]]
    return F.from_json(F.coalesce(*lists, F.concat(F.lit("["), text, F.lit("]"))), "array<string>")


def parse_items(
    documents: DataFrame, json: str, fields: dict[str, Sequence[str]], numbers: Sequence[str] = ()
) -> DataFrame:
    """One row per item with the given fields, the raw item and a status; a document that cannot be read or has no
    items yields one row with that status instead."""
    valid = F.try_parse_json(F.col(json)).isNotNull()
    listed = documents.withColumn("_items", F.when(valid, item_list(F.col(json))))
    rows = listed.select("*", F.explode_outer("_items").alias("_item"))
    status = F.when(F.col("_items").isNull(), BAD_JSON).when(F.size("_items") == 0, NO_DATA).otherwise(OK)
    columns = []
    for name, names in fields.items():
        value = field(F.col("_item"), names)
        columns.append((value.try_cast("double") if name in numbers else null_tokens(value, "rates")).alias(name))
    raw = F.when(F.col("_item").isNotNull(), F.col("_item")).otherwise(F.col(json))
    return rows.select(
        *[f"`{c}`" for c in documents.columns if c != json], *columns, F.nullif(raw, F.lit("")).alias("json_retorno"), status.alias("status")
    )


def parse_rates(documents: DataFrame, json: str = "json") -> DataFrame:
    return parse_items(documents, json, RATE_FIELDS, RATE_NUMBERS).withColumn("fonte", F.lit("NFS-e Nacional"))


SECTION = "array<struct<nomeContrato:string,codigoContrato:string,nomeTrecho:string,aliquotas:array<string>>>"


def parse_section_rates(documents: DataFrame, json: str = "json") -> DataFrame:
    """Two-level documents: dados[] with contract names, each with aliquotas[]. A contract without its own list is its
    own section; missing rates count as 0."""
    text = F.col(json)
    valid = F.try_parse_json(text).isNotNull()
    inner = F.when(F.ltrim(text).startswith("["), text).otherwise(F.get_json_object(text, "$.dados"))
    as_list = F.when(F.ltrim(inner).startswith("["), inner).otherwise(F.concat(F.lit("["), inner, F.lit("]")))
    base = documents.select(
        *[f"`{c}`" for c in documents.columns if c != json],
        valid.alias("_valid"),
        F.arrays_zip(F.from_json(as_list, SECTION).alias("parsed"), F.from_json(as_list, "array<string>").alias("raw")).alias("_contracts"),
    )
    contracts = base.select("*", F.explode_outer("_contracts").alias("_c"))
    own = F.coalesce(F.col("_c.parsed.aliquotas"), F.when(F.col("_c").isNotNull(), F.array(F.col("_c.raw"))))
    rows = contracts.withColumn("_own", own).select("*", F.explode_outer("_own").alias("_s"))
    section = F.col("_s")

    def number(name: str) -> Column:
        raw = F.get_json_object(section, f"$.{name}")
        return F.when(section.isNotNull(), F.when(raw.isNull() | (raw == ""), F.lit(0.0)).otherwise(raw.try_cast("double")))

    def text_of(name: str) -> Column:
        return F.get_json_object(section, f"$.{name}")

    status = (
        F.when(~F.col("_valid"), BAD_JSON)
        .when(F.col("_contracts").isNull() | (F.size("_contracts") == 0), NO_DATA)
        .when(section.isNull(), NO_SECTIONS)
        .otherwise(OK)
    )
    return rows.select(
        *[f"`{c}`" for c in documents.columns if c != json],
        text_of("codigoTrecho").alias("codigo_trecho"),
        F.col("_c.parsed.nomeTrecho").alias("nome_trecho"),
        F.coalesce(F.nullif(F.col("_c.parsed.nomeContrato"), F.lit("")), F.col("_c.parsed.codigoContrato")).alias("nome_contrato"),
        number("aliquota").alias("aliquota"),
        number("aliquotaEfetiva").alias("aliquota_efetiva"),
        number("percentual").alias("percentual"),
        number("extensao").alias("extensao"),
        text_of("dhInicioVigencia").alias("inicio_vigencia"),
        text_of("dhFimVigencia").alias("fim_vigencia"),
        text_of("situacao").alias("situacao"),
        F.lit("NFS-e Via").alias("fonte"),
        status.alias("status"),
        section.alias("json_retorno"),
    )


def pick(items: Column, preferred: Callable[[Column], Column]) -> Column:
    """First array element that satisfies the predicate, else the first element."""
    return F.coalesce(F.get(F.filter(items, preferred), F.lit(0)), F.get(items, F.lit(0)))


# -- providers ------------------------------------------------------------------------------------------------------

NESTED = (
    "nomeEmpresarial string, nomeFantasia string, situacaoCadastral struct<codigo:string,descricao:string,data:string,motivo:string>, "
    "naturezaJuridica struct<codigo:string,descricao:string>, dataAbertura string, cnaePrincipal struct<codigo:string,descricao:string>, "
    "porte struct<codigo:string,descricao:string>, capitalSocial string, correioEletronico string, "
    "telefones array<struct<ddd:string,numero:string>>, "
    "enderecos array<struct<tipo:string,cep:string,logradouro:string,numero:string,complemento:string,bairro:string,municipio:string,uf:string>>"
)
FLAT = (
    "razao_social string, nome_fantasia string, descricao_situacao_cadastral string, data_situacao_cadastral string, "
    "descricao_motivo_situacao_cadastral string, descricao_natureza_juridica string, data_inicio_atividade string, cnae_fiscal bigint, "
    "cnae_fiscal_descricao string, descricao_porte string, capital_social double, opcao_pelo_simples boolean, opcao_pelo_mei boolean, "
    "email string, ddd_telefone_1 string, cep string, logradouro string, numero string, complemento string, bairro string, municipio string, uf string"
)


def _nested_record() -> dict[str, Column]:
    p = F.from_json(F.col("json"), NESTED)
    address = pick(p["enderecos"], lambda e: e["tipo"] == "ESTABELECIMENTO")
    phone = F.get(p["telefones"], F.lit(0))
    code = F.coalesce(digits_only(address["cep"]), F.lit(""))
    town = F.coalesce(F.get_json_object(address["municipio"], "$.descricao"), address["municipio"])

    def label(name: str) -> Column:
        return F.coalesce(F.nullif(p[name]["descricao"], F.lit("")), p[name]["codigo"])

    return {
        "razao_social": p["nomeEmpresarial"],
        "nome_fantasia": p["nomeFantasia"],
        "situacao_cadastral": label("situacaoCadastral"),
        "data_situacao_cadastral": p["situacaoCadastral"]["data"],
        "motivo_situacao_cadastral": p["situacaoCadastral"]["motivo"],
        "natureza_juridica": label("naturezaJuridica"),
        "data_inicio_atividade": p["dataAbertura"],
        "cnae_principal_codigo": digits_only(p["cnaePrincipal"]["codigo"]),
        "cnae_principal_descricao": p["cnaePrincipal"]["descricao"],
        "porte": label("porte"),
        "capital_social": F.regexp_replace(p["capitalSocial"], ",", "."),
        "email": p["correioEletronico"],
        "telefone": F.when(phone.isNotNull(), F.concat(F.coalesce(phone["ddd"], F.lit("")), F.coalesce(phone["numero"], F.lit("")))),
        "receita_cep": F.when(F.length(code) >= 7, pad_left(code, 8)),
        "receita_logradouro": address["logradouro"],
        "receita_numero": address["numero"],
        "receita_complemento": address["complemento"],
        "receita_bairro": address["bairro"],
        "receita_municipio": town,
        "receita_uf": address["uf"],
    }


def _flat_record() -> dict[str, Column]:
    p = F.from_json(F.col("json"), FLAT)
    code = F.trim(F.regexp_replace(F.coalesce(p["cep"], F.lit("")), r"[-.]", ""))
    renamed = {
        "situacao_cadastral": "descricao_situacao_cadastral", "motivo_situacao_cadastral": "descricao_motivo_situacao_cadastral",
        "natureza_juridica": "descricao_natureza_juridica", "cnae_principal_codigo": "cnae_fiscal",
        "cnae_principal_descricao": "cnae_fiscal_descricao", "porte": "descricao_porte", "opcao_simples": "opcao_pelo_simples",
        "opcao_mei": "opcao_pelo_mei", "telefone": "ddd_telefone_1",
    }
    same = ["razao_social", "nome_fantasia", "data_situacao_cadastral", "data_inicio_atividade", "capital_social", "email"]
    address = {f"receita_{n}": p[n] for n in ("logradouro", "numero", "complemento", "bairro", "municipio", "uf")}
    return (
        {n: p[n] for n in same}
        | {target: p[source] for target, source in renamed.items()}
        | address
        | {"receita_cep": F.when(code != "", pad_left(code, 8))}
    )


REGISTRY_LAYOUTS = {"nested": _nested_record, "flat": _flat_record}


def normalise_registry(raw: DataFrame, layout: str) -> DataFrame:
    """Registry documents of one provider in the 25-column record. raw: cnpj, http_status, json, data_consulta.

    Literal nulls become NULL; a document that is not HTTP 200 keeps only its key, time and status.
    """
    record = REGISTRY_LAYOUTS[layout]()
    good = F.col("http_status") == 200
    status = F.when(good, "ok").when(F.col("http_status").isNull(), "timeout").otherwise(
        F.concat(F.lit("erro_http_"), F.col("http_status").cast("string"))
    )
    columns = []
    for f in schemas.REGISTRY.fields:
        if f.name in ("cnpj", "data_consulta"):
            columns.append(F.col(f.name).cast("string").alias(f.name))
        elif f.name == "status_consulta":
            columns.append(status.alias(f.name))
        elif f.name not in record:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            value = record[f.name]
            kind = f.dataType.simpleString()
            clean = value if kind == "boolean" else null_tokens(value.cast("string"), "registry").try_cast(kind)
            columns.append(F.when(good, clean).alias(f.name))
    return raw.select(*columns)


# Postcode providers in the order in which they are asked, and their field names.
_LOCAL = {"logradouro": "logradouro", "bairro": "bairro", "cidade": "localidade", "uf": "uf", "complemento": "complemento"}
POSTCODE_PROVIDERS = {
    "Correios API": _LOCAL,
    "ViaCEP": _LOCAL,
    "BrasilAPI": {"logradouro": "street", "bairro": "neighborhood", "cidade": "city", "uf": "state"},
    "OpenCEP": _LOCAL,
}


def normalise_postcodes(raw: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Postcode documents of several providers in one record per postcode; the first provider with an answer wins.

    raw: cep, provider, http_status, json, data_consulta. wanted: optional table with `cep`; postcodes nobody answered
    come back with status nao_encontrado.
    """
    answers = []
    for rank, (provider, names) in enumerate(POSTCODE_PROVIDERS.items()):
        def get(key: str) -> Column:
            return F.get_json_object(F.col("json"), f"$.{key}")

        usable = (F.col("provider") == provider) & (F.col("http_status") == 200) & F.try_parse_json("json").isNotNull()
        if provider == "ViaCEP":
            usable = usable & ~F.coalesce(get("erro").isin("true", "1"), F.lit(False))
        if provider in ("BrasilAPI", "OpenCEP"):
            usable = usable & (F.coalesce(get("cep"), F.lit("")) != "")
        fields = {n: null_tokens(get(names[n]), "registry") if n in names else F.lit(None).cast("string") for n in ("logradouro", "bairro", "cidade", "uf", "complemento")}
        found = raw.where(usable).select(
            "cep", *[e.alias(n) for n, e in fields.items()], F.lit(provider).alias("fonte"), F.col("data_consulta").cast("string").alias("data_consulta"), F.lit("ok").alias("status_consulta")
        )
        answers.append((found, -rank))
    asked = (wanted if wanted is not None else raw).groupBy("cep")
    times = asked.agg(F.max("data_consulta").cast("string").alias("data_consulta")) if wanted is None else wanted.select("cep").distinct().withColumn("data_consulta", F.lit(None).cast("string"))
    nothing = times.select(
        "cep", *[F.lit(None).cast("string").alias(n) for n in ("logradouro", "bairro", "cidade", "uf", "complemento", "fonte")], "data_consulta", F.lit("nao_encontrado").alias("status_consulta")
    )
    return priority_union([*answers, (nothing, -len(POSTCODE_PROVIDERS))], "cep").select(*schemas.POSTCODE.fieldNames())
