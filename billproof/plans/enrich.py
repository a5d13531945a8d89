"""Reference tables: missing keys, registry ingest from a bulk file, postcode directory, document report."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.documents import cnpj_valid, postcode_key
from ..functions.text import digits_only, null_tokens, pad_left, parse_bool, trimmed
from ..operators.joins import keep_existing, keep_missing, lookup
from ..operators.sets import distinct_keys, priority_union
from ..operators.updates import upsert
from .address import usable


def missing_documents(rows: DataFrame, registry: DataFrame, column: str = "CPF_CNPJ") -> DataFrame:
    """Distinct valid company numbers that the registry table does not hold yet."""
    doc = digits_only(F.col(column))
    wanted = rows.select(doc.alias("cnpj")).where(F.length("cnpj") == 14).distinct().where(cnpj_valid(F.col("cnpj")))
    return keep_missing(wanted, usable(registry), {"cnpj": "cnpj"})


def missing_postcodes(rows: DataFrame, registry: DataFrame, postcodes: DataFrame) -> DataFrame:
    """Distinct postcodes of customers (both addresses) and of the registry that the postcode table does not hold."""
    c = F.col
    sources = [(rows, postcode_key(c("cep_instalacao"))), (rows, postcode_key(c("cep_legal")))]
    sources.append((usable(registry).where(F.length("receita_cep") == 8), c("receita_cep")))
    wanted = distinct_keys(sources, "cep").where(c("cep") != "00000000")
    return keep_missing(wanted, usable(postcodes), {"cep": "cep"})


# Column of a bulk dump for each registry field.
DUMP_COLUMNS = {
    "cnpj": "CNPJ", "razao_social": "RAZAO_SOCIAL", "nome_fantasia": "NOME_FANTASIA",
    "situacao_cadastral": "SITUACAO_CADASTRAL", "data_situacao_cadastral": "DATA_SITUACAO_CADASTRAL",
    "motivo_situacao_cadastral": "MOTIVO_SITUACAO_CADASTRAL", "natureza_juridica": "NATUREZA_JURIDICA",
    "data_inicio_atividade": "DATA_INICIO_ATIVIDADE", "cnae_principal_codigo": "CNAE_FISCAL",
    "cnae_principal_descricao": "CNAE_FISCAL_DESCRICAO", "porte": "PORTE", "capital_social": "CAPITAL_SOCIAL",
    "opcao_simples": "OPCAO_SIMPLES", "opcao_mei": "OPCAO_MEI", "email": "EMAIL", "telefone": "TELEFONE",
    "receita_cep": "CEP", "receita_logradouro": "LOGRADOURO", "receita_numero": "NUMERO",
    "receita_complemento": "COMPLEMENTO", "receita_bairro": "BAIRRO", "receita_municipio": "MUNICIPIO",
    "receita_uf": "UF",
}


def registry_from_dump(dump: DataFrame, mapping: Mapping[str, str] = DUMP_COLUMNS, loaded_at: str | None = None) -> DataFrame:
    """Bulk file in the registry layout; fields without a column in the file are NULL."""
    if mapping.get("cnpj") not in dump.columns:
        raise ValueError("the dump has no column for the company number")
    columns: list[Column] = []
    for f in schemas.REGISTRY.fields:
        source = mapping.get(f.name)
        if f.name == "cnpj":
            value = pad_left(digits_only(F.col(source)), 14)
        elif f.name == "data_consulta":
            value = F.lit(loaded_at)
        elif f.name == "status_consulta":
            value = F.lit("ok")
        elif source is None or source not in dump.columns:
            value = F.lit(None)
        else:
            text = null_tokens(F.col(f"`{source}`"), "registry")
            kind = f.dataType.simpleString()
            if kind == "boolean":
                value = parse_bool(text)
            elif kind == "bigint":
                value = digits_only(text).try_cast("bigint")
            else:
                value = text.try_cast(kind)
        columns.append(value.cast(f.dataType).alias(f.name))
    return dump.select(*columns)


def new_registry_records(
    dump: DataFrame, rows: DataFrame, cache: DataFrame, mapping: Mapping[str, str] = DUMP_COLUMNS, loaded_at: str | None = None
) -> DataFrame:
    """Records of the dump for customers of the base that are not loaded yet, one per company."""
    wanted = rows.select(pad_left(digits_only(F.col("CPF_CNPJ")), 14).alias("cnpj"))
    records = registry_from_dump(dump, mapping, loaded_at)
    fresh = keep_missing(keep_existing(records, wanted, {"cnpj": "cnpj"}), usable(cache), {"cnpj": "cnpj"})
    return priority_union([(fresh, 0)], "cnpj")


def ingest_registry(
    dump: DataFrame, rows: DataFrame, cache: DataFrame, mapping: Mapping[str, str] = DUMP_COLUMNS, loaded_at: str | None = None
) -> DataFrame:
    """The registry table after the ingest."""
    return upsert(cache, new_registry_records(dump, rows, cache, mapping, loaded_at), ["cnpj"], check=False)


def build_postcode_dim(
    street: DataFrame, locality: DataFrame, district: DataFrame, big_user: DataFrame, community_box: DataFrame
) -> DataFrame:
    """Postcode directory: streets, overruled by big users, overruled by community boxes."""
    c = F.col

    def text(name: str) -> Column:
        return F.coalesce(c(name), F.lit(""))

    towns = {"LOC_NO": "town"}
    areas = {"BAI_NO": "area"}
    s = lookup(lookup(street, locality, {"LOC_NU": "LOC_NU"}, towns), district, {"BAI_NU_INI": "BAI_NU"}, areas)
    g = lookup(lookup(big_user, locality, {"LOC_NU": "LOC_NU"}, towns), district, {"BAI_NU": "BAI_NU"}, areas)
    b = lookup(community_box, locality, {"LOC_NU": "LOC_NU"}, towns)

    def shaped(df: DataFrame, road: Column, area: Column, extra: Column) -> DataFrame:
        return df.select(
            trimmed(c("CEP")).alias("cep"),
            road.alias("logradouro"),
            area.alias("bairro"),
            text("town").alias("cidade"),
            text("UFE_SG").alias("uf"),
            extra.alias("complemento"),
        )

    road = F.trim(F.concat_ws(" ", F.trim(text("TLO_TX")), F.trim(text("LOG_NO"))))
    return priority_union(
        [
            (shaped(s, road, text("area"), text("LOG_COMPLEMENTO")), 1),
            (shaped(g, text("GRU_ENDERECO"), text("area"), text("GRU_NO")), 2),
            (shaped(b, text("CPC_ENDERECO"), F.lit(""), text("CPC_NO")), 3),
        ],
        "cep",
    )


def document_report(rows: DataFrame, registry: DataFrame, column: str = "cnpj_informado") -> DataFrame:
    """Given number, its digits, whether the check digits hold, and the registry fields or why they are missing."""
    c = F.col
    report = rows.select(c(column).alias("cnpj_informado")).withColumns(
        {"cnpj_normalizado": digits_only(c("cnpj_informado")), "cnpj_valido": cnpj_valid(c("cnpj_informado"))}
    )
    keyed = report.withColumn("_k", F.when(c("cnpj_valido"), c("cnpj_normalizado")))
    fields = {"razao_social": "razao_social", "nome_fantasia": "nome_fantasia", "situacao_cadastral": "descricao_situacao_cadastral", "receita_uf": "uf", "receita_municipio": "municipio", "status_consulta": "_status"}
    found = lookup(keyed, registry, {"_k": "cnpj"}, fields)
    status = F.when(~c("cnpj_valido"), "nao_consultado_cnpj_invalido").otherwise(F.coalesce(c("_status"), F.lit("nao_consultado")))
    return found.select(
        "cnpj_informado", "cnpj_normalizado", "cnpj_valido", status.alias("api_status"), "razao_social", "nome_fantasia", "descricao_situacao_cadastral", "uf", "municipio"
    )


def document_summary(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count(F.lit(1)).alias("total_cnpjs"), F.count_if("cnpj_valido").alias("validos"), F.count_if(~F.col("cnpj_valido")).alias("invalidos")
    )
