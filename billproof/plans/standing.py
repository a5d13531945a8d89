"""Standing table: three billing systems in one layout, with derived flags, keys and change hash."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import cycle_of, in_cycle, norm_cycle, to_date_safe
from ..functions.keys import row_hash, row_key
from ..functions.numbers import money, norm_dbl, rate
from ..functions.text import NULL_TOKENS, norm_str, trimmed, trimmed_upper
from ..operators.aggregates import coverage
from ..operators.sets import union_strict
from . import rule_catalogue as K
from . import standing_layout as L

SYSTEMS = {
    "NG": (L.NG, L.NG_CYCLE),
    "ADAPTER": (L.ADAPTER, L.ADAPTER_CYCLE),
    "SIMETRA": (L.SIMETRA, L.SIMETRA_CYCLE),
}


def _convert(kind: str, c: Column) -> Column:
    if kind == "s":
        return trimmed(c)
    if kind == "up":
        return trimmed_upper(c)
    if kind == "d2":
        return money(c)
    if kind == "d4":
        return rate(c)
    if kind == "int":
        return c.try_cast("int")
    if kind == "br":
        return F.try_to_timestamp(trimmed(c), F.lit("dd/MM/yyyy")).cast("date")
    if kind == "ymd":
        return F.try_to_timestamp(c.cast("string"), F.lit("yyyyMMdd")).cast("date")
    if kind == "ts":
        return c.cast("date")
    if kind == "any":
        return to_date_safe(c)
    if kind == "cancel":
        # A NULL cancellation date means not cancelled.
        return F.when(trimmed(c) != "", F.lit("SIM")).otherwise(F.lit("NAO"))
    raise ValueError(f"unknown mapping kind {kind!r}")


def map_source(df: DataFrame, mapping: Mapping[str, object], strict: bool = True) -> dict[str, Column]:
    """Every target column from its source column, typed NULL where the system has none.

    strict=True demands every mapped source column; strict=False treats absent ones as NULL.
    """
    out = {}
    for target, kind in L.TARGETS.items():
        entry = mapping.get(target)
        how, source = entry if isinstance(entry, tuple) else (kind, entry)
        if source is None or (not strict and source not in df.columns):
            out[target] = F.lit(None).cast(L.SPARK_TYPES[kind])
        else:
            out[target] = _convert(how, F.col(source))
    return out


def extract(df: DataFrame, system: str, cycle: str | None, strict: bool = True) -> DataFrame:
    """One system in the standing layout, restricted to a cycle on the raw date column."""
    mapping, (date_column, encoding) = SYSTEMS[system]
    rows = df if cycle is None else df.where(in_cycle(F.col(date_column), cycle, encoding))
    return rows.select(
        F.lit(system).alias("sistema_origem"),
        cycle_of(F.col(date_column), encoding).alias("ciclo_faturamento"),
        *[e.alias(n) for n, e in map_source(df, mapping, strict).items()],
    )


def derived_flags() -> dict[str, Column]:
    c = F.col
    return {
        "ind_sem_cst": F.coalesce(c("iss_valor") > 0, F.lit(False)),
        "faturamento_zerado": F.coalesce(c("nf_item_valor") == 0, F.lit(True)),
        "fatura_sem_numero": c("nf_numero").isNull() | trimmed(c("nf_numero")).isin(*NULL_TOKENS["invoice"]),
        "ind_cancelada": F.coalesce(trimmed_upper(c("cancelada")) == "SIM", F.lit(False)),
    }


def build_standing(
    ng: DataFrame,
    adapter: DataFrame,
    simetra: DataFrame,
    cycle: str | None,
    loaded_at: dt.datetime,
    strict: bool = True,
) -> DataFrame:
    """The three systems united, with flags, id_registro (md5) and hash_registro (sha256)."""
    parts = {"NG": ng, "ADAPTER": adapter, "SIMETRA": simetra}
    united = union_strict(*[extract(df, system, cycle, strict) for system, df in parts.items()])
    stamp = F.lit(loaded_at).cast("timestamp")
    flagged = united.withColumns(
        derived_flags()
        | {
            "dt_carga": stamp,
            "dt_processamento": stamp,
            "id_registro": row_key(*[F.col(c) for c in L.KEYED]),
            "hash_registro": row_hash(*[F.col(c) for c in L.HASHED]),
        }
    )
    return flagged.select(*L.STANDING_COLUMNS)


MERGE_KEYS = ["id_registro", "ciclo_faturamento", "sistema_origem"]
CLUSTER_COLUMNS = ["sistema_origem", "uf_dest", "cfop", "cclass"]


# -- first generation -----------------------------------------------------------------------------------------------


def billable_ng(ng: DataFrame) -> DataFrame:
    """Not cancelled, not a substitution, not ICMS with a zero base. Rows with a NULL in a tested column drop out."""
    c = F.col
    zero_base = (trimmed_upper(c("CATEGORIA_FISCAL")) == "ICMS") & (c("ICMS_BASE_CALCULO").try_cast("double") == 0)
    return ng.where(
        (trimmed_upper(c("CANCELADA")) == "NAO") & (F.trim(c("STATUS_NFCOM")) != "SUBSTITUIÇÃO") & ~zero_base
    )


def extract_v1(df: DataFrame, system: str, cycle: str, loaded_at: dt.datetime, strict: bool = True) -> DataFrame:
    mapping = {"NG": L.V1_NG, "ADAPTER": L.V1_ADAPTER}[system]
    columns = []
    for target, source in mapping.items():
        kind = "double" if target in L.V1_NUMBERS else "string"
        if source is None or (not strict and source not in df.columns):
            value = F.lit(None).cast(kind)
        elif target == "posicao_item":
            value = F.col(source).cast("string")
        else:
            value = norm_dbl(F.col(source)) if kind == "double" else norm_str(F.col(source))
        columns.append(value.alias(target))
    mapped = df.select(
        F.lit(system).alias("sistema_origem"),
        F.lit(norm_cycle(cycle)).alias("ciclo_faturamento"),
        F.lit(loaded_at).cast("timestamp").alias("dt_carga"),
        *columns,
    )
    keys = [F.col(c) for c in L.V1_KEYED]
    return mapped.withColumns(
        {
            "id_registro": row_key(F.lit(system), *keys, F.lit(norm_cycle(cycle)), trim=False),
            "hash_registro": row_hash(*[F.col(c) for c in L.V1_HASHED], trim=False),
        }
    ).select(*L.V1_COLUMNS)


def build_standing_v1(
    ng: DataFrame, adapter: DataFrame, cycle_ng: str, cycle_adapter: str, loaded_at: dt.datetime, strict: bool = True
) -> DataFrame:
    """Two systems in the 51-column layout; only the first one has business exclusions."""
    return union_strict(
        extract_v1(billable_ng(ng), "NG", cycle_ng, loaded_at, strict),
        extract_v1(adapter, "ADAPTER", cycle_adapter, loaded_at, strict),
    )


# -- reports ----------------------------------------------------------------------------------------------------------


def _of_cycle(standing: DataFrame, cycle: str | None) -> DataFrame:
    return standing if cycle is None else standing.where(F.col("ciclo_faturamento") == norm_cycle(cycle))


def _total(column: str) -> Column:
    return F.round(F.sum(F.coalesce(F.col(column), F.lit(0))), 2)


def report_systems(standing: DataFrame, cycle: str | None = None) -> DataFrame:
    """Per system: items, contracts, notes, flag counts and amounts."""
    c = F.col
    amounts = {"valor_r": "nf_item_valor"} | {f"{t}_r": f"{t}_valor" for t in L.TAXES}
    return _of_cycle(standing, cycle).groupBy("sistema_origem").agg(
        F.count(F.lit(1)).alias("total_itens"),
        F.count_distinct("id_contrato").alias("contratos"),
        F.count_distinct("nf_numero").alias("notas"),
        F.count_if("faturamento_zerado").alias("zerados_pb000"),
        F.count_if("fatura_sem_numero").alias("sem_nf"),
        F.count_if("ind_cancelada").alias("canceladas"),
        F.count_if("ind_sem_cst").alias("itens_iss"),
        F.count_if(~c("ind_sem_cst")).alias("itens_icms"),
        *[_total(column).alias(name) for name, column in amounts.items()],
    )


def report_cfop(standing: DataFrame, cycle: str | None = None, issuer: str = "SP", n: int | None = 200) -> DataFrame:
    """Operation code by state: volume, amount and status; the n most frequent combinations (None: all)."""
    c = F.col
    lead = F.substring("cfop", 1, 1)
    # Status labels.
    status = (
        F.when(c("cfop").isNull(), "⚪ sem CFOP")
        .when(c("ind_sem_cst"), "🟡 ISS/indSemCST")
        .when(~c("cfop").isin(*K.CFOPS), "🔴 CFOP_INVALIDO")
        .when((c("uf_dest") == issuer) & (lead == "6"), "🔴 deveria 5xxx (intra)")
        .when((c("uf_dest") != issuer) & (lead == "5"), "🔴 deveria 6xxx (inter)")
        .otherwise("✅ OK")
    )
    keys = ["sistema_origem", "uf_dest", "cfop", "icms_cst", "ind_sem_cst"]
    out = (
        _of_cycle(standing, cycle)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("qtd"), F.round(F.sum("nf_item_valor"), 2).alias("valor_r"))
        .select("*", status.alias("status"))
    )
    return out if n is None else out.orderBy(F.desc("qtd"), *keys).limit(n)


def report_taxes(standing: DataFrame, cycle: str | None = None) -> DataFrame:
    """Contradictory taxation per system."""
    c = F.col
    service = c("ind_sem_cst")
    return _of_cycle(standing, cycle).groupBy("sistema_origem").agg(
        F.count_if((c("icms_valor") > 0) & (c("iss_valor") > 0)).alias("icms_iss_simult"),
        F.count_if(~service & (c("icms_aliquota") == 0)).alias("icms_aliq_zero"),
        F.count_if(~service & c("icms_cst").isNull()).alias("icms_sem_cst"),
        F.count_if(service & ((c("pis_valor") > 0) | (c("cofins_valor") > 0))).alias("pis_cofins_indev_iss"),
        F.count(F.lit(1)).alias("total"),
    )


def report_funds(standing: DataFrame, cycle: str | None = None) -> DataFrame:
    """FUST / FUNTTEL against the rule: charged on communication items only."""
    c = F.col
    service = c("ind_sem_cst")
    counts = []
    for fund in ("fust", "funttel"):
        value = c(f"{fund}_valor")
        counts += [
            F.count_if(~service & (value == 0)).alias(f"{fund}_zero_icms"),
            F.count_if(service & (value > 0)).alias(f"{fund}_indevido_iss"),
            _total(f"{fund}_valor").alias(f"total_{fund}_r"),
        ]
    kind = F.when(service, "ISS/SVA").otherwise("ICMS").alias("tipo")
    return _of_cycle(standing, cycle).groupBy("sistema_origem", kind).agg(*counts, F.count(F.lit(1)).alias("total"))


def report_zero(standing: DataFrame, cycle: str | None = None) -> DataFrame:
    """Zero bills and items without a note number."""
    rows = _of_cycle(standing, cycle).where(F.col("faturamento_zerado") | F.col("fatura_sem_numero"))
    return rows.groupBy("sistema_origem").agg(
        F.count_distinct("id_contrato").alias("contratos"),
        F.count_if("faturamento_zerado").alias("itens_zerados"),
        F.count_if("fatura_sem_numero").alias("sem_nf_numero"),
    )


def report_coverage(standing: DataFrame, cycle: str | None = None) -> DataFrame:
    """Percent of filled fields per system."""
    c = F.col
    present = {"pct_uf": "uf_dest", "pct_icms_aliq": "icms_aliquota", "pct_icms_cst": "icms_cst", "pct_pis": "pis_aliquota", "pct_fust": "fust_valor"}
    non_blank = {"pct_cfop": "cfop", "pct_cclass": "cclass", "pct_cpf_cnpj": "cpf_cnpj"}
    filled = {name: c(x).isNotNull() for name, x in present.items()}
    filled |= {name: c(x) != "" for name, x in non_blank.items()}
    filled["pct_chave_nfcom"] = ~c("chave_acesso_nfcom").isin("", "-", "0")
    return coverage(_of_cycle(standing, cycle), ["sistema_origem"], filled)


def report_v1_summary(standing: DataFrame) -> DataFrame:
    """Per system and cycle: rows, contracts, invoices, products and missing codes."""
    missing = {"sem_cclass": "cclass", "sem_cfop": "cfop", "sem_cst": "cst_icms", "sem_uf": "nf_uf"}
    return standing.groupBy("sistema_origem", "ciclo_faturamento").agg(
        F.count(F.lit(1)).alias("registros"),
        F.count_distinct("id_conta_contrato").alias("contratos"),
        F.count_distinct("fatura_numero").alias("faturas"),
        F.count_distinct("nf_item_cod_sap").alias("produtos"),
        *[F.count_if(F.col(x).isNull()).alias(name) for name, x in missing.items()],
    )


def report_without_class(standing: DataFrame, system: str = "ADAPTER", n: int = 50) -> DataFrame:
    """Most frequent products without a class code."""
    rows = standing.where((F.col("sistema_origem") == system) & F.col("cclass").isNull())
    return (
        rows.groupBy("nf_item_cod_sap", "nf_item_descricao")
        .agg(F.count(F.lit(1)).alias("ocorrencias"), F.count_distinct("fatura_numero").alias("faturas"))
        .orderBy(F.desc("ocorrencias"), "nf_item_cod_sap", "nf_item_descricao")
        .limit(n)
    )


def report_classes(standing: DataFrame, system: str = "NG", n: int = 30) -> DataFrame:
    """Most frequent class / operation / CST combinations with mean rates."""
    rows = standing.where(F.col("sistema_origem") == system)
    return (
        rows.groupBy("cclass", "cfop", "cst_icms")
        .agg(
            F.count(F.lit(1)).alias("ocorrencias"),
            F.round(F.avg("icms_aliquota"), 4).alias("icms_medio"),
            F.round(F.avg("pis_aliquota"), 4).alias("pis_medio"),
        )
        .withColumn("grupo_cclass", F.substring("cclass", 1, 1))
        .orderBy(F.desc("ocorrencias"), "cclass", "cfop", "cst_icms")
        .limit(n)
    )
