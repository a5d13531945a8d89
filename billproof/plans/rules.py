"""Tax and invoice rules over billed items: reference lookups, 26 flags, explosion into findings.

Each rule is a predicate over named facts of an item; all flags are built in one projection and the findings in one
explode, so an item crosses no Python worker and is shuffled only when a reference table is too big to broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col_or
from ..functions.dates import cycle_to_lot, norm_cycle, norm_cycle_col
from ..functions.keys import row_key
from ..functions.numbers import diverges, rate
from ..functions.text import (
    is_null_token,
    label_chain,
    strip_decimal_suffix,
    strip_leading_zeros,
    text_array,
    trimmed,
    trimmed_upper,
)
from ..operators.joins import cross_one_row, lookup, lookup_cascade
from . import rule_catalogue as K

ITEM_COLUMNS = [
    "CICLO", "CCLASS", "CCLASS_7D", "CFOP", "UF_DEST", "UF_EMIT_PARAMETRIZADA", "CST_ICMS", "ICMS_STANDING",
    "PIS_STANDING", "COFINS_STANDING", "FUST_STANDING", "FUNTTEL_STANDING", "ICMS_ESPERADO", "PIS_ESPERADO",
    "COFINS_ESPERADO", "FUST_ESPERADO", "FUNTTEL_ESPERADO", "REGIME_TRIB", "GRUPO_CCLASS", "FATURA_NUMERO",
    "ID_CLIENTE", "sistem_origem", "TIPO_FAT", "MUNICIPIO_PRESTACAO", "MUNICIPIO_DEST",
    "TIPO_SERVICO_ESPERADO_CCLASS", "TIPO_IMPOSTO_MESTRE", "IMPACTO_ICMS_ESTIMADO_R$",
]


def select_cycle(items: DataFrame, cycle: str) -> DataFrame:
    """Items of one cycle. CICLO may hold yyyyMM or yyyy-MM; both spellings are tested on the raw column so that the
    filter reaches the scan, and the exact comparison follows."""
    wanted = norm_cycle(cycle)
    raw = F.col("CICLO").cast("string")
    both = raw.contains(wanted) | raw.contains(cycle_to_lot(wanted))
    return items.where(both & (norm_cycle_col(F.col("CICLO")) == wanted))


def clean_items(items: DataFrame) -> DataFrame:
    """The rule inputs, absent columns as NULL, with cleaned codes under x_ names."""
    base = items.select(*[col_or(items, c).alias(c) for c in ITEM_COLUMNS])
    cst = strip_decimal_suffix(F.col("CST_ICMS"))
    blank = is_null_token(cst, "cst")
    return base.select(
        *[F.col(f"`{c}`") for c in ITEM_COLUMNS if c != "CFOP"],
        strip_decimal_suffix(F.col("CFOP")).alias("CFOP"),
        norm_cycle_col(F.col("CICLO")).alias("x_cycle"),
        strip_leading_zeros(F.col("CCLASS")).alias("x_class"),
        strip_leading_zeros(F.col("CCLASS_7D")).alias("x_class7"),
        cst.alias("x_cst"),
        blank.alias("x_cst_blank"),
        F.when(blank, F.lit(K.TAG_NO_CST)).otherwise(F.concat(F.lit(K.TAG_PREFIX), cst)).alias("x_tag_cst"),
    )


def attach_master(items: DataFrame, master: DataFrame) -> DataFrame:
    """Fiscal master by class code, then by the 7-digit code. x_mapped tells whether either was found."""
    dim = master.select(
        strip_leading_zeros(F.col("CCLASS_NFCON")).alias("k"),
        F.col("CST").cast("string").alias("cst"),
        F.col("TAX_UF_MUNICIPIO").alias("tag"),
    )
    found = lookup_cascade(
        items, dim, [("x_class", "k"), ("x_class7", "k")], {"cst": "x_m_cst", "tag": "x_m_tag"}, matched="x_try"
    )
    return found.withColumn("x_mapped", F.col("x_try").isNotNull()).drop("x_try")


def _says_icms(tag: Column) -> Column:
    return tag.isNotNull() & (tag.startswith(K.TAG_PREFIX) | tag.isin(*K.FORMER_TAGS))


def derive_tag(items: DataFrame) -> DataFrame:
    """x_tag_raw: tag from the item's CST, else from the master; x_tag: NULL unless valid; x_icms: either says ICMS."""
    own, master = F.col("x_tag_cst"), F.col("x_m_tag")
    raw = label_chain([(own.isin(*K.VALID_TAGS), own), (master.isin(*K.VALID_TAGS), master)], own)
    tagged = items.withColumn("x_tag_raw", raw)
    tag = F.when(F.col("x_tag_raw").isin(*K.VALID_TAGS), F.col("x_tag_raw"))
    return tagged.withColumns({"x_tag": tag, "x_icms": _says_icms(tag) | _says_icms(master)})


def state_rates(taxes: DataFrame) -> DataFrame:
    """One row per state with the rate of each tag set (the lowest positive one where several are listed)."""
    kind = trimmed_upper(F.col("TIPO_IMPOSTO"))
    value = rate(F.col("ALIQUOTA"))
    return (
        taxes.where(F.col("ALIQUOTA") > 0)
        .groupBy(trimmed_upper(F.col("ESTADO")).alias("state"))
        .agg(*[F.min(F.when(kind.isin(*tags), value)).alias(f"x_rate_{name}") for name, tags in K.RATE_TAGS.items()])
    )


def non_cumulative(taxes: DataFrame) -> DataFrame:
    """The non-cumulative PIS / COFINS pair: one row, or none when the table has no such entry."""
    pair = F.min(F.struct(rate(F.col("PIS")).alias("PIS"), rate(F.col("COFINS")).alias("COFINS"))).alias("p")
    only = taxes.where(trimmed_upper(F.col("TIPO_IMPOSTO")).isin(*K.NON_CUMULATIVE_TAGS)).agg(pair)
    return only.where(F.col("p").isNotNull()).select(F.col("p.PIS").alias("x_pis_nc"), F.col("p.COFINS").alias("x_cofins_nc"))


def attach_rates(items: DataFrame, taxes: DataFrame, strict: bool = False) -> DataFrame:
    """State rates, reference ICMS rate by CST, reference FUST / FUNTTEL.

    Without a PIS / COFINS entry in the tax table no item survives; strict=True keeps the items.
    """
    with_state = items.withColumn("x_state", trimmed_upper(F.col("UF_DEST")))
    names = {f"x_rate_{n}": f"x_rate_{n}" for n in K.RATE_TAGS}
    rated = lookup(with_state, state_rates(taxes), {"x_state": "state"}, names)
    rated = cross_one_row(rated, non_cumulative(taxes), strict=strict)
    cst = F.col("x_cst")
    reference = label_chain(
        [(cst == "0", F.col("x_rate_icms")), (cst == "51", F.col("x_rate_confaz")), (cst == "40", F.col("x_rate_estadual"))],
        F.coalesce(F.col("x_rate_icms"), rate(F.col("ICMS_ESPERADO"))),
    )
    zero = rate(F.lit(0))
    return rated.withColumns(
        {
            "x_icms_ref": reference,
            "x_fust_ref": F.when(F.col("x_icms"), rate(F.lit(K.FUST_RATE))).otherwise(zero),
            "x_funttel_ref": F.when(F.col("x_icms"), rate(F.lit(K.FUNTTEL_RATE))).otherwise(zero),
        }
    )


def prepare_items(
    items: DataFrame, master: DataFrame, taxes: DataFrame, cycle: str | None = None, strict: bool = False
) -> DataFrame:
    """Cycle filter, cleaning, master and rate lookups."""
    chosen = select_cycle(items, cycle) if cycle else items
    return attach_rates(derive_tag(attach_master(clean_items(chosen), master)), taxes, strict=strict)


@dataclass(frozen=True)
class Facts:
    """Named facts of a prepared item, as column expressions.

    By default a NULL regime, master CST, item CST or group makes the rules that negate it stay silent. With strict=True
    a NULL counts as 'not so', and those rules fire.
    """

    issuer: str = "RS"
    tolerance: float = 0.005
    strict: bool = False

    def _negatable(self, c: Column) -> Column:
        return F.coalesce(c, F.lit(False)) if self.strict else c

    def billed(self, tax: str) -> Column:
        return rate(F.col(f"{tax}_STANDING"))

    def billed_or_zero(self, tax: str) -> Column:
        return F.coalesce(self.billed(tax), rate(F.lit(0)))

    def off(self, billed: Column, expected: Column) -> Column:
        return diverges(billed, expected, self.tolerance)

    def off_all(self, tax: str, rates: tuple[float, ...]) -> Column:
        """The billed rate matches none of the legal ones."""
        first, *rest = [self.off(self.billed_or_zero(tax), rate(F.lit(r))) for r in rates]
        for other in rest:
            first = first & other
        return first

    @cached_property
    def mapped(self) -> Column:
        return F.col("x_mapped")

    @cached_property
    def icms(self) -> Column:
        return F.col("x_icms")

    @cached_property
    def cst_blank(self) -> Column:
        return F.col("x_cst_blank")

    @cached_property
    def simples(self) -> Column:
        return self._negatable(trimmed_upper(F.col("REGIME_TRIB")).contains("SIMPLES"))

    @cached_property
    def master_exempt(self) -> Column:
        return self._negatable(strip_decimal_suffix(F.col("x_m_cst")).isin(*K.CST_EXEMPT_MASTER))

    @cached_property
    def zero_rate_ok(self) -> Column:
        return self._negatable(F.col("x_cst").isin(*K.CST_ZERO_RATE_OK))

    @cached_property
    def master_tag(self) -> Column:
        tag = F.col("x_m_tag")
        return label_chain([(tag == old, new) for old, new in K.FORMER_TAGS.items()], tag)

    @cached_property
    def cfop(self) -> Column:
        return F.col("CFOP")

    @cached_property
    def has_cfop(self) -> Column:
        return ~is_null_token(self.cfop, "cfop")

    @cached_property
    def group(self) -> Column:
        return F.col("GRUPO_CCLASS").cast("string")

    def in_group(self, groups: list[str], negatable: bool = False) -> Column:
        test = self.group.isin(*groups)
        return self._negatable(test) if negatable else test

    @cached_property
    def icms_charged(self) -> Column:
        billed = self.billed("ICMS")
        return billed.isNotNull() & (billed > 0)

    @cached_property
    def to_state(self) -> Column:
        return F.col("x_state")

    @cached_property
    def from_state(self) -> Column:
        return trimmed_upper(F.coalesce(F.col("UF_EMIT_PARAMETRIZADA"), F.lit(self.issuer)))

    @cached_property
    def wrong_direction(self) -> Column:
        lead = F.substring(self.cfop, 1, 1)
        inside = self.to_state == self.from_state
        return (inside & (lead == "6")) | (~inside & (lead == "5"))

    def missing(self, column: str, kind: str) -> Column:
        return is_null_token(F.col(column), kind, upper=True)


# Predicates of the rules, by tag.
PREDICATES: dict[str, Callable[[Facts], Column]] = {
    "CST_INCOMPATIVEL_TRIBUTO": lambda f: f.mapped & f.icms & ~f.cst_blank & (F.col("x_tag_cst") != f.master_tag),
    "CST_ICMS_NULO": lambda f: f.mapped & f.icms & f.cst_blank & ~f.master_exempt,
    "ICMS_DIVERGENTE": lambda f: f.mapped & f.icms & ~f.cst_blank & f.off(f.billed("ICMS"), F.col("x_icms_ref")),
    "PIS_DIVERGENTE": lambda f: f.mapped & ~f.simples & f.icms & f.off_all("PIS", K.PIS_RATES),
    "COFINS_DIVERGENTE": lambda f: f.mapped & ~f.simples & f.icms & f.off_all("COFINS", K.COFINS_RATES),
    "PIS_COFINS_SIMPLES_ALERTA": lambda f: f.mapped
    & f.simples
    & (f.off_all("PIS", K.PIS_RATES) | f.off_all("COFINS", K.COFINS_RATES)),
    "FUST_INCORRETO": lambda f: f.mapped & f.off(f.billed_or_zero("FUST"), F.col("x_fust_ref")),
    "FUNTTEL_INCORRETO": lambda f: f.mapped & f.off(f.billed_or_zero("FUNTTEL"), F.col("x_funttel_ref")),
    "ICMS_SEM_ALIQUOTA": lambda f: f.icms & ~f.zero_rate_ok & (f.billed("ICMS").isNull() | (f.billed("ICMS") == 0)),
    "CCLASS_NAO_MAPEADO": lambda f: ~f.mapped,
    "CFOP_INVALIDO": lambda f: f.icms & f.has_cfop & ~f.cfop.isin(*K.CFOPS),
    "CFOP_INCOMPATIVEL_UF": lambda f: f.icms
    & f.has_cfop
    & f.cfop.isin(*K.CFOPS)
    & f.to_state.isin(*K.STATES)
    & f.wrong_direction,
    "CFOP_ICMS_COM_ISS": lambda f: f.has_cfop
    & f.mapped
    & f.in_group(K.GROUPS_COMMUNICATION)
    & f.cfop.isin(*K.CFOPS_SERVICE),
    "CFOP_SVA_COM_ICMS": lambda f: f.has_cfop
    & f.mapped
    & f.in_group(K.GROUPS_SERVICE)
    & f.cfop.isin(*K.CFOPS_COMMUNICATION),
    "CFOP_933_COM_CST": lambda f: f.cfop.isin(*K.CFOPS_SERVICE) & ~f.cst_blank,
    "ITEM_FINANCEIRO_COM_CFOP": lambda f: f.mapped & f.in_group(K.GROUPS_FINANCIAL) & f.has_cfop,
    "UF_DEST_INVALIDA": lambda f: f.missing("UF_DEST", "name") | ~f.to_state.isin(*K.STATES),
    "FATURA_SEM_NUMERO": lambda f: f.missing("FATURA_NUMERO", "name"),
    "CFOP_AUSENTE": lambda f: f.icms & ~f.cst_blank & ~f.has_cfop,
    "INDSEMCST_COM_CFOP": lambda f: f.mapped
    & ~f.icms
    & f.has_cfop
    & ~f.cfop.isin(*K.CFOPS_SERVICE)
    & ~f.in_group(K.GROUPS_FINANCIAL, negatable=True),
    "COFATURAMENTO_COM_ICMS": lambda f: f.in_group(K.GROUPS_COBILLING) & f.icms_charged,
    "FAT_CENTRALIZADO_COM_ICMS": lambda f: f.in_group(K.GROUPS_CENTRAL) & f.icms_charged,
    "MUNICIPIO_PRESTACAO_AUSENTE": lambda f: f.missing("MUNICIPIO_PRESTACAO", "municipality"),
    "TIPO_FAT_SUBSTITUICAO": lambda f: trimmed_upper(F.col("TIPO_FAT")) == "SUBSTITUIÇÃO",
    "MUNICIPIO_DEST_AUSENTE": lambda f: ~f.missing("UF_DEST", "name") & f.missing("MUNICIPIO_DEST", "name"),
    "CCLASS_7D_DIVERGENTE": lambda f: f.mapped & (F.col("x_class7") != F.col("x_class")),
}


@dataclass(frozen=True)
class Rule:
    tag: str
    category: str
    severity: str
    text: str
    predicate: Callable[[Facts], Column]

    @property
    def status(self) -> str:
        return K.STATUS_OF[self.severity]


RULES: list[Rule] = [Rule(tag, category, severity, text, PREDICATES[tag]) for tag, category, severity, text in K.RULE_TEXTS]


def rule_flags(prepared: DataFrame, rules: list[Rule] = RULES, facts: Facts = Facts()) -> DataFrame:
    """One boolean column per rule, named by its tag, in one projection. NULL means: not fired."""
    return prepared.select("*", *[r.predicate(facts).alias(r.tag) for r in rules])


def tax_rules(prepared: DataFrame, facts: Facts = Facts()) -> DataFrame:
    return rule_flags(prepared, [r for r in RULES if r.category == K.TAXES], facts)


def invoice_rules(prepared: DataFrame, facts: Facts = Facts()) -> DataFrame:
    return rule_flags(prepared, [r for r in RULES if r.category == K.INVOICE], facts)


# -- explosion ----------------------------------------------------------------------------------------------------


def explode_findings(flagged: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """One row per fired rule, and one OK row per category in which nothing fired.

    Keeps the other columns and adds regra, tag, status, substatus, observacao, hash_registro (sha256 of status,
    substatus and observacao) and regras_disparadas (all fired rules of the item's category).
    """
    categories = list(dict.fromkeys(r.category for r in rules))
    fired_text, nothing = {}, {}
    for category in categories:
        mine = [r for r in rules if r.category == category]
        texts = [F.when(F.col(r.tag), F.lit(f"{r.tag}[{r.severity}]")) for r in mine]
        count = sum((F.when(F.col(r.tag), 1).otherwise(0) for r in mine), F.lit(0))
        fired_text[category] = F.concat(F.lit("REGRAS_DISPARADAS("), count.cast("string"), F.lit("): "), F.concat_ws(" | ", *texts))
        nothing[category] = count == 0
    # Each candidate is the number of an entry of `entries`; NULL candidates vanish in the filter after the explode.
    entries = [(r.category, r.tag, r.status, r.severity, f"{r.tag}: {r.text}") for r in rules]
    entries += [(c, None, K.OK_STATUS, K.OK_SEVERITY, K.OK_TEXT) for c in categories]
    candidates = [F.when(F.col(r.tag), F.lit(i + 1)) for i, r in enumerate(rules)]
    candidates += [F.when(nothing[c], F.lit(len(rules) + i + 1)) for i, c in enumerate(categories)]
    keep = [F.col(f"`{c}`") for c in flagged.columns if c not in {r.tag for r in rules}]
    numbered = flagged.select(
        *keep,
        *[fired_text[c].alias(f"_fired{i}") for i, c in enumerate(categories)],
        F.explode(F.array(*candidates)).alias("_rule"),
    ).where(F.col("_rule").isNotNull())

    def pick(values: list[str | None]) -> Column:
        # An array of constants: folded once, so a row costs one index access.
        return F.element_at(text_array(values), F.col("_rule"))

    def entry(position: int) -> Column:
        return pick([e[position] for e in entries])

    hashes = pick([hashlib.sha256("|".join(e[2:5]).encode()).hexdigest() for e in entries])
    category = entry(0)
    fired = label_chain([(category == c, F.col(f"_fired{i}")) for i, c in enumerate(categories)])
    return numbered.select(
        *keep,
        category.alias("regra"),
        entry(1).alias("tag"),
        entry(2).alias("status"),
        entry(3).alias("substatus"),
        entry(4).alias("observacao"),
        hashes.alias("hash_registro"),
        F.when(entry(1).isNotNull(), fired).alias("regras_disparadas"),
    )


def _shown(column: str) -> Column:
    """Trimmed text for a payload; NULL and literal nulls show as ''."""
    text = f"trim(cast({column} AS string))"
    return F.expr(f"CASE WHEN {column} IS NULL OR lower({text}) IN ('nan', 'none', 'null') THEN '' ELSE {text} END")


def _payload(*pairs: tuple[str, Column]) -> Column:
    return F.concat(*[part for i, (label, value) in enumerate(pairs) for part in (F.lit(f"{' | ' if i else ''}{label}: "), value)])


def _given(column: str) -> Column:
    """A column of the library's own making: only NULL needs care."""
    return F.expr(f"coalesce(cast({column} AS string), '')")


def payload_columns(shown_issuer: str = "SP") -> dict[str, Column]:
    """Per item and category: what was billed and what was expected, as text."""
    c = F.col
    tags = [("TAG_VALIDADA", _given("x_tag")), ("TAG_CST", _given("x_tag_cst")), ("TAG_RAW", _given("x_tag_raw")), ("TAG_MESTRE", _shown("x_m_tag"))]
    standing = [(t, _shown(f"{t}_STANDING")) for t in ("ICMS", "PIS", "COFINS", "FUST", "FUNTTEL")]
    cst = _shown("x_cst")
    icms = label_chain(
        [
            (cst == "0", F.concat(F.lit("ICMS_CST_0 (aliq nominal UF): "), _given("x_rate_icms"))),
            (
                cst == "51",
                F.concat(F.lit("ICMS_CST_51 (diferimento CONFAZ): "), _given("x_rate_confaz"), F.lit(" — ICMS nao destacado")),
            ),
            (
                cst == "40",
                F.concat(F.lit("ICMS_CST_40 (isento estadual): "), _given("x_rate_estadual"), F.lit(" — aliq=0% nacional")),
            ),
        ],
        _payload(("ICMS_CST_0 (UF)", _given("x_rate_icms")), ("ICMS_ESPERADO_STANDING", _shown("ICMS_ESPERADO"))),
    )
    # Constant parts of the payloads.
    legal = F.lit(" | PIS_CUMUL: 0.65 | PIS_NC: 1.65 | COFINS_CUMUL: 3.0 | COFINS_NC: 7.6 | ")
    valid = F.lit(" | CFOPS_VALIDOS: 5301-5307,5933,6301-6307,6933,1205,7301 | REGRA_CFOP: mesma UF=5xxx outra UF=6xxx | ")
    financial = F.lit(" | GRUPOS_FIN: 100,110 (indSemCST sem CFOP)")
    issuer = F.coalesce(F.nullif(_shown("UF_EMIT_PARAMETRIZADA"), F.lit("")), F.lit(shown_issuer))
    master = [("CST_MESTRE", _shown("x_m_cst")), ("TAG_JOIN", _shown("x_m_tag"))]
    return {
        "_billed_taxes": _payload(*tags, *standing, ("CST", cst), ("REGIME", _shown("REGIME_TRIB"))),
        "_truth_taxes": F.concat(
            icms, legal, _payload(("FUST_RN004", _given("x_fust_ref")), ("FUNTTEL_RN004", _given("x_funttel_ref")), *master)
        ),
        "_billed_invoice": _payload(
            *tags,
            ("CCLASS", _shown("CCLASS")),
            ("CFOP", _shown("CFOP")),
            ("UF_DEST", _shown("UF_DEST")),
            ("CST", cst),
            ("GRUPO_CCLASS", _shown("GRUPO_CCLASS")),
            ("FATURA", _shown("FATURA_NUMERO")),
        ),
        "_truth_invoice": F.concat(F.lit("UF_EMISSORA: "), issuer, valid, _payload(*reversed(master)), financial),
    }


RATE_COLUMNS = {
    "icms_standing": "ICMS_STANDING", "icms_esperado": "ICMS_ESPERADO", "icms_verdade_uf": "x_rate_icms",
    "icms_confaz_uf": "x_rate_confaz", "icms_estadual_uf": "x_rate_estadual", "pis_standing": "PIS_STANDING",
    "cofins_standing": "COFINS_STANDING", "fust_standing": "FUST_STANDING", "funttel_standing": "FUNTTEL_STANDING",
    "pis_esperado": "PIS_ESPERADO", "cofins_esperado": "COFINS_ESPERADO", "fust_esperado": "FUST_ESPERADO",
    "funttel_esperado": "FUNTTEL_ESPERADO", "fust_rn004": "x_fust_ref", "funttel_rn004": "x_funttel_ref",
    "pis_nc": "x_pis_nc", "cofins_nc": "x_cofins_nc",
}
TEXT_COLUMNS = {
    "fatura_numero": "FATURA_NUMERO", "id_cliente": "ID_CLIENTE", "sistema_origem": "sistem_origem",
    "cclass": "CCLASS", "cfop": "CFOP", "uf_dest": "UF_DEST", "tipo_servico": "TIPO_SERVICO_ESPERADO_CCLASS",
    "regime_trib": "REGIME_TRIB", "tipo_imposto_mestre": "TIPO_IMPOSTO_MESTRE", "grupo_cclass": "GRUPO_CCLASS",
    "cst_icms": "x_cst", "cst_esperado_mestre": "x_m_cst", "tipo_trib_mestre": "x_m_tag", "tag_join_final": "x_tag",
}


def item_layout(flagged: DataFrame, cycle: str, issuer: str = "RS") -> DataFrame:
    """Everything that is the same for all findings of an item, built once before the explosion: texts ('' for NULL),
    rates as DECIMAL(8,4), impact as DECIMAL(18,2), payloads and the finding key of each category; plus the flags."""
    c = F.col
    emitted = F.coalesce(F.nullif(c("UF_EMIT_PARAMETRIZADA").cast("string"), F.lit("")), F.lit(issuer))
    keys = ["sistema_origem", "fatura_numero", "id_cliente", "cclass", "cfop"]

    def finding_key(category: str) -> Column:
        return row_key(*[c(TEXT_COLUMNS[k]) for k in keys], F.lit(category), F.lit(cycle), trim=False)

    return flagged.select(
        c("x_cycle").alias("ciclo_faturamento"),
        *[F.coalesce(c(f"`{source}`").cast("string"), F.lit("")).alias(name) for name, source in TEXT_COLUMNS.items()],
        emitted.alias("uf_emit"),
        *[rate(c(source)).alias(name) for name, source in RATE_COLUMNS.items()],
        c("`IMPACTO_ICMS_ESTIMADO_R$`").try_cast("decimal(18,2)").alias("impacto_icms_r"),
        *[text.alias(name) for name, text in payload_columns().items()],
        finding_key(K.TAXES).alias("_key_taxes"),
        finding_key(K.INVOICE).alias("_key_invoice"),
        *[r.tag for r in RULES],
    )


def finding_layout(exploded: DataFrame) -> DataFrame:
    """Final finding columns: payloads and key of the finding's own category.

    id_validacao leaves the tag out, so the findings of one item and category share it.
    """
    c = F.col
    of_taxes = c("regra") == K.TAXES

    def own(name: str) -> Column:
        return F.when(of_taxes, c(f"_{name}_taxes")).otherwise(c(f"_{name}_invoice"))

    fired = F.when(c("regras_disparadas").isNull(), F.lit("")).otherwise(F.concat(c("regras_disparadas"), F.lit(" | ")))
    return exploded.select(
        "ciclo_faturamento",
        *TEXT_COLUMNS,
        "uf_emit",
        "regra",
        "status",
        "substatus",
        "observacao",
        own("billed").alias("dados_billing"),
        F.concat(fired, own("truth")).alias("dados_tabela_verdade"),
        *RATE_COLUMNS,
        "impacto_icms_r",
        own("key").alias("id_validacao"),
        "hash_registro",
    )


def findings(
    items: DataFrame,
    master: DataFrame,
    taxes: DataFrame,
    cycle: str,
    issuer: str = "RS",
    tolerance: float = 0.005,
    strict: bool = False,
) -> DataFrame:
    """The whole rule job: 40-column findings of one cycle, with keys and fixed decimals."""
    facts = Facts(issuer=issuer.strip().upper(), tolerance=tolerance, strict=strict)
    flagged = rule_flags(prepare_items(items, master, taxes, cycle, strict), RULES, facts)
    return finding_layout(explode_findings(item_layout(flagged, cycle, facts.issuer)))


def to_hub(findings_df: DataFrame, cycle: str, loaded_at: Column) -> DataFrame:
    """Findings in the 28-column layout of the hub that the roll-ups read. loaded_at: the run's timestamp."""
    none = F.lit(None).cast("string")
    no_value = F.lit(None).cast("double")
    c = F.col
    return findings_df.select(
        c("fatura_numero").alias("FATURA"),
        c("id_cliente").alias("ID_CONTA_CONTRATO"),
        c("regra").alias("REGRA"),
        c("status").alias("STATUS"),
        c("substatus").alias("SUBSTATUS"),
        c("observacao").alias("OBSERVACAO"),
        c("dados_billing").alias("DADOS_BILLING"),
        none.alias("DADOS_CONTRATO"),
        c("dados_tabela_verdade").alias("DADOS_TABELA_VERDADE"),
        none.alias("Produto"),
        c("tipo_servico").alias("Tipo_Servico"),
        none.alias("Desc_Servico"),
        c("tipo_imposto_mestre").alias("Tipo_Imposto"),
        none.alias("Promocao"),
        none.alias("Grupo_Localidade"),
        F.lit(cycle_to_lot(cycle)).alias("ID_Lote"),
        c("sistema_origem").alias("CRM"),
        no_value.alias("JUROS_MULTA"),
        no_value.alias("VALOR_DESCONTO"),
        loaded_at.cast("timestamp").alias("DT_CARGA"),
        loaded_at.cast("timestamp").alias("DT_ATUALIZACAO"),
        c("fatura_numero").alias("NUMERO_FATURA"),
        no_value.alias("VALOR_BILLING"),
        no_value.alias("VALOR_CONTRATO"),
        no_value.alias("VALOR_TABELA_VERDADE"),
        none.alias("DESCONTOS_NOMES"),
        none.alias("dt_cancelamento"),
        F.lit("NFCOM").alias("SEGMENTO"),
    )
