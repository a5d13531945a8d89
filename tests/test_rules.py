"""Each rule: an item that fires it, one that does not, and what a NULL input does by default and in strict mode."""

import pytest
from pyspark.sql import functions as F

from billproof.plans import rule_catalogue as K
from billproof.plans import rules as P

CLEAN = {
    "CICLO": "2026-07", "CCLASS": "0100101", "CCLASS_7D": "100101", "CFOP": "5301", "UF_DEST": "RS",
    "UF_EMIT_PARAMETRIZADA": "RS", "CST_ICMS": "0", "ICMS_STANDING": "17", "PIS_STANDING": "0.65",
    "COFINS_STANDING": "3", "FUST_STANDING": "1", "FUNTTEL_STANDING": "0.5", "ICMS_ESPERADO": "17",
    "REGIME_TRIB": "REAL", "GRUPO_CCLASS": "10", "FATURA_NUMERO": "1", "ID_CLIENTE": "c", "sistem_origem": "NG",
    "TIPO_FAT": "Normal", "MUNICIPIO_PRESTACAO": "X", "MUNICIPIO_DEST": "Y",
}
MASTER = [("100101", "0", "ICMS_CST_0"), ("200", "40", "ICMS_CST_40"), ("300", None, "SEM"), ("400", None, "ICMS"), ("500", "41.0", "ICMS_CONFAZ")]
SERVICE = {"CCLASS": "300", "CCLASS_7D": "300", "CST_ICMS": None, "ICMS_STANDING": None, "FUST_STANDING": "0", "FUNTTEL_STANDING": "0", "CFOP": None, "GRUPO_CCLASS": "60"}

# tag: (changes that fire it, changes that keep it silent)
CASES = {
    "CST_INCOMPATIVEL_TRIBUTO": ({"CST_ICMS": "40"}, {"CST_ICMS": "0.0"}),
    "CST_ICMS_NULO": ({"CST_ICMS": "nan"}, {"CST_ICMS": None, "CCLASS": "200", "CCLASS_7D": "200"}),
    "ICMS_DIVERGENTE": ({"ICMS_STANDING": "12"}, {"ICMS_STANDING": "0.17"}),
    "PIS_DIVERGENTE": ({"PIS_STANDING": None}, {"PIS_STANDING": "0.0165"}),
    "COFINS_DIVERGENTE": ({"COFINS_STANDING": "5"}, {"COFINS_STANDING": "7.6"}),
    "PIS_COFINS_SIMPLES_ALERTA": ({"REGIME_TRIB": "simples nacional", "PIS_STANDING": "9"}, {"REGIME_TRIB": "SIMPLES"}),
    "FUST_INCORRETO": ({"FUST_STANDING": None}, {"FUST_STANDING": "0.01"}),
    "FUNTTEL_INCORRETO": ({"FUNTTEL_STANDING": "1"}, {"FUNTTEL_STANDING": "0.005"}),
    "ICMS_SEM_ALIQUOTA": ({"ICMS_STANDING": "0"}, {"ICMS_STANDING": "0", "CST_ICMS": "40"}),
    "CCLASS_NAO_MAPEADO": ({"CCLASS": "9", "CCLASS_7D": "9"}, {"CCLASS": "9"}),
    "CFOP_INVALIDO": ({"CFOP": "5101"}, {"CFOP": "1205"}),
    "CFOP_INCOMPATIVEL_UF": ({"CFOP": "6301"}, {"CFOP": "6301", "UF_DEST": "SP"}),
    "CFOP_ICMS_COM_ISS": ({"CFOP": "5933.0"}, {"CFOP": "5933", "GRUPO_CCLASS": "60"}),
    "CFOP_SVA_COM_ICMS": ({"GRUPO_CCLASS": "60"}, {"GRUPO_CCLASS": "60", "CFOP": "5933"}),
    "CFOP_933_COM_CST": ({"CFOP": "6933"}, {"CFOP": "6933", "CST_ICMS": None}),
    "ITEM_FINANCEIRO_COM_CFOP": ({"GRUPO_CCLASS": "100"}, {"GRUPO_CCLASS": "100", "CFOP": "null"}),
    "UF_DEST_INVALIDA": ({"UF_DEST": None}, {"UF_DEST": " sp "}),
    "FATURA_SEM_NUMERO": ({"FATURA_NUMERO": "NaN"}, {"FATURA_NUMERO": "0"}),
    "CFOP_AUSENTE": ({"CFOP": ""}, {**SERVICE}),
    "INDSEMCST_COM_CFOP": ({**SERVICE, "CFOP": "5301"}, {**SERVICE, "CFOP": "5933"}),
    "COFATURAMENTO_COM_ICMS": ({"GRUPO_CCLASS": "130"}, {"GRUPO_CCLASS": "130", "ICMS_STANDING": "0"}),
    "FAT_CENTRALIZADO_COM_ICMS": ({"GRUPO_CCLASS": "12"}, {"GRUPO_CCLASS": "12", "ICMS_STANDING": None}),
    "MUNICIPIO_PRESTACAO_AUSENTE": ({"MUNICIPIO_PRESTACAO": "nao informado"}, {"MUNICIPIO_PRESTACAO": "-"}),
    "TIPO_FAT_SUBSTITUICAO": ({"TIPO_FAT": " Substituição "}, {"TIPO_FAT": None}),
    "MUNICIPIO_DEST_AUSENTE": ({"MUNICIPIO_DEST": None}, {"MUNICIPIO_DEST": None, "UF_DEST": "none"}),
    "CCLASS_7D_DIVERGENTE": ({"CCLASS_7D": "200"}, {"CCLASS_7D": None}),
}
# Silent by default because a NULL is negated; fires in strict mode.
NULL_CASES = {
    "PIS_DIVERGENTE": {"REGIME_TRIB": None, "PIS_STANDING": "9"},
    "COFINS_DIVERGENTE": {"REGIME_TRIB": None, "COFINS_STANDING": "9"},
    "CST_ICMS_NULO": {"CST_ICMS": None, "CCLASS": "400", "CCLASS_7D": "400"},
    "ICMS_SEM_ALIQUOTA": {"CST_ICMS": None, "ICMS_STANDING": None},
    "INDSEMCST_COM_CFOP": {**SERVICE, "CFOP": "5301", "GRUPO_CCLASS": None},
}


def items(spark, changes):
    schema = ", ".join(f"{c} string" for c in CLEAN)
    data = [tuple({**CLEAN, **c, "ID_CLIENTE": str(i)}[k] for k in CLEAN) for i, c in enumerate(changes)]
    return spark.createDataFrame(data, schema)


def references(spark, with_nc=True):
    master = spark.createDataFrame([(f"00{a}", b, c) for a, b, c in MASTER], "CCLASS_NFCON string, CST string, TAX_UF_MUNICIPIO string")
    taxes = [("rs ", "ICMS", 17.0, None, None), ("SP", "ICMS_CST_0", 18.0, None, None)]
    if with_nc:
        taxes.append((None, "PIS_COFINS", 0.0, 1.65, 7.6))
    return master, spark.createDataFrame(taxes, "ESTADO string, TIPO_IMPOSTO string, ALIQUOTA double, PIS double, COFINS double")


def fired(spark, changes, strict=False):
    master, taxes = references(spark)
    prepared = P.prepare_items(items(spark, changes), master, taxes, "202607")
    flagged = P.rule_flags(prepared, facts=P.Facts(strict=strict)).orderBy(F.col("ID_CLIENTE").cast("int"))
    return [{t for t, *_ in K.RULE_TEXTS if r[t]} for r in flagged.collect()]


def test_catalogue_is_complete():
    assert len(P.RULES) == 26 and set(CASES) == {r.tag for r in P.RULES} == set(P.PREDICATES)
    assert [r.category for r in P.RULES].count(K.TAXES) == 9


def test_clean_item_fires_nothing(spark):
    assert fired(spark, [{}]) == [set()]


def test_every_rule_fires_and_stays_silent(spark):
    tags = list(CASES)
    got = fired(spark, [CASES[t][0] for t in tags] + [CASES[t][1] for t in tags])
    for i, t in enumerate(tags):
        assert t in got[i], f"{t} should fire"
        assert t not in got[len(tags) + i], f"{t} should be silent"


@pytest.mark.parametrize("strict", [False, True])
def test_null_inputs(spark, strict):
    tags = list(NULL_CASES)
    got = fired(spark, [NULL_CASES[t] for t in tags], strict)
    assert [t in g for t, g in zip(tags, got)] == [strict] * len(tags)


def test_explosion_counts_and_text(spark):
    master, taxes = references(spark)
    changes = [{}, {"ICMS_STANDING": "12", "FUST_STANDING": None, "FATURA_NUMERO": None}]
    out = P.findings(items(spark, changes), master, taxes, "2026-07").collect()
    mine = sorted((r for r in out if r.id_cliente == "1"), key=lambda r: r.observacao)
    assert [r.regra for r in out if r.id_cliente == "0"].count(K.TAXES) == 1
    assert [(r.status, r.observacao.split(":")[0]) for r in mine] == [("ALERTA", "FATURA_SEM_NUMERO"), ("ALERTA", "FUST_INCORRETO"), ("ALERTA", "ICMS_DIVERGENTE")]
    truth = mine[2].dados_tabela_verdade
    assert truth.startswith("REGRAS_DISPARADAS(2): ICMS_DIVERGENTE[ALERTA] | FUST_INCORRETO[ALERTA] | ICMS_CST_0 (aliq nominal UF): 17.0000 | PIS_CUMUL: 0.65")
    assert "UF_EMISSORA: RS | CFOPS_VALIDOS" in mine[0].dados_tabela_verdade
    assert len({r.id_validacao for r in mine}) == 2  # the key leaves the tag out
    assert len(out[0]) == 42 - 2 + 2


def test_missing_pis_cofins_empties_the_cycle(spark):
    master, taxes = references(spark, with_nc=False)
    data = items(spark, [{}])
    assert P.prepare_items(data, master, taxes, "2026-07").count() == 0
    assert P.prepare_items(data, master, taxes, "2026-07", strict=True).count() == 1


def test_cycle_spellings(spark):
    data = items(spark, [{"CICLO": "202607"}, {"CICLO": " 2026-07"}, {"CICLO": "2026-08"}, {"CICLO": None}, {"CICLO": "12026-07"}])
    assert [P.select_cycle(data, c).count() for c in ("2026-07", "202607")] == [2, 2]


def test_hub_layout(spark):
    master, taxes = references(spark)
    out = P.to_hub(P.findings(items(spark, [{}]), master, taxes, "202607"), "202607", F.lit("2026-07-31 00:00:00"))
    assert len(out.columns) == 28
    assert {(r.ID_Lote, r.SEGMENTO) for r in out.collect()} == {("2026-07", "NFCOM")}
