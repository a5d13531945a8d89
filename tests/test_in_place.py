"""Findings that stay where they are, marks of hashes, medians over counted values."""

import datetime as dt
import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from billproof.operators import joins as J
from billproof.plans import dataset as D
from billproof.plans import findings as P
from billproof.session import stored

DAY = dt.date(2026, 1, 1)
HUB = "FATURA string, ID_CONTA_CONTRATO string, REGRA string, STATUS string, CRM string, OBSERVACAO string, DADOS_BILLING string"
MORE = ("SUBSTATUS", "SEGMENTO", "Tipo_Servico", "Desc_Servico", "Tipo_Imposto", "Produto", "DADOS_CONTRATO", "DADOS_TABELA_VERDADE", "VALOR_BILLING", "VALOR_CONTRATO")


def _hub(rows, data):
    return rows(HUB, data).select("*", *[F.lit(None).cast("string").alias(c) for c in MORE], F.lit("L").alias("ID_Lote"), F.lit("p").alias("Promocao"))


def _data(seed, n, rules):
    rng = random.Random(seed)
    pick = lambda *values: rng.choice(values)
    return [
        (pick("f1", "f2", "f3", None), pick("a", "b", "c", None), pick(*rules), pick("ALERTA", "INCORRETO", "CORRETO"), pick("NG", " ng ", "AN", None), pick("x: y", " ", None), pick("1", "2", None))
        for _ in range(n)
    ]


def _bag(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.mark.parametrize(
    "rules", [P.RULES_DIRECT, [*P.RULES_DIRECT, "PRE-BILLING", "GAP_FATURAMENTO", None]], ids=["direct", "with others"]
)
def test_saved_findings_are_not_moved_for_the_tables(spark, rows, monkeypatch, rules):
    people = rows("IDCONTA string, IDCONTRATO string, CODIGOCLIENTE string, nome string, CPF_CNPJ string", [("a", "b", "b", "A", "1")])
    hub = stored(_hub(rows, _data(1, 300, rules) + [(f"f{i}", "z", rules[0], "ALERTA", "NG", "t", "1") for i in range(9, 90)]), "hub")
    accounts = P.account_rollup(hub, people, "L", dt.datetime(2026, 1, 1))
    for keep in (False, True):
        dealt = P.prepare_hub(hub, accounts, "L", keep)
        want = [_bag(make(dealt, DAY)) for make in (P.detail_of, P.tag_detail_of)]
        with monkeypatch.context() as m:
            m.setattr(P, "bucketed", None)
            there = P.prepare_hub(hub, accounts, "L", keep, saved=True)
        assert there.count() == dealt.count() and "Exchange hashpartitioning" not in there._jdf.queryExecution().executedPlan().toString()
        assert there.where("_alone AND ID_CONTA = 'z'").count() > 70
        assert [_bag(make(there, DAY)) for make in (P.detail_of, P.tag_detail_of)] == want
        assert len(want[0]) == len(set(want[0])) < there.count()
    monkeypatch.setattr(P, "FEW_INVOICES", -1)  # more invoices than are looked up by broadcast
    assert [_bag(make(P.prepare_hub(hub, accounts, "L", True, saved=True), DAY)) for make in (P.detail_of, P.tag_detail_of)] == want


def test_findings_are_made_once_for_the_accounts(spark, rows, tmp_path):
    people = rows("IDCONTA string, IDCONTRATO string, CODIGOCLIENTE string, nome string, CPF_CNPJ string", [("a", "b", "b", "A", "1")])
    path = str(tmp_path / "hub")
    _hub(rows, _data(3, 200, [*P.RULES_DIRECT, "PRE-BILLING", None])).write.parquet(path)
    make = lambda df, **more: P.account_rollup(df, people, "L", dt.datetime(2026, 1, 1), only_bad=False, **more)
    for hub in (spark.read.parquet(path), spark.read.parquet(path).drop("SEGMENTO", "Produto")):
        for limit in (16_000_000, 300):  # no account and some accounts have long texts
            once, again = make(hub, text_limit=limit), make(hub, text_limit=limit, saved=True)
            assert not any(path in name for name in once.inputFiles()) and any(path in name for name in again.inputFiles())
            assert _bag(once) == _bag(again) and once.count() == 16
    notes = {(r.ID_CONTA, r.SISTEMA): r.OBSERVACAO for r in make(spark.read.parquet(path)).collect()}
    for (account, system), text in notes.items():
        mine = [d for d in _data(3, 200, [*P.RULES_DIRECT, "PRE-BILLING", None]) if d[1] == account and {"AN": "SIMETRA", " ng ": "ng"}.get(d[4], d[4]) == system]
        tag = lambda d: d[5].split(":")[0].strip() if d[2] in P.RULES_TAG_IN_TEXT and d[5] is not None else d[2]
        want = [(f"{tag(d)}: {d[5]}" if d[5] and d[5].strip() else tag(d)) for d in mine if d[3] in P.BAD and tag(d) is not None]
        wrong = any(d[3] == "INCORRETO" for d in mine)
        assert (text or "") == (" | ".join(sorted(want)) if wrong else "")


def test_the_chain_does_not_deal_its_findings(spark, monkeypatch, rows):
    from registered import findings as Q

    hub = _hub(rows, _data(2, 200, P.RULES_DIRECT))
    people = rows("IDCONTA string, IDCONTRATO string, CODIGOCLIENTE string, nome string, CPF_CNPJ string", [("a", "b", "b", "A", "1")])
    monkeypatch.setattr(Q, "LOT", "L")
    monkeypatch.setattr(Q, "rules_hub", lambda spark, sf: hub)
    monkeypatch.setattr(Q, "customers", lambda spark, sf: people)
    monkeypatch.setattr(P, "bucketed", None)
    keys = {(r.FATURA, r.ID_CONTA_CONTRATO, r.REGRA, r.STATUS, r.OBSERVACAO) for r in hub.collect()}
    found = Q.d25_chain(spark, "").collect()
    assert len(found) == len(keys) and {(r.FATURA, r.ID_CONTA, r.REGRA, r.STATUS, r.OBSERVACAO) for r in found} == keys
    assert Q.d26_chain(spark, "").count() == len([k for k in keys if k[3] in P.BAD])


def test_marks_hold_every_hash(spark, monkeypatch):
    for n, most in ((0, 1 << 28), (3, 1 << 28), (3000, 1 << 28), (3000, 1 << 12)):
        monkeypatch.setattr(J, "MOST_MARKS", most)
        among = J.code_marks(spark.range(n).select(F.xxhash64("id").alias("h")), "h")
        got = among(spark.range(20000), F.xxhash64("id"), "m")
        assert got.columns == ["id", "m"]
        marked = {r.id for r in got.where("m").collect()}
        assert marked >= set(range(n))
        if most > 1 << 12:
            assert len(marked) - n < 0.06 * 20000


def test_medians_are_taken_from_counted_values(spark, monkeypatch):
    rng = random.Random(7)
    data = [(rng.choice([0.0, -0.0, 1.5, None]), rng.choice([math.nan, 2.0, math.inf]), rng.randint(0, 9), float(i), None) for i in range(1500)]
    df = spark.createDataFrame(data, "`a b` double, n double, i int, u double, none double").repartition(5)
    seen, real = {}, D.stored
    monkeypatch.setattr(D, "stored", lambda df, name: seen.setdefault(name, real(df, name)))
    found = D.exact_medians(df, df.columns)
    order = lambda v: (math.isnan(v), v)
    for at, name in enumerate(df.columns):
        own = sorted((float(r[at]) for r in data if r[at] is not None), key=order)
        if name == "none":
            assert found[name] is None
        else:
            middle = (own[(len(own) - 1) // 2] + own[len(own) // 2]) / 2
            assert found[name] == middle or (math.isnan(found[name]) and math.isnan(middle))
    counts = {r.c: (r.rows, r.n) for r in seen["values"].groupBy("c").agg(F.count("*").alias("rows"), F.sum("n").alias("n")).collect()}
    assert counts == {"a b": (2, sum(r[0] is not None for r in data)), "n": (3, 1500), "i": (10, 1500), "u": (1500, 1500)}
    assert found["u"] == statistics.median(range(1500)) == float(np.median([r[3] for r in data]))
