"""How rows move: NULL keys, one look-up for several tries, accounts and hub rows that travel once, k-means passes."""

import contextlib
import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from billproof.operators import clusters
from billproof.operators import joins as J
from billproof.plans import findings as P
from billproof.plans import segmentation as S


@contextlib.contextmanager
def _shuffles(spark):
    """No broadcasts of its own accord and no merged partitions, but adaptive skew handling."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _plan(df):
    return df._jdf.queryExecution().toString()


def test_null_keys_are_dealt_over_the_reducers(spark):
    rows = spark.range(0, 8000, 1, 8).select("id", F.when(F.col("id") % 8 == 0, (F.col("id") % 40).cast("string")).alias("k"))
    dim = spark.range(0, 30).select(F.col("id").cast("string").alias("key"), (F.col("id") * 10).alias("v"))
    with _shuffles(spark):
        out = J.lookup(rows, dim, {"k": "key"}, {"v": "v"})
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 8000 and max(sizes) < 4000
        assert out.columns == ["id", "k", "v"]
        got = {r["id"]: (r["k"], r["v"]) for r in out.collect()}
        assert all(got[i] == ((str(i % 40), i % 40 * 10 if i % 40 < 30 else None) if i % 8 == 0 else (None, None)) for i in range(8000))
        left = J.keep_missing(rows, dim, {"k": "key"})
        assert left.columns == ["id", "k"]
        assert left.count() == 7000 + 200 and left.where("k IS NULL").count() == 7000
        assert max(r["count"] for r in left.groupBy(F.spark_partition_id()).count().collect()) < 4000


def test_tries_of_one_column_are_one_join(spark, rows):
    dim = rows("a string, b string, nome string", [("1", "2", "x"), ("1", "1", "w"), ("3", "1", None), (None, "4", "z"), ("3", None, "y")])
    df = rows("k string", [("1",), ("2",), ("3",), ("4",), ("5",), (None,)])
    out = J.lookup_cascade(df, dim, [("k", "a"), ("k", "b")], {"nome": "nome"}, matched="try")
    with _shuffles(spark):
        assert {r["k"]: (r["nome"], r["try"]) for r in out.collect()} == {
            "1": ("w", 1), "2": ("x", 2), "3": (None, 1), "4": ("z", 2), "5": (None, None), None: (None, None),
        }
        logical = out._jdf.queryExecution().optimizedPlan().toString()
        assert logical.count("Join LeftOuter") == 1


HUB = "FATURA string, ID_CONTA_CONTRATO string, REGRA string, STATUS string, CRM string"
MORE = ("SUBSTATUS", "OBSERVACAO", "SEGMENTO", "Tipo_Servico", "Desc_Servico", "Tipo_Imposto", "Produto", "DADOS_BILLING", "DADOS_CONTRATO", "DADOS_TABELA_VERDADE", "VALOR_BILLING", "VALOR_CONTRATO")


def _hub(rows, data):
    return rows(HUB, data).select("*", *[F.lit(None).cast("string").alias(c) for c in MORE], F.lit("L").alias("ID_Lote"), F.lit("p").alias("Promocao"))


def test_accounts_with_short_texts_take_one_aggregate(rows):
    hub = _hub(rows, [("f1", "a", "GAP", "INCORRETO", "NG"), ("f2", "a", "GAP", "ALERTA", "NG"), (None, "a", "OUTRA", "CORRETO", "AN"), ("f2", "b", "GAP", "ALERTA", None), ("f3", None, "GAP", "ALERTA", "NG")])
    people = rows("IDCONTA string, IDCONTRATO string, CODIGOCLIENTE string, nome string, CPF_CNPJ string", [("a", "b", "b", "A", "1")])
    make = lambda limit: P.account_rollup(hub, people, "L", dt.datetime(2026, 1, 1), only_bad=False, text_limit=limit)
    short = make(1000)
    assert "_least" not in _plan(short)  # no text is counted, measured and dealt out
    mixed = make(25)  # account a has longer texts than that, the others have not
    assert "_least" in _plan(mixed)
    keep = [c for c in short.columns if c not in P.TEXT_COLUMNS]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, short.select(keep).collect())) == sorted(map(key, make(40).select(keep).collect()))
    got = {(r.ID_CONTA, r.SISTEMA): r for r in short.collect()}
    assert got["a", "NG"].FATURA == "f1 | f2" and got["a", "NG"].OBSERVACAO == "GAP | GAP" and got["a", "NG"].NOME_CLIENTE == "A"
    assert got["a", "SIMETRA"].FATURA == "" and got["b", None].NOME_CLIENTE == "A" and got["b", None].Ordem_Status == 0
    assert got[None, "NG"].FATURA == "f3" and got[None, "NG"].NOME_CLIENTE is None


def test_hub_rows_move_once(spark, rows):
    data = [
        ("f1", "a", "PRE-BILLING", "ALERTA", "NG"),  # a: known, pre-billing in NG
        ("f2", "a", "VALIDACAO_NFCOM", "ALERTA", " ng "),
        ("f2", "a", "VALIDACAO_NFCOM", "ALERTA", "ADAPTER"),
        (None, "a", "VALIDACAO_NFCOM", "CORRETO", "NG"),
        (None, "a", "GAP", "CORRETO", "AN"),
        ("f3", "b", "PRE BILLING", "ALERTA", "NG"),  # b: unknown
        ("f3", "b", "VALIDACAO_IMPOSTOS", "ALERTA", "NG"),
        (None, "b", "GAP", "ALERTA", "NG"),
        ("f4", None, "PRE-BILLING", "ALERTA", "NG"),
        ("f4", None, "VALIDACAO_NFCOM", "ALERTA", "NG"),
        ("f5", "a", None, "ALERTA", "NG"),
    ]
    hub = _hub(rows, data)
    known = rows("ID_CONTA string", [("a",), ("a",), (None,)])
    for use, keep_null in ((data, False), (data, True), ([x for x in data if x[0]], False)):
        table = P.prepare_hub(_hub(rows, use), known, "L", keep_null)
        assert "Promocao" not in table.columns and "ID_CONTA_CONTRATO" not in table.columns
        got = sorted(map(str, (tuple(r) for r in table.select("FATURA", "ID_CONTA", "REGRA", "CRM", "_prebilling").collect())))
        want = []
        for f, a, rule, _, crm in use:
            direct = rule in P.RULES_DIRECT
            if direct or (a == "a" and (rule is not None or keep_null)):
                want.append(str((f, a, rule, crm, "SIM" if a == "a" and crm.strip().upper() == "NG" else "NAO")))
        assert got == sorted(want)
    kept = P.relevant_findings(hub, known, "L")
    assert kept.columns == hub.columns and kept.count() == 7


def test_a_pass_of_kmeans_adds_up(spark):
    rng = np.random.default_rng(3)
    rows = np.vstack([rng.normal(size=(30000, 3)), np.zeros((5, 3))])
    df = spark.createDataFrame([tuple(map(float, r)) for r in rows], "a double, b double, c double").repartition(3)
    centres = rng.normal(size=(4, 6, 3))
    centres[0, 1] = centres[0, 0]  # a tie goes to the smaller number
    got = {(r["start"], r["centre"]): r for r in clusters._sums(df, centres)}
    for s in range(4):
        away = ((rows[:, None, :] - centres[s][None]) ** 2).sum(axis=2)
        mine = away.argmin(axis=1)
        for c in range(6):
            at = mine == c
            assert ((s, c) in got) == bool(at.any())
            if at.any():
                r = got[s, c]
                assert r["n"] == at.sum()
                assert np.allclose([r["away"], r["s0"], r["s1"], r["s2"]], [away[at, c].sum(), *rows[at].sum(axis=0)])
    assert clusters._sums(df.where("a > 1000"), centres) == []


def test_a_class_of_labels_does_not_meet_in_one_task(spark):
    df = spark.range(0, 4000, 1, 4).select("id", F.when(F.col("id") % 10 < 9, "ALTA").otherwise("BAIXA").alias("y"))
    with _shuffles(spark):
        out = S.class_weights(df, "y")
        assert max(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()) == 1000
        assert {r["y"]: round(r["_weight"], 6) for r in out.select("y", "_weight").distinct().collect()} == {"ALTA": round(4000 / 7200, 6), "BAIXA": 5.0}


def test_both_sides_of_the_merge_share_their_exchange(spark, rows, tmp_path):
    from registered import standing as Q

    day = dt.date(1998, 3, 5), dt.date(2001, 1, 1)
    lines = [(k, n, k + n, k % 12, 10.0 * n, 0.05, "AN"[n % 2]) for k in range(60) for n in range(1, 8)]
    kinds = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_tax double, l_returnflag string"
    rows(kinds, lines + lines[:9] + [(None,) + lines[0][1:]]).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(k, k % 7 if k % 11 else None, "OPF"[k % 3], day[k % 2] if k % 13 else None) for k in range(60)]
    rows("o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate date", orders).write.parquet(f"{tmp_path}/orders.parquet")
    rows("c_custkey long, c_nationkey int", [(k, k) for k in range(6)] + [(None, 1)]).write.parquet(f"{tmp_path}/customer.parquet")
    with _shuffles(spark):
        merged = Q.d1_merge(spark, str(tmp_path))
        got = merged.collect()
        plan = merged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert sum("Exchange hashpartitioning(id_registro" in x and "ReusedExchange" not in x for x in plan.splitlines()) == 1
    want = {(r["id_registro"], r["ciclo_faturamento"], r["sistema_origem"]): r["h"] for r in Q.standing(spark, str(tmp_path)).groupBy("id_registro", "ciclo_faturamento", "sistema_origem").agg(F.min("hash_registro").alias("h")).collect()}
    assert {(r["id_registro"], r["ciclo_faturamento"], r["sistema_origem"]) for r in got} == set(want) and len(got) >= len(want) > 100
    for r in got:
        cycle, system = r["ciclo_faturamento"], r["sistema_origem"]
        if cycle is not None:
            assert r["hash_registro"] == want[r["id_registro"], cycle, system]
            assert r["acao"] == ("insert" if cycle > "199912" else "update" if system == "NG" else "keep")


def test_partitions_are_written_without_sorting_a_task(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from billproof.sources import tables as T

    name, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (seen.append(spark.conf.get(name)), write(self, *a, **k))[1])
    before, path = spark.conf.get(name), str(tmp_path / "t")
    values = [f"v{i}" for i in range(3 * T.OPEN_FILES)]  # more than a task keeps open
    value = F.when(F.col("id") % 50 == 7, None).otherwise(F.concat(F.lit("v"), F.col("id") % len(values)))
    df = spark.range(0, 5000, 1, 2).select("id", value.alias("regra"), F.lit("a").alias("lote"))
    want = {(r["id"], r["regra"]) for r in df.collect() if r["regra"] in values[:-1]}
    for _ in range(2):
        assert T.replace_slice(df, path, "lote", "a", "regra", values[:-1])["rows"] == len(want)
    assert T.replace_slice(df.where("regra = 'v1'"), path, "lote", "a", "regra", ["v1", "v2"])["v2"] == 0
    got = spark.read.parquet(path).select("id", "regra").collect()
    assert {tuple(r) for r in got} == {x for x in want if x[1] != "v2"} and len(got) == len({r["id"] for r in got})
    T.append(df, str(tmp_path / "u"), ["regra"])
    assert spark.read.parquet(str(tmp_path / "u")).where("regra IS NULL").count() == df.where("regra IS NULL").count()
    assert seen.count(str(T.OPEN_FILES)) == 4 and spark.conf.get(name) == before
