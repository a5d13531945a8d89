"""Edge rows of the findings, address and revenue operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from billproof import schemas
from billproof.plans import address as P
from billproof.plans import findings as FD
from billproof.plans import revenue as R
from billproof.plans import segmentation as S

NOW = dt.datetime(2026, 7, 31, 10, 0)
HUB = (
    "FATURA string, ID_CONTA_CONTRATO string, REGRA string, STATUS string, SUBSTATUS string, OBSERVACAO string, DADOS_BILLING string, DADOS_CONTRATO string, "
    "DADOS_TABELA_VERDADE string, Produto string, Tipo_Servico string, Desc_Servico string, Tipo_Imposto string, ID_Lote string, CRM string, VALOR_BILLING string, "
    "VALOR_CONTRATO string, SEGMENTO string, FAIXA string"
)


def hub(rows, entries):
    names = [c.split()[0] for c in HUB.split(", ")]
    base = dict.fromkeys(names) | {"ID_Lote": "2026-07", "CRM": "NG", "STATUS": "CORRETO", "SUBSTATUS": "OK"}
    return rows(HUB, [tuple({**base, **e}[n] for n in names) for e in entries])


def customers(rows):
    return rows(
        "IDCONTA string, IDCONTRATO string, CODIGOCLIENTE string, nome string, CPF_CNPJ string",
        [("1", "9", "9", "Um", "d1"), ("8", "2", "8", "Dois", None), ("7", "7", "2", "Codigo", "d2"), ("3", None, None, " ", "x")],
    )


def test_account_rollup_edges(rows):
    data = hub(
        rows,
        [
            {"ID_CONTA_CONTRATO": "1", "FATURA": "b", "REGRA": "PRE-BILLING", "STATUS": "INCORRETO", "OBSERVACAO": "o1", "VALOR_BILLING": "1.5", "Produto": "P"},
            {"ID_CONTA_CONTRATO": "1", "FATURA": "a", "REGRA": "VALIDACAO_NFCOM", "STATUS": "ALERTA", "OBSERVACAO": "T: x", "VALOR_BILLING": " "},
            {"ID_CONTA_CONTRATO": "1", "FATURA": "a", "REGRA": "GAP", "STATUS": "CORRETO", "VALOR_BILLING": "2"},
            {"ID_CONTA_CONTRATO": "1", "REGRA": "GAP", "STATUS": "ALERTA", "CRM": "SIMETRA(AN)"},
            {"ID_CONTA_CONTRATO": "2", "REGRA": "PRE BILLING", "STATUS": "INCORRETO", "CRM": "AN "},
            {"ID_CONTA_CONTRATO": "2", "REGRA": "GAP", "STATUS": "ALERTA", "CRM": None},
            {"ID_CONTA_CONTRATO": "5", "REGRA": "GAP", "STATUS": "CORRETO"},
        ],
    )
    got = {(r.ID_CONTA, r.SISTEMA): r for r in FD.account_rollup(data, customers(rows), "2026-07", NOW).collect()}
    assert set(got) == {("1", "NG"), ("1", "SIMETRA"), ("2", "SIMETRA"), ("2", None)}
    ng = got[("1", "NG")]
    assert (ng.STATUS, ng.FATURA, ng.PROBLEMA, ng.VALOR, ng.Ordem_Status, ng.POSSUI_PREBILLING, ng.ANALISTA) == (
        "INCORRETO", "a | b", "PRE-BILLING | VALIDACAO_NFCOM", 3.5, 4, "SIM", "PRE-BILLING",
    )
    assert ng.OBSERVACAO == ng.RESUMO == "P: o1 | T: T: x" and ng.NOME_CLIENTE == "Um" and ng.CPF_CNPJ == "d1"
    alert = got[("1", "SIMETRA")]
    assert (alert.STATUS, alert.STATUS_VALIDACAO, alert.PROBLEMA, alert.OBSERVACAO) == ("ALERTA", "PENDENTE", None, None)
    old = got[("2", "SIMETRA")]
    # only the hyphen spelling names an analyst and weighs 2; pre-billing exists in two systems only
    assert (old.ANALISTA, old.Ordem_Status, old.POSSUI_PREBILLING, old.NOME_CLIENTE, old.CPF_CNPJ) == (None, 1, "NAO", "Dois", "d2")
    assert got[("2", None)].Ordem_Status == 0


def test_detail_edges(rows):
    data = hub(
        rows,
        [
            {"ID_CONTA_CONTRATO": "1", "REGRA": "VALOR FATURA", "STATUS": "ALERTA", "Produto": "P", "FAIXA": " 0-9 ", "VALOR_BILLING": "5", "VALOR_CONTRATO": "6"},
            {"ID_CONTA_CONTRATO": "1", "REGRA": "PRE BILLING", "STATUS": "CORRETO"},
            {"ID_CONTA_CONTRATO": "1", "REGRA": "DIVERGENCIA_CONTRATO_PRODUTO", "STATUS": "INCORRETO", "DADOS_CONTRATO": "c", "DADOS_TABELA_VERDADE": "v", "VALOR_CONTRATO": "6"},
            {"ID_CONTA_CONTRATO": "4", "REGRA": "GAP", "STATUS": "INCORRETO"},
            {"ID_CONTA_CONTRATO": "4", "REGRA": "VALIDACAO_NFCOM", "STATUS": "INCORRETO", "OBSERVACAO": " "},
            {"ID_CONTA_CONTRATO": "1", "REGRA": None, "STATUS": "INCORRETO"},
        ],
    )
    accounts = rows("ID_CONTA string", [("1",), ("1",)])
    got = {r.REGRA: r for r in FD.detail(data, accounts, "2026-07", NOW.date()).collect()}
    assert set(got) == {"VALOR FATURA", "PRE BILLING", "DIVERGENCIA_CONTRATO_PRODUTO", "VALIDACAO_NFCOM"}
    assert FD.detail(data, accounts, "2026-07", NOW.date(), keep_null_rule=True).count() == 5
    value = got["VALOR FATURA"]
    assert (value.TAG, value.DADOS_KENAN, value.DADOS_TABELA_VERDADE, value.POSSUI_PREBILLING) == ("P - 0-9", "5", "6", "SIM")
    contract = got["DIVERGENCIA_CONTRATO_PRODUTO"]
    assert (contract.DADOS_KENAN, contract.DADOS_TABELA_VERDADE) == ("c", "v")
    assert got["PRE BILLING"].TAG is None and got["VALIDACAO_NFCOM"].POSSUI_PREBILLING == "NAO"
    tags = {r.REGRA: r for r in FD.tag_detail(data, accounts, "2026-07", NOW.date()).collect()}
    assert tags["DIVERGENCIA_CONTRATO_PRODUTO"].DADOS_KENAN == "6" and tags["DIVERGENCIA_CONTRATO_PRODUTO"].DADOS_TABELA_VERDADE == "6"
    assert "PRE BILLING" not in tags and tags["VALOR FATURA"].POSSUI_PREBILLING == "SIM"


def test_text_parts_cover_long_accounts(rows):
    data = hub(rows, [{"ID_CONTA_CONTRATO": "1", "REGRA": "GAP", "STATUS": "INCORRETO", "OBSERVACAO": f"o{i}"} for i in range(40)])
    parts = FD.account_text_parts(data, "2026-07", limit=60).collect()
    assert len(parts) > 3
    assert sorted(" | ".join(p._notes for p in parts).split(" | ")) == sorted(f"GAP: o{i}" for i in range(40))
    tables = {n: FD.account_rollup(data, customers(rows), "2026-07", NOW, text_limit=n) for n in (60, 1_000_000)}
    cut, whole = (t.collect() for t in tables.values())
    assert tables[60].schema == tables[1_000_000].schema and len(cut) == len(whole) == 1  # the same grain at any limit
    assert cut[0].OBSERVACAO == next(p._notes for p in parts if p._part == 0) and cut[0].TEXTO_PARTES == len(parts)
    assert len(whole[0].OBSERVACAO.split(" | ")) == 40 and whole[0].TEXTO_PARTES == 1
    assert cut[0].TEXTO_DIGESTO == whole[0].TEXTO_DIGESTO == sum(p._digest for p in parts) != 0
    assert cut[0].TEXTO_TAMANHO == whole[0].TEXTO_TAMANHO == sum(p._size for p in parts) == sum(len(f"GAP: o{i}") for i in range(40))
    assert [(r.STATUS, r.faturas) for r in FD.report_accounts(tables[60]).collect()] == [("INCORRETO", 1)]


def customer_row(**changes):
    base = dict.fromkeys(schemas.CUSTOMER_ROW) | {
        "ID_CLIENTE_CONTRATO": "1", "CPF_CNPJ": "11222333000181", "NOME_CLIENTE": "Empresa Um Ltda", "cep_instalacao": "90000-010",
        "cidade_instalacao": "Pôrto Alegre - AN", "uf_instalacao": "RS", "cep_legal": "90000010", "cidade_legal": "Porto Alegre", "uf_legal": "RS",
    }
    return tuple(str(v) if v is not None else None for v in (base | changes).values())


def references(rows):
    registry = rows(
        "cnpj string, razao_social string, situacao_cadastral string, receita_cep string, receita_municipio string, receita_uf string, status_consulta string",
        [("11222333000181", "EMPRESA UM LTDA", "Ativa", "90000010", "PORTO ALEGRE", "RS", "ok"), ("99999999000199", "X", "BAIXADA", None, None, None, "ok"), ("1", "Y", "A", None, None, None, "timeout")],
    )
    postcodes = rows(
        "cep string, logradouro string, bairro string, cidade string, uf string, fonte string, status_consulta string",
        [("90000010", "Rua A", "B", "Porto Alegre", "RS", "f", "ok"), ("90000000", "", "", "Porto Alegre", "RS", "f", "ok"), ("80000000", "", "", "Curitiba", "PR", "f", "nao_encontrado")],
    )
    return registry, postcodes


def checked(rows, changes, **options):
    schema = ", ".join(f"{c} string" for c in schemas.CUSTOMER_ROW)
    data = rows(schema, [customer_row(FATURA=i, **c) for i, c in enumerate(changes)])
    return P.check_all(P.enrich(data, *references(rows)), **options)


def test_address_states(rows):
    cases = [
        ({}, "Confere", "Confere", "Confere"),
        ({"cidade_instalacao": "Canoas"}, "Divergente", "Confere", "Confere"),
        ({"cep_instalacao": None}, "Confere", "Confere", "Confere"),  # a NULL postcode passes
        ({"cep_instalacao": ""}, "CepGenericoOk", "Confere", "Confere"),  # blank becomes the generic 00000000
        ({"cep_instalacao": "80000000", "cep_legal": "80000000"}, "CepGenericoOk", "Divergente", "Confere"),
        ({"cep_instalacao": "90000000", "cidade_instalacao": "Canoas"}, "CepGenericoDiverge", "Confere", "Confere"),
        ({"cep_legal": "90000000"}, "Confere", "CepGenericoOk", "Confere"),  # confirmed, although the registry postcode differs
        ({"uf_legal": "SC"}, "Confere", "Divergente", "Confere"),
        ({"CPF_CNPJ": "99.999.999/0001-99"}, "Confere", "Confere", "Divergente"),
        ({"CPF_CNPJ": "12345678000199"}, "Confere", "Divergente", "nao_carregado"),
        ({"cidade_instalacao": None, "uf_instalacao": ""}, "Confere", "Confere", "Confere"),
    ]
    got = checked(rows, [c[0] for c in cases]).orderBy(F.col("FATURA").cast("int")).collect()
    assert [(r.ci_state, r.cl_state, r.cad_state) for r in got] == [c[1:] for c in cases]
    assert got[1].ci_obs == "Cidade divergente: base 'Canoas' x CEP 'Porto Alegre'"
    assert got[8].cad_obs == "Situação: BAIXADA | Razão social divergente: base 'Empresa Um Ltda' x Receita 'X'"


def test_older_policy_and_status_maps(rows):
    cases = [{"cep_instalacao": "90000000"}, {"CPF_CNPJ": "99999999000199"}, {"CPF_CNPJ": "12345678000199"}]
    note = checked(rows, cases, policy="note").orderBy(F.col("FATURA").cast("int")).collect()
    assert note[0].ci_state == "Divergente" and note[0].ci_obs == "[CEP] CEP genérico: 90000-000 (sede do município) | Município confirmado: Porto Alegre/RS"
    assert "CEP divergente: base '90000010' x Receita ''" in note[1].cl_obs
    status = {v: P.status_table(checked(rows, cases), m).where("REGRA = 'DADOS_CADASTRAIS' AND FATURA = '2'").first() for v, m in (("v5", P.STATUS_V5), ("latest", P.STATUS_LATEST))}
    assert (status["v5"].STATUS, status["v5"].SUBSTATUS) == ("PENDENTE", "CACHE_VAZIO")
    assert status["latest"].STATUS == "INCORRETO"
    with pytest.raises(ValueError):
        checked(rows, cases, policy="x")


def test_similarity_check(rows):
    names = ["Empresa Um Ltda", "Emp. Um Ltda ME", "Empresa Um Ltda Me Epp X", "", "Outra"]
    got = checked(rows, [{"NOME_CLIENTE": n} for n in names] + [{"CPF_CNPJ": "12345678000199"}], similarity=0.75).orderBy(F.col("FATURA").cast("int")).collect()
    assert [r.cad_state for r in got] == ["Exato", "Alerta", "Divergente", "sem_dado", "Divergente", "nao_carregado"]
    assert got[1].cad_obs == "Razão social similar (75% palavras iguais): base 'Emp. Um Ltda ME' x Receita 'EMPRESA UM LTDA'"


def test_address_outputs_row_counts(rows):
    cases = [{}, {"CPF_CNPJ": None}, {"CPF_CNPJ": "123"}, {"CPF_CNPJ": "11122233344"}]
    schema = ", ".join(f"{c} string" for c in schemas.CUSTOMER_ROW)
    data = rows(schema, [customer_row(FATURA=i, **c) for i, c in enumerate(cases)])
    report, registration, status = P.address_outputs(data, *references(rows))
    assert (report.count(), registration.count(), status.count()) == (6, 2, 6)
    assert report.columns == P.ADDRESS_COLUMNS and status.columns == P.STATUS_COLUMNS


def test_sheet_rows_fall_back_to_installation_address(rows):
    sheet = rows("documento string, CEP string, cidade string, uf string", [("1", "2", "c", "SP")])
    got = P.rows_from_sheet(sheet).first()
    assert (got.cep_legal, got.cidade_legal, got.CPF_CNPJ, got.PRODUTO) == ("2", "c", "1", None)
    with pytest.raises(ValueError):
        P.rows_from_sheet(rows("nome string", [("x",)]))


def fact(rows, entries):
    return rows("SISTEMA string, CPF_CNPJ string, ANO_MES string, FATURA string, QTD_CONTRATO bigint, VALOR_FATURADO double", [(s, c, m, f"{i}", q, v) for i, (s, c, m, q, v) in enumerate(entries)])


def test_revenue_edges(rows):
    data = fact(
        rows,
        [
            ("SIMETRA", "a", "2026-02", 1, 100.0), ("NG", "a", "2026-03", 1, 90.0), ("NG", "a", "2026-05", 2, 100.0),
            ("SIMETRA", "b", "2026-02", 1, 50.0), ("NG", "c", "2026-03", 1, 0.0), ("NG", "c", "2026-05", 1, None),
            ("SIMETRA", None, "2026-01", 1, 5.0), ("NG", None, "2026-05", 1, 50.0),
            ("SIMETRA", "d", "2026-02", 1, -1.0), ("NG", "d", "2026-03", 1, 10.0), ("SIMETRA", "d", "2026-03", 1, 1.0),
        ],
    )
    got = {r.CPF_CNPJ: r for r in R.customer_stats(data, "2026-04", "2026-02", "2026-03").collect()}
    assert set(got) == {"a", "b", None, "d"}  # no positive amount: not in the table
    assert (got["a"].TENDENCIA, got["a"].STATUS_MIGRACAO, got["a"].MESES_ATIVOS) == ("ESTÁVEL", "MIGROU", 3)
    assert (got["b"].TENDENCIA, got["b"].STATUS_MIGRACAO) == ("DADOS INSUFICIENTES", "SUMIU")
    assert (got[None].PRIMEIRO_MES, got[None].TENDENCIA, got[None].STATUS_MIGRACAO) == (None, "ESTÁVEL", "N/A")
    # migration flags and overlap look at every invoice, also at negative ones
    assert (got["d"].STATUS_MIGRACAO, got["d"].MESES_DUPLICADOS) == ("MIGROU", 1)
    fates = {r.CPF_CNPJ: r.DESTINO for r in R.destiny(data, R.Window2(("2026-01", "2026-02"), ("2026-03", "2026-05")), "2026-02").collect()}
    assert fates == {"a": R.D_LOWER, "b": R.D_LEFT}
    assert R.leak_check(data, ["2026-02"]).first()[0] == 0


def test_empty_inputs(rows):
    empty = fact(rows, [])
    assert R.customer_stats(empty, "x", "y", "z").count() == 0
    assert R.two_system(empty, "2026-03").count() == 0
    assert R.duplicated_revenue(empty).first().TOTAL == 0.0
    row = R.diagnose(R.monthly_kpi(empty), "2026-02").first()
    assert (row.pct_fat, row.PIOR_MES_FATURAMENTO, row.pior_fat_pct) == (0.0, None, 0.0)


def test_too_few_labels(rows):
    df = rows("faturamento_atual double, severidade string", [(1.0, "ALTA"), (2.0, "BAIXA")])
    with pytest.raises(S.TooFewLabels):
        S.fit_severity(df)


def test_outlier_share(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("faturamento_atual"))
    assert S.outliers(df).where(F.col("anomalia_iso") == S.ANOMALY).count() == 80
