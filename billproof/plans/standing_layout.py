"""Column layouts and source mappings of the standing table.

A mapping entry is target: (kind, source column). Kinds: s text, up upper-case text, d2 DECIMAL(18,2), d4 DECIMAL(8,4),
int, br / ts / ymd / any date encodings, cancel (cancellation flag from a cancellation date). Regular families of
columns come from naming rules, the rest is listed.
"""

from __future__ import annotations

TAXES = ["icms", "iss", "pis", "cofins", "fust", "funttel"]
RETAINED = ["ir", "pis", "cofins", "csll"]
LEDGER_TAXES = ["icms", "pis", "cofins", "iss"]

# Target columns before, between and after the tax families, with their types.
_HEAD = {
    "categoria_fiscal": "s", "modelo_nf": "s", "tipo_emissao_nfcom": "s", "nf_numero": "s", "nf_serie": "s",
    "nf_valor": "d2", "data_emissao": "date", "chave_acesso_nfcom": "s", "status_integracao_nfcom": "s",
    "regime_especial": "s", "cancelada": "s", "status_nfcom": "s", "nota_substituta": "s", "empresa_prestadora": "s",
    "pessoa_emissora": "s", "operadora": "s", "id_contrato": "s", "id_cliente": "s", "cpf_cnpj": "s",
    "nome_cliente": "s", "tipo_assinante": "s", "status_contrato": "s", "uf_dest": "s", "cidade_dest": "s",
    "cod_produto": "s", "posicao_item": "int", "descricao_item": "s", "cclass": "s", "tipo_receita": "s",
    "data_inicio_cobranca": "date", "data_fim_cobranca": "date", "nf_item_valor": "d2", "desconto": "d2", "cfop": "s",
}


def _tax_targets() -> dict[str, str]:
    out = {}
    for tax in TAXES:
        out |= {f"{tax}_cst": "s", f"{tax}_base": "d2", f"{tax}_aliquota": "d4", f"{tax}_valor": "d2"}
        if tax == "icms":
            out["icms_isento"] = "d2"
    for tax in RETAINED:
        out |= {f"{tax}_retido_aliquota": "d4", f"{tax}_retido_valor": "d2"}
    out["iss_retido_valor"] = "d2"
    return out


def _ledger_targets() -> dict[str, str]:
    out = ["conta_debito_rec", "descr_conta_debito_rec", "conta_debito_adiant", "conta_credito_rec", "descr_conta_credito_rec"]
    for tax in LEDGER_TAXES:
        for side in ("debito", "credito"):
            out += [f"conta_{side}_{tax}", f"descr_conta_{side}_{tax}"]
    return dict.fromkeys(out, "s")


# Mapped columns of the standing table and their kinds.
TARGETS: dict[str, str] = _HEAD | _tax_targets() | _ledger_targets()

SPARK_TYPES = {"s": "string", "d2": "decimal(18,2)", "d4": "decimal(8,4)", "int": "int", "date": "date"}

# Where each system keeps the columns.
NG_CYCLE = ("FATURA_DATA_EMISSAO", "br")
NG = {
    "categoria_fiscal": "CATEGORIA_FISCAL", "modelo_nf": "MODELO", "tipo_emissao_nfcom": "TIPO_EMISSAO_NFCOM",
    "nf_numero": "NF_NUMERO", "nf_valor": "NF_VALOR", "data_emissao": ("br", "NF_DATA_EMISSAO"),
    "chave_acesso_nfcom": "CHAVE_ACESSO_NFCOM", "status_integracao_nfcom": "STATUS_INTEGRACAO_NFCOM",
    "regime_especial": "REGIME_ESPECIAL", "cancelada": "CANCELADA", "status_nfcom": "STATUS_NFCOM",
    "nota_substituta": "NOTA_SUBSTITUTA", "empresa_prestadora": "EMPRESA_PRESTADORA",
    "pessoa_emissora": "PESSOA_EMISSORA", "operadora": "OPERADORA", "id_contrato": "CONTA_NUMERO",
    "id_cliente": "COD_CLIENTE_SAP", "nome_cliente": "NOME_ASSINANTE", "tipo_assinante": "TIPO_ASSINANTE",
    "uf_dest": ("up", "NF_UF"), "cidade_dest": "NF_CIDADE", "cod_produto": "NF_ITEM_COD_SAP",
    "posicao_item": "POSICAO_ITEM", "descricao_item": "NF_ITEM_DESCRICAO", "cclass": "CCLASS",
    "data_inicio_cobranca": ("any", "DATA_INICIO_COBRANCA"), "data_fim_cobranca": ("any", "DATA_FIM_COBRANCA"),
    "nf_item_valor": "NF_ITEM_VALOR", "cfop": "CFOP", "iss_retido_valor": "VALOR_ISS_RETIDO",
    "conta_debito_rec": "CONTA_DEBITO_REC", "descr_conta_debito_rec": "DESCR_CONTA_DEBITO_REC",
    "conta_debito_adiant": "CONTA_DEBITO_ADIANT", "conta_credito_rec": "CONTA_CREDITO_REC",
    "descr_conta_credito_rec": "DESCR_CONTA_CREDITO_REC",
}
for _tax in TAXES:
    _t = _tax.upper()
    NG |= {
        f"{_tax}_cst": f"{_t}_CST",
        f"{_tax}_base": f"{_t}_BASE_CALCULO",
        f"{_tax}_aliquota": f"{_t}_ALIQUOTA",
        f"{_tax}_valor": f"{_t}_VALOR_IMPOSTO",
    }
for _tax in RETAINED:
    NG |= {f"{_tax}_retido_aliquota": f"ALIQUOTA_{_tax.upper()}_RETIDO", f"{_tax}_retido_valor": f"VALOR_{_tax.upper()}_RETIDO"}
for _tax in LEDGER_TAXES:
    for _side in ("debito", "credito"):
        _name = f"CONTA_{_side}_{_tax}".upper()
        NG |= {f"conta_{_side}_{_tax}": _name, f"descr_conta_{_side}_{_tax}": f"{_name}_DESCRICAO"}

# Second system.
ADAPTER_CYCLE = ("DATA_EMISSAO_NOTA", "ts")
ADAPTER = {
    "categoria_fiscal": "TipoNF", "tipo_emissao_nfcom": "Tipo_Emissao", "nf_numero": "NUMERO_NF",
    "nf_valor": "ValorNotaFiltro", "data_emissao": ("ts", "DATA_EMISSAO_NOTA"),
    "status_integracao_nfcom": "StatusNotaIntegracao", "regime_especial": "REGIME_ESPECIAL",
    "cancelada": "NotaCancelada", "empresa_prestadora": "Empresa", "operadora": "OPERACAO", "id_contrato": "CONTRATO",
    "id_cliente": "IDCliente", "cpf_cnpj": "CPF_CNPJ", "nome_cliente": "Cliente", "status_contrato": "Status_Contrato",
    "cidade_dest": "Cidade", "cod_produto": "ITEM_CODE_SAP", "posicao_item": "Ordem",
    "descricao_item": "DescricaoFiscal", "cclass": "codigoClassificacao", "tipo_receita": "TipoReceita",
    "nf_item_valor": "ValorItemFiltro", "desconto": "Desconto", "cfop": "NumeroCFOP", "icms_cst": "CST",
    "icms_isento": "IsentoICMS", "pis_aliquota": "PIS", "cofins_aliquota": "COFINS", "fust_aliquota": "Fust",
    "funttel_aliquota": "AliquotaFunttel", "funttel_valor": "ValorFuntel", "conta_debito_rec": "ContrapartidaDebito",
    "conta_credito_rec": "CreditoReceita",
}
for _tax in ("icms", "iss", "pis", "cofins"):
    ADAPTER |= {f"{_tax}_base": f"Base{_tax.upper()}", f"{_tax}_valor": f"Valor{_tax.upper()}"}
for _tax, _label in (("icms", "ICMS"), ("pis", "Pis"), ("cofins", "Cofins"), ("iss", "ISS")):
    for _side in ("debito", "credito"):
        _name = f"Conta{_side.capitalize()}{_label}"
        ADAPTER |= {f"conta_{_side}_{_tax}": f"Classificador{_name}", f"descr_conta_{_side}_{_tax}": f"Descricao{_name}"}

# Third system.
SIMETRA_CYCLE = ("FT_EMISSAO", "int")
SIMETRA = {
    "categoria_fiscal": "TIPO_PROD", "modelo_nf": "C5_TIPOF", "nf_numero": "FT_NFISCAL", "nf_serie": "FT_SERIE",
    "nf_valor": "FT_VALCONT", "data_emissao": ("ymd", "FT_EMISSAO"), "chave_acesso_nfcom": "FT_CHVNFE",
    "status_integracao_nfcom": "F3_DESCRET", "regime_especial": "FT_CLASFIS", "cancelada": ("cancel", "FT_DTCANC"),
    "nota_substituta": "IS_NFSUBS", "empresa_prestadora": "FT_FILIAL", "id_contrato": "COD_CNTR",
    "id_cliente": "FT_CLIEFOR", "uf_dest": ("up", "FT_ESTADO"), "cod_produto": "B1_COD", "posicao_item": "FT_ITEM",
    "descricao_item": "B1_DESC", "cclass": "B1_XCCLASS", "tipo_receita": "TIPO_PROD", "nf_item_valor": "FT_TOTAL",
    "desconto": "FT_DESCONT", "cfop": "FT_CFOP", "icms_base": "FT_BASEICM", "icms_aliquota": "FT_ALIQICM",
    "icms_valor": "FT_VALICM", "icms_isento": "FT_ISENICM", "iss_cst": "F3_CSTISS", "pis_cst": "FT_CSTPIS",
    "pis_base": "FT_BASEPIS", "pis_aliquota": "FT_ALIQPIS", "pis_valor": "FT_VALPIS", "cofins_cst": "FT_CSTCOF",
    "cofins_base": "FT_BASECOF", "cofins_aliquota": "FT_ALIQCOF", "cofins_valor": "FT_VALCOF",
    "fust_base": "FT_BASIMP5", "fust_aliquota": "FT_ALQIMP5", "fust_valor": "FT_VALIMP5",
    "funttel_base": "FT_BASIMP6", "funttel_aliquota": "FT_ALQIMP6", "funttel_valor": "FT_VALIMP6",
    "ir_retido_aliquota": "FT_ALIQIRR", "ir_retido_valor": "FT_VALIRR", "pis_retido_aliquota": "FT_ARETPIS",
    "pis_retido_valor": "FT_VRETPIS", "cofins_retido_aliquota": "FT_ARETCOF", "cofins_retido_valor": "FT_VRETCOF",
    "csll_retido_aliquota": "FT_ARETCSL", "csll_retido_valor": "FT_VRETCSL", "iss_retido_valor": "FT_VALINS",
}

# Columns of the change hash, in order.
HASHED = [
    "cfop", "icms_cst", "icms_aliquota", "icms_valor", "iss_valor", "pis_aliquota", "pis_valor", "cofins_aliquota",
    "cofins_valor", "fust_aliquota", "fust_valor", "funttel_aliquota", "funttel_valor", "nf_item_valor", "uf_dest",
    "cancelada",
]
KEYED = ["sistema_origem", "ciclo_faturamento", "nf_numero", "posicao_item", "id_contrato", "cod_produto"]
FLAGS = ["ind_sem_cst", "faturamento_zerado", "fatura_sem_numero", "ind_cancelada"]
META = ["id_registro", "sistema_origem", "ciclo_faturamento", "dt_carga", "dt_processamento", "hash_registro"]

# All columns of the standing table, in order.
STANDING_COLUMNS = [*META, *TARGETS, *FLAGS]

# The first generation of the table (51 columns, two systems).
V1_TAXES = TAXES
V1_NG = {
    "id_conta_contrato": "CONTA_NUMERO", "id_cliente": "COD_CLIENTE_SAP", "nome_assinante": "NOME_ASSINANTE",
    "tipo_pessoa": "TIPO_ASSINANTE", "empresa_prestadora": "EMPRESA_PRESTADORA", "fatura_numero": "FATURA_NUMERO",
    "fatura_data_emissao": "FATURA_DATA_EMISSAO", "fatura_valor_atual": "FATURA_VALOR_ATUAL", "nf_numero": "NF_NUMERO",
    "nf_valor": "NF_VALOR", "nf_item_cod_sap": "NF_ITEM_COD_SAP", "nf_item_descricao": "NF_ITEM_DESCRICAO",
    "posicao_item": "POSICAO_ITEM", "data_inicio_cobranca": "DATA_INICIO_COBRANCA",
    "data_fim_cobranca": "DATA_FIM_COBRANCA", "nf_item_valor": "NF_ITEM_VALOR", "cclass": "CCLASS", "cfop": "CFOP",
    "cst_icms": "ICMS_CST",
}
for _tax in TAXES:
    _t = _tax.upper()
    V1_NG |= {f"{_tax}_aliquota": f"{_t}_ALIQUOTA", f"{_tax}_base_calculo": f"{_t}_BASE_CALCULO", f"{_tax}_valor": f"{_t}_VALOR_IMPOSTO"}
V1_NG |= {
    "nf_uf": "NF_UF", "nf_cidade": "NF_CIDADE", "status_nfcom": "STATUS_NFCOM",
    "tipo_emissao_nfcom": "TIPO_EMISSAO_NFCOM", "cancelada": "CANCELADA", "nota_substituta": "NOTA_SUBSTITUTA",
    "nota_substituida": "NOTA_SUBSTITUIDA", "chave_acesso_nfcom": "CHAVE_ACESSO_NFCOM",
    "regime_especial": "REGIME_ESPECIAL",
}
V1_ADAPTER = V1_NG | {
    "id_conta_contrato": "idcontrato", "tipo_pessoa": "TipoPessoa", "status_nfcom": "StatusNotaFiscal",
    "tipo_emissao_nfcom": "TipoEmissao", "cclass": None, "cst_icms": None, "nota_substituta": None,
    "nota_substituida": None, "chave_acesso_nfcom": None, "regime_especial": None,
}
V1_NUMBERS = {"fatura_valor_atual", "nf_valor", "nf_item_valor"} | {
    f"{t}_{part}" for t in TAXES for part in ("aliquota", "base_calculo", "valor")
}
V1_KEYED = ["id_conta_contrato", "fatura_numero", "nf_item_cod_sap", "posicao_item"]
V1_HASHED = ["cclass", "cfop", "cst_icms", "icms_aliquota", "pis_aliquota", "nf_uf"]
V1_COLUMNS = ["id_registro", "sistema_origem", "ciclo_faturamento", "dt_carga", *V1_NG, "hash_registro"]
