"""Fixed layouts of the reference tables used by the address and registration checks."""

from __future__ import annotations

from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

# Registry record.
_REGISTRY = [
    "cnpj", "razao_social", "nome_fantasia", "situacao_cadastral", "data_situacao_cadastral",
    "motivo_situacao_cadastral", "natureza_juridica", "data_inicio_atividade", "cnae_principal_codigo",
    "cnae_principal_descricao", "porte", "capital_social", "opcao_simples", "opcao_mei", "email", "telefone",
    "receita_cep", "receita_logradouro", "receita_numero", "receita_complemento", "receita_bairro",
    "receita_municipio", "receita_uf", "data_consulta", "status_consulta",
]
_REGISTRY_TYPES = {
    "cnae_principal_codigo": LongType(), "capital_social": DoubleType(), "opcao_simples": BooleanType(),
    "opcao_mei": BooleanType(),
}
REGISTRY = StructType([StructField(c, _REGISTRY_TYPES.get(c, StringType())) for c in _REGISTRY])

# Postcode record.
POSTCODE = StructType(
    [
        StructField(c, StringType())
        for c in ["cep", "logradouro", "bairro", "cidade", "uf", "complemento", "fonte", "data_consulta", "status_consulta"]
    ]
)

# Headerless postcode directory files.
DIRECTORY = {
    "street": ["LOG_NU", "UFE_SG", "LOC_NU", "BAI_NU_INI", "BAI_NU_FIM", "LOG_NO", "LOG_COMPLEMENTO", "CEP", "TLO_TX", "LOG_STA_EDI", "LOG_NO_ABREV"],
    "locality": ["LOC_NU", "UFE_SG", "LOC_NO", "CEP", "LOC_IN_SIT", "LOC_IN_TIPO_LOC", "LOC_NU_SUB", "LOC_NO_ABREV", "MUN_NU"],
    "district": ["BAI_NU", "UFE_SG", "LOC_NU", "BAI_NO", "BAI_NO_ABREV"],
    "big_user": ["GRU_NU", "UFE_SG", "LOC_NU", "BAI_NU", "LOG_NU", "GRU_NO", "GRU_ENDERECO", "CEP", "GRU_NO_ABREV"],
    "community_box": ["CPC_NU", "UFE_SG", "LOC_NU", "CPC_NO", "CPC_ENDERECO", "CEP"],
}

# Columns of the customer rows that the address checks read.
CUSTOMER_ROW = [
    "FATURA", "NUMERO_FATURA", "ID_CLIENTE_CONTRATO", "SEGMENTO", "cidade_instalacao", "bairro_instalacao",
    "cep_instalacao", "uf_instalacao", "cidade_legal", "bairro_legal", "cep_legal", "uf_legal", "CPF_CNPJ",
    "NOME_CLIENTE", "INSCRICAO_ESTADUAL", "PRODUTO", "TIPO_SERVICO", "DESCRICAO_SERVICO", "TIPO_IMPOSTO", "PROMOCAO",
    "GRUPO_LOCALIDADE", "ID_LOTE", "CRM",
]

# Header spellings of a customer sheet, by role.
SHEET_HEADERS = {
    "CPF_CNPJ": ["CPF_CNPJ", "CPF/CNPJ", "DOCUMENTO", "CNPJ", "CPF", "DOC"],
    "FATURA": ["FATURA"],
    "ID_CLIENTE_CONTRATO": ["ID_CLIENTE_CONTRATO", "ID_CLIENTE", "ID"],
    "REGRA": ["REGRA"],
    "SEGMENTO": ["SEGMENTO"],
    "NOME_CLIENTE": ["NOME_CLIENTE", "NOME", "CLIENTE"],
    "INSCRICAO_ESTADUAL": ["INSCRICAO_ESTADUAL", "IE"],
    "cep_instalacao": ["cep_instalacao", "CEP"],
    "cidade_instalacao": ["cidade_instalacao", "CIDADE", "CITY"],
    "bairro_instalacao": ["bairro_instalacao", "BAIRRO"],
    "uf_instalacao": ["uf_instalacao", "UF", "ESTADO", "STATE"],
    "cep_legal": ["cep_legal"],
    "cidade_legal": ["cidade_legal"],
    "bairro_legal": ["bairro_legal"],
    "uf_legal": ["uf_legal"],
    "PRODUTO": ["PRODUTO"],
    "TIPO_SERVICO": ["TIPO_SERVICO"],
    "DESCRICAO_SERVICO": ["DESCRICAO_SERVICO"],
    "TIPO_IMPOSTO": ["TIPO_IMPOSTO"],
    "PROMOCAO": ["PROMOCAO"],
    "GRUPO_LOCALIDADE": ["GRUPO_LOCALIDADE"],
    "ID_LOTE": ["ID_LOTE"],
    "CRM": ["CRM", "SISTEMA_ORIGEM"],
}
