"""Fixed schemas of the registry files and of the company's own inputs.

Every registry column is text (ids keep their leading zeros); no schema is
ever inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Column layouts of the registry files, in file order.
EMPRESAS_COLUMNS = [
    "cnpj_basico", "razao_social", "natureza_juridica", "qualificacao_responsavel",
    "capital_social_str", "porte_empresa", "ente_federativo_responsavel",
]
ESTABELECIMENTO_COLUMNS = [
    "cnpj_basico", "cnpj_ordem", "cnpj_dv", "matriz_filial", "nome_fantasia",
    "situacao_cadastral", "data_situacao_cadastral", "motivo_situacao_cadastral",
    "nome_cidade_exterior", "pais", "data_inicio_atividades", "cnae_fiscal",
    "cnae_fiscal_secundaria", "tipo_logradouro", "logradouro", "numero", "complemento",
    "bairro", "cep", "uf", "municipio", "ddd1", "telefone1", "ddd2", "telefone2",
    "ddd_fax", "fax", "correio_eletronico", "situacao_especial", "data_situacao_especial",
]
SOCIOS_COLUMNS = [
    "cnpj_basico", "identificador_de_socio", "nome_socio", "cnpj_cpf_socio",
    "qualificacao_socio", "data_entrada_sociedade", "pais", "representante_legal",
    "nome_representante", "qualificacao_representante_legal", "faixa_etaria",
]
SIMPLES_COLUMNS = [
    "cnpj_basico", "opcao_simples", "data_opcao_simples", "data_exclusao_simples",
    "opcao_mei", "data_opcao_mei", "data_exclusao_mei",
]
CODE_COLUMNS = ["codigo", "descricao"]

# Registry file-name suffix of each table.
REGISTRY_SUFFIX = {
    "empresas": ".EMPRECSV",
    "estabelecimento": ".ESTABELE",
    "socios_original": ".SOCIOCSV",
    "simples": ".SIMPLES.CSV.*",
    "cnae": ".CNAECSV",
    "motivo": ".MOTICSV",
    "municipio": ".MUNICCSV",
    "natureza_juridica": ".NATJUCSV",
    "pais": ".PAISCSV",
    "qualificacao_socio": ".QUALSCSV",
}

# Loaded-table layouts (derived columns appended the way the loader does).
EMPRESAS_TABLE_COLUMNS = [c for c in EMPRESAS_COLUMNS if c != "capital_social_str"] + ["capital_social"]
ESTABELECIMENTO_TABLE_COLUMNS = ESTABELECIMENTO_COLUMNS + ["cnpj"]
SOCIOS_TABLE_COLUMNS = ["cnpj"] + SOCIOS_COLUMNS

# Bronze extract of active establishments.
BRONZE_COLUMNS = ["cnpj", "cnae_fiscal", "municipio", "cnpj_basico", "nome_fantasia"]

SALES_KEYS = ["cnpj", "it-codigo", "familia", "familia_comercial"]


def string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


REGISTRY_SCHEMAS = {
    "empresas": string_schema(EMPRESAS_COLUMNS),
    "estabelecimento": string_schema(ESTABELECIMENTO_COLUMNS),
    "socios_original": string_schema(SOCIOS_COLUMNS),
    "simples": string_schema(SIMPLES_COLUMNS),
}
CODE_SCHEMA = string_schema(CODE_COLUMNS)

VENDAS_SCHEMA = T.StructType([
    T.StructField("it-codigo", T.StringType(), True),
    T.StructField("familia", T.StringType(), True),
    T.StructField("familia_comercial", T.StringType(), True),
    T.StructField("cnpj", T.StringType(), True),
    T.StructField("cliente", T.StringType(), True),
    T.StructField("valor", T.DecimalType(18, 2), True),
])
LEADS_SCHEMA = T.StructType([
    T.StructField("cnpj", T.StringType(), True),
    T.StructField("data", T.StringType(), True),
])

FACT_COLUMNS = [
    "cnpj", "cnae_fiscal", "municipio", "cnpj_basico", "nome_fantasia", "razao_social",
    "porte_empresa", "id_regime_tributario", "possui_lead", "atual_cliente",
    "cnpj_mais_similar", "similaridade",
]
