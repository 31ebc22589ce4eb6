"""Column sets, types and fixed lookup values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)

# Names and order of the raw and published columns.
MONEY_COLUMNS = [
    "valorEmpenhado",
    "valorLiquidado",
    "valorPago",
    "valorRestoInscrito",
    "valorRestoCancelado",
    "valorRestoPago",
]

TEXT_COLUMNS = [
    "codigoEmenda",
    "tipoEmenda",
    "autor",
    "nomeAutor",
    "numeroEmenda",
    "localidadeDoGasto",
    "funcao",
    "subfuncao",
]

RAW_COLUMNS = ["codigoEmenda", "ano", *TEXT_COLUMNS[1:], *MONEY_COLUMNS]

# Money and codes stay text in the raw layer: inferring them as numbers would lose
# leading zeros and misread the Brazilian separators.
RAW = T.StructType(
    [
        T.StructField(name, T.LongType() if name == "ano" else T.StringType())
        for name in RAW_COLUMNS
    ]
)

FACT_COLUMNS = [
    "codigoEmenda",
    "ano",
    "autor",
    "funcao",
    "subfuncao",
    "localidadeDoGasto",
    "uf",
    "tipoEmenda",
    *MONEY_COLUMNS,
    "taxa_execucao_pct",
    "restos_liquidos",
    "emenda_vitrine",
    "ano_id",
    "localidade_id",
    "autor_id",
]

# Names and order of the feature columns, and those that are correlated.
FEATURE_COLUMNS = [
    "codigoEmenda",
    "autor",
    "funcao",
    "uf",
    "regiao",
    "ano",
    "valorEmpenhado",
    "valorPago",
    "taxa_execucao_pct",
    "pct_do_total_autor",
    "desvio_execucao_vs_autor",
    "zscore_valor",
    "flag_vitrine",
    "flag_em_restos",
    "flag_nordeste",
    "flag_norte",
    "flag_individual",
    "executou_bem",
]

LABEL = "executou_bem"

CORRELATED_FEATURES = [
    "valorEmpenhado",
    "taxa_execucao_pct",
    "pct_do_total_autor",
    "desvio_execucao_vs_autor",
    "zscore_valor",
    "flag_vitrine",
    "flag_em_restos",
    "flag_nordeste",
    "flag_norte",
    "flag_individual",
]

# State names and codes, regions, themes and default labels. They must
# equal the published ones for the results to be right.
STATE_CODES = {
    "ACRE": "AC",
    "ALAGOAS": "AL",
    "AMAPÁ": "AP",
    "AMAZONAS": "AM",
    "BAHIA": "BA",
    "CEARÁ": "CE",
    "DISTRITO FEDERAL": "DF",
    "ESPÍRITO SANTO": "ES",
    "GOIÁS": "GO",
    "MARANHÃO": "MA",
    "MATO GROSSO": "MT",
    "MATO GROSSO DO SUL": "MS",
    "MINAS GERAIS": "MG",
    "PARÁ": "PA",
    "PARAÍBA": "PB",
    "PARANÁ": "PR",
    "PERNAMBUCO": "PE",
    "PIAUÍ": "PI",
    "RIO DE JANEIRO": "RJ",
    "RIO GRANDE DO NORTE": "RN",
    "RIO GRANDE DO SUL": "RS",
    "RONDÔNIA": "RO",
    "RORAIMA": "RR",
    "SANTA CATARINA": "SC",
    "SÃO PAULO": "SP",
    "SERGIPE": "SE",
    "TOCANTINS": "TO",
}

REGION_STATES = {
    "Norte": ["AC", "AM", "AP", "PA", "RO", "RR", "TO"],
    "Nordeste": ["AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"],
    "Sudeste": ["ES", "MG", "RJ", "SP"],
    "Sul": ["PR", "RS", "SC"],
    "Centro-Oeste": ["DF", "GO", "MS", "MT"],
}

THEMES = {
    "Saúde": "Social",
    "Educação": "Social",
    "Assistência Social": "Social",
    "Infraestrutura": "Infraestrutura",
    "Transporte": "Infraestrutura",
    "Defesa Nacional": "Segurança",
}

TYPE_LABELS = ["Individual", "Comissão", "Bancada"]

NO_STATE = "NA"
NATIONAL = "Nacional"
OTHER_THEME = "Outros"
OTHER_TYPE = "Outro"
NO_SUBFUNCTION = "Não informada"
PERIOD_LABELS = ("Pré-Pandemia/Pandemia", "Pós-Pandemia", "Atual")
