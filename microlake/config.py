"""Layout of the labour-registry microdata: names, dimensions, rules, thresholds.

Everything here is data. Operators take these as default arguments, so another
layout only needs another config.
"""
from __future__ import annotations

# --- fixed values (must equal the source layout for right results) --------------------

# Layout-specific header names (already normalised) -> canonical bronze names.
CANONICAL_NAMES = {
    "municipio_codigo": "municipio",
    "cnae_2_0_classe_codigo": "cnae_2_0_classe",
    "cbo_2002_ocupacao_codigo": "cbo_ocupacao_2002",
    "ind_vinculo_ativo_31_12_codigo": "vinculo_ativo_31_12",
    "sexo_codigo": "sexo_trabalhador",
    "escolaridade_apos_2005_codigo": "escolaridade_apos_2005",
    "raca_cor_codigo": "raca_cor",
    "mes_desligamento_codigo": "mes_desligamento",
    "motivo_desligamento_codigo": "motivo_desligamento",
    "tamanho_estabelecimento_codigo": "tamanho_estabelecimento",
    "natureza_juridica_codigo": "natureza_juridica",
    "vl_rem_dezembro_nom": "vl_remun_dezembro_nom",
    "vl_rem_media_nom": "vl_remun_media_nom",
    "vl_rem_dezembro_sm": "vl_remun_dezembro_sm",
    "vl_rem_media_sm": "vl_remun_media_sm",
}

# Columns without which a year cannot become silver.
REQUIRED_COLUMNS = ["municipio", "vinculo_ativo_31_12", "vl_remun_dezembro_nom"]

# The 17 canonical bronze columns the silver layer reads.
NEEDED_COLUMNS = [
    "municipio", "cnae_2_0_classe", "cbo_ocupacao_2002", "vinculo_ativo_31_12",
    "sexo_trabalhador", "escolaridade_apos_2005", "raca_cor", "idade", "tempo_emprego",
    "mes_desligamento", "motivo_desligamento", "tamanho_estabelecimento", "natureza_juridica",
    "vl_remun_dezembro_nom", "vl_remun_media_nom", "vl_remun_dezembro_sm", "vl_remun_media_sm",
]

# State dimension: IBGE state code -> abbreviation (27 rows).
STATES = [
    ("11", "RO"), ("12", "AC"), ("13", "AM"), ("14", "RR"), ("15", "PA"), ("16", "AP"),
    ("17", "TO"), ("21", "MA"), ("22", "PI"), ("23", "CE"), ("24", "RN"), ("25", "PB"),
    ("26", "PE"), ("27", "AL"), ("28", "SE"), ("29", "BA"), ("31", "MG"), ("32", "ES"),
    ("33", "RJ"), ("35", "SP"), ("41", "PR"), ("42", "SC"), ("43", "RS"), ("50", "MS"),
    ("51", "MT"), ("52", "GO"), ("53", "DF"),
]

SEXES = [(1, "Masculino"), (2, "Feminino")]

SCHOOLING = [
    (1, "Analfabeto"), (2, "Até 5ª incompleto"), (3, "5ª completo fundamental"),
    (4, "6ª a 9ª fundamental"), (5, "Fundamental completo"), (6, "Médio incompleto"),
    (7, "Médio completo"), (8, "Superior incompleto"), (9, "Superior completo"),
    (10, "Mestrado"), (11, "Doutorado"),
]

# First digit of the state code -> macro-region.
REGIONS = {"1": "Norte", "2": "Nordeste", "3": "Sudeste", "4": "Sul", "5": "Centro-Oeste"}

# Value rules of the silver layer: invalid values become NULL, rows are kept.
MUNICIPALITY_PATTERN = r"^\d{6}$"
INDUSTRY_CLASS_PATTERN = r"^\d{5}$"
AGE_RANGE = (14, 100)
MONTH_RANGE = (1, 12)

# Gate thresholds of the silver layer.
MAX_NULL_PAY = 0.05
MAX_NULL_STATE = 0.01

# Pay bands and age bands (upper bounds are exclusive).
PAY_BANDS = [(3000, "baixa"), (4500, "media")]
PAY_BAND_TOP = "alta"
AGE_BANDS = [(25, "ate_24"), (40, "25_39"), (60, "40_59")]
AGE_BAND_TOP = "60_mais"

# Dictionary naming rules.
TABLE_NAME_PATTERN = r"^(bronze|silver|gold)\.[a-z][a-z0-9_]*$"
COLUMN_NAME_PATTERN = r"^[a-z][a-z0-9_]*$"
MIN_TABLE_DESCRIPTION = 10
MIN_COLUMN_DESCRIPTION = 5

# --- contracts ------------------------------------------------------------------------

SILVER_CONTRACT = (
    "ano int, cod_municipio string, cod_uf string, cnae_classe string, cnae_divisao string, "
    "cbo string, natureza_juridica string, sexo int, escolaridade int, raca_cor int, idade int, "
    "tamanho_estab int, mes_desligamento int, motivo_desligamento int, "
    "tempo_emprego_meses decimal(10,1), vinculo_ativo boolean, desligado_no_ano boolean, "
    "remun_dezembro_nom decimal(18,2), remun_media_nom decimal(18,2), "
    "remun_dezembro_sm decimal(18,2), remun_media_sm decimal(18,2)"
)
