"""The data dictionary as plain rows (one per table, one per described column).

Kept as data rather than a nested document, so it is loaded with an explicit schema
and checked with the same join machinery as any other table.
"""
from __future__ import annotations

NAME = "vinculos"
OWNER = "equipe de dados"
#: Business rules that hold for every table of the lake.
RULES = [
    "Cada linha é um vínculo de emprego; quem tem dois empregos conta duas vezes.",
    "Valores nominais não se comparam entre anos; as colunas em salários mínimos (_sm), sim.",
    "Estoque conta só os vínculos ativos em 31/12; desligamento conta todos os do ano.",
    "Códigos são texto: o zero à esquerda faz parte deles.",
    "UF nula: o município não pertence a nenhuma UF da tabela.",
]

TABLE_SCHEMA = ("tabela string, descricao string, grao string, atualizacao string, completa boolean, "
                "caminho string, pergunta string")
COLUMN_SCHEMA = "tabela string, coluna string, descricao string, unidade string"

TABLES = [
    ("bronze.vinculos", "Linhas dos arquivos de origem, todas as colunas como texto.",
     "linha do arquivo", "por ano", False, "bronze", None),
    ("silver.vinculos", "Vínculos de emprego tipados e validados, um por linha da origem.",
     "vínculo x ano", "por ano", True, "silver", None),
    ("gold.emprego_uf_ano", "Estoque de vínculos ativos e remuneração por UF e ano.",
     "ano x uf", "por ano", True, "gold/gold_emprego_uf_ano", "Quantos empregos há em cada UF e quanto pagam?"),
    ("gold.gap_sexo_uf_ano", "Remuneração média de mulheres e homens por UF e ano.",
     "ano x uf", "por ano", True, "gold/gold_gap_sexo_uf_ano", "Quanto as mulheres recebem para cada real dos homens?"),
    ("gold.top_cnae_uf_ano", "Divisões de atividade com a maior massa salarial de cada UF e ano.",
     "ano x uf x divisão", "por ano", True, "gold/gold_top_cnae_uf_ano", "Que atividades mais pagam salários em cada UF?"),
    ("gold.desligamento_uf_ano", "Vínculos do ano e desligamentos por UF.",
     "ano x uf", "por ano", False, "gold/gold_desligamento_uf_ano", "Que parte dos vínculos termina no ano?"),
    ("gold.escolaridade_ano", "Remuneração média por escolaridade e ano.",
     "ano x escolaridade", "por ano", True, "gold/gold_escolaridade_ano", "Quanto rende mais estudo?"),
]

COLUMNS = [
    ("bronze.vinculos", "ano", "Ano da pasta de origem, partição da tabela.", "ano"),
    ("bronze.vinculos", "municipio", "Código do município como veio no arquivo.", None),
    ("bronze.vinculos", "vl_remun_dezembro_nom", "Remuneração de dezembro, em texto como veio.", "R$"),
    ("silver.vinculos", "ano", "Ano base da declaração.", "ano"),
    ("silver.vinculos", "cod_municipio", "Código do município com seis dígitos.", None),
    ("silver.vinculos", "cod_uf", "Código da UF, dois primeiros dígitos do município.", None),
    ("silver.vinculos", "cnae_classe", "Classe de atividade econômica, cinco dígitos.", None),
    ("silver.vinculos", "cnae_divisao", "Divisão de atividade, dois primeiros dígitos da classe.", None),
    ("silver.vinculos", "cbo", "Ocupação do trabalhador.", None),
    ("silver.vinculos", "natureza_juridica", "Natureza jurídica do estabelecimento.", None),
    ("silver.vinculos", "sexo", "Sexo do trabalhador (1 masculino, 2 feminino).", None),
    ("silver.vinculos", "escolaridade", "Grau de instrução, de 1 a 11.", None),
    ("silver.vinculos", "raca_cor", "Raça ou cor declarada.", None),
    ("silver.vinculos", "idade", "Idade entre 14 e 100 anos; fora disso é nula.", "anos"),
    ("silver.vinculos", "tamanho_estab", "Faixa de tamanho do estabelecimento.", None),
    ("silver.vinculos", "mes_desligamento", "Mês do desligamento, nulo se ativo.", "mês"),
    ("silver.vinculos", "motivo_desligamento", "Motivo do desligamento.", None),
    ("silver.vinculos", "tempo_emprego_meses", "Tempo no emprego.", "meses"),
    ("silver.vinculos", "vinculo_ativo", "Ativo em 31 de dezembro.", None),
    ("silver.vinculos", "desligado_no_ano", "Teve desligamento no ano.", None),
    ("silver.vinculos", "remun_dezembro_nom", "Remuneração de dezembro, nominal.", "R$"),
    ("silver.vinculos", "remun_media_nom", "Remuneração média do ano, nominal.", "R$"),
    ("silver.vinculos", "remun_dezembro_sm", "Remuneração de dezembro em salários mínimos.", "SM"),
    ("silver.vinculos", "remun_media_sm", "Remuneração média em salários mínimos.", "SM"),
    ("gold.emprego_uf_ano", "ano", "Ano base.", "ano"),
    ("gold.emprego_uf_ano", "cod_uf", "Código da UF.", None),
    ("gold.emprego_uf_ano", "uf", "Sigla da UF.", None),
    ("gold.emprego_uf_ano", "qtd_vinculos", "Vínculos ativos em 31/12.", "vínculos"),
    ("gold.emprego_uf_ano", "massa_salarial_dez_nom", "Soma das remunerações de dezembro.", "R$"),
    ("gold.emprego_uf_ano", "remun_media_dez_nom", "Média da remuneração de dezembro.", "R$"),
    ("gold.emprego_uf_ano", "remun_media_dez_sm", "Média em salários mínimos.", "SM"),
    ("gold.emprego_uf_ano", "remun_mediana_dez_sm", "Mediana de dezembro em salários mínimos.", "SM"),
    ("gold.gap_sexo_uf_ano", "ano", "Ano base.", "ano"),
    ("gold.gap_sexo_uf_ano", "cod_uf", "Código da UF.", None),
    ("gold.gap_sexo_uf_ano", "uf", "Sigla da UF.", None),
    ("gold.gap_sexo_uf_ano", "rem_mulher_sm", "Remuneração média das mulheres em dezembro.", "SM"),
    ("gold.gap_sexo_uf_ano", "rem_homem_sm", "Remuneração média dos homens em dezembro.", "SM"),
    ("gold.gap_sexo_uf_ano", "razao_mulher_homem", "Média das mulheres sobre a dos homens.", "fração"),
    ("gold.top_cnae_uf_ano", "ano", "Ano base.", "ano"),
    ("gold.top_cnae_uf_ano", "cod_uf", "Código da UF.", None),
    ("gold.top_cnae_uf_ano", "uf", "Sigla da UF.", None),
    ("gold.top_cnae_uf_ano", "cnae_divisao", "Divisão de atividade econômica.", None),
    ("gold.top_cnae_uf_ano", "qtd_vinculos", "Vínculos ativos em 31/12.", "vínculos"),
    ("gold.top_cnae_uf_ano", "massa_salarial_dez_nom", "Soma das remunerações de dezembro.", "R$"),
    ("gold.top_cnae_uf_ano", "posicao", "Posição pela massa salarial dentro da UF e do ano.", None),
    ("gold.desligamento_uf_ano", "ano", "Ano base.", "ano"),
    ("gold.desligamento_uf_ano", "taxa_desligamento", "Desligados sobre vínculos do ano.", "fração"),
    ("gold.escolaridade_ano", "ano", "Ano base.", "ano"),
    ("gold.escolaridade_ano", "escolaridade", "Grau de instrução.", None),
    ("gold.escolaridade_ano", "escolaridade_desc", "Nome do grau de instrução.", None),
    ("gold.escolaridade_ano", "qtd_vinculos", "Vínculos ativos.", "vínculos"),
    ("gold.escolaridade_ano", "remun_media_dez_sm", "Média em salários mínimos.", "SM"),
]
