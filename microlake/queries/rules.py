"""Registered queries of declared quality rules over the raw rows."""
from __future__ import annotations

from pyspark.sql import functions as F

from microlake.operators import rules
from microlake.operators.rules import Rule
from microlake.queries import inputs
from microlake.queries import oracle as o

RULES = [
    Rule("municipio_codigo", "pattern", "municipio", pattern="[0-9]{6}"),
    Rule("cnae_codigo", "pattern", "cnae_2_0_classe", pattern="[0-9]{5}"),
    Rule("idade_tipo", "type", "idade", type="int"),
    Rule("idade_faixa", "range", "idade", low=14, high=100),
    Rule("sexo_dominio", "domain", "sexo_trabalhador", values=("01", "02")),
    Rule("remuneracao_tipo", "type", "vl_remun_dezembro_nom", type="decimal"),
    Rule("remuneracao_preenchida", "filled", "vl_remun_dezembro_nom", limit=0.02),
    Rule("escolaridade_faixa", "range", "escolaridade_apos_2005", low=1, high=11),
]
_SHOWN = ["ano", "municipio", "cnae_2_0_classe", "idade", "escolaridade_apos_2005", "vl_remun_dezembro_nom"]


def rule_report(spark, sf):
    """All rules over every raw row in one scan."""
    return rules.report(inputs.raw(spark, sf), RULES)


def quarantine(spark, sf):
    """Every row that breaks a rule, with all its reasons."""
    _, bad = rules.set_aside(inputs.raw(spark, sf), RULES)
    return bad.select(*_SHOWN, F.array_join("motivos", ",").alias("motivos"))


QUERIES = {f.__name__: f for f in [rule_report, quarantine]}

_DEC = o.sql_dec("vl_remun_dezembro_nom")
_BAD = {
    "municipio_codigo": "trim(municipio) <> '' AND NOT regexp_full_match(trim(municipio), '[0-9]{6}')",
    "cnae_codigo": "trim(cnae_2_0_classe) <> '' AND NOT regexp_full_match(trim(cnae_2_0_classe), '[0-9]{5}')",
    "idade_tipo": f"trim(idade) <> '' AND {o.sql_int('idade')} IS NULL",
    "idade_faixa": "TRY_CAST(idade AS DOUBLE) NOT BETWEEN 14 AND 100",
    "sexo_dominio": "trim(sexo_trabalhador) <> '' AND sexo_trabalhador NOT IN ('01', '02')",
    "remuneracao_tipo": f"trim(vl_remun_dezembro_nom) <> '' AND {_DEC} IS NULL",
    "remuneracao_preenchida": "coalesce(trim(vl_remun_dezembro_nom), '') = ''",
    "escolaridade_faixa": "TRY_CAST(escolaridade_apos_2005 AS DOUBLE) NOT BETWEEN 1 AND 11",
}

SQL = {
    "rule_report": o.with_(o.RAW) + " UNION ALL ".join(
        f"SELECT '{name}' AS regra, CAST(count(*) AS BIGINT) AS linhas, CAST(count_if({bad}) AS BIGINT) AS violacoes, "
        f"CAST({0.02 if name == 'remuneracao_preenchida' else 0} AS DOUBLE) AS limite, "
        f"count_if({bad}) <= {0.02 if name == 'remuneracao_preenchida' else 0} * count(*) AS ok FROM raw" for name, bad in _BAD.items()),
    "quarantine": o.with_(o.RAW) + f"SELECT * FROM (SELECT {', '.join(_SHOWN)}, concat_ws(',', " + ", ".join(
        f"CASE WHEN {bad} THEN '{name}' END" for name, bad in _BAD.items() if name != "remuneracao_preenchida")
        + ") AS motivos FROM raw) x WHERE motivos <> ''",
}
