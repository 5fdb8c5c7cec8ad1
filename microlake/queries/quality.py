"""Registered quality queries: gates, contracts, ranges, coverage, history roll-up."""
from __future__ import annotations

from pyspark.sql import functions as F

from microlake import config
from microlake.functions import clean
from microlake.operators import dims, marts, quality, windows
from microlake.operators.silver import to_silver
from microlake.queries import inputs
from microlake.queries import oracle as o
from microlake.session import scratch_path
from microlake.sinks import tables

# the declared checks of the history stand-in (event types of the events table)
DECLARED_CHECKS = ["click", "error", "purchase", "signup", "view"]
MIN_WAGE_RATIO = 1212.12
SMALL_CELL_K = 100


def layer_gate(spark, sf):
    raw = inputs.raw(spark, sf)
    return quality.layer_gate(to_silver(raw), raw)


_TYPED = {"int": ("idade", "mes_desligamento", "sexo_trabalhador", "escolaridade_apos_2005", "raca_cor",
                  "motivo_desligamento", "tamanho_estabelecimento"),
          "decimal(18,2)": ("vl_remun_dezembro_nom", "vl_remun_media_nom", "vl_remun_dezembro_sm", "vl_remun_media_sm")}


def schema_contract_diff(spark, sf):
    """Bronze stored as text, read back: per column, the rows whose text is not of the contract's type."""
    path = scratch_path(spark, "bronze-contract")
    tables.write_table(inputs.raw(spark, sf), path)
    parse = {"int": clean.int_of, "decimal(18,2)": clean.decimal_of}
    return quality.type_failures(tables.read_table(spark, path),
                                 {c: (t, parse[t](F.col(c))) for t, cols in _TYPED.items() for c in cols}, "bronze")


def range_violations(spark, sf):
    raw = inputs.raw(spark, sf)
    s = to_silver(raw, keep=[clean.int_of(F.col("idade")).alias("idade_bruta"),
                             clean.int_of(F.col("mes_desligamento")).alias("mes_bruto")])
    lo_a, hi_a = config.AGE_RANGE
    lo_m, hi_m = config.MONTH_RANGE
    return quality.range_violations(s, {
        "idade_silver": (F.col("idade"), lo_a, hi_a),
        "mes_silver": (F.col("mes_desligamento"), lo_m, hi_m),
        "idade_bruta": (F.col("idade_bruta"), lo_a, hi_a),
        "mes_bruto": (F.col("mes_bruto"), lo_m, hi_m),
    }, ["ano"])


def rank_bound(spark, sf):
    top = marts.top_industry(marts.active(inputs.silver(spark, sf)), dims.state_dim(spark), 10)
    return quality.bound_check(top, ["ano", "cod_uf"], "posicao", 10)


def year_coverage(spark, sf):
    s = inputs.silver(spark, sf)
    emp = marts.employment(marts.active(s), dims.state_dim(spark))
    return quality.key_coverage(s, emp, "ano", "em_silver", "em_gold")


def unit_consistency(spark, sf):
    return quality.ratio_check(inputs.silver(spark, sf), ["ano"], "remun_dezembro_nom",
                               "remun_dezembro_sm", MIN_WAGE_RATIO, 0.01)


def check_rollup(spark, sf):
    """Declared checks of every aula (a customer stands for one) against their latest status.

    Every declared aula has a row, zeros where nothing ran; its last run is that of any record.
    """
    from microlake.queries.windows import _history_rows
    latest = windows.latest_per_key(_history_rows(spark, sf), ["aula", "check"], "ts", "detalhe", ["status"])
    known = F.col("check").isin(DECLARED_CHECKS)
    ran = latest.groupBy("aula").agg(
        F.count_if(known & (F.col("status") == "passou")).alias("passaram"),
        F.count_if(known & (F.col("status") == "falhou")).alias("falharam"),
        F.max("ts").alias("ultima_execucao"))
    aulas = inputs.table(spark, sf, "customer").select(F.col("c_custkey").cast("int").alias("aula"))
    done = {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("passaram", "falharam")}
    return aulas.join(ran, "aula", "left").select(
        "aula", F.lit(len(DECLARED_CHECKS)).cast("bigint").alias("declarados"), *[v.alias(c) for c, v in done.items()],
        (F.lit(len(DECLARED_CHECKS)) - done["passaram"] - done["falharam"]).cast("bigint").alias("sem_execucao"),
        "ultima_execucao")


def small_cell_suppression(spark, sf):
    emp = marts.employment(marts.active(inputs.silver(spark, sf)), dims.state_dim(spark))
    return quality.suppress_small_cells(
        emp, "qtd_vinculos",
        ["massa_salarial_dez_nom", "remun_media_dez_nom", "remun_media_dez_sm",
         "remun_mediana_dez_sm"], SMALL_CELL_K)


QUERIES = {f.__name__: f for f in [
    layer_gate, schema_contract_diff, range_violations, rank_bound, year_coverage,
    unit_consistency, check_rollup, small_cell_suppression]}

_GATE = f"""
SELECT s.ano, r.* FROM (
  SELECT ano, count(*) AS qs, avg(CAST(remun_dezembro_nom IS NULL AS INT)) AS nr,
         avg(CAST(cod_uf IS NULL AS INT)) AS nu FROM silver GROUP BY ano) s
JOIN (SELECT ano, count(*) AS qb FROM raw GROUP BY ano) b ON s.ano = b.ano,
LATERAL (SELECT * FROM (VALUES
  ('silver_nao_vazia', CAST(qs AS DOUBLE), 1.0::DOUBLE, qs >= 1),
  ('silver_igual_bronze', CAST(qs AS DOUBLE), CAST(qb AS DOUBLE), qs = qb),
  ('nulo_remuneracao', nr, {config.MAX_NULL_PAY}::DOUBLE, coalesce(nr <= {config.MAX_NULL_PAY}, false)),
  ('nulo_uf', nu, {config.MAX_NULL_STATE}::DOUBLE, coalesce(nu <= {config.MAX_NULL_STATE}, false))
) v(regra, valor, limite, ok)) r"""

_RANGES = f"""
SELECT g.ano, r.* FROM (
  SELECT ano, count_if(NOT (idade BETWEEN 14 AND 100)) AS a,
    count_if(NOT (mes_desligamento BETWEEN 1 AND 12)) AS b FROM silver GROUP BY ano) g
JOIN (SELECT ano, count_if(NOT ({o.sql_int('idade')} BETWEEN 14 AND 100)) AS c,
    count_if(NOT ({o.sql_int('mes_desligamento')} BETWEEN 1 AND 12)) AS d FROM raw GROUP BY ano) w
  ON g.ano = w.ano,
LATERAL (SELECT * FROM (VALUES ('idade_silver', CAST(a AS BIGINT)), ('mes_silver', CAST(b AS BIGINT)),
  ('idade_bruta', CAST(c AS BIGINT)), ('mes_bruto', CAST(d AS BIGINT))) v(regra, qtd)) r"""

SQL = {
    "layer_gate": o.with_(*o.BASE) + _GATE,
    "schema_contract_diff": o.with_(o.RAW) + " UNION ALL ".join(
        f"SELECT 'bronze' AS tabela, '{c}' AS coluna, '{t}' AS tipo_esperado, CAST(count(*) AS BIGINT) AS linhas, "
        f"CAST(count_if(coalesce(trim({c}), '') <> '') AS BIGINT) AS preenchidas, "
        f"CAST(count_if(coalesce(trim({c}), '') <> '' AND {(o.sql_int if t == 'int' else o.sql_dec)(c)} IS NULL) AS BIGINT) AS falhas "
        f"FROM raw" for t, cols in _TYPED.items() for c in cols),
    "range_violations": o.with_(*o.BASE) + _RANGES,
    "rank_bound": o.with_(*o.BASE_ACTIVE) + """
SELECT ano, cod_uf, CAST(max(rn) AS INT) AS max_posicao, max(rn) <= 10 AS ok FROM (
  SELECT ano, cod_uf, row_number() OVER (PARTITION BY ano, cod_uf ORDER BY m DESC, cnae_divisao) AS rn
  FROM (SELECT ano, cod_uf, cnae_divisao, sum(remun_dezembro_nom) AS m FROM active
        WHERE cnae_divisao IS NOT NULL GROUP BY 1, 2, 3) a) r WHERE rn <= 10 GROUP BY 1, 2""",
    "year_coverage": o.with_(*o.BASE_ACTIVE) + """
SELECT coalesce(s.ano, g.ano) AS ano, s.ano IS NOT NULL AS em_silver, g.ano IS NOT NULL AS em_gold
FROM (SELECT DISTINCT ano FROM silver) s FULL JOIN (SELECT DISTINCT ano FROM active) g ON s.ano = g.ano""",
    "unit_consistency": o.with_(*o.BASE) + f"""
SELECT ano, razao, {MIN_WAGE_RATIO}::DOUBLE AS esperado,
  coalesce(abs(CAST(razao AS DOUBLE) - {MIN_WAGE_RATIO}) <= {MIN_WAGE_RATIO * 0.01}, false) AS ok
FROM (SELECT ano, {o.dec_ratio_round('sum(remun_dezembro_nom)', 'sum(remun_dezembro_sm)', 2, out_precision=31)} AS razao
      FROM silver GROUP BY ano) x""",
    "check_rollup": """
WITH h AS (SELECT CAST(user_id AS INT) AS aula, event_type AS "check", ts,
    CASE WHEN value > 50 THEN 'passou' ELSE 'falhou' END AS status,
    row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC,
                       'event ' || CAST(event_id AS VARCHAR) DESC) AS rn
  FROM events),
r AS (SELECT aula, count_if(status = 'passou' AND "check" IN ('click', 'error', 'purchase', 'signup', 'view')) AS p,
    count_if(status = 'falhou' AND "check" IN ('click', 'error', 'purchase', 'signup', 'view')) AS f, max(ts) AS ultima
  FROM h WHERE rn = 1 GROUP BY aula)
SELECT CAST(c_custkey AS INT) AS aula, CAST(5 AS BIGINT) AS declarados, CAST(coalesce(p, 0) AS BIGINT) AS passaram,
  CAST(coalesce(f, 0) AS BIGINT) AS falharam, CAST(5 - coalesce(p, 0) - coalesce(f, 0) AS BIGINT) AS sem_execucao,
  ultima AS ultima_execucao
FROM customer LEFT JOIN r ON aula = CAST(c_custkey AS INT)""",
    "small_cell_suppression": o.with_(*o.BASE_ACTIVE, o.STATES) + f"""
SELECT ano, cod_uf, uf, qtd_vinculos,
  CASE WHEN qtd_vinculos >= {SMALL_CELL_K} THEN massa_salarial_dez_nom END AS massa_salarial_dez_nom,
  CASE WHEN qtd_vinculos >= {SMALL_CELL_K} THEN remun_media_dez_nom END AS remun_media_dez_nom,
  CASE WHEN qtd_vinculos >= {SMALL_CELL_K} THEN remun_media_dez_sm END AS remun_media_dez_sm,
  CASE WHEN qtd_vinculos >= {SMALL_CELL_K} THEN remun_mediana_dez_sm END AS remun_mediana_dez_sm,
  NOT (qtd_vinculos >= {SMALL_CELL_K}) AS suprimido
FROM (SELECT e.*, d.uf FROM (
  SELECT ano, cod_uf, CAST(count(*) AS BIGINT) AS qtd_vinculos,
    CAST(sum(remun_dezembro_nom) AS DECIMAL(28,2)) AS massa_salarial_dez_nom,
    {o.round_avg_dec('remun_dezembro_nom')} AS remun_media_dez_nom,
    {o.round_avg_dec('remun_dezembro_sm')} AS remun_media_dez_sm,
    quantile_disc(remun_dezembro_sm, 0.5) AS remun_mediana_dez_sm
  FROM active GROUP BY ano, cod_uf) e LEFT JOIN dim_uf d ON e.cod_uf = d.cod_uf) m""",
}
