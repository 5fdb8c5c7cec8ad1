"""Registered mart queries (view ``silver`` over the driver's tables)."""
from __future__ import annotations

from microlake.operators import dims, marts
from microlake.queries import inputs
from microlake.queries import oracle as o


def _actives(spark, sf):
    return marts.active(inputs.silver(spark, sf))


def mart_employment(spark, sf):
    return marts.employment(_actives(spark, sf), dims.state_dim(spark))


def mart_pay_gap(spark, sf):
    return marts.pay_gap(_actives(spark, sf), dims.state_dim(spark))


def mart_pay_gap_median(spark, sf):
    return marts.pay_gap_median(_actives(spark, sf), dims.state_dim(spark))


def mart_top_industry(spark, sf):
    return marts.top_industry(_actives(spark, sf), dims.state_dim(spark), 10)


def mart_schooling(spark, sf):
    return marts.schooling(_actives(spark, sf), dims.schooling_dim(spark))


def mart_separation(spark, sf):
    return marts.separation(inputs.silver(spark, sf), dims.state_dim(spark))


def mart_size(spark, sf):
    return marts.by_size(_actives(spark, sf))


def mart_age_band(spark, sf):
    return marts.by_age_band(_actives(spark, sf))


def region_totals(spark, sf):
    return marts.region_totals(mart_employment(spark, sf))


def year_totals(spark, sf):
    return marts.year_totals(mart_employment(spark, sf))


def gold_all_employment(spark, sf):
    """Employment mart from the shared one-scan aggregate (must equal mart_employment)."""
    return marts.all_marts(inputs.silver(spark, sf), spark)["gold_emprego_uf_ano"]


def gold_all_separation(spark, sf):
    return marts.all_marts(inputs.silver(spark, sf), spark)["gold_desligamento_uf_ano"]


def gold_top_industry_from_facts(spark, sf):
    """Top-10 industries rebuilt from the re-aggregatable fine facts."""
    fine = marts.fine_facts(_actives(spark, sf))
    return marts.top_industry_from_facts(fine, dims.state_dim(spark), 10)


def gold_schooling_from_facts(spark, sf):
    fine = marts.fine_facts(_actives(spark, sf))
    return marts.schooling_from_facts(fine, dims.schooling_dim(spark))


QUERIES = {
    "mart_employment": mart_employment,
    "mart_pay_gap": mart_pay_gap,
    "mart_pay_gap_median": mart_pay_gap_median,
    "mart_top_industry": mart_top_industry,
    "mart_schooling": mart_schooling,
    "mart_separation": mart_separation,
    "mart_size": mart_size,
    "mart_age_band": mart_age_band,
    "region_totals": region_totals,
    "year_totals": year_totals,
    "gold_all_employment": gold_all_employment,
    "gold_all_separation": gold_all_separation,
    "gold_top_industry_from_facts": gold_top_industry_from_facts,
    "gold_schooling_from_facts": gold_schooling_from_facts,
}

_EMP = f"""emp AS (
SELECT e.*, d.uf FROM (
  SELECT ano, cod_uf, CAST(count(*) AS BIGINT) AS qtd_vinculos,
    CAST(sum(remun_dezembro_nom) AS DECIMAL(28,2)) AS massa_salarial_dez_nom,
    {o.round_avg_dec('remun_dezembro_nom')} AS remun_media_dez_nom,
    {o.round_avg_dec('remun_dezembro_sm')} AS remun_media_dez_sm,
    quantile_disc(remun_dezembro_sm, 0.5) AS remun_mediana_dez_sm
  FROM active GROUP BY ano, cod_uf) e
LEFT JOIN dim_uf d ON e.cod_uf = d.cod_uf)"""

_F = "CASE WHEN sexo = 2 THEN remun_dezembro_sm END"
_M = "CASE WHEN sexo = 1 THEN remun_dezembro_sm END"

_SEP = f"""sep AS (
SELECT s.*, {o.rate_round('qtd_desligados', 'qtd_vinculos_no_ano')} AS taxa_desligamento, d.uf FROM (
  SELECT ano, cod_uf, CAST(count(*) AS BIGINT) AS qtd_vinculos_no_ano,
    CAST(sum(CAST(desligado_no_ano AS INT)) AS BIGINT) AS qtd_desligados
  FROM silver GROUP BY ano, cod_uf) s
LEFT JOIN dim_uf d ON s.cod_uf = d.cod_uf)"""

SQL = {
    "mart_employment": o.with_(*o.BASE_ACTIVE, o.STATES, _EMP) + "SELECT * FROM emp",
    "mart_pay_gap": o.with_(*o.BASE_ACTIVE, o.STATES) + f"""
SELECT g.ano, g.cod_uf, d.uf,
  {o.avg_dec(_F)} AS rem_mulher_sm, {o.avg_dec(_M)} AS rem_homem_sm,
  {o.ratio_round(o.units6(_F), o.units6(_M))} AS razao_mulher_homem
FROM active g LEFT JOIN dim_uf d ON g.cod_uf = d.cod_uf
GROUP BY g.ano, g.cod_uf, d.uf""",
    "mart_pay_gap_median": o.with_(*o.BASE_ACTIVE, o.STATES) + f"""
SELECT x.*, d.uf FROM (
SELECT ano, cod_uf,
  {o.avg_dec(_F)} AS rem_mulher_sm, {o.avg_dec(_M)} AS rem_homem_sm,
  quantile_disc({_F}, 0.5) AS mediana_mulher_sm, quantile_disc({_M}, 0.5) AS mediana_homem_sm,
  {o.ratio_round(o.units6(_F), o.units6(_M))} AS razao_mulher_homem,
  {o.dec_ratio_round(f'quantile_disc({_F}, 0.5)', f'quantile_disc({_M}, 0.5)', out_precision=22)} AS razao_mediana_mulher_homem
FROM active GROUP BY ano, cod_uf) x LEFT JOIN dim_uf d ON x.cod_uf = d.cod_uf""",
    "mart_top_industry": o.with_(*o.BASE_ACTIVE, o.STATES) + """
SELECT r.*, d.uf FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY ano, cod_uf
                 ORDER BY massa_salarial_dez_nom DESC, cnae_divisao ASC) AS INT) AS posicao
  FROM (SELECT ano, cod_uf, cnae_divisao, CAST(count(*) AS BIGINT) AS qtd_vinculos,
          CAST(sum(remun_dezembro_nom) AS DECIMAL(28,2)) AS massa_salarial_dez_nom
        FROM active WHERE cnae_divisao IS NOT NULL GROUP BY ano, cod_uf, cnae_divisao) a
) r LEFT JOIN dim_uf d ON r.cod_uf = d.cod_uf
WHERE r.posicao <= 10""",
    "mart_schooling": o.with_(*o.BASE_ACTIVE, o.SCHOOLING) + f"""
SELECT a.*, d.escolaridade_desc FROM (
  SELECT ano, escolaridade, CAST(count(*) AS BIGINT) AS qtd_vinculos,
    {o.round_avg_dec('remun_dezembro_sm')} AS remun_media_dez_sm
  FROM active GROUP BY ano, escolaridade) a
LEFT JOIN dim_esc d ON a.escolaridade = d.escolaridade""",
    "mart_separation": o.with_(*o.BASE, o.STATES, _SEP) + "SELECT * FROM sep",
    "mart_size": o.with_(*o.BASE_ACTIVE) + f"""
SELECT ano, tamanho_estab, CAST(count(*) AS BIGINT) AS qtd_vinculos,
  {o.round_avg_dec('remun_dezembro_sm')} AS remun_media_dez_sm
FROM active GROUP BY ano, tamanho_estab""",
    "mart_age_band": o.with_(*o.BASE_ACTIVE) + f"""
SELECT ano, faixa_etaria, CAST(count(*) AS BIGINT) AS qtd_vinculos,
  {o.round_avg_dec('remun_dezembro_sm')} AS remun_media_dez_sm
FROM (SELECT *, CASE WHEN idade IS NULL THEN NULL WHEN idade < 25 THEN 'ate_24'
        WHEN idade < 40 THEN '25_39' WHEN idade < 60 THEN '40_59' ELSE '60_mais' END AS faixa_etaria
      FROM active) a
GROUP BY ano, faixa_etaria""",
    "region_totals": o.with_(*o.BASE_ACTIVE, o.STATES, _EMP) + f"""
SELECT ano, {o.REGION_CASE.format(c='cod_uf')} AS regiao,
  CAST(sum(qtd_vinculos) AS BIGINT) AS qtd_vinculos,
  CAST(sum(massa_salarial_dez_nom) AS DECIMAL(38,2)) AS massa_salarial_dez_nom
FROM emp GROUP BY ano, regiao""",
    "year_totals": o.with_(*o.BASE_ACTIVE, o.STATES, _EMP) + """
SELECT ano, CAST(sum(qtd_vinculos) AS BIGINT) AS qtd_vinculos,
  CAST(sum(massa_salarial_dez_nom) AS DECIMAL(38,2)) AS massa_salarial_dez_nom
FROM emp GROUP BY ano""",
}
SQL["gold_all_employment"] = SQL["mart_employment"]
SQL["gold_all_separation"] = SQL["mart_separation"]
SQL["gold_top_industry_from_facts"] = SQL["mart_top_industry"]
SQL["gold_schooling_from_facts"] = SQL["mart_schooling"]
