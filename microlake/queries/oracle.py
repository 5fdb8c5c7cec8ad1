"""Independent SQL (DuckDB dialect) for the correctness gate.

The oracle re-derives everything from the driver's tables with plain SQL; it shares
no code with the Spark side. Helpers below reproduce Spark's decimal result types
and HALF_UP rounding with exact integer arithmetic, because DuckDB averages decimals
as DOUBLE.
"""
from __future__ import annotations

RAW = """raw AS (
SELECT cast(year(l_shipdate) AS int) AS ano,
  CASE WHEN l_orderkey % 199 = 0 THEN '9999'
       ELSE cast(11 + c_nationkey AS string) || lpad(cast(l_suppkey % 10000 AS string), 4, '0') END AS municipio,
  CASE WHEN l_orderkey % 83 = 0 THEN '4711' ELSE cast(10000 + (l_partkey * 37) % 89999 AS string) END AS cnae_2_0_classe,
  lpad(cast((l_partkey * 13) % 1000000 AS string), 6, '0') AS cbo_ocupacao_2002,
  CASE WHEN l_linestatus = 'O' THEN '1' ELSE '0' END AS vinculo_ativo_31_12,
  '0' || cast(1 + l_suppkey % 2 AS string) AS sexo_trabalhador,
  cast(1 + l_partkey % 12 AS string) AS escolaridade_apos_2005,
  cast(1 + l_orderkey % 9 AS string) AS raca_cor,
  CASE WHEN l_orderkey % 89 = 0 THEN '150' ELSE cast(16 + cast(l_quantity AS int) AS string) END AS idade,
  cast(1 + l_orderkey % 240 AS string) || ',' || cast(l_linenumber % 10 AS string) AS tempo_emprego,
  CASE WHEN l_linestatus = 'O' THEN '0' ELSE cast(month(l_shipdate) AS string) END AS mes_desligamento,
  CASE WHEN l_linestatus = 'O' THEN '0' ELSE '11' END AS motivo_desligamento,
  cast(1 + l_suppkey % 10 AS string) AS tamanho_estabelecimento,
  '2062' AS natureza_juridica,
  CASE WHEN l_orderkey % 101 = 0 THEN '{ñ class}' WHEN l_orderkey % 97 = 0 THEN ''
       WHEN year(l_shipdate) < 1999 THEN replace(cast(cast(l_extendedprice AS decimal(18,2)) AS string), '.', ',')
       ELSE cast(cast(l_extendedprice AS decimal(18,2)) AS string) END AS vl_remun_dezembro_nom,
  replace(cast(cast(cast(l_extendedprice AS decimal(18,2)) * cast(0.95 AS decimal(9,6)) AS decimal(18,2)) AS string), '.', ',') AS vl_remun_media_nom,
  replace(cast(cast(cast(l_extendedprice AS decimal(18,2)) * cast(0.000825 AS decimal(9,6)) AS decimal(18,2)) AS string), '.', ',') AS vl_remun_dezembro_sm,
  replace(cast(cast(cast(l_extendedprice AS decimal(18,2)) * cast(0.000784 AS decimal(9,6)) AS decimal(18,2)) AS string), '.', ',') AS vl_remun_media_sm
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
)"""


def sql_int(x: str) -> str:
    """Spark ``try_cast(trim(x) AS int)``: DuckDB would round '1.5' to 2, so guard it."""
    return (f"CASE WHEN regexp_full_match(trim({x}), '[+-]?[0-9]+') "
            f"THEN TRY_CAST(trim({x}) AS INTEGER) END")


def sql_dec(x: str, p: int = 18, s: int = 2) -> str:
    t = f"trim({x})"
    return (f"TRY_CAST(CASE WHEN instr({t}, ',') > 0 THEN replace(replace({t}, '.', ''), ',', '.') "
            f"ELSE {t} END AS DECIMAL({p},{s}))")


def sql_pay(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR trim({x}) = '' THEN CAST(0 AS DECIMAL(18,2)) ELSE {sql_dec(x)} END"


SILVER = f"""silver AS (
SELECT ano, cod_municipio, substring(cod_municipio, 1, 2) AS cod_uf,
  cnae_classe, substring(cnae_classe, 1, 2) AS cnae_divisao, cbo, natureza_juridica,
  sexo, escolaridade, raca_cor,
  CASE WHEN idade0 BETWEEN 14 AND 100 THEN idade0 END AS idade,
  tamanho_estab,
  CASE WHEN mes0 BETWEEN 1 AND 12 THEN mes0 END AS mes_desligamento,
  motivo_desligamento, tempo_emprego_meses, vinculo_ativo,
  (CASE WHEN mes0 BETWEEN 1 AND 12 THEN mes0 END) IS NOT NULL AS desligado_no_ano,
  remun_dezembro_nom, remun_media_nom, remun_dezembro_sm, remun_media_sm
FROM (SELECT ano,
  CASE WHEN regexp_full_match(trim(municipio), '[0-9]{{6}}') THEN trim(municipio) END AS cod_municipio,
  CASE WHEN regexp_full_match(trim(cnae_2_0_classe), '[0-9]{{5}}') THEN trim(cnae_2_0_classe) END AS cnae_classe,
  trim(cbo_ocupacao_2002) AS cbo, trim(natureza_juridica) AS natureza_juridica,
  {sql_int('sexo_trabalhador')} AS sexo,
  {sql_int('escolaridade_apos_2005')} AS escolaridade,
  {sql_int('raca_cor')} AS raca_cor,
  {sql_int('idade')} AS idade0,
  {sql_int('tamanho_estabelecimento')} AS tamanho_estab,
  {sql_int('mes_desligamento')} AS mes0,
  {sql_int('motivo_desligamento')} AS motivo_desligamento,
  {sql_dec('tempo_emprego', 10, 1)} AS tempo_emprego_meses,
  trim(vinculo_ativo_31_12) = '1' AS vinculo_ativo,
  {sql_pay('vl_remun_dezembro_nom')} AS remun_dezembro_nom,
  {sql_pay('vl_remun_media_nom')} AS remun_media_nom,
  {sql_pay('vl_remun_dezembro_sm')} AS remun_dezembro_sm,
  {sql_pay('vl_remun_media_sm')} AS remun_media_sm
FROM raw) s0
)"""

ACTIVE = "active AS (SELECT * FROM silver WHERE vinculo_ativo)"

STATES = """dim_uf AS (SELECT * FROM (VALUES
  ('11','RO'),('12','AC'),('13','AM'),('14','RR'),('15','PA'),('16','AP'),('17','TO'),
  ('21','MA'),('22','PI'),('23','CE'),('24','RN'),('25','PB'),('26','PE'),('27','AL'),
  ('28','SE'),('29','BA'),('31','MG'),('32','ES'),('33','RJ'),('35','SP'),('41','PR'),
  ('42','SC'),('43','RS'),('50','MS'),('51','MT'),('52','GO'),('53','DF')) t(cod_uf, uf))"""

SCHOOLING = """dim_esc AS (SELECT * FROM (VALUES
  (1,'Analfabeto'),(2,'Até 5ª incompleto'),(3,'5ª completo fundamental'),
  (4,'6ª a 9ª fundamental'),(5,'Fundamental completo'),(6,'Médio incompleto'),
  (7,'Médio completo'),(8,'Superior incompleto'),(9,'Superior completo'),
  (10,'Mestrado'),(11,'Doutorado')) t(escolaridade, escolaridade_desc))"""

REGION_CASE = ("CASE substring({c}, 1, 1) WHEN '1' THEN 'Norte' WHEN '2' THEN 'Nordeste' "
               "WHEN '3' THEN 'Sudeste' WHEN '4' THEN 'Sul' WHEN '5' THEN 'Centro-Oeste' END")


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = (RAW, SILVER)
BASE_ACTIVE = (RAW, SILVER, ACTIVE)


# --- exact Spark decimal arithmetic ------------------------------------------------------

def _half_up_div(num: str, den: str) -> str:
    """round_half_up(num / den) for integers, any sign; NULL when den is 0 or NULL."""
    return (f"(sign({num}) * sign({den}) * ((2 * abs({num}) + abs({den})) // (2 * abs({den}))))")


def units6(x: str, scale: int = 2) -> str:
    """Spark ``avg(decimal(p,scale))`` as an integer count of 1e-6 units (HALF_UP)."""
    cents = f"CAST(sum({x}) * {10 ** scale} AS HUGEINT)"
    n = f"nullif(count({x}), 0)"
    return _half_up_div(f"{cents} * {10 ** (6 - scale)}", n)


def avg_dec(x: str, scale: int = 2) -> str:
    """Spark avg of decimal(18,scale) -> decimal(22, scale+4)."""
    return f"CAST(CAST({units6(x, scale)} AS DECIMAL(38,0)) * 0.000001 AS DECIMAL(22,6))"


def round_avg_dec(x: str, k: int = 2, scale: int = 2) -> str:
    """Spark ``round(avg(decimal(18,scale)), k)`` -> decimal(19,k)."""
    u = units6(x, scale)
    step = 10 ** (6 - k)
    return (f"CAST(CAST({_half_up_div(u, str(step))} AS DECIMAL(38,0)) * {1 / 10 ** k:.{k}f} "
            f"AS DECIMAL({17 + k},{k}))")


def ratio_round(u_num: str, u_den: str, k: int = 3) -> str:
    """Spark ``round(try_divide(a, b), k)`` for two decimal(22,6) averages given as units."""
    q = _half_up_div(f"({u_num}) * {10 ** k}", f"nullif({u_den}, 0)")
    return f"CAST(CAST({q} AS DECIMAL(38,0)) * {1 / 10 ** k:.{k}f} AS DECIMAL({23 + k},{k}))"


def rate_round(num: str, den: str, k: int = 4) -> str:
    """Spark ``round(try_divide(bigint, bigint), k)`` -> double."""
    return f"CAST({_half_up_div(f'({num}) * {10 ** k}', f'nullif({den}, 0)')} AS DOUBLE) / {10 ** k}"


def dec_ratio_round(a: str, b: str, k: int = 3, scale: int = 2, out_precision: int = 38) -> str:
    """Spark ``round(try_divide(a, b), k)`` for two decimal(18,scale) values."""
    q = _half_up_div(f"CAST(({a}) * {10 ** scale} AS HUGEINT) * {10 ** k}",
                     f"nullif(CAST(({b}) * {10 ** scale} AS HUGEINT), 0)")
    return f"CAST(CAST({q} AS DECIMAL(38,0)) * {1 / 10 ** k:.{k}f} AS DECIMAL({out_precision},{k}))"
