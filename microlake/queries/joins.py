"""Registered join queries (customer, nation, region, orders, supplier, silver)."""
from __future__ import annotations

from pyspark.sql import functions as F

from microlake.functions import clean
from microlake.operators import dims, joins, marts
from microlake.queries import inputs
from microlake.queries import oracle as o


def _customer_states(spark, sf):
    cu = inputs.table(spark, sf, "customer")
    return cu.select("c_custkey", "c_name", (11 + F.col("c_nationkey")).cast("string").alias("cod_uf"))


def broadcast_left_join(spark, sf):
    """Customers labelled with their state; unknown codes keep the row with NULL label."""
    return dims.label(_customer_states(spark, sf), dims.state_dim(spark), "cod_uf")


def join_kinds(spark, sf):
    """Rows of every join kind between all orders and all customers (customers
    without orders make right/full differ from inner)."""
    od = inputs.table(spark, sf, "orders")
    cu = inputs.table(spark, sf, "customer")
    return joins.join_kind_counts(od.select("o_orderkey", "o_custkey"),
                                  cu.select("c_custkey", "c_name"), "o_custkey", "c_custkey")


def orphan_state_codes(spark, sf):
    return joins.orphan_codes(inputs.silver(spark, sf), dims.dim_state(spark), "cod_uf")


def domain_violations(spark, sf):
    """Codes outside their dimension, all rules in one scan of silver."""
    return joins.domain_violations(inputs.silver(spark, sf), {
        "uf_fora_do_dominio": ("cod_uf", dims.dim_state(spark)),
        "escolaridade_fora_do_dominio": ("escolaridade", dims.dim_schooling(spark)),
        "sexo_fora_do_dominio": ("sexo", dims.dim_sex(spark))})


def municipalities(spark, sf):
    """Municipality dimension derived from suppliers: 7-digit code (6 + check digit),
    name, state. Grows with the supplier table, so it is joined without a hint."""
    su = inputs.table(spark, sf, "supplier")
    code6 = F.concat((11 + F.col("s_nationkey")).cast("string"),
                     F.lpad((F.col("s_suppkey") % 10000).cast("string"), 4, "0"))
    return su.select(F.concat(code6, (F.col("s_suppkey") % 10).cast("string")).alias("id"),
                     F.col("s_name").alias("nome_municipio"))


def geo_enrich(spark, sf):
    s = inputs.silver(spark, sf).select("ano", "cod_municipio", "cod_uf")
    m = municipalities(spark, sf)
    # one row per 6-digit key (a dimension key must be unique or totals inflate)
    m6 = (m.groupBy(F.substring("id", 1, 6).alias("cod_municipio"))
          .agg(F.min("nome_municipio").alias("nome_municipio")))
    e = (s.join(m6, "cod_municipio", "left")
         .join(dims.state_dim(spark), "cod_uf", "left")
         .withColumn("regiao", clean.region_of(F.col("cod_uf"))))
    return e.groupBy("ano", "regiao", "uf", "nome_municipio").agg(
        F.count(F.lit(1)).alias("qtd_vinculos"))


def _deflators(spark):
    """Year-keyed price factors (a small reference table: one row per year of a fixed
    range, so its size is bounded by construction and it is broadcast)."""
    years = spark.range(1990, 2031).select(F.col("id").cast("int").alias("ano"))
    factor = F.lit(1) + (F.lit(2001) - F.col("ano")) * F.lit("0.05").cast("decimal(9,6)")
    return years.select("ano", factor.cast("decimal(9,6)").alias("fator"))


def deflate_series(spark, sf):
    yearly = marts.year_totals(marts.employment(marts.active(inputs.silver(spark, sf)),
                                                dims.state_dim(spark)))
    return joins.apply_factor(yearly, _deflators(spark), "ano", "massa_salarial_dez_nom",
                              "fator", "massa_salarial_real")


def per_capita(spark, sf):
    """Links per 1,000 inhabitants; population = customers per state code."""
    pop = (_customer_states(spark, sf).groupBy("cod_uf")
           .agg(F.count(F.lit(1)).alias("populacao")))
    links = (marts.active(inputs.silver(spark, sf)).groupBy("ano", "cod_uf")
             .agg(F.count(F.lit(1)).alias("qtd_vinculos")))
    return joins.rate_per(links, pop, ["cod_uf"], "qtd_vinculos", "populacao", 1000,
                          "vinculos_por_mil")


def top1_via_join(spark, sf):
    od = inputs.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return joins.top1_via_join(od, "o_custkey", "o_totalprice")


def dim_lookup(spark, sf):
    """Silver labelled with all three literal dimensions (broadcast, bounded)."""
    s = inputs.silver(spark, sf).select("ano", "cod_uf", "sexo", "escolaridade")
    return (s.join(dims.state_dim(spark), "cod_uf", "left")
            .join(dims.sex_dim(spark), "sexo", "left")
            .join(dims.schooling_dim(spark), "escolaridade", "left")
            .groupBy("ano", "uf", "sexo_desc", "escolaridade_desc")
            .agg(F.count(F.lit(1)).alias("qtd_vinculos")))


QUERIES = {f.__name__: f for f in [
    broadcast_left_join, join_kinds, orphan_state_codes, domain_violations, geo_enrich,
    deflate_series, per_capita, top1_via_join, dim_lookup]}

_SEX = "dim_sexo AS (SELECT * FROM (VALUES (1,'Masculino'),(2,'Feminino')) t(sexo, sexo_desc))"
_EMP_YEAR = f"""yearly AS (
SELECT ano, CAST(count(*) AS BIGINT) AS qtd_vinculos,
  CAST(sum(remun_dezembro_nom) AS DECIMAL(38,2)) AS massa_salarial_dez_nom
FROM active GROUP BY ano)"""
_DEFL = """defl AS (SELECT ano, CAST(1 + (2001 - ano) * CAST(0.05 AS DECIMAL(9,6)) AS DECIMAL(9,6)) AS fator
FROM (SELECT CAST(range AS INT) AS ano FROM range(1990, 2031)) y)"""

SQL = {
    "broadcast_left_join": o.with_(o.STATES) + """
SELECT c_custkey, c_name, c.cod_uf, d.uf
FROM (SELECT c_custkey, c_name, cast(11 + c_nationkey AS string) AS cod_uf FROM customer) c
LEFT JOIN dim_uf d ON c.cod_uf = d.cod_uf""",
    "join_kinds": """WITH l AS (SELECT o_orderkey, o_custkey FROM orders),
r AS (SELECT c_custkey, c_name FROM customer)
SELECT 'inner' AS tipo, CAST(count(*) AS BIGINT) AS qtd FROM l JOIN r ON o_custkey = c_custkey
UNION ALL SELECT 'left', count(*) FROM l LEFT JOIN r ON o_custkey = c_custkey
UNION ALL SELECT 'right', count(*) FROM l RIGHT JOIN r ON o_custkey = c_custkey
UNION ALL SELECT 'full', count(*) FROM l FULL JOIN r ON o_custkey = c_custkey
UNION ALL SELECT 'left_semi', count(*) FROM l WHERE o_custkey IN (SELECT c_custkey FROM r)
UNION ALL SELECT 'left_anti', count(*) FROM l WHERE NOT EXISTS (SELECT 1 FROM r WHERE c_custkey = o_custkey)""",
    "orphan_state_codes": o.with_(*o.BASE, o.STATES) + """
SELECT DISTINCT cod_uf FROM silver WHERE cod_uf IS NOT NULL AND cod_uf NOT IN (SELECT cod_uf FROM dim_uf)""",
    "domain_violations": o.with_(*o.BASE, o.STATES, o.SCHOOLING, _SEX) + """
SELECT 'uf_fora_do_dominio' AS regra, cod_uf AS codigo, CAST(count(*) AS BIGINT) AS qtd FROM silver
WHERE cod_uf IS NOT NULL AND cod_uf NOT IN (SELECT cod_uf FROM dim_uf) GROUP BY cod_uf
UNION ALL
SELECT 'escolaridade_fora_do_dominio', CAST(escolaridade AS VARCHAR), count(*) FROM silver
WHERE escolaridade IS NOT NULL AND escolaridade NOT IN (SELECT escolaridade FROM dim_esc) GROUP BY escolaridade
UNION ALL
SELECT 'sexo_fora_do_dominio', CAST(sexo AS VARCHAR), count(*) FROM silver
WHERE sexo IS NOT NULL AND sexo NOT IN (SELECT sexo FROM dim_sexo) GROUP BY sexo""",
    "geo_enrich": o.with_(*o.BASE, o.STATES) + f"""
, m AS (SELECT substring(cast(11 + s_nationkey AS string) || lpad(cast(s_suppkey % 10000 AS string), 4, '0')
          || cast(s_suppkey % 10 AS string), 1, 6) AS cod_municipio, min(s_name) AS nome_municipio
          FROM supplier GROUP BY 1)
SELECT ano, {o.REGION_CASE.format(c='s.cod_uf')} AS regiao, d.uf, m.nome_municipio,
  CAST(count(*) AS BIGINT) AS qtd_vinculos
FROM silver s LEFT JOIN m ON s.cod_municipio = m.cod_municipio LEFT JOIN dim_uf d ON s.cod_uf = d.cod_uf
GROUP BY 1, 2, 3, 4""",
    "deflate_series": o.with_(*o.BASE_ACTIVE, _EMP_YEAR, _DEFL) + """
SELECT y.ano, qtd_vinculos, massa_salarial_dez_nom, fator,
  CAST(massa_salarial_dez_nom * fator AS DECIMAL(28,2)) AS massa_salarial_real
FROM yearly y LEFT JOIN defl d ON y.ano = d.ano""",
    "per_capita": o.with_(*o.BASE_ACTIVE) + f"""
, pop AS (SELECT cast(11 + c_nationkey AS string) AS cod_uf, CAST(count(*) AS BIGINT) AS populacao
          FROM customer GROUP BY 1)
, links AS (SELECT ano, cod_uf, CAST(count(*) AS BIGINT) AS qtd_vinculos FROM active GROUP BY 1, 2)
SELECT l.ano, l.cod_uf, l.qtd_vinculos, p.populacao,
  {o.rate_round('l.qtd_vinculos * 1000', 'p.populacao', 3)} AS vinculos_por_mil
FROM links l LEFT JOIN pop p ON l.cod_uf = p.cod_uf""",
    "top1_via_join": """
SELECT o.o_orderkey, o.o_custkey, o.o_totalprice FROM orders o
JOIN (SELECT o_custkey, max(o_totalprice) AS best FROM orders GROUP BY o_custkey) b
  ON o.o_custkey IS NOT DISTINCT FROM b.o_custkey AND o.o_totalprice = b.best""",
    "dim_lookup": o.with_(*o.BASE, o.STATES, o.SCHOOLING, _SEX) + """
SELECT ano, d.uf, x.sexo_desc, e.escolaridade_desc, CAST(count(*) AS BIGINT) AS qtd_vinculos
FROM silver s LEFT JOIN dim_uf d ON s.cod_uf = d.cod_uf LEFT JOIN dim_sexo x ON s.sexo = x.sexo
LEFT JOIN dim_esc e ON s.escolaridade = e.escolaridade GROUP BY 1, 2, 3, 4""",
}
