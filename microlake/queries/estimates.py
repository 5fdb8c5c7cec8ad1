"""Registered queries: medians from stored sketches, safe suppression, drift of distributions, stratified sample."""
from __future__ import annotations

from pyspark.sql import functions as F

from microlake.functions import clean
from microlake.operators import disclosure, estimates, marts
from microlake.queries import inputs
from microlake.queries import oracle as o
from microlake.queries.quality import SMALL_CELL_K
from microlake.session import scratch_path

SAMPLE_K = 5
MAX_SHIFT, MAX_NULLS = 0.05, 0.02


def region_medians(spark, sf):
    """Medians per region from sketches stored per (ano, cod_uf). ``ok``: the rank of the merged median
    among the rows is within the sketch's bound; ``outro_ok`` asks the same of the 0.6 quantile,
    which must not pass for the median."""
    act = marts.active(inputs.silver(spark, sf)).withColumn("regiao", clean.region_of(F.col("cod_uf")))
    path = scratch_path(spark, "sketch-facts")
    estimates.sketch_facts(act, "remun_dezembro_sm", ["ano", "cod_uf"]).write.parquet(path)
    facts, by = spark.read.parquet(path), ["ano", "regiao"]
    found = estimates.rank_within(estimates.region_medians(facts), act, "remun_dezembro_sm", by)
    other = estimates.rank_within(estimates.region_medians(facts, 0.6), act, "remun_dezembro_sm", by)
    wrong = other.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("ok").alias("outro_ok"))
    return found.join(wrong, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]).select("ano", "regiao", "qtd", "qtd_valor", "ok", "outro_ok")


def suppression_safe(spark, sf):
    """Employment per state and year with small cells and those that would give them away withheld."""
    act = marts.active(inputs.silver(spark, sf))
    cells = act.groupBy("ano", "cod_uf").agg(F.count(F.lit(1)).alias("qtd_vinculos")) \
        .withColumn("regiao", clean.region_of(F.col("cod_uf")))
    out = disclosure.suppress(cells, "regiao", "cod_uf", "ano", "qtd_vinculos", SMALL_CELL_K)
    return out.withColumn("qtd_vinculos", F.when(F.col("supressao").isNull(), F.col("qtd_vinculos")))


_NUMERIC = {"idade": (14.0, 100.0), "remun_dezembro_sm": (0.0, 100.0)}
_NOMINAL = ["sexo", "cod_uf"]


def _damaged(silver):
    """A second load of silver: in one year a column loses a tenth of its values and another shifts."""
    hit = F.col("ano") == 1996
    tenth = F.substring(F.md5(F.concat_ws("|", "cod_municipio", "cbo", "remun_media_nom")), 1, 1).isin("0", "1")
    return silver.withColumn("sexo", F.when(hit & tenth, F.lit(None)).otherwise(F.col("sexo"))) \
        .withColumn("idade", F.when(hit, F.col("idade") + 20).otherwise(F.col("idade")))


def profile_drift(spark, sf):
    """Stored profiles of two loads of silver, the second damaged in one year, compared per year and column."""
    silver = inputs.silver(spark, sf)
    paths = []
    for name, rows in (("first", silver), ("second", _damaged(silver))):
        paths.append(scratch_path(spark, f"profile-{name}"))
        estimates.column_profile(rows, _NUMERIC, _NOMINAL, ["ano"]).coalesce(1).write.parquet(paths[-1])
    before, after = (spark.read.parquet(p) for p in paths)
    out = estimates.profile_drift(before, after, ["ano"], MAX_SHIFT, MAX_NULLS)
    return out.select("ano", "coluna", *[F.round(c, 6).alias(c) for c in ("distancia", "nulos_antes", "nulos_depois")], "ok")


def stratified_sample(spark, sf):
    """Five orders of every (year, status), merged from the samples of two halves of the table."""
    od = inputs.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("ano"))
    strata, ids = ["ano", "o_orderstatus"], ["o_orderkey"]
    halves = [estimates.stratified_sample(od.where(F.pmod("o_orderkey", F.lit(2)) == r), strata, ids, SAMPLE_K)
              for r in (0, 1)]
    return estimates.merge_samples(halves[0].unionByName(halves[1]), strata, ids, SAMPLE_K)


QUERIES = {f.__name__: f for f in [region_medians, suppression_safe, profile_drift, stratified_sample]}

_REGION = ("CASE substring(cod_uf, 1, 1) WHEN '1' THEN 'Norte' WHEN '2' THEN 'Nordeste' WHEN '3' THEN 'Sudeste' "
           "WHEN '4' THEN 'Sul' WHEN '5' THEN 'Centro-Oeste' END")


def _bin(c, low, high):
    v = f"CAST({c} AS DOUBLE)"
    width = (high - low) / estimates.BINS
    return (f"CASE WHEN {v} IS NULL THEN 'nulo' WHEN {v} < {low} THEN 'abaixo' WHEN {v} > {high} THEN 'acima' "
            f"ELSE CAST(CAST(least(floor(({v} - {low}) / CAST({width} AS DOUBLE)), {estimates.BINS - 1}) AS BIGINT) AS VARCHAR) END")


def _profiles(source):
    parts = [f"SELECT ano, '{c}' AS coluna, {_bin(c, *r)} AS faixa FROM {source}" for c, r in _NUMERIC.items()]
    parts += [f"SELECT ano, '{c}' AS coluna, coalesce(CAST({c} AS VARCHAR), 'nulo') AS faixa FROM {source}" for c in _NOMINAL]
    return "SELECT ano, coluna, faixa, count(*) AS n FROM (" + " UNION ALL ".join(parts) + ") x GROUP BY 1, 2, 3"


def _shares(source):
    return (f"SELECT ano, coluna, faixa, CASE WHEN faixa <> 'nulo' THEN n / sum(CASE WHEN faixa <> 'nulo' THEN n END) OVER w END AS s, "
            f"CASE WHEN faixa = 'nulo' THEN n / sum(n) OVER w END AS z FROM ({_profiles(source)}) p WINDOW w AS (PARTITION BY ano, coluna)")


SQL = {
    "region_medians": o.with_(*o.BASE_ACTIVE) + f"""
, v AS (SELECT ano, {_REGION} AS regiao, CAST(remun_dezembro_sm AS DOUBLE) AS v FROM active),
q AS (SELECT ano, regiao, count(*) AS n, count(v) AS nv, quantile_disc(v, 0.6) AS q60 FROM v GROUP BY ano, regiao),
r AS (SELECT q.ano, q.regiao, count_if(v < q60) / count(*) AS lo FROM v JOIN q ON v.ano IS NOT DISTINCT FROM q.ano
      AND v.regiao IS NOT DISTINCT FROM q.regiao WHERE v IS NOT NULL GROUP BY 1, 2)
SELECT q.ano, q.regiao, CAST(n AS BIGINT) AS qtd, CAST(nv AS BIGINT) AS qtd_valor, true AS ok,
  coalesce(r.lo - 0.5 <= {estimates.RANK_ERROR}, true) AS outro_ok
FROM q LEFT JOIN r ON q.ano IS NOT DISTINCT FROM r.ano AND q.regiao IS NOT DISTINCT FROM r.regiao""",
    "suppression_safe": o.with_(*o.BASE_ACTIVE) + f"""
, t AS (SELECT ano, cod_uf, {_REGION} AS regiao, count(*) AS n FROM active GROUP BY ano, cod_uf),
c AS (SELECT *, coalesce(regiao, chr(0)) AS g, coalesce(cod_uf, chr(0)) AS u, CAST(ano AS VARCHAR) AS y, n < {SMALL_CELL_K} AS small,
        CASE WHEN n < {SMALL_CELL_K} THEN 0 ELSE n END AS cost FROM t),
r AS (SELECT p.g, p.u, p.y, a.u AS u2, b.y AS y2,
        row_number() OVER (PARTITION BY p.g, p.u, p.y ORDER BY a.cost + b.cost + d.cost, a.u, b.y) AS k
      FROM c p JOIN c a ON a.g = p.g AND a.y = p.y AND a.u <> p.u JOIN c b ON b.g = p.g AND b.u = p.u AND b.y <> p.y
      JOIN c d ON d.g = p.g AND d.u = a.u AND d.y = b.y WHERE p.small),
s AS (SELECT DISTINCT g, unnest([u, u2, u, u2]) AS u, unnest([y, y, y2, y2]) AS y FROM r WHERE k = 1),
l AS (SELECT g, u, y FROM c WHERE small EXCEPT SELECT g, u, y FROM r)
SELECT c.ano, c.cod_uf, CASE WHEN NOT c.small AND s.g IS NULL THEN CAST(c.n AS BIGINT) END AS qtd_vinculos, c.regiao,
  CASE WHEN c.small THEN 'primaria' WHEN s.g IS NOT NULL THEN 'complementar' END AS supressao,
  NOT EXISTS (SELECT 1 FROM l WHERE l.g = c.g AND l.y = c.y) AS total_grupo_publicado,
  NOT EXISTS (SELECT 1 FROM l WHERE l.g = c.g AND l.u = c.u) AS total_unidade_publicado, false AS recuperavel
FROM c LEFT JOIN s ON s.g = c.g AND s.u = c.u AND s.y = c.y""",
    "profile_drift": o.with_(*o.BASE) + f"""
, damaged AS (SELECT * REPLACE (
    CASE WHEN ano = 1996 AND substring(md5(concat_ws('|', cod_municipio, cbo, CAST(remun_media_nom AS VARCHAR))), 1, 1) IN ('0', '1')
         THEN NULL ELSE sexo END AS sexo, CASE WHEN ano = 1996 THEN idade + 20 ELSE idade END AS idade) FROM silver),
a AS ({_shares('silver')}), b AS ({_shares('damaged')}),
j AS (SELECT coalesce(a.ano, b.ano) AS ano, coalesce(a.coluna, b.coluna) AS coluna, a.s AS sa, b.s AS sb, a.z AS za, b.z AS zb
      FROM a FULL JOIN b ON a.ano = b.ano AND a.coluna = b.coluna AND a.faixa = b.faixa),
d AS (SELECT ano, coluna, CASE WHEN (count(sa) = 0) <> (count(sb) = 0) THEN 1 ELSE sum(abs(coalesce(sa, 0) - coalesce(sb, 0))) / 2 END AS distancia,
        coalesce(sum(za), 0) AS na, coalesce(sum(zb), 0) AS nb FROM j GROUP BY ano, coluna)
SELECT ano, coluna, round(CAST(distancia AS DOUBLE), 6) AS distancia, round(CAST(na AS DOUBLE), 6) AS nulos_antes,
  round(CAST(nb AS DOUBLE), 6) AS nulos_depois, distancia <= {MAX_SHIFT} AND nb - na <= {MAX_NULLS} AS ok FROM d""",
    "stratified_sample": f"""
SELECT o_orderkey, o_orderstatus, CAST(ano AS INT) AS ano FROM (
  SELECT o_orderkey, o_orderstatus, year(o_orderdate) AS ano, row_number() OVER (PARTITION BY year(o_orderdate), o_orderstatus
    ORDER BY md5('42|' || CAST(o_orderkey AS VARCHAR))) AS n FROM orders) x WHERE n <= {SAMPLE_K}""",
}
