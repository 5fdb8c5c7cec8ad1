"""Registered aggregate queries (silver, orders)."""
from __future__ import annotations

from pyspark.sql import functions as F

from microlake.operators import profile
from microlake.queries import inputs
from microlake.queries import oracle as o
from microlake.session import scratch_path
from microlake.sinks import tables


def avg_by_category(spark, sf):
    s = inputs.silver(spark, sf)
    return s.groupBy("sexo").agg(F.round(F.avg("remun_dezembro_nom"), 2).alias("media"))


def count_by_year(spark, sf):
    od = inputs.table(spark, sf, "orders")
    return (od.groupBy(F.year(F.to_date("o_orderdate")).alias("ano_pedido"))
            .agg(F.count(F.lit(1)).alias("qtd")).orderBy("ano_pedido"))


def distinct_domain(spark, sf):
    return inputs.silver(spark, sf).select("ano").distinct()


def null_rates(spark, sf):
    return profile.null_rates(inputs.silver(spark, sf), ["remun_dezembro_nom", "cod_uf"], ["ano"])


def null_profile(spark, sf):
    return profile.null_profile(inputs.silver(spark, sf))


def describe_stats(spark, sf):
    return profile.describe_stats(inputs.silver(spark, sf),
                                  ["idade", "remun_dezembro_sm", "tempo_emprego_meses"])


def active_share(spark, sf):
    return profile.share(inputs.silver(spark, sf), "vinculo_ativo", ["ano"])


def control_totals(spark, sf):
    """Control totals of the layers as (metrica, valor) rows: silver rows, active rows,
    employment-mart total (must equal active), separation-mart total (must equal
    silver), payroll of silver and of the mart, max rank of the top-industry mart.

    The gold totals are read back from marts written by the production build, so a wrong
    filter, a lost group or rows multiplied by a dimension show as a difference."""
    s = inputs.silver(spark, sf)
    gold = tables.write_gold(spark, s, scratch_path(spark, "control-gold"))

    def rows(df, **metrics):
        one = df.agg(*[v.cast("decimal(38,2)").alias(k) for k, v in metrics.items()])
        pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("metrica"), F.col(k).alias("valor")) for k in metrics]))
        return one.select(pairs.alias("r")).select("r.*")

    def mart(name):
        return tables.read_table(spark, gold[name])

    active = F.col("vinculo_ativo")
    return (rows(s, qtd_silver=F.count(F.lit(1)), qtd_ativos=F.count_if(active),
                 massa_silver_ativos=F.sum(F.when(active, F.col("remun_dezembro_nom"))))
            .unionByName(rows(mart("gold_emprego_uf_ano"), qtd_gold_emprego=F.sum("qtd_vinculos"),
                              massa_gold_emprego=F.sum("massa_salarial_dez_nom")))
            .unionByName(rows(mart("gold_desligamento_uf_ano"), qtd_gold_desligamento=F.sum("qtd_vinculos_no_ano")))
            .unionByName(rows(mart("gold_top_cnae_uf_ano"), max_posicao=F.max("posicao"))))


QUERIES = {f.__name__: f for f in [
    avg_by_category, count_by_year, distinct_domain, null_rates, null_profile,
    describe_stats, active_share, control_totals]}

_SILVER_COLS = ["ano", "cod_municipio", "cod_uf", "cnae_classe", "cnae_divisao", "cbo",
                "natureza_juridica", "sexo", "escolaridade", "raca_cor", "idade", "tamanho_estab",
                "mes_desligamento", "motivo_desligamento", "tempo_emprego_meses", "vinculo_ativo",
                "desligado_no_ano", "remun_dezembro_nom", "remun_media_nom", "remun_dezembro_sm",
                "remun_media_sm"]
_PROFILE = " UNION ALL ".join(
    f"SELECT '{c}' AS coluna, CAST(count_if({c} IS NULL) AS BIGINT) AS nulos, "
    f"CAST(count(*) AS BIGINT) AS total FROM silver" for c in _SILVER_COLS)


def _describe(c):
    x = f"CAST({c} AS DOUBLE)"
    return (f"SELECT '{c}' AS coluna, CAST(count({x}) AS BIGINT) AS qtd, round(avg({x}), 4) AS media, "
            f"round(stddev_samp({x}), 4) AS desvio, min({x}) AS minimo, max({x}) AS maximo FROM silver")


SQL = {
    "avg_by_category": o.with_(*o.BASE) + f"""
SELECT sexo, {o.round_avg_dec('remun_dezembro_nom')} AS media FROM silver GROUP BY sexo""",
    "count_by_year": """SELECT CAST(year(o_orderdate) AS INT) AS ano_pedido, CAST(count(*) AS BIGINT) AS qtd
FROM orders GROUP BY 1 ORDER BY 1""",
    "distinct_domain": o.with_(*o.BASE) + "SELECT DISTINCT ano FROM silver",
    "null_rates": o.with_(*o.BASE) + """
SELECT ano, CAST(count(*) AS BIGINT) AS qtd_linhas,
  avg(CAST(remun_dezembro_nom IS NULL AS INT)) AS nulo_remun_dezembro_nom,
  avg(CAST(cod_uf IS NULL AS INT)) AS nulo_cod_uf
FROM silver GROUP BY ano""",
    "null_profile": o.with_(*o.BASE) + f"""
SELECT coluna, nulos, total, {o.rate_round('nulos * 100', 'total', 2)} AS pct_nulo
FROM ({_PROFILE}) p ORDER BY pct_nulo DESC, coluna""",
    "describe_stats": o.with_(*o.BASE) + " UNION ALL ".join(
        _describe(c) for c in ["idade", "remun_dezembro_sm", "tempo_emprego_meses"]),
    "active_share": o.with_(*o.BASE) + """
SELECT ano, CAST(count(*) AS BIGINT) AS qtd_linhas,
  avg(CAST(coalesce(vinculo_ativo, false) AS INT)) AS share_vinculo_ativo
FROM silver GROUP BY ano""",
    "control_totals": o.with_(*o.BASE_ACTIVE) + """
SELECT 'qtd_silver' AS metrica, CAST(count(*) AS DECIMAL(38,2)) AS valor FROM silver
UNION ALL SELECT 'qtd_ativos', CAST(count(*) AS DECIMAL(38,2)) FROM active
UNION ALL SELECT 'massa_silver_ativos', CAST(sum(remun_dezembro_nom) AS DECIMAL(38,2)) FROM active
UNION ALL SELECT 'qtd_gold_emprego', CAST(count(*) AS DECIMAL(38,2)) FROM active
UNION ALL SELECT 'massa_gold_emprego', CAST(sum(remun_dezembro_nom) AS DECIMAL(38,2)) FROM active
UNION ALL SELECT 'qtd_gold_desligamento', CAST(count(*) AS DECIMAL(38,2)) FROM silver
UNION ALL SELECT 'max_posicao', CAST(max(rn) AS DECIMAL(38,2)) FROM (
  SELECT row_number() OVER (PARTITION BY ano, cod_uf ORDER BY m DESC, cnae_divisao) AS rn FROM (
    SELECT ano, cod_uf, cnae_divisao, sum(remun_dezembro_nom) AS m FROM active
    WHERE cnae_divisao IS NOT NULL GROUP BY 1, 2, 3) a) r WHERE rn <= 10""",
}
