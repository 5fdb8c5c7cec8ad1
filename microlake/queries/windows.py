"""Registered window / top-k queries (customer, orders, lineitem, events, marts)."""
from __future__ import annotations

from pyspark.sql import functions as F

from microlake.operators import dims, marts, windows
from microlake.queries import inputs
from microlake.queries import oracle as o
from microlake.session import scratch_path
from microlake.sources import history


def top1_per_group(spark, sf):
    """Richest customer per nation (row_number == 1, rank column dropped)."""
    cu = inputs.table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    return windows.top1(cu, ["c_nationkey"], [F.col("c_acctbal").desc(), F.col("c_custkey")])


def group_avg_per_row(spark, sf):
    """Every order with the mean order value of its customer (rows kept)."""
    od = inputs.table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(18,2)").alias("total"))
    return windows.group_stat_per_row(od, "o_custkey", F.avg("total"), "media_cliente")


def rank_variants(spark, sf):
    """rank / dense_rank of every line inside its order, computed without a window over
    raw rows (range-partitioned counts + per-partition offsets), so a hot group is
    spread over many tasks."""
    li = inputs.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return windows.ranks_at_scale(li, ["l_orderkey"], [("l_quantity", True)])


def rank_row_number(spark, sf):
    li = inputs.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return windows.rank_variants(li, ["l_orderkey"],
                                 [F.col("l_quantity").desc(), F.col("l_linenumber")])


def topk_states(spark, sf):
    emp = marts.employment(marts.active(inputs.silver(spark, sf)), dims.state_dim(spark))
    per_state = emp.groupBy("cod_uf", "uf").agg(F.sum("qtd_vinculos").alias("qtd_vinculos"))
    return per_state.orderBy(F.desc("qtd_vinculos"), F.asc("cod_uf")).limit(5)


def min_ratio_state(spark, sf):
    gap = marts.pay_gap(marts.active(inputs.silver(spark, sf)), dims.state_dim(spark))
    return (gap.filter(F.col("razao_mulher_homem").isNotNull())
            .orderBy("razao_mulher_homem", "ano", "cod_uf").limit(1)
            .select("ano", "cod_uf", "uf", "razao_mulher_homem"))


def _history_rows(spark, sf):
    """Check history stand-in from events: aula = user, check = event type,
    status passou when value > 50."""
    ev = inputs.table(spark, sf, "events")
    return ev.select(
        F.col("ts"), F.col("user_id").cast("int").alias("aula"),
        F.col("event_type").alias("check"),
        F.when(F.col("value") > 50, "passou").otherwise("falhou").alias("status"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("detalhe"),
        F.lit("events").alias("origem"))


def latest_check_status(spark, sf):
    """Write the history as JSON lines, read it back with a fixed schema, keep the
    latest status per (aula, check)."""
    path = scratch_path(spark, "check-history")
    history.write_jsonl(_history_rows(spark, sf), path)
    h = history.read_check_history(spark, path)
    return windows.latest_per_key(h, ["aula", "check"], "ts", "detalhe", ["status"])


def run_drift(spark, sf):
    """Daily volume per event type against the previous day (lag)."""
    ev = inputs.table(spark, sf, "events")
    daily = (ev.groupBy("event_type", F.to_date("ts").alias("dia"))
             .agg(F.count(F.lit(1)).alias("qtd")))
    return windows.previous_value(daily, ["event_type"], "dia", "qtd", "qtd_anterior")


QUERIES = {f.__name__: f for f in [
    top1_per_group, group_avg_per_row, rank_variants, rank_row_number, topk_states,
    min_ratio_state, latest_check_status, run_drift]}

_EMP_STATE = """SELECT e.cod_uf, d.uf, CAST(sum(qtd) AS BIGINT) AS qtd_vinculos FROM
 (SELECT ano, cod_uf, count(*) AS qtd FROM active GROUP BY ano, cod_uf) e
 LEFT JOIN dim_uf d ON e.cod_uf = d.cod_uf GROUP BY e.cod_uf, d.uf"""
_F = "CASE WHEN sexo = 2 THEN remun_dezembro_sm END"
_M = "CASE WHEN sexo = 1 THEN remun_dezembro_sm END"

SQL = {
    "top1_per_group": """SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM (
  SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rn
  FROM customer) WHERE rn = 1""",
    "group_avg_per_row": f"""WITH od AS (SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(18,2)) AS total FROM orders),
g AS (SELECT o_custkey, {o.avg_dec('total')} AS media_cliente FROM od GROUP BY o_custkey)
SELECT od.*, g.media_cliente FROM od LEFT JOIN g ON od.o_custkey IS NOT DISTINCT FROM g.o_custkey""",
    "rank_variants": """SELECT l_orderkey, l_linenumber, l_quantity,
  CAST(rank() OVER w AS INT) AS rank, CAST(dense_rank() OVER w AS INT) AS dense_rank
FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_quantity DESC)""",
    "rank_row_number": """SELECT l_orderkey, l_linenumber, l_quantity,
  CAST(row_number() OVER w AS INT) AS row_number, CAST(rank() OVER w AS INT) AS rank,
  CAST(dense_rank() OVER w AS INT) AS dense_rank
FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber)""",
    "topk_states": o.with_(*o.BASE_ACTIVE, o.STATES) + _EMP_STATE
    + " ORDER BY qtd_vinculos DESC, cod_uf ASC LIMIT 5",
    "min_ratio_state": o.with_(*o.BASE_ACTIVE, o.STATES) + f"""
SELECT g.ano, g.cod_uf, d.uf, g.razao_mulher_homem FROM (
  SELECT ano, cod_uf, {o.ratio_round(o.units6(_F), o.units6(_M))} AS razao_mulher_homem
  FROM active GROUP BY ano, cod_uf) g LEFT JOIN dim_uf d ON g.cod_uf = d.cod_uf
WHERE razao_mulher_homem IS NOT NULL ORDER BY razao_mulher_homem, ano, g.cod_uf LIMIT 1""",
    "latest_check_status": """SELECT aula, "check", ts, detalhe, status FROM (
  SELECT CAST(user_id AS INT) AS aula, event_type AS "check", ts,
    'event ' || CAST(event_id AS VARCHAR) AS detalhe,
    CASE WHEN value > 50 THEN 'passou' ELSE 'falhou' END AS status,
    row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC,
                       'event ' || CAST(event_id AS VARCHAR) DESC) AS rn
  FROM events) WHERE rn = 1""",
    "run_drift": """SELECT event_type, dia, qtd, qtd_anterior, qtd - qtd_anterior AS variacao_qtd FROM (
  SELECT event_type, dia, qtd, lag(qtd) OVER (PARTITION BY event_type ORDER BY dia) AS qtd_anterior
  FROM (SELECT event_type, CAST(ts AS DATE) AS dia, CAST(count(*) AS BIGINT) AS qtd
        FROM events GROUP BY 1, 2) d) x""",
}
