"""Registered queries in which a check has to say no: write modes, gates of stored years,
reloads from a damaged source, restored snapshots, and comparisons that differ."""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from microlake.functions import clean
from microlake.operators import compare, manifest, quality
from microlake.operators.silver import to_silver
from microlake.queries import ingestion, inputs
from microlake.queries import oracle as o
from microlake.queries.quality import _GATE
from microlake.queries.tables import _OD, REPLACED_YEAR, _orders, _years
from microlake.session import scratch_path
from microlake.sinks import files, tables
from microlake.sources import text

LOST_YEAR, CHANGED_YEAR = 1996, 1997          # rows are lost in the one, a price is wrong in the other
YEARS_ASKED = range(1990, 2001)


def write_modes(spark, sf):
    """Finished orders stored, then the others written over them in each mode: what the table holds then."""
    first = _orders(spark, sf).filter(F.col("o_orderstatus") == "F")
    second = _orders(spark, sf).filter(F.col("o_orderstatus") != "F")
    out = None
    for mode in ("overwrite", "append", "ignore", "error"):
        path = scratch_path(spark, f"mode-{mode}")
        first.write.parquet(path)
        refused = False
        try:
            second.write.mode(mode).parquet(path)
        except AnalysisException as e:
            refused = e.getCondition() == "PATH_ALREADY_EXISTS"
        rows = spark.read.parquet(path).groupBy("o_orderstatus").agg(
            F.count(F.lit(1)).alias("qtd"), F.sum("o_totalprice").alias("total")) \
            .select(F.lit(mode).alias("modo"), F.lit(refused).alias("recusado"), "o_orderstatus", "qtd", "total")
        out = rows if out is None else out.unionByName(rows)
    return out


def _damaged(df, year, lost):
    """The rows without those of a year for which ``lost`` holds."""
    return df.filter(~((F.col("ano") == year) & F.coalesce(lost, F.lit(False))))


def stored_year_gate(spark, sf):
    """Stored years gated one by one, silver of 1996 stored without its women, the pay of 1997 stored as NULL."""
    raw = inputs.raw(spark, sf)
    bronze, silver = scratch_path(spark, "gate-bronze"), scratch_path(spark, "gate-silver")
    tables.write_table(raw, bronze)
    s = _damaged(to_silver(tables.read_table(spark, bronze)), LOST_YEAR, F.col("sexo") == 2)
    tables.write_table(s.withColumn("remun_dezembro_nom", F.when(F.col("ano") != CHANGED_YEAR, F.col("remun_dezembro_nom"))), silver)
    years = sorted(int(f.rsplit("=", 1)[1]) for f in files.list_folders(spark, bronze + "/ano=*"))
    verdicts = []
    for ano in years:
        try:
            verdicts.append((ano, True, quality.check_stored_year(spark, silver, bronze, ano)))
        except quality.GateFailed:
            verdicts.append((ano, False, None))
    return spark.createDataFrame(verdicts, "ano int, aprovado boolean, regras bigint")


def _reloaded(spark, sf):
    """The source as a later load finds it: 1996 lost its orders in process, one of 1997's statuses has other prices."""
    od = _damaged(_orders(spark, sf), LOST_YEAR, F.col("o_orderstatus") == "P")
    wrong = (F.col("ano") == CHANGED_YEAR) & (F.col("o_orderstatus") == "P")
    return od.withColumn("o_totalprice", F.when(wrong, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
                         .cast("decimal(18,2)"))


def reload_of_damaged_source(spark, sf):
    """A second load from a damaged source: counts and checksums of every year against the first load's."""
    path, snap = scratch_path(spark, "orders-damaged"), scratch_path(spark, "orders-damaged-stats")
    years = _years(spark, sf)
    tables.replace_partition(_orders(spark, sf), path, years)
    tables.partition_stats(tables.read_table(spark, path)).select(
        "ano", F.col("qtd").alias("qtd_1"), F.col("hash").alias("hash_1")).write.parquet(snap)
    tables.replace_partition(_reloaded(spark, sf), path, years)
    again = tables.partition_stats(tables.read_table(spark, path))
    return spark.read.parquet(snap).join(again, "ano", "full").select(
        "ano", F.col("qtd_1").eqNullSafe(F.col("qtd")).alias("mesma_contagem"), F.col("hash_1").eqNullSafe(F.col("hash")).alias("igual"))


def run_history_of_damaged_run(spark, sf):
    """The manifests of two runs, the second from the damaged source: which years are not repeatable."""
    path = scratch_path(spark, "manifest-damaged")
    for i, source in ((1, _orders(spark, sf)), (2, _reloaded(spark, sf))):
        table = scratch_path(spark, f"run-{i}-orders")
        tables.write_table(source, table)
        kept = tables.read_table(spark, table)
        mart = kept.groupBy("ano").agg(F.count(F.lit(1)).alias("qtd_vinculos"))
        counts = manifest.layer_counts({"bronze": kept, "silver": kept, "gold_vinculos_ativos": mart})
        manifest.append_manifest(manifest.manifest_rows(counts, f"run-{i}", f"2024-01-0{i} 00:00:00",
                                                        ["bronze", "silver", "gold_vinculos_ativos"]), path)
    return manifest.rerun_consistency(manifest.read_manifest(spark, path))


def snapshot_restored(spark, sf):
    """Year 1996 archived, replaced by its finished orders, restored from the archive: the year at each step."""
    path, archive = scratch_path(spark, "orders-restored"), scratch_path(spark, "orders-restored-archive")
    tables.write_table(_orders(spark, sf), path)

    def year():
        return tables.read_partition(spark, path, REPLACED_YEAR)

    steps = []

    def kept(step):
        target = scratch_path(spark, f"restored-{step}")
        tables.read_table(spark, path).groupBy("ano").agg(F.count(F.lit(1)).alias("qtd"), F.sum("o_totalprice").alias("total")) \
            .select(F.lit(step).alias("etapa"), "ano", "qtd", "total").write.parquet(target)
        steps.append(target)

    tables.archive_snapshot(year(), archive, "s1")
    tables.replace_partition(_orders(spark, sf).filter((F.col("ano") == REPLACED_YEAR) & (F.col("o_orderstatus") == "F")),
                             path, REPLACED_YEAR)
    kept("trocado")
    tables.restore_snapshot(spark, archive, "s1", path, REPLACED_YEAR)
    kept("restaurado")
    return spark.read.parquet(*steps)


def years_with_rows(spark, sf):
    """Which years of a stored table hold any row; each test stops at the first row it finds."""
    path = scratch_path(spark, "orders-asked")
    tables.write_table(_orders(spark, sf), path)
    table = tables.read_table(spark, path)
    return spark.createDataFrame([(y, tables.has_rows(table.filter(F.col("ano") == y))) for y in YEARS_ASKED],
                                 "ano int, tem_linhas boolean")


def prices_as_text(spark, sf):
    """Prices and what a discount takes off them, written with a decimal comma."""
    li = inputs.table(spark, sf, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return li.select("l_orderkey", "l_linenumber", clean.decimal_comma(price).alias("preco"),
                     clean.decimal_comma(-price).alias("estorno"),
                     clean.decimal_comma(F.when(F.col("l_linenumber") != 1, price)).alias("preco_das_demais"))


def sql_differs_from_df(spark, sf):
    """The orders of the damaged source in SQL against the API's of the whole source: rows on one side only."""
    od = _orders(spark, sf).select("ano", "o_orderstatus", "o_orderpriority", "o_totalprice")
    view = "orders_sql_" + spark.conf.get("spark.app.id").replace("-", "_").replace(".", "_")
    od.createOrReplaceTempView(view)
    by_sql = spark.sql(f"""SELECT ano, o_orderstatus, o_orderpriority, CAST(o_totalprice +
        CASE WHEN ano = {CHANGED_YEAR} AND o_orderstatus = 'P' THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS o_totalprice FROM {view}
        WHERE NOT (ano = {LOST_YEAR} AND o_orderstatus = 'P')""")
    return compare.multiset_difference(by_sql, od, "sql", "api")


def storage_rows(spark, sf):
    """Landed text against the same rows as a Parquet bronze table: files and lines per year, and that none is empty."""
    root = ingestion._root(spark, sf)
    path = scratch_path(spark, "bronze-stored")
    tables.write_table(ingestion._bronze(spark, sf), path)
    landed = text.line_counts(spark, root + "/*/*")
    by_text = landed.groupBy("ano").agg(F.count(F.lit(1)).alias("arquivos"), F.sum("linhas_dados").cast("bigint").alias("linhas_texto"))
    sizes = spark.createDataFrame([(int(f.rsplit("=", 1)[1]), tables.storage_bytes(spark, f)) for f in
                                   files.list_folders(spark, path + "/ano=*")], "ano int, bytes_parquet long")
    stored = tables.read_table(spark, path).groupBy("ano").agg(F.count(F.lit(1)).alias("linhas_parquet"))
    return by_text.join(stored, "ano", "full").join(sizes, "ano", "full").select(
        "ano", "arquivos", "linhas_texto", "linhas_parquet", (F.col("bytes_parquet") > 0).alias("tem_bytes"))


QUERIES = {f.__name__: f for f in [
    write_modes, stored_year_gate, reload_of_damaged_source, run_history_of_damaged_run, snapshot_restored,
    years_with_rows, prices_as_text, sql_differs_from_df, storage_rows]}

# --- oracle ------------------------------------------------------------------------------

_RE = f"""re AS (SELECT o_orderkey, ano, o_orderstatus, o_orderpriority, CAST(o_totalprice +
  CASE WHEN ano = {CHANGED_YEAR} AND o_orderstatus = 'P' THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS o_totalprice
  FROM od WHERE NOT (ano = {LOST_YEAR} AND o_orderstatus = 'P'))"""
_BAD_SILVER = f"""silver AS (SELECT * REPLACE (CASE WHEN ano <> {CHANGED_YEAR} THEN remun_dezembro_nom END AS remun_dezembro_nom)
  FROM whole WHERE NOT (ano = {LOST_YEAR} AND coalesce(sexo = 2, false)))"""


def _comma(x: str) -> str:
    return f"replace(CAST(CAST({x} AS DECIMAL(18,2)) AS VARCHAR), '.', ',')"


SQL = {
    "write_modes": o.with_(_OD) + """
SELECT modo, modo = 'error' AS recusado, o_orderstatus, CAST(count(*) AS BIGINT) AS qtd, CAST(sum(o_totalprice) AS DECIMAL(28,2)) AS total
FROM od, (VALUES ('overwrite'), ('append'), ('ignore'), ('error')) m(modo)
WHERE modo = 'append' OR (modo = 'overwrite') = (o_orderstatus <> 'F') GROUP BY modo, o_orderstatus""",
    "stored_year_gate": o.with_(o.RAW, o.SILVER.replace("silver AS", "whole AS", 1), _BAD_SILVER) + f"""
SELECT ano, bool_and(ok) AS aprovado, CAST(CASE WHEN bool_and(ok) THEN count(*) END AS BIGINT) AS regras FROM ({_GATE}) g GROUP BY ano""",
    "reload_of_damaged_source": o.with_(_OD, _RE) + """
SELECT a.ano, a.n = coalesce(b.n, 0) AS mesma_contagem, a.n = coalesce(b.n, 0) AND a.t = b.t AS igual
FROM (SELECT ano, count(*) AS n, sum(o_totalprice) AS t FROM od GROUP BY ano) a
LEFT JOIN (SELECT ano, count(*) AS n, sum(o_totalprice) AS t FROM re GROUP BY ano) b ON a.ano = b.ano""",
    "run_history_of_damaged_run": o.with_(_OD, _RE) + """
SELECT ano, CAST(2 AS BIGINT) AS execucoes, CAST(count(DISTINCT n) AS BIGINT) AS contagens_distintas_silver, count(DISTINCT n) = 1 AS ok
FROM (SELECT ano, count(*) AS n FROM od GROUP BY ano UNION ALL SELECT ano, count(*) FROM re GROUP BY ano) c GROUP BY ano""",
    "snapshot_restored": o.with_(_OD) + f"""
SELECT etapa, ano, CAST(count(*) AS BIGINT) AS qtd, CAST(sum(o_totalprice) AS DECIMAL(28,2)) AS total
FROM od, (VALUES ('trocado'), ('restaurado')) e(etapa)
WHERE etapa = 'restaurado' OR ano <> {REPLACED_YEAR} OR o_orderstatus = 'F' GROUP BY etapa, ano""",
    "years_with_rows": o.with_(_OD) + f"""
SELECT CAST(y AS INT) AS ano, y IN (SELECT ano FROM od) AS tem_linhas FROM range({YEARS_ASKED.start}, {YEARS_ASKED.stop}) r(y)""",
    "prices_as_text": f"""
SELECT l_orderkey, l_linenumber, {_comma('l_extendedprice')} AS preco, {_comma('-l_extendedprice')} AS estorno,
  CASE WHEN l_linenumber <> 1 THEN {_comma('l_extendedprice')} END AS preco_das_demais FROM lineitem""",
    "sql_differs_from_df": o.with_(_OD, _RE, "x AS (SELECT ano, o_orderstatus, o_orderpriority, o_totalprice FROM re)",
                                   "y AS (SELECT ano, o_orderstatus, o_orderpriority, o_totalprice FROM od)") + """
SELECT (SELECT CAST(count(*) AS BIGINT) FROM x) AS linhas_sql, (SELECT CAST(count(*) AS BIGINT) FROM y) AS linhas_api,
  (SELECT CAST(count(*) AS BIGINT) FROM (SELECT * FROM x EXCEPT ALL SELECT * FROM y) a) AS so_sql,
  (SELECT CAST(count(*) AS BIGINT) FROM (SELECT * FROM y EXCEPT ALL SELECT * FROM x) b) AS so_api,
  (SELECT count(*) FROM (SELECT * FROM y EXCEPT ALL SELECT * FROM x) c) = 0 AS iguais""",
    "storage_rows": o.with_(o.RAW) + f"""
SELECT ano, CAST(count(DISTINCT arquivo) AS BIGINT) AS arquivos, CAST(count(*) AS BIGINT) AS linhas_texto,
  CAST(count(*) AS BIGINT) AS linhas_parquet, true AS tem_bytes
FROM (SELECT ano, {ingestion._FILE} AS arquivo FROM raw) r GROUP BY ano""",
}
