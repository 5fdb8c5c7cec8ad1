"""Registered table queries: partition replace, evolution, pruning, idempotence,
compaction, CSV export, manifest, snapshots, upsert (orders by year, scratch tables)."""
from __future__ import annotations

from pyspark.sql import functions as F

from microlake.operators import dims, manifest, marts
from microlake.queries import inputs, lake
from microlake.queries import marts as mart_queries
from microlake.queries import oracle as o
from microlake.session import scratch_path
from microlake.sinks import files, tables


def _orders(spark, sf):
    od = inputs.table(spark, sf, "orders")
    return od.select("o_orderkey", "o_custkey", "o_orderstatus",
                     F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
                     "o_orderpriority", F.year("o_orderdate").cast("int").alias("ano"))


def _years(spark, sf):
    return sorted(r[0] for r in _orders(spark, sf).select("ano").distinct().collect())


def _orders_table(spark, sf, files_per_partition=None):
    path = scratch_path(spark, "orders-by-year")
    df = _orders(spark, sf)
    if files_per_partition:
        df = df.repartition(files_per_partition)
    tables.write_table(df, path)
    return path


REPLACED_YEAR = 1996


def replace_partition(spark, sf):
    """Replace year 1996 with its finished orders only; other years untouched."""
    path = _orders_table(spark, sf)
    fix = _orders(spark, sf).filter((F.col("ano") == REPLACED_YEAR) & (F.col("o_orderstatus") == "F"))
    tables.replace_partition(fix, path, REPLACED_YEAR)
    t = tables.read_table(spark, path)
    return t.groupBy("ano").agg(F.count(F.lit(1)).alias("qtd"), F.sum("o_totalprice").alias("total"))


def replace_partition_empty(spark, sf):
    """Replace year 1996 with no rows: the year is gone, the others untouched."""
    path = _orders_table(spark, sf)
    tables.replace_partition(_orders(spark, sf).filter("false"), path, REPLACED_YEAR)
    return tables.read_table(spark, path).groupBy("ano").agg(F.count(F.lit(1)).alias("qtd"))


def schema_evolution(spark, sf):
    """Years before 1998 written without ``o_orderpriority``; later years add it with
    mergeSchema; the merged read shows it as NULL for the old years."""
    path = scratch_path(spark, "orders-evolving")
    od = _orders(spark, sf)
    tables.write_table(od.filter(F.col("ano") < 1998).drop("o_orderpriority"), path)
    new_years = [y for y in _years(spark, sf) if y >= 1998]
    tables.replace_partition(od.filter(F.col("ano") >= 1998), path, new_years, merge_schema=True)
    t = tables.read_table(spark, path, merge_schema=True)
    return t.groupBy("ano").agg(F.count(F.lit(1)).alias("qtd"),
                                F.count("o_orderpriority").alias("qtd_prioridade"))


def partition_pruned_read(spark, sf):
    path = _orders_table(spark, sf)
    return (tables.read_table(spark, path).filter(F.col("ano") == REPLACED_YEAR)
            .select("o_orderkey", "o_totalprice", "ano"))


def idempotent_reload(spark, sf):
    """Load every year twice from the same source: counts and checksums must match."""
    path = scratch_path(spark, "orders-reload")
    years = _years(spark, sf)
    tables.replace_partition(_orders(spark, sf), path, years)
    first = tables.partition_stats(tables.read_table(spark, path))
    first_rows = first.select("ano", F.col("qtd").alias("qtd_1"), F.col("hash").alias("hash_1"))
    snap = scratch_path(spark, "orders-reload-stats")
    first_rows.write.parquet(snap)                 # keep run-1 stats before run 2 replaces data
    tables.replace_partition(_orders(spark, sf), path, years)
    second = tables.partition_stats(tables.read_table(spark, path))
    j = spark.read.parquet(snap).join(second, "ano", "full")
    return j.select("ano", F.col("qtd").alias("qtd"),
                    (F.col("qtd_1").eqNullSafe(F.col("qtd")) & F.col("hash_1").eqNullSafe(F.col("hash")))
                    .alias("igual"))


def compaction_preserves_rows(spark, sf):
    """8 files per year -> compacted to ceil(bytes/128 MB) files; rows and checksum kept."""
    path = _orders_table(spark, sf, files_per_partition=8)
    before = tables.partition_stats(tables.read_table(spark, path))
    snap = scratch_path(spark, "compaction-before")
    before.write.parquet(snap)
    for y in _years(spark, sf):
        tables.compact_partition(spark, path, y, scratch_path(spark, f"compaction-{y}"))
    after = tables.partition_stats(tables.read_table(spark, path))
    b = spark.read.parquet(snap).select("ano", F.col("qtd").alias("qtd_antes"),
                                        F.col("arquivos").alias("arquivos_antes"),
                                        F.col("hash").alias("hash_antes"))
    j = b.join(after, "ano", "full")
    return j.select("ano", "qtd_antes", F.col("qtd").alias("qtd_depois"), "arquivos_antes",
                    F.col("arquivos").alias("arquivos_depois"),
                    F.col("hash_antes").eqNullSafe(F.col("hash")).alias("igual"))


def csv_export_roundtrip(spark, sf):
    emp = marts.employment(marts.active(inputs.silver(spark, sf)), dims.state_dim(spark))
    path = scratch_path(spark, "gold-csv")
    tables.export_csv(emp, path)
    return tables.read_csv_export(spark, path, emp.schema)


def _manifest_for(spark, paths, run_id, ts):
    counts = manifest.layer_counts({name: tables.read_table(spark, paths[of]) for name, of in (
        ("bronze", "bronze.vinculos"), ("silver", "silver.vinculos"), ("gold_vinculos_ativos", "gold.emprego_uf_ano"))})
    return manifest.manifest_rows(counts, run_id, ts, ["bronze", "silver", "gold_vinculos_ativos"])


def run_manifest(spark, sf):
    path = scratch_path(spark, "manifest")
    manifest.append_manifest(_manifest_for(spark, lake.stored(spark, sf), "run-1", "2024-01-01 00:00:00"), path)
    return manifest.read_manifest(spark, path).drop("run_id", "ts")


def run_history(spark, sf):
    """Two runs, each of which loads bronze, silver and the employment mart from the inputs
    into folders of its own; their counts must agree."""
    path = scratch_path(spark, "manifest-history")
    for i in (1, 2):
        paths = lake.load(spark, sf) | {"gold.emprego_uf_ano": scratch_path(spark, f"gold-run-{i}")}
        silver = tables.read_table(spark, paths["silver.vinculos"])
        tables.write_table(marts.employment(marts.active(silver), dims.state_dim(spark)), paths["gold.emprego_uf_ano"])
        manifest.append_manifest(_manifest_for(spark, paths, f"run-{i}", f"2024-01-0{i} 00:00:00"), path)
    return manifest.rerun_consistency(manifest.read_manifest(spark, path))


def snapshot_compare(spark, sf):
    """Archive the whole table as snapshot s1, replace every year (open orders removed,
    prices rounded), then compare the snapshot with the current table by key."""
    path = _orders_table(spark, sf)
    archive = scratch_path(spark, "orders-archive")
    tables.archive_snapshot(tables.read_table(spark, path), archive, "s1")
    fix = (_orders(spark, sf).filter(F.col("o_orderstatus") != "O")
           .withColumn("o_totalprice", F.round("o_totalprice", 0).cast("decimal(18,2)")))
    tables.replace_partition(fix, path, _years(spark, sf))
    before = tables.read_snapshot(spark, archive, "s1")
    return tables.compare_versions(before, tables.read_table(spark, path), ["o_orderkey"])


_MOMENTS = {"v1": "2024-01-01 00:00:00", "v2": "2024-02-01 00:00:00", "v3": "2024-03-01 00:00:00"}


def _versioned_orders(spark, sf):
    """Orders loaded by year (v1), one year replaced by its finished orders (v2), then emptied (v3);
    each replaced year is archived first and every write is logged."""
    path, archive, history = (scratch_path(spark, f"orders-{x}") for x in ("live", "versions", "history"))
    od = _orders(spark, sf)
    steps = [("v1", od, None), ("v2", od.filter(F.col("o_orderstatus") == "F"), REPLACED_YEAR),
             ("v3", od.filter("false"), REPLACED_YEAR)]
    for version, rows, year in steps:
        years = [year] if year else _years(spark, sf)
        if year:
            tables.archive_snapshot(tables.read_partition(spark, path, year), archive, version)
            rows = rows.filter(F.col("ano") == year)
        tables.replace_partition(rows, path, years)
        counts = dict(rows.groupBy("ano").count().collect())            # a row per year
        tables.log_writes(spark, history, [("orders", y, "replace", version, _MOMENTS[version], counts.get(y, 0)) for y in years])
    return path, archive, history


def table_history(spark, sf):
    """Every write of the table: version, operation, snapshot id, time, rows. A write logged
    last with the earliest time gets the next version; the others keep theirs."""
    _, _, history = _versioned_orders(spark, sf)
    tables.log_write(spark, history, "orders", REPLACED_YEAR, "import", "v0", "2023-12-01 00:00:00", 0)
    return tables.table_history(spark, history)


def snapshot_as_of(spark, sf):
    """Rows and total per year as they were between the writes, by timestamp."""
    path, archive, history = _versioned_orders(spark, sf)
    out = []
    for moment in ("2024-01-15 00:00:00", "2024-02-15 00:00:00", "2024-03-15 00:00:00"):
        t = tables.read_as_of(spark, path, archive, history, "orders", moment)
        out.append(t.groupBy("ano").agg(F.count(F.lit(1)).alias("qtd"), F.sum("o_totalprice").alias("total"))
                   .withColumn("em", F.lit(moment)))
    return out[0].unionByName(out[1]).unionByName(out[2])


def snapshot_retention(spark, sf):
    """One snapshot per year of orders; snapshots more than two years older than the
    newest are removed from storage. The result says what was there and what is left."""
    archive = scratch_path(spark, "orders-snapshots")
    od = _orders(spark, sf)
    od.withColumn("snapshot_id", F.concat(F.lit("s"), F.col("ano").cast("string"))) \
      .write.mode("append").partitionBy("ano", "snapshot_id").parquet(archive)
    snap = scratch_path(spark, "snapshot-listing")
    (spark.read.parquet(archive).groupBy("snapshot_id").agg(F.count(F.lit(1)).alias("qtd"), F.max("ano").alias("ano"))
     .write.parquet(snap))
    listing = spark.read.parquet(snap)
    names = [f.rsplit("/", 2) for f in files.list_folders(spark, archive + "/ano=*/snapshot_id=*")]
    years = {n[2].split("=", 1)[1]: int(n[1].split("=", 1)[1]) for n in names}     # from folder names
    newest = max(years.values(), default=0)
    tables.expire_snapshots(spark, archive, [s for s, y in years.items() if y < newest - 2])
    left = spark.read.parquet(archive).groupBy("snapshot_id").agg(F.count(F.lit(1)).alias("restam"))
    return listing.join(left, "snapshot_id", "left").select(
        "snapshot_id", "ano", "qtd", F.coalesce("restam", F.lit(0)).alias("restam"))


def upsert_by_join(spark, sf):
    """Pending orders become finished with a corrected price; new orders under negative keys
    (-1 - key: key 0 must not be changed twice) are inserted. Only the years that hold pending orders are read whole and rewritten; of
    the others the keys alone are read, to find changed orders that moved."""
    path = _orders_table(spark, sf)
    pend = _orders(spark, sf).filter(F.col("o_orderstatus") == "P")
    upd = pend.withColumn("o_orderstatus", F.lit("F")).withColumn(
        "o_totalprice", (F.col("o_totalprice") + 1).cast("decimal(18,2)"))
    ins = pend.withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    tables.upsert_partitions(spark, path, upd.unionByName(ins), ["o_orderkey"], scratch_path(spark, "upsert-stage"),
                             keys_move=True)
    return tables.read_table(spark, path).drop("ano")


QUERIES = {f.__name__: f for f in [
    replace_partition, replace_partition_empty, schema_evolution, partition_pruned_read, idempotent_reload,
    compaction_preserves_rows, csv_export_roundtrip, run_manifest, run_history,
    snapshot_compare, table_history, snapshot_as_of, snapshot_retention, upsert_by_join]}

_OD = """od AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
  o_orderpriority, CAST(year(o_orderdate) AS INT) AS ano FROM orders)"""

SQL = {
    "replace_partition_empty": o.with_(_OD) + f"""
SELECT ano, CAST(count(*) AS BIGINT) AS qtd FROM od WHERE ano <> {REPLACED_YEAR} GROUP BY ano""",
    "replace_partition": o.with_(_OD) + f"""
SELECT ano, CAST(count(*) AS BIGINT) AS qtd, CAST(sum(o_totalprice) AS DECIMAL(28,2)) AS total FROM od
WHERE ano <> {REPLACED_YEAR} OR o_orderstatus = 'F' GROUP BY ano""",
    "schema_evolution": o.with_(_OD) + """
SELECT ano, CAST(count(*) AS BIGINT) AS qtd,
  CAST(CASE WHEN ano >= 1998 THEN count(o_orderpriority) ELSE 0 END AS BIGINT) AS qtd_prioridade
FROM od GROUP BY ano""",
    "partition_pruned_read": o.with_(_OD) + f"SELECT o_orderkey, o_totalprice, ano FROM od WHERE ano = {REPLACED_YEAR}",
    "idempotent_reload": o.with_(_OD) + "SELECT ano, CAST(count(*) AS BIGINT) AS qtd, true AS igual FROM od GROUP BY ano",
    "compaction_preserves_rows": o.with_(_OD) + """
SELECT ano, CAST(count(*) AS BIGINT) AS qtd_antes, CAST(count(*) AS BIGINT) AS qtd_depois,
  CAST(8 AS BIGINT) AS arquivos_antes, CAST(1 AS BIGINT) AS arquivos_depois, true AS igual FROM od GROUP BY ano""",
    "csv_export_roundtrip": mart_queries.SQL["mart_employment"],
    "run_manifest": o.with_(*o.BASE_ACTIVE) + """
SELECT s.ano, b.bronze, s.silver, a.gold_vinculos_ativos FROM
 (SELECT ano, CAST(count(*) AS BIGINT) AS silver FROM silver GROUP BY ano) s
 JOIN (SELECT ano, CAST(count(*) AS BIGINT) AS bronze FROM raw GROUP BY ano) b ON s.ano = b.ano
 LEFT JOIN (SELECT ano, CAST(count(*) AS BIGINT) AS gold_vinculos_ativos FROM active GROUP BY ano) a
 ON s.ano = a.ano""",
    "run_history": o.with_(*o.BASE) + """
SELECT ano, CAST(2 AS BIGINT) AS execucoes, CAST(1 AS BIGINT) AS contagens_distintas_silver, true AS ok
FROM silver GROUP BY ano""",
    "snapshot_compare": o.with_(_OD) + f"""
, b AS (SELECT * FROM od),
a AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(round(o_totalprice, 0) AS DECIMAL(18,2)) AS o_totalprice,
      o_orderpriority, ano FROM od WHERE o_orderstatus <> 'O'),
j AS (SELECT b.o_custkey AS b1, a.o_custkey AS a1, b.o_orderstatus AS b2, a.o_orderstatus AS a2,
        b.o_totalprice AS b3, a.o_totalprice AS a3, b.o_orderpriority AS b4, a.o_orderpriority AS a4,
        b.ano AS b5, a.ano AS a5, b.o_orderkey IS NOT NULL AS hb, a.o_orderkey IS NOT NULL AS ha
      FROM b FULL JOIN a ON b.o_orderkey = a.o_orderkey),
t AS (SELECT CAST(count_if(NOT ha) AS BIGINT) AS so_antes, CAST(count_if(NOT hb) AS BIGINT) AS so_depois,
  count_if(hb AND ha AND b1 IS DISTINCT FROM a1) AS c1, count_if(hb AND ha AND b2 IS DISTINCT FROM a2) AS c2,
  count_if(hb AND ha AND b3 IS DISTINCT FROM a3) AS c3, count_if(hb AND ha AND b4 IS DISTINCT FROM a4) AS c4,
  count_if(hb AND ha AND b5 IS DISTINCT FROM a5) AS c5,
  count_if(hb AND b1 IS NULL) AS nb1, count_if(hb AND b2 IS NULL) AS nb2, count_if(hb AND b3 IS NULL) AS nb3,
  count_if(hb AND b4 IS NULL) AS nb4, count_if(hb AND b5 IS NULL) AS nb5,
  count_if(ha AND a1 IS NULL) AS na1, count_if(ha AND a2 IS NULL) AS na2, count_if(ha AND a3 IS NULL) AS na3,
  count_if(ha AND a4 IS NULL) AS na4, count_if(ha AND a5 IS NULL) AS na5 FROM j)
SELECT v.coluna, CAST(v.alteradas AS BIGINT) AS alteradas, CAST(v.nulos_antes AS BIGINT) AS nulos_antes,
  CAST(v.nulos_depois AS BIGINT) AS nulos_depois, so_antes, so_depois
FROM t, LATERAL (SELECT * FROM (VALUES ('o_custkey', c1, nb1, na1), ('o_orderstatus', c2, nb2, na2),
  ('o_totalprice', c3, nb3, na3), ('o_orderpriority', c4, nb4, na4), ('ano', c5, nb5, na5))
  x(coluna, alteradas, nulos_antes, nulos_depois)) v""",
    "table_history": o.with_(_OD) + f"""
, w AS (SELECT 'v1' AS snapshot_id, TIMESTAMP '2024-01-01 00:00:00' AS ts, ano, count(*) AS linhas FROM od GROUP BY ano
  UNION ALL SELECT 'v2', TIMESTAMP '2024-02-01 00:00:00', {REPLACED_YEAR}, count(*) FROM od
    WHERE ano = {REPLACED_YEAR} AND o_orderstatus = 'F'
  UNION ALL SELECT 'v3', TIMESTAMP '2024-03-01 00:00:00', {REPLACED_YEAR}, 0),
n AS (SELECT *, row_number() OVER (ORDER BY ts, snapshot_id, ano) - 1 AS versao FROM w)
SELECT 'orders' AS tabela, CAST(ano AS INT) AS ano, 'replace' AS operacao, snapshot_id, ts, CAST(linhas AS BIGINT) AS linhas,
  CAST(versao AS BIGINT) AS versao FROM n
UNION ALL SELECT 'orders', {REPLACED_YEAR}, 'import', 'v0', TIMESTAMP '2023-12-01 00:00:00', 0, count(*) FROM n""",
    "snapshot_as_of": o.with_(_OD) + f"""
, t AS (SELECT '2024-01-15 00:00:00' AS em, * FROM od
  UNION ALL SELECT '2024-02-15 00:00:00', * FROM od WHERE ano <> {REPLACED_YEAR} OR o_orderstatus = 'F'
  UNION ALL SELECT '2024-03-15 00:00:00', * FROM od WHERE ano <> {REPLACED_YEAR})
SELECT em, ano, CAST(count(*) AS BIGINT) AS qtd, CAST(sum(o_totalprice) AS DECIMAL(28,2)) AS total FROM t GROUP BY em, ano""",
    "snapshot_retention": o.with_(_OD) + """
SELECT 's' || ano AS snapshot_id, CAST(ano AS INT) AS ano, CAST(count(*) AS BIGINT) AS qtd,
  CAST(CASE WHEN ano < (SELECT max(ano) FROM od) - 2 THEN 0 ELSE count(*) END AS BIGINT) AS restam FROM od GROUP BY ano""",
    "upsert_by_join": o.with_(_OD) + """
, ch AS (SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus, CAST(o_totalprice + 1 AS DECIMAL(18,2)) AS o_totalprice,
           o_orderpriority FROM od WHERE o_orderstatus = 'P'
         UNION ALL SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM od
         WHERE o_orderstatus = 'P')
SELECT coalesce(c.o_orderkey, b.o_orderkey) AS o_orderkey,
  CASE WHEN c.o_orderkey IS NOT NULL THEN c.o_custkey ELSE b.o_custkey END AS o_custkey,
  CASE WHEN c.o_orderkey IS NOT NULL THEN c.o_orderstatus ELSE b.o_orderstatus END AS o_orderstatus,
  CASE WHEN c.o_orderkey IS NOT NULL THEN c.o_totalprice ELSE b.o_totalprice END AS o_totalprice,
  CASE WHEN c.o_orderkey IS NOT NULL THEN c.o_orderpriority ELSE b.o_orderpriority END AS o_orderpriority
FROM (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM od) b
FULL JOIN ch c ON b.o_orderkey = c.o_orderkey""",
}
