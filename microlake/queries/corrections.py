"""Registered queries on corrections: files released again, merges with clauses, comparison by digests."""
from __future__ import annotations

from pyspark.sql import functions as F

from microlake.functions import clean
from microlake.operators import digests
from microlake.queries import ingestion, inputs, landing
from microlake.queries import oracle as o
from microlake.queries.tables import REPLACED_YEAR, SQL as TABLE_SQL, _OD, _orders, _orders_table, _years
from microlake.session import scratch_path
from microlake.sinks import files, merge, tables
from microlake.sources import releases

REWRITTEN_YEAR, GROWN_YEAR = 1996, 1997


def _late(raw):
    """A portable sixteenth of the rows."""
    return F.substring(F.md5(F.concat_ws("|", *sorted(raw.columns))), 1, 1) == "0"


def release_reload(spark, sf):
    """Two releases of the landed files. The first has wrong schooling codes in some rows of one
    year and lacks some rows of the next, whose files then go on where they ended; the others
    stay. The second load must find just that and leave the rows of the second release."""
    raw = inputs.raw(spark, sf)
    root, target, state = (scratch_path(spark, f"release-{x}") for x in ("landing", "bronze", "state"))
    late = _late(raw)
    wrong = late & (F.col("ano") == REWRITTEN_YEAR)
    first = raw.withColumn("_late", late).where(~(F.col("_late") & (F.col("ano") == GROWN_YEAR))) \
        .withColumn("escolaridade_apos_2005", F.when(F.col("_late") & (F.col("ano") == REWRITTEN_YEAR), "99")
                    .otherwise(F.col("escolaridade_apos_2005"))).drop("_late")
    # only the years released again need lines in an order that comes back; the others are not sorted
    again = F.coalesce(F.col("ano").isin(REWRITTEN_YEAR, GROWN_YEAR), F.lit(False))
    landing.write_landing(spark, first.where(again), root, last=F.lit(False))
    landing.write_landing(spark, first.where(~again), root)
    releases.load_releases(spark, root, target, state)
    for year in (REWRITTEN_YEAR, GROWN_YEAR):
        files.delete(spark, f"{root}/{year}")
    second = raw.where(F.col("ano").isin(REWRITTEN_YEAR, GROWN_YEAR))
    landing.write_landing(spark, second, root, last=late)
    report = releases.load_releases(spark, root, target, state)
    rows = releases.read_files(spark, target)
    sums = rows.groupBy("ano", F.col("arquivo_origem").alias("arquivo")).agg(
        F.count(F.lit(1)).alias("qtd"), F.sum(clean.decimal_of(F.col("vl_remun_dezembro_nom"))).alias("soma_dez"),
        F.sum(clean.int_of(F.col("escolaridade_apos_2005"))).alias("soma_escolaridade"))
    return report.join(sums, ["ano", "arquivo"]).select("ano", "arquivo", "situacao", "linhas", (F.col("blocos_alterados") > 0).alias("alterado"),
                                                       "qtd", "soma_dez", "soma_escolaridade")


def merge_corrections(spark, sf):
    """Corrections with clauses: cancelled orders go, pending ones are finished, some in the year
    after, new ones are added, one without a key is corrected; others only look matched. The
    key index names the years whose keys are read."""
    path, index = _orders_table(spark, sf), scratch_path(spark, "orders-key-index")
    od = _orders(spark, sf)
    nameless = od.where(F.col("ano") == REPLACED_YEAR).agg(
        F.lit(None).cast("bigint").alias("o_orderkey"), F.min("o_custkey").alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        F.lit(0).cast("decimal(18,2)").alias("o_totalprice"), F.lit("none").alias("o_orderpriority"), F.lit(REPLACED_YEAR).alias("ano"))
    nameless.write.mode("append").partitionBy("ano").parquet(path)
    merge.write_index(spark, path, index, ["o_orderkey"])
    key, pending = F.col("o_orderkey"), F.col("o_orderstatus") == "P"
    source = od.where(pending | (key % 97 == 0)).withColumn("op", F.when(pending, F.when(key % 2 == 0, "fix").otherwise("move"))
                                                            .when(key % 2 == 0, "cancel").otherwise("look"))
    source = source.withColumn("ano", F.when(F.col("op") == "move", F.col("ano") + 1).otherwise(F.col("ano"))) \
        .withColumn("o_orderstatus", F.when(F.col("op").isin("fix", "move"), "F").otherwise(F.col("o_orderstatus"))) \
        .withColumn("o_totalprice", (F.col("o_totalprice") + 1).cast("decimal(18,2)"))
    new = od.where(pending).withColumn("o_orderkey", -key - 1).withColumn("op", F.lit("new"))
    fix = nameless.withColumn("o_orderpriority", F.lit("found")).withColumn("op", F.lit("fix"))
    merge.merge(spark, path, source.unionByName(new).unionByName(fix), ["o_orderkey"], scratch_path(spark, "merge-stage"),
                delete="s.op = 'cancel' AND t.o_orderstatus <> 'P'", update="s.op IN ('fix', 'move')", insert="s.op = 'new'", index=index)
    return tables.read_table(spark, path)


def compare_by_digest(spark, sf):
    """As ``snapshot_compare``, but versions are compared by partition, bucket and row digests, and
    only the buckets that differ are joined: the second version differs in two years alone."""
    before, after = _orders_table(spark, sf), _orders_table(spark, sf)
    changed = [REPLACED_YEAR, REPLACED_YEAR + 1]
    fix = _orders(spark, sf).where(F.col("ano").isin(changed) & (F.col("o_orderstatus") != "O")) \
        .withColumn("o_totalprice", F.round("o_totalprice", 0).cast("decimal(18,2)"))
    tables.replace_partition(fix, after, [y for y in _years(spark, sf) if y in changed])
    old, new = (digests.write_digests(spark, p, scratch_path(spark, f"digests-{n}"), ["o_orderkey"]) for n, p in (("a", before), ("b", after)))
    return digests.compare_by_digest(spark, before, after, old, new, ["o_orderkey"])


def sized_write(spark, sf):
    """Orders of which one year has three fifths, written in files of a tenth of all rows: the hot year
    in several, small ones in one; ``igual`` says that a year's files differ by less than a factor of two."""
    path = scratch_path(spark, "orders-sized")
    od = _orders(spark, sf)
    hot = od.withColumn("ano", F.when(F.pmod("o_orderkey", F.lit(5)) < 3, REPLACED_YEAR).otherwise(F.col("ano")))
    tables.write_sized(hot, path, target_bytes=max(1, od.count() // 10), weight=F.lit(1))
    rows = tables.read_table(spark, path).groupBy("ano", F.col("_metadata.file_path").alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return rows.groupBy("ano").agg(F.sum("n").alias("qtd"), F.count(F.lit(1)).alias("arquivos"), (F.max("n") < 2 * F.min("n")).alias("igual"))


QUERIES = {f.__name__: f for f in [release_reload, merge_corrections, compare_by_digest, sized_write]}

_RAW_COLS = sorted(["ano", "municipio", "cnae_2_0_classe", "cbo_ocupacao_2002", "vinculo_ativo_31_12", "sexo_trabalhador",
                    "escolaridade_apos_2005", "raca_cor", "idade", "tempo_emprego", "mes_desligamento", "motivo_desligamento",
                    "tamanho_estabelecimento", "natureza_juridica", "vl_remun_dezembro_nom", "vl_remun_media_nom",
                    "vl_remun_dezembro_sm", "vl_remun_media_sm"])

SQL = {
    "release_reload": o.with_(o.RAW) + f"""
SELECT ano, arquivo, CASE WHEN NOT bool_or(late) OR ano NOT IN ({REWRITTEN_YEAR}, {GROWN_YEAR}) THEN 'igual'
    WHEN ano = {GROWN_YEAR} THEN CASE WHEN bool_and(late) THEN 'novo' ELSE 'crescido' END ELSE 'reescrito' END AS situacao,
  CAST(count(*) + 1 AS BIGINT) AS linhas,
  bool_or(late) AND NOT (bool_and(late) AND ano = {GROWN_YEAR}) AND ano IN ({REWRITTEN_YEAR}, {GROWN_YEAR}) AS alterado,
  CAST(count(*) AS BIGINT) AS qtd, CAST(sum({o.sql_dec('vl_remun_dezembro_nom')}) AS DECIMAL(28,2)) AS soma_dez,
  CAST(sum({o.sql_int('escolaridade_apos_2005')}) AS BIGINT) AS soma_escolaridade
FROM (SELECT *, {ingestion._FILE} AS arquivo, substring(md5(concat_ws('|', {', '.join(_RAW_COLS)})), 1, 1) = '0' AS late FROM raw) r
GROUP BY ano, arquivo""",
    "merge_corrections": o.with_(_OD) + f"""
SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderstatus = 'P' THEN CAST(o_totalprice + 1 AS DECIMAL(18,2)) ELSE o_totalprice END AS o_totalprice, o_orderpriority,
  CAST(CASE WHEN o_orderstatus = 'P' AND o_orderkey % 2 <> 0 THEN ano + 1 ELSE ano END AS INT) AS ano
FROM od WHERE o_orderstatus = 'P' OR NOT (o_orderkey % 97 = 0 AND o_orderkey % 2 = 0)
UNION ALL SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, ano FROM od WHERE o_orderstatus = 'P'
UNION ALL SELECT NULL, min(o_custkey), 'O', CAST(0 AS DECIMAL(18,2)), 'found', {REPLACED_YEAR} FROM od WHERE ano = {REPLACED_YEAR}""",
    "sized_write": o.with_(_OD) + f"""
, h AS (SELECT CASE WHEN o_orderkey % 5 < 3 THEN {REPLACED_YEAR} ELSE ano END AS ano, count(*) AS n,
    (SELECT greatest(1, count(*) // 10) FROM od) AS target FROM od GROUP BY 1)
SELECT CAST(ano AS INT) AS ano, CAST(n AS BIGINT) AS qtd, CAST(greatest(1, round_even(n / target, 0)) AS BIGINT) AS arquivos, true AS igual FROM h""",
    "compare_by_digest": TABLE_SQL["snapshot_compare"].replace(
        "a AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(round(o_totalprice, 0) AS DECIMAL(18,2)) AS o_totalprice,\n"
        "      o_orderpriority, ano FROM od WHERE o_orderstatus <> 'O')",
        f"a AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(CASE WHEN ano IN ({REPLACED_YEAR}, {REPLACED_YEAR + 1}) THEN "
        f"round(o_totalprice, 0) ELSE o_totalprice END AS DECIMAL(18,2)) AS o_totalprice, o_orderpriority, ano FROM od\n"
        f"      WHERE o_orderstatus <> 'O' OR ano NOT IN ({REPLACED_YEAR}, {REPLACED_YEAR + 1}))"),
}
