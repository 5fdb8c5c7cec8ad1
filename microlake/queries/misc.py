"""Registered small operators: write/read smoke, deterministic hash sample."""
from __future__ import annotations

from pyspark.sql import functions as F

from microlake.operators.sampling import hash_sample
from microlake.queries import inputs
from microlake.session import scratch_path


def range_smoke(spark, sf):
    """Write ids derived from every lineitem row, read them back, check the totals."""
    li = inputs.table(spark, sf, "lineitem")
    ids = li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"))
    path = scratch_path(spark, "smoke")
    ids.write.mode("overwrite").parquet(path)
    back = spark.read.parquet(path)
    return back.agg(F.count(F.lit(1)).alias("qtd"), F.sum("id").alias("soma"),
                    F.min("id").alias("minimo"), F.max("id").alias("maximo"))


def sample_one_percent(spark, sf):
    li = inputs.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return hash_sample(li, ["l_orderkey", "l_linenumber"], 1, portable=True)


QUERIES = {"range_smoke": range_smoke, "hash_sample": sample_one_percent}

SQL = {
    "hash_sample": """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
WHERE CAST(('0x' || substr(md5('42|' || CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR)), 1, 8))
           AS BIGINT) % 100 < 1""",
    "range_smoke": """SELECT CAST(count(*) AS BIGINT) AS qtd, CAST(sum(l_orderkey * 10 + l_linenumber) AS BIGINT) AS soma,
  min(l_orderkey * 10 + l_linenumber) AS minimo, max(l_orderkey * 10 + l_linenumber) AS maximo FROM lineitem""",
}
