"""Comparing two versions of a partitioned table by digests, joining only what differs.

Rows are dealt by key into buckets. A digest table holds, per partition and bucket, the number
of rows and the exact sum of their hashes. Two versions agree in a bucket if both numbers
agree; a partition whose buckets all agree is not read again, and of the others only rows of
differing buckets are joined. A key that moved between partitions lies in the same bucket
number of both, so differing buckets are joined across all partitions that differ in them.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from microlake.sinks import tables
from microlake.sinks.tables import PARTITION

BUCKETS = 256


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(tables.row_hash(keys), F.lit(buckets)).cast("int")


def write_digests(spark: SparkSession, path: str, digests: str, keys: list[str], buckets: int = BUCKETS, col: str = PARTITION) -> str:
    """Digests of the table at ``path``, stored beside it when it is written: one scan, partial sums."""
    t = tables.read_table(spark, path, merge_schema=True)
    nulls = F.map_from_arrays(F.array(*[F.lit(c) for c in t.columns]), F.array(*[F.count_if(F.col(c).isNull()) for c in t.columns]))
    t.groupBy(F.col(col), bucket_of(keys, buckets).alias("balde")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(tables.row_hash(t.columns).cast("decimal(38,0)")).alias("soma"), nulls.alias("nulos")) \
        .withColumn("baldes", F.lit(buckets)).coalesce(1).write.mode("overwrite").parquet(digests)
    return digests


def differing_buckets(spark: SparkSession, before: str, after: str, col: str = PARTITION) -> DataFrame:
    """(col, balde) that do not agree in two digest tables."""
    b, a = (spark.read.parquet(p).select(F.struct(col, "balde").alias(f"{n}_k"), F.struct("n", "soma", "baldes").alias(n))
            for p, n in ((before, "b"), (after, "a")))
    j = b.join(a, F.col("b_k").eqNullSafe(F.col("a_k")), "full").where(~F.col("b").eqNullSafe(F.col("a")))
    return j.select(F.coalesce("b_k", "a_k").alias("k")).select(f"k.{col}", "k.balde")


def compare_by_digest(spark: SparkSession, before: str, after: str, before_digests: str, after_digests: str,
                      keys: list[str], col: str = PARTITION) -> DataFrame:
    """``tables.compare_versions`` of two stored versions (paths) from their digests.

    Of the versions only partitions that differ are read, and of those only rows of differing
    buckets are joined; NULL counts of the rest come from the digests. Digest tables must be
    of the stored versions and have one number of buckets.
    """
    counts = {r["baldes"] for p in (before_digests, after_digests) for r in spark.read.parquet(p).select("baldes").distinct().collect()}
    if len(counts) > 1:
        raise ValueError(f"digests with different numbers of buckets: {sorted(counts)}")
    buckets = counts.pop() if counts else BUCKETS
    differ = differing_buckets(spark, before_digests, after_digests, col).collect()         # at most partitions x buckets rows
    years, numbers = sorted({r[0] for r in differ}), sorted({r["balde"] for r in differ})
    b, a = (tables.read_table(spark, p, merge_schema=True) for p in (before, after))

    def among(bucket: Column) -> Column:
        return F.col(col).isin(years) & bucket.isin(numbers) if differ else F.lit(False)

    joined = tables.compare_versions(*[t.where(among(bucket_of(keys, buckets))) for t in (b, a)], keys)
    alike = spark.read.parquet(after_digests).where(~among(F.col("balde"))).select(F.explode("nulos").alias("coluna", "nulos")) \
        .groupBy("coluna").agg(F.sum("nulos").alias("nulos"))
    rest = F.coalesce("nulos", F.lit(0))
    return joined.join(alike, "coluna", "left").select(
        "coluna", "alteradas", (F.col("nulos_antes") + rest).alias("nulos_antes"), (F.col("nulos_depois") + rest).alias("nulos_depois"),
        "so_antes", "so_depois")
