"""Run manifest: one row per run and year with the row counts of every layer."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST_SCHEMA = ("run_id string, ts timestamp_ntz, ano int, bronze bigint, silver bigint, "
                   "gold_vinculos_ativos bigint")


def layer_counts(layers: dict[str, DataFrame], by: str = "ano") -> DataFrame:
    """(ano, camada, qtd) from one aggregate per layer; ``gold_*`` layers are marts
    whose ``qtd_vinculos`` column is summed instead of counting rows."""
    parts = []
    for name, df in layers.items():
        measure = F.sum("qtd_vinculos") if name.startswith("gold") else F.count(F.lit(1))
        parts.append(df.groupBy(by).agg(measure.cast("bigint").alias("qtd"))
                     .withColumn("camada", F.lit(name)))
    return reduce(lambda a, b: a.unionByName(b), parts)


def manifest_rows(counts: DataFrame, run_id: str, ts: str, layers: list[str],
                  by: str = "ano") -> DataFrame:
    """Pivot (ano, camada, qtd) to one row per year with ``max(when)`` (no pivot
    pass to discover values: the layer names are known)."""
    return counts.groupBy(by).agg(
        *[F.max(F.when(F.col("camada") == c, F.col("qtd"))).alias(c) for c in layers]
    ).select(F.lit(run_id).alias("run_id"), F.to_timestamp_ntz(F.lit(ts)).alias("ts"), by,
             *layers)


def append_manifest(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path)


def rerun_consistency(manifest: DataFrame, by: str = "ano", col: str = "silver") -> DataFrame:
    """Idempotence over runs: per year, runs seen and distinct counts (1 = stable)."""
    return manifest.groupBy(by).agg(
        F.count_distinct("run_id").alias("execucoes"),
        F.count_distinct(col).alias(f"contagens_distintas_{col}"),
    ).withColumn("ok", F.col(f"contagens_distintas_{col}") == 1)
