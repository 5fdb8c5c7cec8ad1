"""Column profiles in a single scan (one aggregate, then unpivot of one row)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_rates(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Share of NULLs of chosen columns (0..1), optionally per group, with the row count."""
    aggs = [F.count(F.lit(1)).alias("qtd_linhas")]
    aggs += [F.avg(F.col(c).isNull().cast("int")).alias(f"nulo_{c}") for c in columns]
    return df.groupBy(*(by or [])).agg(*aggs)


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column: NULL count and percentage, sorted by percentage desc.

    All counts come from one aggregate over the table (a single scan whatever the
    number of columns); the one-row result is unpivoted, so nothing loops on the driver.
    """
    cols = columns or df.columns
    one = df.agg(F.count(F.lit(1)).alias("_total"),
                 *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    long = one.select(
        "_total",
        F.explode(F.array(*[F.struct(F.lit(c).alias("coluna"), F.col(f"_n{i}").alias("nulos"))
                            for i, c in enumerate(cols)])).alias("_p"))
    return (long.select(F.col("_p.coluna").alias("coluna"), F.col("_p.nulos").alias("nulos"),
                        F.col("_total").alias("total"),
                        F.round(F.try_divide(F.col("_p.nulos") * 100, F.col("_total")), 2)
                        .alias("pct_nulo"))
            # one row per column, all in the single partition of the global aggregate:
            # a local sort orders it without a range-partitioning (sampling) job
            .coalesce(1).sortWithinPartitions(F.desc("pct_nulo"), "coluna"))


def describe_stats(df: DataFrame, columns: list[str], digits: int = 4) -> DataFrame:
    """count / mean / stddev / min / max per column, typed (one row per column)."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__stddev"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    one = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("coluna"), F.col(f"{c}__count").alias("qtd"),
                 F.round(F.col(f"{c}__mean"), digits).alias("media"),
                 F.round(F.col(f"{c}__stddev"), digits).alias("desvio"),
                 F.col(f"{c}__min").alias("minimo"), F.col(f"{c}__max").alias("maximo"))
        for c in columns]))
    return one.select(rows.alias("_r")).select("_r.*")


def share(df: DataFrame, flag: str, by: list[str] | None = None) -> DataFrame:
    """Share of rows whose boolean flag is true (NULL counts as not true)."""
    return df.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("qtd_linhas"),
        F.avg(F.coalesce(F.col(flag), F.lit(False)).cast("int")).alias(f"share_{flag}"))
