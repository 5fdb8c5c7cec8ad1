"""Result comparison as one aggregate (multiset semantics, duplicates count)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def multiset_difference(a: DataFrame, b: DataFrame, name_a: str = "a",
                        name_b: str = "b") -> DataFrame:
    """Rows of ``a`` missing in ``b`` and vice versa (what ``exceptAll`` both ways
    returns), counted in one shuffle: both sides are unioned with a tag and grouped by
    every column; NULLs group together. One summary row."""
    cols = a.columns
    tagged = (a.select(*cols, F.lit(1).alias("_a"), F.lit(0).alias("_b"))
              .unionByName(b.select(*cols, F.lit(0).alias("_a"), F.lit(1).alias("_b"))))
    per_row = tagged.groupBy(*cols).agg(F.sum("_a").alias("_na"), F.sum("_b").alias("_nb"))
    return per_row.agg(
        F.sum("_na").cast("bigint").alias(f"linhas_{name_a}"),
        F.sum("_nb").cast("bigint").alias(f"linhas_{name_b}"),
        F.sum(F.greatest(F.col("_na") - F.col("_nb"), F.lit(0))).cast("bigint").alias(f"so_{name_a}"),
        F.sum(F.greatest(F.col("_nb") - F.col("_na"), F.lit(0))).cast("bigint").alias(f"so_{name_b}"),
    ).withColumn("iguais", (F.col(f"so_{name_a}") == 0) & (F.col(f"so_{name_b}") == 0))
