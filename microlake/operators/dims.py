"""Small code -> label dimensions and the enrichment joins that use them.

Broadcast rule: a side is hinted for broadcast only when its row count has a static
bound (a literal dimension, or a key domain such as years or states). Anything whose
size grows with the data is joined without a hint: AQE measures the real size of the
shuffle stage and switches to a broadcast join only if it is below
``spark.sql.adaptive.autoBroadcastJoinThreshold``; otherwise it stays a sort-merge join.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from microlake import config


def dim_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(config.STATES, "cod_uf string, uf string")


def dim_sex(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(config.SEXES, "sexo int, sexo_desc string")


def dim_schooling(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(config.SCHOOLING, "escolaridade int, escolaridade_desc string")


def bounded(dim: DataFrame, max_rows: int) -> DataFrame:
    """``dim`` with a broadcast hint if it has at most ``max_rows`` rows (counted, reading no
    more than that), else ``dim`` as it is: the join then shuffles, with the same result."""
    return F.broadcast(dim) if dim.limit(max_rows + 1).count() <= max_rows else dim


def state_dim(spark: SparkSession) -> DataFrame:
    """A literal of config, broadcast: its rows are in the program."""
    return F.broadcast(dim_state(spark))


def schooling_dim(spark: SparkSession) -> DataFrame:
    return F.broadcast(dim_schooling(spark))


def sex_dim(spark: SparkSession) -> DataFrame:
    return F.broadcast(dim_sex(spark))


def label(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Left join on ``key`` (kept once): unmatched and NULL keys keep the row, label NULL."""
    return df.join(dim, key, "left")


def duplicate_keys(dim: DataFrame, key: str | list[str]) -> DataFrame:
    """Keys that appear more than once: a left join to such a dimension multiplies
    rows and inflates every total, so dimensions are checked before use."""
    keys = [key] if isinstance(key, str) else key
    return dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("qtd")).filter(F.col("qtd") > 1)


def checked(dim: DataFrame, key: str | list[str]) -> DataFrame:
    """The dimension itself, after verifying its key is unique (raises otherwise)."""
    dup = duplicate_keys(dim, key).limit(5).collect()
    if dup:
        raise ValueError(f"dimension key not unique: {[r.asDict() for r in dup]}")
    return dim
