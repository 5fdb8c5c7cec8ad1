"""Connected components of a link table, by alternating large and small stars."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored


def _state(edges: DataFrame) -> tuple:
    """Count and order-free checksum of the links; two numbers reach the driver."""
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the least node of its component.

    Each round moves every node's links to its least neighbour (aggregate and join, so a hub
    with many links is split like any skewed join) and is written to the shared folder; the
    rounds needed grow with the logarithm of the longest path. Links to oneself and nulls
    are ignored; an empty table gives no rows.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")) \
        .where(F.col("a") != F.col("b")).distinct()
    edges = stored(spark, edges, "links")
    state = _state(edges)
    while state[0]:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b")) \
            .union(least).distinct()
        edges = stored(spark, small.select("a", "b"), "links")
        last, state = state, _state(edges)
        if state == last:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")) \
        .union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
