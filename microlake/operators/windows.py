"""Ranking and per-group operators.

Window functions need every row of a partition key in one task. They are used only
where the partition is small by construction (after aggregation, or a natural small
group). For per-row group statistics over raw rows the aggregate is computed first
and joined back, which keeps hot keys splittable (partial aggregation + AQE skew join).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from microlake.session import scratch_path


def top_n(df: DataFrame, by: list[str], order: list[Column], n: int,
          rank_col: str = "posicao") -> DataFrame:
    """Keep the first ``n`` rows per group (``row_number``: exactly n, ties broken by
    ``order``). Spark plans the filter as a WindowGroupLimit, which also limits rows
    before the shuffle."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def top1(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """One row per group, rank column dropped."""
    return top_n(df, by, order, 1, "_rn").drop("_rn")


def rank_variants(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """row_number (unique), rank (gaps after ties), dense_rank (no gaps)."""
    w = Window.partitionBy(*by).orderBy(*order)
    return (df.withColumn("row_number", F.row_number().over(w))
              .withColumn("rank", F.rank().over(w))
              .withColumn("dense_rank", F.dense_rank().over(w)))


def group_stat_per_row(df: DataFrame, key: str, stat: Column, name: str) -> DataFrame:
    """Every row plus a statistic of its group (same result as an unordered window).

    Aggregate-then-join: partial aggregation shrinks a hot key before the shuffle and
    AQE can split the skewed side of the join; NULL keys form their own group.
    """
    g = df.groupBy(key).agg(stat.alias(name)).withColumnRenamed(key, "_k")
    return df.join(g, df[key].eqNullSafe(g["_k"]), "left").drop("_k")


def latest_per_key(df: DataFrame, keys: list[str], ts: str, tie: str,
                   cols: list[str]) -> DataFrame:
    """Most recent row per key ("last execution wins"), deterministic on equal ts.

    ``max_by`` over a (ts, tie) struct is an ordinary aggregate: partial results are
    combined before the shuffle, so a key with millions of runs is never sorted whole.
    """
    order = F.struct(F.col(ts), F.col(tie))
    payload = F.struct(*[F.col(c) for c in [ts, tie, *cols]])
    return (df.groupBy(*keys).agg(F.max_by(payload, order).alias("_last"))
            .select(*keys, *[F.col(f"_last.{c}").alias(c) for c in [ts, tie, *cols]]))


def previous_value(df: DataFrame, by: list[str], order: str, value: str,
                   out: str) -> DataFrame:
    """Run-over-run variation: previous value of ``value`` inside ``by`` ordered by
    ``order`` (``lag``), and the difference."""
    w = Window.partitionBy(*by).orderBy(order)
    return (df.withColumn(out, F.lag(value).over(w))
              .withColumn(f"variacao_{value}", F.col(value) - F.col(out)))


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def ranks_at_scale(df: DataFrame, by: list[str], order: list[tuple[str, bool]],
                   partitions: int | None = None) -> DataFrame:
    """``rank`` and ``dense_rank`` without putting a whole group in one task.

    ``order`` is [(column, descending)]. Rows are first reduced to (group, value) with
    counts (partial aggregation), range-partitioned on (group, value) so a hot group
    is spread over many tasks, and written once to the shared folder with the number of
    their range partition (bounds are sampled, so a second evaluation may cut elsewhere);
    then they are ranked inside each range partition, and shifted by the
    rows/values of the earlier partitions of the same group (a table with one row per
    partition and group). The ranks are joined back on (group, value). With a unique
    ordering, ``rank`` equals ``row_number``.
    """
    keys = [c for c, _ in order]
    sort = [F.col(c).desc() if d else F.col(c).asc() for c, d in order]
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(*by, *keys).agg(F.count(F.lit(1)).alias("_c"))
    ranged = (counts.repartitionByRange(n, *[F.col(b).asc() for b in by], *sort)
              .withColumn("_p", F.spark_partition_id()))
    path = scratch_path(df.sparkSession, "ranks")
    ranged.write.parquet(path)
    ranged = df.sparkSession.read.schema(ranged.schema).parquet(path)
    local = Window.partitionBy("_p", *by).orderBy(*sort)
    before = local.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (ranged.withColumn("_rows_before", F.coalesce(F.sum("_c").over(before), F.lit(0)))
              .withColumn("_vals_before", F.row_number().over(local) - 1))
    seg = ranged.groupBy("_p", *by).agg(F.sum("_c").alias("_seg_rows"),
                                         F.count(F.lit(1)).alias("_seg_vals"))
    earlier = Window.partitionBy(*by).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    seg = (seg.withColumn("_off_rows", F.coalesce(F.sum("_seg_rows").over(earlier), F.lit(0)))
              .withColumn("_off_vals", F.coalesce(F.sum("_seg_vals").over(earlier), F.lit(0)))
              .select("_p", *by, "_off_rows", "_off_vals"))
    table = _null_safe_join(ranked, seg, ["_p", *by]).select(
        *by, *keys,
        (F.col("_off_rows") + F.col("_rows_before") + 1).cast("int").alias("rank"),
        (F.col("_off_vals") + F.col("_vals_before") + 1).cast("int").alias("dense_rank"))
    return _null_safe_join(df, table, [*by, *keys], "left")
