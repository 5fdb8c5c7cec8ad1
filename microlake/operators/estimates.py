"""Mergeable estimates: medians that roll up, stratified samples, distributions kept per load."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from microlake.functions import clean

#: Size of a quantile sketch, and the rank error its size promises for a single quantile (normalised, 99 %).
SKETCH_K, RANK_ERROR = 200, 0.0133


def sketch_facts(actives: DataFrame, value: str, by: list[str], k: int = SKETCH_K) -> DataFrame:
    """Per group: rows, rows with a value, and a quantile sketch of the value. Sketches merge, so
    coarser groups come from these rows, not from the data."""
    return actives.groupBy(*by).agg(F.count(F.lit(1)).alias("qtd"), F.count(value).alias("qtd_valor"),
                                    F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("esboco"))


def merged_quantile(facts: DataFrame, by: list[str], p: float = 0.5, k: int = SKETCH_K) -> DataFrame:
    """Per coarser group: rows, and the quantile from the merged sketches (NULL without a value)."""
    merged = facts.groupBy(*by).agg(F.sum("qtd").alias("qtd"), F.sum("qtd_valor").alias("qtd_valor"),
                                    F.kll_merge_agg_double("esboco", F.lit(k)).alias("esboco"))
    quantile = F.when(F.col("qtd_valor") > 0, F.kll_sketch_get_quantile_double("esboco", F.lit(p)))
    return merged.select(*by, "qtd", "qtd_valor", quantile.alias("quantil"))


def rank_within(estimates: DataFrame, rows: DataFrame, value: str, by: list[str], p: float = 0.5, error: float = RANK_ERROR) -> DataFrame:
    """``estimates`` with ``erro_posto``, how far the quantile's rank among the rows lies from p (0 if the
    rows equal to it reach across p), and ``ok``: within ``error``. One scan, counts only."""
    e = estimates.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("quantil").alias("_q"))
    joined = rows.where(F.col(value).isNotNull()).join(e, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
    v = F.col(value).cast("double")
    ranks = joined.groupBy(*by).agg((F.count_if(v < F.col("_q")) / F.count(F.lit(1))).alias("_lo"),
                                    (F.count_if(v <= F.col("_q")) / F.count(F.lit(1))).alias("_hi"))
    off = F.greatest(F.col("_lo") - p, p - F.col("_hi"), F.lit(0.0))
    r = ranks.select(*[F.col(c).alias(f"_{c}") for c in by], off.alias("erro_posto"))
    return estimates.join(r, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by], "left").drop(*[f"_{c}" for c in by]) \
        .withColumn("ok", F.coalesce(F.col("erro_posto") <= error, F.lit(True)))


def region_medians(facts: DataFrame, p: float = 0.5) -> DataFrame:
    """Medians per year and macro-region from sketches per (ano, cod_uf)."""
    return merged_quantile(facts.withColumn("regiao", clean.region_of(F.col("cod_uf"))), ["ano", "regiao"], p)


# --- stratified samples -----------------------------------------------------------------

def portable_hash(columns: list[Column], seed: int) -> Column:
    """md5 of the seed and the columns: the order of a sample that any SQL engine can recompute."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in columns]))


def stratified_sample(rows: DataFrame, strata: list[str], id_columns: list[str], k: int, seed: int = 42) -> DataFrame:
    """The ``k`` rows of least hash in every stratum (all rows of a smaller one).

    Which rows those are does not depend on order, partitioning or what else was loaded.
    ``row_number`` up to k is planned as a limit per group in every task before the shuffle,
    so a hot stratum sends k rows a task, not all of its rows. Equal ids are ordered by the
    whole row.
    """
    whole = F.to_json(F.struct(*rows.columns))
    order = Window.partitionBy(*strata).orderBy("_h", whole)
    return rows.withColumn("_h", portable_hash([F.col(c) for c in id_columns], seed)) \
        .withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k).drop("_n", "_h")


def merge_samples(samples: DataFrame, strata: list[str], id_columns: list[str], k: int, seed: int = 42) -> DataFrame:
    """The sample of a union of tables from the union of their samples (as large as ``k``)."""
    return stratified_sample(samples, strata, id_columns, k, seed)


# --- drift of distributions ----------------------------------------------------------------

BINS = 20


def column_profile(rows: DataFrame, numeric: dict[str, tuple[float, float]], nominal: list[str], by: list[str], bins: int = BINS) -> DataFrame:
    """Per group and column: how many rows fall into each bin, one scan for all columns.

    Numeric columns have ``bins`` equal bins over a fixed range, one below and one above it;
    nominal ones a bin per value; NULLs a bin of their own. The bins are fixed, so profiles of
    different loads can be stored and compared.
    """
    def numeric_bin(c: str, low: float, high: float) -> Column:
        v = F.col(c).cast("double")
        inside = F.least(F.floor((v - low) / ((high - low) / bins)), F.lit(bins - 1)).cast("string")
        return F.when(v.isNull(), "nulo").when(v < low, "abaixo").when(v > high, "acima").otherwise(inside)

    cells = [F.struct(F.lit(c).alias("coluna"), numeric_bin(c, lo, hi).alias("faixa")) for c, (lo, hi) in numeric.items()]
    cells += [F.struct(F.lit(c).alias("coluna"), F.coalesce(F.col(c).cast("string"), F.lit("nulo")).alias("faixa")) for c in nominal]
    # counted per row of distinct bins first would not shrink; explode + partial aggregation leaves columns x bins rows a task
    return rows.select(*by, F.explode(F.array(*cells)).alias("c")).groupBy(*by, "c.coluna", "c.faixa").agg(F.count(F.lit(1)).alias("qtd"))


def profile_drift(before: DataFrame, after: DataFrame, by: list[str], max_shift: float, max_nulls: float) -> DataFrame:
    """Distance of two stored profiles per group and column.

    ``distancia`` is the total variation of the non-NULL bins (half the sum of the share
    differences), ``nulos_antes`` and ``nulos_depois`` are shares of NULLs; ``ok`` says that
    the distance is at most ``max_shift`` and the NULL share rose by at most ``max_nulls``. A
    column without a value on one side alone has distance 1, a group on one side alone is not ok.
    """
    keys = [*by, "coluna"]

    def shares(p: DataFrame, side: str) -> DataFrame:
        total = Window.partitionBy(*keys)                   # over a few bins per column, not over rows
        value = F.col("faixa") != "nulo"
        return p.select(*keys, "faixa", (F.when(value, F.col("qtd")) / F.sum(F.when(value, F.col("qtd"))).over(total)).alias(f"s_{side}"),
                        (F.when(~value, F.col("qtd")) / F.sum("qtd").over(total)).alias(f"n_{side}"), F.lit(True).alias(f"in_{side}"))

    j = shares(before, "a").join(shares(after, "b"), [*keys, "faixa"], "full")
    half = F.sum(F.abs(F.coalesce("s_a", F.lit(0.0)) - F.coalesce("s_b", F.lit(0.0)))) / 2
    one_side = (F.count("s_a") == 0) != (F.count("s_b") == 0)
    out = j.groupBy(*keys).agg(
        F.when(one_side, 1.0).otherwise(F.coalesce(half, F.lit(0.0))).alias("distancia"),
        F.when(F.max("in_a"), F.coalesce(F.sum("n_a"), F.lit(0.0))).alias("nulos_antes"),
        F.when(F.max("in_b"), F.coalesce(F.sum("n_b"), F.lit(0.0))).alias("nulos_depois"))
    fits = (F.col("distancia") <= max_shift) & (F.col("nulos_depois") - F.col("nulos_antes") <= max_nulls)
    return out.withColumn("ok", F.coalesce(fits, F.lit(False)))
