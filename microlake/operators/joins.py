"""Join operators: labels, orphans, enrichment, year-keyed factors, top-1 via join.

Strategy notes for large inputs:
* literal or key-domain dimensions (states, years) are broadcast through
  ``dims.bounded``; tables derived from data are joined without a hint and AQE picks
  broadcast or sort-merge from the measured size;
* anti/orphan checks first reduce the big side to its distinct keys (partial
  aggregation before the shuffle), so a hot key costs one row per task, not a third of
  the table.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from microlake.operators import dims

MAX_FACTORS = 10_000


def orphan_codes(df: DataFrame, dim: DataFrame, key: str,
                 allowed: list | None = None) -> DataFrame:
    """Distinct non-NULL codes of ``df`` that the dimension lacks (left anti join).
    ``allowed`` lists codes known to have no label (e.g. the 'not identified' code of a
    release), so the check can be strict about everything else."""
    codes = df.select(key).filter(F.col(key).isNotNull()).distinct()
    if allowed:
        codes = codes.filter(~F.col(key).isin(*allowed))
    return codes.join(dim.select(key), key, "left_anti")


def domain_violations(df: DataFrame, rules: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """(regra, codigo, qtd): codes outside their dimension, with counts; NULL is no violation.

    ``rules``: name -> (column, dimension that has that column). Every row gives one
    (rule, code) pair per rule, counted next to the scan; only the counts meet the domains.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(name).alias("regra"), F.col(key).cast("string").alias("codigo"))
                               for name, (key, _) in rules.items()]))
    counts = (df.select(pairs.alias("p")).select("p.*").filter(F.col("codigo").isNotNull())
              .groupBy("regra", "codigo").agg(F.count(F.lit(1)).alias("qtd")))
    domains = reduce(DataFrame.unionByName, [
        dim.select(F.lit(name).alias("regra"), F.col(key).cast("string").alias("codigo")) for name, (key, dim) in rules.items()])
    return counts.join(domains, ["regra", "codigo"], "left_anti")


JOIN_KINDS = ("inner", "left", "right", "full", "left_semi", "left_anti")


def join_rows(left: DataFrame, right: DataFrame, key_left: str, key_right: str, kind: str,
              sort_merge: bool = False) -> DataFrame:
    """Rows of ``left`` and ``right`` joined on equal keys. NULL keys never match, as in SQL.

    No hint by default: Spark broadcasts a side it knows to be small and else sorts and
    merges, splitting skewed partitions. ``sort_merge`` asks for the latter.
    """
    if kind not in JOIN_KINDS:
        raise ValueError(f"unknown join kind {kind!r}")
    return left.join(right.hint("merge") if sort_merge else right, left[key_left] == right[key_right], kind)


def join_kind_counts(left: DataFrame, right: DataFrame, key_left: str, key_right: str) -> DataFrame:
    """(tipo, qtd): rows of the join of each kind. The joins run; only counts leave them."""
    parts = [join_rows(left, right, key_left, key_right, k).agg(F.count(F.lit(1)).alias("qtd"))
             .select(F.lit(k).alias("tipo"), "qtd") for k in JOIN_KINDS]
    return reduce(DataFrame.unionByName, parts)


def top1_via_join(df: DataFrame, group: str, value: str) -> DataFrame:
    """Rows holding the group maximum (ties kept): groupBy max joined back on both keys."""
    best = df.groupBy(group).agg(F.max(value).alias("_best"))
    return (df.join(best, (df[group].eqNullSafe(best[group])) & (df[value] == best["_best"]))
            .drop(best[group]).drop("_best"))


def apply_factor(df: DataFrame, factors: DataFrame, key: str, value: str, factor: str,
                 out: str, result_type: str = "decimal(28,2)") -> DataFrame:
    """Multiply a measure by a key-keyed factor (deflator / unit conversion).

    ``factors`` must have one row per key (checked, else the measure would be counted
    twice); it is broadcast if it is found to have few rows.
    """
    return (df.join(dims.bounded(dims.checked(factors, key), MAX_FACTORS), key, "left")
            .withColumn(out, (F.col(value) * F.col(factor)).cast(result_type)))


def rate_per(df: DataFrame, population: DataFrame, keys: list[str], count: str,
             pop: str, per: int, out: str, digits: int = 3) -> DataFrame:
    """count / population * per, rounded; missing or zero population gives NULL."""
    j = df.join(population, keys, "left")
    return j.withColumn(out, F.round(F.try_divide(F.col(count) * per, F.col(pop)), digits))
