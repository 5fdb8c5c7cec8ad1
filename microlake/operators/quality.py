"""Quality rules kept as data: every check returns result rows, a wrapper raises.

Each rule set is evaluated with one aggregate per input (single scan), then the one
row per group is unpivoted into (rule, value, limit, ok) rows.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from microlake import config


class GateFailed(AssertionError):
    pass


def _rules(*items: tuple[str, Column, Column, Column]) -> Column:
    """array<struct<regra, valor, limite, ok>> to explode into rule rows."""
    return F.explode(F.array(*[
        F.struct(F.lit(n).alias("regra"), v.cast("double").alias("valor"),
                 lim.cast("double").alias("limite"), ok.alias("ok"))
        for n, v, lim, ok in items]))


def silver_metrics(by: str = "ano") -> list[Column]:
    """Aggregates the silver gate needs (usable in ``groupBy().agg`` or ``observe``)."""
    return [F.count(F.lit(1)).alias("qtd_silver"),
            F.count_if(F.col("remun_dezembro_nom").isNull()).alias("nulos_remun"),
            F.count_if(F.col("cod_uf").isNull()).alias("nulos_uf")]


def gate_rules(metrics: DataFrame, bronze_counts: DataFrame, by: str = "ano",
               max_null_pay: float = config.MAX_NULL_PAY,
               max_null_state: float = config.MAX_NULL_STATE) -> DataFrame:
    """Rule rows (regra, valor, limite, ok) from per-year silver metrics
    (qtd_silver, nulos_remun, nulos_uf) and bronze counts (qtd_bronze)."""
    j = metrics.join(bronze_counts, by, "full")
    qs, qb = F.coalesce("qtd_silver", F.lit(0)), F.coalesce("qtd_bronze", F.lit(0))
    nr = F.try_divide(F.col("nulos_remun"), F.col("qtd_silver"))
    nu = F.try_divide(F.col("nulos_uf"), F.col("qtd_silver"))
    return j.select(by, _rules(
        ("silver_nao_vazia", qs, F.lit(1), qs >= 1),
        ("silver_igual_bronze", qs, qb, qs == qb),
        ("nulo_remuneracao", nr, F.lit(max_null_pay), F.coalesce(nr <= max_null_pay, F.lit(False))),
        ("nulo_uf", nu, F.lit(max_null_state), F.coalesce(nu <= max_null_state, F.lit(False))),
    ).alias("r")).select(by, "r.*")


def layer_gate(silver: DataFrame, bronze: DataFrame, by: str = "ano",
               max_null_pay: float = config.MAX_NULL_PAY,
               max_null_state: float = config.MAX_NULL_STATE) -> DataFrame:
    """Silver gate per year: non-empty, same count as bronze, NULL share of pay and
    of state under their limits. One aggregate per layer, joined on the year."""
    s = silver.groupBy(by).agg(*silver_metrics(by))
    b = bronze.groupBy(by).agg(F.count(F.lit(1)).alias("qtd_bronze"))
    return gate_rules(s, b, by, max_null_pay, max_null_state)


def enforce(results: DataFrame, ok: str = "ok") -> int:
    """Raise with every failed rule; returns the number of rules checked. Only the
    (small) rule rows are collected."""
    rows = results.collect()
    failed = [r.asDict() for r in rows if not r[ok]]
    if failed:
        raise GateFailed(f"{len(failed)} rule(s) failed: {failed}")
    return len(rows)


def schema_rows(spark: SparkSession, schema: StructType | str, table: str) -> DataFrame:
    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    return spark.createDataFrame([(table, f.name, f.dataType.simpleString()) for f in st.fields],
                                 "tabela string, coluna string, tipo string")


def contract_diff(spark: SparkSession, actual: StructType, expected: StructType | str,
                  table: str) -> DataFrame:
    """Expected vs actual columns: missing, unexpected, or another type. Empty = ok."""
    e = schema_rows(spark, expected, table).withColumnRenamed("tipo", "tipo_esperado")
    a = schema_rows(spark, actual, table).withColumnRenamed("tipo", "tipo_real")
    j = e.join(a, ["tabela", "coluna"], "full")
    problem = (F.when(F.col("tipo_real").isNull(), "ausente")
               .when(F.col("tipo_esperado").isNull(), "inesperada")
               .when(F.col("tipo_real") != F.col("tipo_esperado"), "tipo_diferente"))
    return j.withColumn("problema", problem).filter(F.col("problema").isNotNull())


def type_failures(df: DataFrame, rules: dict[str, tuple[str, Column]], table: str) -> DataFrame:
    """(tabela, coluna, tipo_esperado, linhas, preenchidas, falhas) of stored text columns.

    ``rules``: column -> (expected type, its parsed value). A row fails where it holds
    something but blanks that does not parse. One aggregate, one scan.
    """
    def filled(c: str) -> Column:
        return F.coalesce(F.trim(F.col(c)) != "", F.lit(False))

    one = df.agg(F.count(F.lit(1)).alias("linhas"), *[x for c, (_, parsed) in rules.items() for x in (
        F.count_if(filled(c)).alias(f"p_{c}"), F.count_if(filled(c) & parsed.isNull()).alias(f"f_{c}"))])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("coluna"), F.lit(t).alias("tipo_esperado"), F.col("linhas"),
                                        F.col(f"p_{c}").alias("preenchidas"), F.col(f"f_{c}").alias("falhas"))
                               for c, (t, _) in rules.items()]))
    return one.select(rows.alias("r")).select(F.lit(table).alias("tabela"), "r.*")


def check_contract(spark: SparkSession, df: DataFrame, expected: StructType | str,
                   table: str) -> DataFrame:
    """Raise before a write when the frame does not match its contract."""
    diff = contract_diff(spark, df.schema, expected, table)
    problems = diff.collect()
    if problems:
        raise GateFailed(f"{table}: contract violated: {[r.asDict() for r in problems]}")
    return df


def range_violations(df: DataFrame, rules: dict[str, tuple[Column, float, float]],
                     by: list[str]) -> DataFrame:
    """Rows outside [low, high] per rule; NULL values are not violations."""
    agg = df.groupBy(*by).agg(*[
        F.count_if(~c.between(lo, hi)).alias(name) for name, (c, lo, hi) in rules.items()])
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("regra"), F.col(n).alias("qtd"))
                              for n in rules]))
    return agg.select(*by, rows.alias("r")).select(*by, "r.*")


def bound_check(df: DataFrame, by: list[str], col: str, bound: int) -> DataFrame:
    return (df.groupBy(*by).agg(F.max(col).alias(f"max_{col}"))
            .withColumn("ok", F.col(f"max_{col}") <= bound))


def key_coverage(left: DataFrame, right: DataFrame, key: str, left_name: str,
                 right_name: str) -> DataFrame:
    """Which key values exist on each side (full outer join of the distinct keys)."""
    lk = left.select(key).distinct().withColumn(left_name, F.lit(True))
    rk = right.select(key).distinct().withColumn(right_name, F.lit(True))
    return (lk.join(rk, key, "full")
            .select(key, F.coalesce(left_name, F.lit(False)).alias(left_name),
                    F.coalesce(right_name, F.lit(False)).alias(right_name)))


def ratio_check(df: DataFrame, by: list[str], num: str, den: str, expected: float,
                tolerance: float, digits: int = 2) -> DataFrame:
    """sum(num)/sum(den) per group against an expected value with relative tolerance."""
    g = df.groupBy(*by).agg(F.sum(num).alias("_n"), F.sum(den).alias("_d"))
    ratio = F.round(F.try_divide(F.col("_n"), F.col("_d")), digits)
    return g.select(*by, ratio.alias("razao"), F.lit(expected).alias("esperado"),
                    F.coalesce(F.abs(ratio - F.lit(expected)) <= F.lit(expected * tolerance),
                               F.lit(False)).alias("ok"))


def suppress_small_cells(df: DataFrame, count_col: str, value_cols: list[str],
                         k: int) -> DataFrame:
    """Publishable mart: values of groups with fewer than ``k`` rows become NULL."""
    keep = F.col(count_col) >= k
    out = df
    for c in value_cols:
        out = out.withColumn(c, F.when(keep, F.col(c)))
    return out.withColumn("suprimido", ~keep)


def check_stored_year(spark: SparkSession, silver_path: str, bronze_path: str, ano: int,
                      by: str = "ano") -> int:
    """Gate a stored year: both tables are read with a partition filter (pruned to the
    year's folders), evaluated and enforced."""
    s = spark.read.parquet(silver_path).filter(F.col(by) == ano)
    b = spark.read.parquet(bronze_path).filter(F.col(by) == ano)
    return enforce(layer_gate(s, b, by))
