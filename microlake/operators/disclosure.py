"""Complementary suppression of small cells in a table with published margins.

Cells are counts per (group, unit, year); the totals of each (group, year) and of each unit
are published. A withheld cell can be worked out if it is the only one withheld in a line, or
follows from several lines. Seen as a graph - lines are nodes, a withheld cell joins its two
lines - a cell follows from the totals only if no cycle runs through it: around a cycle, values
can go up and down in turn without changing a total. So every small cell gets the cheapest
rectangle: another unit and another year of its group whose three other corners are withheld
too, and all four lie on a cycle. Where a group has no second unit or year, the totals of the
cell's two lines are withheld instead.

All of it runs on the published cells, whose number the dimensions bound, not on rows.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _rectangles(corners: DataFrame, cells: DataFrame) -> DataFrame:
    """All rectangles (g, u, y, u2, y2) of ``corners`` over ``cells``, with the three other corners' cost."""
    c = {i: cells.select(F.col("_g").alias(f"g{i}"), F.col("_u").alias(f"u{i}"), F.col("_y").alias(f"y{i}"), F.col("_cost").alias(f"c{i}"))
         for i in (1, 2, 3)}
    j = corners.select("_g", "_u", "_y") \
        .join(c[1], (F.col("_g") == F.col("g1")) & (F.col("_y") == F.col("y1")) & (F.col("_u") != F.col("u1"))) \
        .join(c[2], (F.col("_g") == F.col("g2")) & (F.col("_u") == F.col("u2")) & (F.col("_y") != F.col("y2"))) \
        .join(c[3], (F.col("_g") == F.col("g3")) & (F.col("u1") == F.col("u3")) & (F.col("y2") == F.col("y3")))
    return j.select("_g", "_u", "_y", F.col("u1").alias("other_u"), F.col("y2").alias("other_y"),
                    (F.col("c1") + F.col("c2") + F.col("c3")).alias("_cost"))


def suppress(table: DataFrame, group: str, unit: str, year: str, count: str, k: int) -> DataFrame:
    """``table`` (one row per group, unit and year) with

    * ``supressao``: ``primaria`` (fewer than ``k``), ``complementar`` or NULL (published);
    * ``total_grupo_publicado``, ``total_unidade_publicado``: whether the cell's line totals are;
    * ``recuperavel``: whether the cell is withheld and yet could follow from published totals.

    NULL groups, units and years count as values of their own.
    """
    keys = {"_g": group, "_u": unit, "_y": year}
    named = table.select("*", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")).alias(a) for a, c in keys.items()])
    cells = named.select("_g", "_u", "_y", F.when(F.col(count) < k, 0).otherwise(F.col(count)).alias("_cost"), (F.col(count) < k).alias("_small"))
    small = cells.where("_small")
    best = _rectangles(small, cells).groupBy("_g", "_u", "_y").agg(F.min(F.struct("_cost", "other_u", "other_y")).alias("b")) \
        .select("_g", "_u", "_y", "b.other_u", "b.other_y")
    corners = F.array(F.struct("_u", "_y"), F.struct(F.col("other_u").alias("_u"), F.col("_y").alias("_y")),
                      F.struct(F.col("_u").alias("_u"), F.col("other_y").alias("_y")), F.struct(F.col("other_u").alias("_u"), F.col("other_y").alias("_y")))
    chosen = best.select("_g", F.explode(corners).alias("c")).select("_g", "c._u", "c._y").distinct().withColumn("_chosen", F.lit(True))
    alone = small.join(best, ["_g", "_u", "_y"], "left_anti")
    group_lines = alone.select("_g", "_y").distinct().withColumn("_no_group", F.lit(True))
    unit_lines = alone.select("_g", "_u").distinct().withColumn("_no_unit", F.lit(True))
    withheld = cells.join(chosen, ["_g", "_u", "_y"], "left").where(F.col("_small") | F.col("_chosen")).withColumn("_cost", F.lit(0))
    safe = _rectangles(withheld, withheld).select("_g", "_u", "_y").distinct().withColumn("_on_cycle", F.lit(True))
    out = named.join(chosen, ["_g", "_u", "_y"], "left").join(safe, ["_g", "_u", "_y"], "left") \
        .join(group_lines, ["_g", "_y"], "left").join(unit_lines, ["_g", "_u"], "left")
    kind = F.when(F.col(count) < k, "primaria").when(F.col("_chosen"), "complementar")
    open_line = F.col("_no_group").isNull() | F.col("_no_unit").isNull()
    return out.select(*table.columns, kind.alias("supressao"), F.col("_no_group").isNull().alias("total_grupo_publicado"),
                      F.col("_no_unit").isNull().alias("total_unidade_publicado"),
                      (kind.isNotNull() & F.col("_on_cycle").isNull() & open_line).alias("recuperavel"))
