"""Quality rules declared as data: one aggregate reports all of them, one projection sets bad rows aside.

A rule names a column and what must hold; ``report`` compiles all rules of a table into a single
aggregate, ``set_aside`` into a single projection that gives every row the list of the rules it
breaks. Kinds:

* ``range``: a number between ``low`` and ``high``; ``domain``: one of ``values``; ``pattern``: the
  whole trimmed text matches; ``type``: a filled text can be read as int or decimal. A NULL or
  blank value breaks none of these, that is what
* ``filled`` is for: the share of NULL or blank values is at most ``limit`` (0: each such row is bad);
* ``key``: no two rows agree in ``columns`` (a NULL is a value like any other).
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from microlake.functions import clean


@dataclass(frozen=True)
class Rule:
    name: str
    kind: str
    column: str = ""
    low: float | None = None
    high: float | None = None
    values: tuple = ()
    pattern: str = ""
    type: str = ""
    limit: float = 0.0
    columns: tuple = field(default=())

    def __post_init__(self):
        if self.kind not in ("range", "domain", "pattern", "type", "filled", "key"):
            raise ValueError(f"rule {self.name!r}: unknown kind {self.kind!r}")
        if self.kind == "type" and self.type not in ("int", "decimal"):
            raise ValueError(f"rule {self.name!r}: unknown type {self.type!r}")


def _blank(c: Column) -> Column:
    return F.coalesce(F.trim(c.cast("string")), F.lit("")) == ""


def _broken(rule: Rule) -> Column:
    """Whether a row breaks the rule (never NULL); a ``key`` rule needs the other rows."""
    c = F.col(rule.column)
    if rule.kind == "filled":
        return _blank(c)
    if rule.kind == "range":
        # what is no number is for a type rule to tell
        v = c.try_cast("double")
        bad = (v < rule.low if rule.low is not None else F.lit(False)) | (v > rule.high if rule.high is not None else F.lit(False))
    elif rule.kind == "domain":
        bad = ~c.cast("string").isin(*[str(v) for v in rule.values])
    elif rule.kind == "pattern":
        bad = ~F.trim(c.cast("string")).rlike(f"^(?:{rule.pattern})$")
    else:
        bad = (clean.int_of(c) if rule.type == "int" else clean.decimal_of(c)).isNull()
    return ~_blank(c) & F.coalesce(bad, F.lit(False))


def report(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """(regra, linhas, violacoes, limite, ok) per rule: one scan and one aggregate for all rules.

    violacoes: rows that break the rule; of a ``key`` rule the rows beyond the first of each
    key. An empty table breaks nothing.
    """
    cells = []
    for k, r in enumerate(rules):
        if r.kind == "key":
            keyed = F.struct(*[F.struct(F.col(c).isNull(), F.col(c)) for c in r.columns])
            cells.append((F.count(F.lit(1)) - F.count_distinct(keyed)).alias(f"v{k}"))
        else:
            cells.append(F.count_if(_broken(r)).alias(f"v{k}"))
    one = rows.agg(F.count(F.lit(1)).alias("linhas"), *cells)
    out = F.explode(F.array(*[F.struct(F.lit(r.name).alias("regra"), F.col(f"v{k}").alias("violacoes"),
                                       F.lit(float(r.limit) if r.kind == "filled" else 0.0).alias("limite")) for k, r in enumerate(rules)]))
    return one.select("linhas", out.alias("r")).select("r.regra", "linhas", "r.violacoes", "r.limite") \
        .withColumn("ok", F.col("violacoes") <= F.col("limite") * F.col("linhas"))


def with_reasons(rows: DataFrame, rules: list[Rule], name: str = "motivos") -> DataFrame:
    """``rows`` with the names of the rules each breaks, as declared. A ``filled`` rule with a limit
    over 0 judges the table, not the row. ``key`` rules count the rows of a key (one window each)."""
    reasons = []
    for r in rules:
        if r.kind == "key":
            keyed = Window.partitionBy(*r.columns)
            reasons.append(F.when(F.count(F.lit(1)).over(keyed) > 1, r.name))
        elif r.kind != "filled" or r.limit == 0:
            reasons.append(F.when(_broken(r), r.name))
    listed = F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")
    return rows.withColumn(name, listed)


def set_aside(rows: DataFrame, rules: list[Rule], name: str = "motivos") -> tuple[DataFrame, DataFrame]:
    """(good rows as they were, bad rows with all their reasons), both from the same projection: written
    together by a partition on whether there is a reason, or each on its own."""
    judged = with_reasons(rows, rules, name)
    return judged.where(F.size(name) == 0).drop(name), judged.where(F.size(name) > 0)
