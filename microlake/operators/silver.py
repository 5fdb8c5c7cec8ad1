"""Bronze (all strings) -> silver (fixed typed contract), one projection, no row lost.

The whole transform is a single narrow ``select`` (no shuffle): it runs as one
whole-stage-codegen span next to the scan, so it scales with the number of files.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from microlake import config
from microlake.functions import clean


class _Presence:
    """Which bronze columns exist for the year being transformed.

    After schema evolution a bronze *table* shows every column ever seen, so column
    presence must come from the year's source layout, not from ``df.columns``.
    """

    def __init__(self, df: DataFrame, present: list[str] | None):
        self.df = df
        self.present = set(df.columns if present is None else present) & set(df.columns)

    def has(self, name: str) -> bool:
        return name in self.present


_PAY_COLUMNS = ("vl_remun_dezembro_nom", "vl_remun_media_nom", "vl_remun_dezembro_sm", "vl_remun_media_sm")


def _typed_columns(b: DataFrame, present: list[str] | None,
                   absent: dict[str, list[str]] | None = None) -> list[Column]:
    p = _Presence(b, present)

    def text(n):
        return F.trim(F.col(n)) if p.has(n) else F.lit(None).cast("string")

    def integer(n):
        return clean.int_of(F.col(n)) if p.has(n) else F.lit(None).cast("int")

    def pay(n):
        if not p.has(n):
            return F.lit(None).cast("decimal(18,2)")
        if absent and absent[n]:
            # the row's own file decides: absent there -> NULL, present but empty -> 0
            return F.when(~F.col("arquivo_origem").isin(absent[n]), clean.pay_of(F.col(n)))
        return clean.pay_of(F.col(n))

    months = (clean.decimal_of(F.col("tempo_emprego"), 10, 1) if p.has("tempo_emprego")
              else F.lit(None).cast("decimal(10,1)"))
    active = clean.flag_of(F.col("vinculo_ativo_31_12")) if p.has("vinculo_ativo_31_12") \
        else F.lit(None).cast("boolean")

    municipality = clean.keep_if_matches(text("municipio"), config.MUNICIPALITY_PATTERN)
    industry = clean.keep_if_matches(text("cnae_2_0_classe"), config.INDUSTRY_CLASS_PATTERN)
    age = clean.keep_if_between(integer("idade"), *config.AGE_RANGE)
    month = clean.keep_if_between(integer("mes_desligamento"), *config.MONTH_RANGE)
    return [
        F.col("ano").cast("int").alias("ano"),
        municipality.alias("cod_municipio"),
        F.substring(municipality, 1, 2).alias("cod_uf"),
        industry.alias("cnae_classe"),
        F.substring(industry, 1, 2).alias("cnae_divisao"),
        text("cbo_ocupacao_2002").alias("cbo"),
        text("natureza_juridica").alias("natureza_juridica"),
        integer("sexo_trabalhador").alias("sexo"),
        integer("escolaridade_apos_2005").alias("escolaridade"),
        integer("raca_cor").alias("raca_cor"),
        age.alias("idade"),
        integer("tamanho_estabelecimento").alias("tamanho_estab"),
        month.alias("mes_desligamento"),
        integer("motivo_desligamento").alias("motivo_desligamento"),
        months.alias("tempo_emprego_meses"),
        active.alias("vinculo_ativo"),
        month.isNotNull().alias("desligado_no_ano"),
        pay("vl_remun_dezembro_nom").alias("remun_dezembro_nom"),
        pay("vl_remun_media_nom").alias("remun_media_nom"),
        pay("vl_remun_dezembro_sm").alias("remun_dezembro_sm"),
        pay("vl_remun_media_sm").alias("remun_media_sm"),
    ]


def missing_required(columns: list[str], required: list[str] | None = None) -> list[str]:
    required = config.REQUIRED_COLUMNS if required is None else required
    have = set(columns)
    return [c for c in required if c not in have]


def to_silver(bronze: DataFrame, present: list[str] | None = None,
              keep: list | None = None) -> DataFrame:
    """Typed, validated silver rows; same row count as the input.

    ``present``: the columns of the year's source layout (defaults to the frame's).
    ``keep``: extra bronze columns carried through unchanged (e.g. the lineage column).
    """
    missing = missing_required(list(present) if present is not None else bronze.columns)
    if missing:
        raise ValueError(f"required columns absent: {missing}")
    extra = [F.col(k) if isinstance(k, str) else k for k in (keep or [])]
    return bronze.select(*_typed_columns(bronze, present), *extra)


def file_problems(rows: list) -> dict[str, list[str]]:
    """File -> required columns its own layout lacks (``rows``: layout rows, one per file)."""
    return {r["caminho"]: m for r in rows if (m := missing_required(r["colunas"]))}


def to_silver_by_file(parts: list[DataFrame], rows: list, keep: list | None = None) -> DataFrame:
    """Silver where column presence is decided per source file.

    After a union of layouts a missing column and an empty field are both NULL, but the pay
    rule differs: absent -> NULL, empty -> 0. So each layout's frame (``parts``) is
    transformed on its own, before the union: presence is a property of the scan, and no
    row is shuffled. A file without a required column fails before anything is read.
    """
    problems = file_problems(rows)
    if problems:
        raise ValueError(f"required columns absent: {problems}")
    return reduce(DataFrame.unionByName, [to_silver(p, keep=keep) for p in parts])


def to_silver_stored(bronze: DataFrame, rows: list, keep: list | None = None) -> DataFrame:
    """Silver of a stored bronze table: presence by layout, from the lineage column.

    ``rows`` hold one entry per file of the year. Rows of files with the same columns are
    told apart by a literal list of names in the plan - no join - and the tables of files
    are as long as the listing that the load holds anyway.
    """
    problems = file_problems(rows)
    if problems:
        raise ValueError(f"required columns absent: {problems}")
    by_columns: dict[tuple, set] = {}
    for r in rows:
        by_columns.setdefault(tuple(sorted(set(r["colunas"]) & set(_PAY_COLUMNS))), set()).add(r["arquivo"])
    names = sorted(by_columns)
    if len(names) == 1:
        return to_silver(bronze, present=[c for c in bronze.columns if c not in _PAY_COLUMNS or c in names[0]], keep=keep)
    absent = {c: sorted(f for n in names if c not in n for f in by_columns[n]) for c in _PAY_COLUMNS}
    extra = [F.col(k) if isinstance(k, str) else k for k in (keep or [])]
    return bronze.select(*_typed_columns(bronze, None, absent), *extra)
