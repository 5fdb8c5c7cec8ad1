"""Landed source text written from the ``raw`` stand-in, in two layouts.

Per year folder there is one file per region of the municipality code, as the real
releases ship them. Files of the Nordeste region use the newer layout (',' separator,
every field quoted, other header names, no 'Tempo Emprego', one extra column, ext
``.COMT``); the others use the older one (';', ``.txt``). All text is latin-1.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark import StorageLevel
from pyspark.sql import functions as F

from microlake import config
from microlake.queries import inputs
from microlake.session import scratch_path
from microlake.sinks.files import publish_single_files, unsorted_writes

# fixed values: header text of the two layouts (canonical name -> header as released)
OLD_HEADERS = {
    "municipio": "Município",
    "cnae_2_0_classe": "CNAE 2.0 Classe",
    "cbo_ocupacao_2002": "CBO Ocupação 2002",
    "vinculo_ativo_31_12": "Vínculo Ativo 31/12",
    "sexo_trabalhador": "Sexo Trabalhador",
    "escolaridade_apos_2005": "Escolaridade após 2005",
    "raca_cor": "Raça Cor",
    "idade": "Idade",
    "tempo_emprego": "Tempo Emprego",
    "mes_desligamento": "Mês Desligamento",
    "motivo_desligamento": "Motivo Desligamento",
    "tamanho_estabelecimento": "Tamanho Estabelecimento",
    "natureza_juridica": "Natureza Jurídica",
    "vl_remun_dezembro_nom": "Vl Remun Dezembro Nom",
    "vl_remun_media_nom": "Vl Remun Média Nom",
    "vl_remun_dezembro_sm": "Vl Remun Dezembro (SM)",
    "vl_remun_media_sm": "Vl Remun Média (SM)",
}
NEW_HEADERS = {
    "municipio": "Município - Código",
    "cnae_2_0_classe": "CNAE 2.0 Classe - Código",
    "cbo_ocupacao_2002": "CBO 2002 Ocupação - Código",
    "vinculo_ativo_31_12": "Ind Vínculo Ativo 31/12 - Código",
    "sexo_trabalhador": "Sexo - Código",
    "escolaridade_apos_2005": "Escolaridade Após 2005 - Código",
    "raca_cor": "Raça Cor - Código",
    "idade": "Idade",
    "mes_desligamento": "Mês Desligamento - Código",
    "motivo_desligamento": "Motivo Desligamento - Código",
    "tamanho_estabelecimento": "Tamanho Estabelecimento - Código",
    "natureza_juridica": "Natureza Jurídica - Código",
    "vl_remun_dezembro_nom": "Vl Rem Dezembro Nom",
    "vl_remun_media_nom": "Vl Rem Média Nom",
    "vl_remun_dezembro_sm": "Vl Rem Dezembro (SM)",
    "vl_remun_media_sm": "Vl Rem Média (SM)",
    "ind_trab_intermitente": "Ind Trab Intermitente",
}
NEW_LAYOUT_DIGIT = "2"
UNKNOWN_REGION = "IGNORADO"


def file_name_of(municipio) -> F.Column:
    digit = F.substring(municipio, 1, 1)
    names = F.create_map(*[F.lit(x) for k, v in sorted(config.REGIONS.items())
                           for x in (k, v.upper())])
    region = F.coalesce(F.try_element_at(names, digit), F.lit(UNKNOWN_REGION))
    ext = F.when(digit == NEW_LAYOUT_DIGIT, F.lit(".COMT")).otherwise(F.lit(".txt"))
    return F.concat(F.lit("VINCULOS_"), region, ext)


def _names(new: bool, parts: int) -> list[str]:
    """Names of the files that a year can have in one of the layouts."""
    regions = [v.upper() for k, v in sorted(config.REGIONS.items()) if (k == NEW_LAYOUT_DIGIT) == new]
    stems = [f"VINCULOS_{r}" for r in regions + ([] if new else [UNKNOWN_REGION])]
    return [s + (f"_{k}" if parts > 1 else "") + (".COMT" if new else ".txt") for s in stems for k in range(parts)]


#: Years in a row whose files get tasks of their own.
_YEARS = 20


def _file_no(arquivos: list[str]) -> tuple[int, F.Column]:
    """(tasks, task of a row): every file of ``_YEARS`` years has its own, so none waits for another."""
    index = F.create_map(*[F.lit(x) for k, a in enumerate(arquivos) for x in (a, k)])
    year = F.pmod(F.coalesce(F.col("ano"), F.lit(0)), F.lit(_YEARS))
    return _YEARS * len(arquivos), (year * len(arquivos) + F.try_element_at(index, F.col("arquivo"))).cast("int")


def _write_layout(df: DataFrame, staging: str, headers: dict[str, str], sep: str,
                  quote_all: bool, last: F.Column | None, arquivos: list[str]) -> None:
    cols = [F.col(k).alias(v) for k, v in headers.items()]
    tasks, number = _file_no(arquivos)
    rows = df.withColumn("_file", number)
    if last is not None:
        # by a hash of the row, those for which ``last`` is true above the others: cheap to compare
        place = F.shiftrightunsigned(F.xxhash64(*[F.col(k) for k in headers]), 1)
        rows = rows.withColumn("_place", F.when(last, place).otherwise(place + F.lit(-2 ** 63)))
    rows = rows.select("ano", "arquivo", "_file", *cols, *(["_place"] if last is not None else [])) \
        .repartitionById(tasks, "_file").drop("_file")      # one task, hence one file, per output file
    if last is not None:
        rows = rows.sortWithinPartitions("_place", *[F.col(f"`{v}`") for v in headers.values()]).drop("_place")
    with unsorted_writes(df.sparkSession):
        (rows.write.mode("overwrite")
           .partitionBy("ano", "arquivo")
           .option("header", True).option("sep", sep).option("encoding", "ISO-8859-1")
           .option("quoteAll", quote_all).option("escape", '"')
           .csv(staging))


def write_landing(spark: SparkSession, raw: DataFrame, root: str, parts_per_file: int = 1,
                  last: F.Column | None = None) -> str:
    """root/<ano>/VINCULOS_<REGION>.<ext> with stable names. With ``last``, rows have a
    fixed order within a file (by their hash), those for which it is true behind the others.

    With ``parts_per_file`` > 1 every (year, region) file is split by a row hash into
    that many files (``..._<k>.<ext>``) so a region holding a large share of the rows
    is written by several tasks; 1 reproduces the released one-file-per-region shape.
    """
    staged = raw.withColumn("arquivo", file_name_of(F.col("municipio")))
    # both layout writes read the same rows: keep them once instead of recomputing the
    # joins (an evicted or lost block is recomputed from lineage)
    staged = staged.persist(StorageLevel.MEMORY_AND_DISK)
    if parts_per_file > 1:
        part = F.pmod(F.xxhash64(*[F.col(c) for c in raw.columns]), F.lit(parts_per_file))
        staged = staged.withColumn("arquivo", F.regexp_replace(
            "arquivo", r"\.([^.]+)$", F.concat(F.lit("_"), part.cast("string"), F.lit(".$1"))))
    is_new = F.coalesce(F.substring("municipio", 1, 1) == NEW_LAYOUT_DIGIT, F.lit(False))   # no code: old layout
    new = staged.filter(is_new).withColumn("ind_trab_intermitente", F.lit("0"))
    old = staged.filter(~is_new)
    for name, part, headers, sep, quote_all in (
            ("old", old, OLD_HEADERS, ";", False), ("new", new, NEW_HEADERS, ",", True)):
        staging = scratch_path(spark, f"landing-staging-{name}")
        _write_layout(part, staging, headers, sep, quote_all, last, _names(name == "new", parts_per_file))

        def target(path: str) -> str:
            parts = path.rstrip("/").split("/")
            ano = parts[-3].split("=", 1)[1]
            arq = parts[-2].split("=", 1)[1]
            return f"{root}/{ano}/{arq}"

        publish_single_files(spark, staging, "ano=*/arquivo=*/part-*", target)
    staged.unpersist()
    return root


_CACHE: dict = {}


def landing(spark: SparkSession, sf: str) -> str:
    """Landing folder for these tables, written once per Spark application."""
    key = (spark.conf.get("spark.app.id"), sf)
    if key not in _CACHE:
        root = scratch_path(spark, "landing")
        _CACHE[key] = write_landing(spark, inputs.raw(spark, sf), root)
    return _CACHE[key]
