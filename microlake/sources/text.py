"""Delimited latin-1 text -> all-string bronze, with layouts that drift between files.

Reading plan for a year folder:
1. files are listed and the first line of every file is read (one job over all files,
   a few KB of each — never a pass over all the data);
2. files are grouped by (separator, normalised header) — files with the same
   separator but another column order must not be read together, or CSV would
   match columns by position;
3. one CSV scan per layout group (all files of a group in one scan, split by Spark);
4. lineage (``_metadata.file_name``), name normalisation, canonical renames, year;
5. ``unionByName(allowMissingColumns=True)``: a column missing in a layout is NULL.
Only file names and header strings reach the driver, never rows.
"""
from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from microlake import config
from microlake.functions.names import canonicalize, normalize_name_expr, normalized_names

LATIN1 = "ISO-8859-1"
LINEAGE = "arquivo_origem"
_NO_SEP = "\u0001"


def listed_path(col) -> "F.Column":
    """A file path as the listing gives it, with one slash behind ``file:``."""
    return F.regexp_replace(col, "^file:/+", "file:/")


def _decoded(col) -> "F.Column":
    return F.url_decode(F.replace(col, F.lit("+"), F.lit("%2B")))


def scanned_path() -> "F.Column":
    """The path of a scanned file in the listing's form: ``_metadata`` is URL-encoded."""
    return listed_path(_decoded(F.col("_metadata.file_path")))


def scanned_name() -> "F.Column":
    """The name of a scanned file as the listing gives it."""
    return _decoded(F.col("_metadata.file_name"))


def read_delimited(spark: SparkSession, paths: str | list[str], sep: str = ";") -> DataFrame:
    """Header, chosen separator, latin-1, every column a string; quoted fields with
    doubled quotes inside are accepted (``escape='"'``)."""
    return (spark.read
            .option("header", True)
            .option("sep", sep)
            .option("encoding", LATIN1)
            .option("inferSchema", False)
            .option("quote", '"')
            .option("escape", '"')
            .option("mode", "PERMISSIVE")
            .csv(paths))


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Raw lines of latin-1 text (``spark.read.text`` ignores the charset): the CSV
    reader with a separator and quote that never occur returns each line whole."""
    return (spark.read
            .schema("line string")
            .option("header", False)
            .option("sep", _NO_SEP)
            .option("quote", "")
            .option("encoding", LATIN1)
            .csv(paths)
            .select("line", F.col("_metadata.file_path").alias("caminho"),
                    scanned_name().alias("arquivo"),
                    F.col("_metadata.file_block_start").alias("_block")))


HEADER_THREADS = 16
_HEADERS = "caminho string, arquivo string, header string"
_HEADER_CACHE = _HEADERS + ", tamanho long, modificado long"


def first_line(spark: SparkSession, path: str) -> str:
    """First line of one file, read the way the CSV source reads a header: a job that
    stops after the first line of the first split (a few KB, whatever the file size)."""
    cols = (spark.read.option("header", True).option("sep", _NO_SEP).option("quote", "")
            .option("encoding", LATIN1).option("inferSchema", False).csv(path).columns)
    return cols[0] if cols else ""


def first_lines(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """First line of every path: one job whose tasks read a few KB of each file. Files that only
    Spark can open (viewfs, some compressions) get a tiny job each, several at a time."""
    from concurrent.futures import ThreadPoolExecutor

    from microlake.sources import first_lines as source
    stores: dict = {}
    for p in paths:                       # one try per store and file ending stands for all its files
        stores.setdefault((re.match(r"([^/]*:(//[^/]*)?)?", p).group(), p.rsplit("/", 1)[-1].rpartition(".")[2]), []).append(p)
    direct = [p for group in stores.values() if source.opens_directly(group[0]) for p in group]
    out = {} if not direct else {r["caminho"]: r["header"] for r in source.read_first_lines(spark, direct, LATIN1).collect()}
    rest = [p for p in paths if p not in out]
    with ThreadPoolExecutor(max_workers=min(HEADER_THREADS, max(1, len(rest)))) as pool:
        out.update(zip(rest, pool.map(lambda p: first_line(spark, p), rest)))
    return out


def headers(spark: SparkSession, paths: str | list[str], cache: str | None = None) -> DataFrame:
    """First line of each file: (caminho, arquivo, header), '' for a file without a byte.

    Files are listed first (metadata), so every landed file has a row; then all first
    lines are read by one job (``first_lines``): the cost is per file, not per byte, at
    any input size. ``cache``: a table that keeps headers by path, size and modification
    time; only files it does not know are opened, and they are added.
    """
    from microlake.sinks import files
    found = files.list_data_files(spark, paths, with_time=True)
    known: dict = {}
    if cache and files.exists(spark, cache):
        known = {(r["caminho"], r["tamanho"], r["modificado"]): r["header"]
                 for r in spark.read.schema(_HEADER_CACHE).parquet(cache).collect()}
    new = [f for f in found if (f[0], f[2], f[3]) not in known]
    lines = first_lines(spark, [f[0] for f in new if f[2]])
    heads = [lines[f[0]] if f[2] else "" for f in new]
    known.update({(f[0], f[2], f[3]): h for f, h in zip(new, heads)})
    if cache and new:
        spark.createDataFrame([(f[0], f[1], h, f[2], f[3]) for f, h in zip(new, heads)], _HEADER_CACHE) \
            .coalesce(1).write.mode("append").parquet(cache)
    return spark.createDataFrame([(f[0], f[1], known[(f[0], f[2], f[3])]) for f in found], _HEADERS)


def split_header(header: str, sep: str) -> list[str]:
    """Column names of a header line; a quoted name may hold the separator."""
    import csv
    return next(csv.reader([header], delimiter=sep), [])


def _count(s, ch: str):
    return F.length(s) - F.length(F.replace(s, F.lit(ch), F.lit("")))


def separator_of(header) -> "F.Column":
    """';' when the header has at least as many ';' as ',' outside quotes, else ','."""
    header = F.regexp_replace(header, '"[^"]*"', "")
    return F.when(_count(header, ";") >= _count(header, ","), F.lit(";")).otherwise(F.lit(","))


def layouts(spark: SparkSession, paths: str | list[str],
            needed: list[str] | None = None, cache: str | None = None) -> DataFrame:
    """Per file: separator, normalised + canonical column names, column count and the
    needed columns the layout lacks; a file without a byte has no column and lacks all."""
    needed = config.NEEDED_COLUMNS if needed is None else needed
    rows = headers(spark, paths, cache).withColumn("sep", separator_of(F.col("header"))).collect()   # a short row per file
    h = spark.createDataFrame([(r["caminho"], r["arquivo"], r["header"], r["sep"], split_header(r["header"], r["sep"]))
                               for r in rows], _HEADERS + ", sep string, campos array<string>")
    renames = F.create_map(*[F.lit(x) for kv in sorted(config.CANONICAL_NAMES.items()) for x in kv])
    norm = F.transform("campos", normalize_name_expr)
    canon = F.transform(norm, lambda c: F.coalesce(F.try_element_at(renames, c), c))
    needed_arr = F.array(*[F.lit(c) for c in needed])
    return (h.withColumn("colunas_normalizadas", norm)
            .withColumn("colunas", canon)
            .withColumn("qtd_colunas", F.size(canon))
            .withColumn("faltando", F.array_sort(F.array_except(needed_arr, canon))).drop("campos"))


def folder_year() -> "F.Column":
    """Year taken from the name of the folder that holds the file (``.../2022/x.txt``)."""
    return F.regexp_extract(F.col("_metadata.file_path"), r"/(\d{4})/[^/]+$", 1).try_cast("int")


def prepare_bronze(df: DataFrame, ano: int | None) -> DataFrame:
    """Normalised and canonical names, lineage, and the year: a constant, or (``None``)
    the year folder of each file. A source column named like the year or the lineage
    gives way to them. One projection, as ``_metadata`` only exists on the scan."""
    lineage = F.col(LINEAGE) if LINEAGE in df.columns else scanned_name()
    year = folder_year() if ano is None else F.lit(ano).cast("int")
    names = normalized_names(df.columns)
    kept = [F.col(f"`{c}`").alias(n) for c, n in zip(df.columns, names) if n not in ("ano", LINEAGE)]
    return canonicalize(df.select(*kept, lineage.alias(LINEAGE), year.alias("ano")))


def file_columns(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(ano, arquivo_origem, colunas): canonical columns of every file, keyed like the
    bronze lineage (year folder + file name)."""
    lay = layouts(spark, paths)
    return lay.select(F.regexp_extract("caminho", r"/(\d{4})/[^/]+$", 1).try_cast("int").alias("ano"),
                      F.col("arquivo").alias(LINEAGE), "colunas")


def layout_rows(spark: SparkSession, paths: str | list[str], cache: str | None = None) -> list:
    """The per-file layout rows, collected once (header metadata: one short row per
    file), to group the reads and to feed per-file column presence."""
    return layouts(spark, paths, cache=cache).select("caminho", "arquivo", "sep", "colunas_normalizadas",
                                                     "colunas").collect()


def groups_of(rows: list) -> dict:
    """(separator, normalised header) -> file paths; files without a byte hold no row to read."""
    groups: dict = {}
    for r in rows:
        if r["colunas_normalizadas"]:
            groups.setdefault((r["sep"], tuple(r["colunas_normalizadas"])), []).append(r["caminho"])
    return groups


def layout_frames(spark: SparkSession, rows: list, ano: int | None) -> list[DataFrame]:
    """Prepared bronze of each layout: one scan per group of files."""
    parts = [prepare_bronze(read_delimited(spark, sorted(files), sep), ano)
             for (sep, _), files in sorted(groups_of(rows).items())]
    if not parts:
        raise FileNotFoundError("no input files")
    return parts


def union_by_name(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_year(spark: SparkSession, folder: str, ano: int, rows: list | None = None) -> DataFrame:
    """Every file of a year folder (any extension), grouped by layout, prepared and united
    by name. Spark passes over names that start with '.' or '_'; a landed '_' name is an
    error, not a silent loss. ``rows``: layout rows already collected for the folder."""
    pattern = folder.rstrip("/") + "/*"
    return union_by_name(layout_frames(spark, rows if rows is not None else landed_rows(spark, pattern), ano))


def landed_rows(spark: SparkSession, pattern: str, cache: str | None = None) -> list:
    """Layout rows of all files that match; raises if there is none, or one that Spark would not read."""
    from microlake.sinks import files
    hidden = files.hidden_files(spark, pattern)
    if hidden:
        raise ValueError(f"file names must not start with '_': {hidden}")
    rows = layout_rows(spark, pattern, cache)
    if not rows:
        raise FileNotFoundError(f"no files match {pattern}")
    return rows


def read_landing(spark: SparkSession, root: str) -> DataFrame:
    """All year folders under ``root`` at once: one scan per layout across years; the
    year of each row comes from its folder."""
    return union_by_name(layout_frames(spark, landed_rows(spark, root.rstrip("/") + "/*/*"), None))


def rows_per_file(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("ano", LINEAGE).agg(F.count(F.lit(1)).alias("qtd_linhas"))


def line_counts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Data lines per file (all lines minus the header), keyed by (year folder, file name).

    Every line counts, blank ones too: line ends are the same bytes in any one-byte charset.
    """
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("caminho"),
                                          scanned_name().alias("arquivo"))
    return (lines.groupBy(F.regexp_extract("caminho", r"/(\d{4})/[^/]+$", 1).try_cast("int").alias("ano"), "arquivo")
            .agg((F.count(F.lit(1)) - 1).alias("linhas_dados")))


def reconcile(expected: DataFrame, loaded: DataFrame, key: str,
              expected_col: str, loaded_col: str) -> DataFrame:
    """Full outer join of two per-file counts. A file missing on one side counts 0 there:
    a difference, unless the other side has no row either (a header alone)."""
    e = expected.withColumnRenamed(expected_col, "esperado")
    lo = loaded.withColumnRenamed(loaded_col, "carregado")
    return (e.join(lo, key, "full")
            .withColumn("esperado", F.coalesce("esperado", F.lit(0)))
            .withColumn("carregado", F.coalesce("carregado", F.lit(0)))
            .withColumn("confere", F.col("esperado") == F.col("carregado")))


def line_hash(line) -> "F.Column":
    """First 60 bits of the md5 of a line, as a number: any SQL engine can compute it."""
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 15), 16, 10).cast("decimal(38,0)")


_AT_BITS = (1 << 33) - 1


def line_sums(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Per split of a file (caminho, inicio): lines ``n``, the sum ``soma`` of their hashes in any
    order, and ``pesada``, the sum of each hash times the line's number within the split.

    Lines are the bytes between line feeds, blank ones too, decoded as latin-1. A task numbers
    its rows, so with ``first`` the number of a split's first row, sum h (at - first + 1) =
    sum h at - (first - 1) sum h: partial sums leave a row per split and task, no line is
    shuffled or sorted.
    """
    at = F.monotonically_increasing_id().bitwiseAND(F.lit(_AT_BITS))
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        scanned_path().alias("caminho"), F.col("_metadata.file_block_start").alias("inicio"), at.alias("_at"),
        line_hash(F.decode(F.col("value").cast("binary"), LATIN1)).alias("_h"))
    sums = lines.groupBy("caminho", "inicio").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_h").alias("soma"), F.min("_at").alias("_first"),
        F.sum(F.col("_h") * F.col("_at").cast("decimal(10,0)")).alias("_by_at"))
    first = (F.col("_first") - 1).cast("decimal(11,0)")
    return sums.select("caminho", "inicio", "n", F.col("soma").cast("decimal(38,0)").alias("soma"),
                       (F.col("_by_at") - first * F.col("soma")).cast("decimal(38,0)").alias("pesada"))


_MODULUS = 2 ** 61 - 1


def fingerprints(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Per file (year folder and name): size, modification time, lines, ``checksum`` of the
    lines in any order, and ``sequencia``, a checksum that lines in another order change.

    Files come from the listing, so one without a byte has a row of zeros; lines from one
    scan split across tasks (``line_sums``). The splits of a file start where those before
    them end: a window over a row per split.
    """
    from microlake.sinks import files
    found = files.list_data_files(spark, paths, with_time=True)
    listed = spark.createDataFrame([(f[0], f[1], f[2], f[3]) for f in found], "caminho string, arquivo string, tamanho long, ms long") \
        .select(listed_path(F.col("caminho")).alias("caminho"), "arquivo", "tamanho", F.timestamp_millis("ms").alias("modificado"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("caminho").orderBy("inicio")
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    modulus = F.lit(_MODULUS).cast("decimal(38,0)")
    placed = line_sums(spark, paths).withColumn("antes", before.cast("decimal(12,0)")).withColumn(
        "pesada", F.pmod(F.pmod(F.col("pesada"), modulus) + F.pmod(F.pmod(F.col("soma"), modulus) * F.col("antes"), modulus), modulus))
    sums = placed.groupBy("caminho").agg(F.sum("n").alias("linhas"), F.sum("soma").cast("decimal(38,0)").alias("checksum"),
                                         F.pmod(F.sum("pesada"), modulus).cast("decimal(38,0)").alias("sequencia"))
    zero = F.lit(0).cast("decimal(38,0)")
    return listed.join(sums, "caminho", "left").select(
        F.regexp_extract("caminho", r"/(\d{4})/[^/]+$", 1).try_cast("int").alias("ano"), "arquivo", "tamanho", "modificado",
        F.coalesce("linhas", F.lit(0)).alias("linhas"), F.coalesce("checksum", zero).alias("checksum"),
        F.coalesce("sequencia", zero).alias("sequencia"))
