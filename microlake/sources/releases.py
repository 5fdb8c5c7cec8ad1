"""Landed files that are released again under the same name.

A state table keeps, per file, its size, time and a hash tree over its blocks. A block is a
split of a fixed number of bytes (the lines that begin in it), so a change in place touches
the blocks it lies in and a longer file only its last and its new ones. Inner nodes hash up
to ``FAN`` nodes below them. A load opens only files whose size or time is not the stored one,
compares their tree with the stored one from the root down, and puts the rows of changed files
in the place of the old ones: the table is partitioned by year and file. Rows are written
before the state, so a load that stops in between is simply done again.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from microlake.session import scratch_path
from microlake.sinks import files
from microlake.sources import text

BLOCK_BYTES = 16 * 1024 * 1024
#: Children of an inner node, and levels above the blocks: files of up to 64**3 blocks have one root.
FAN, LEVELS = 64, 3
FILE = "arquivo"
STATE = ("ano int, arquivo string, tamanho long, modificado long, nivel int, pos long, n long, "
         "soma decimal(38,0), pesada decimal(38,0), hash string, carga long")
REPORT = "ano int, arquivo string, situacao string, linhas long, blocos long, blocos_alterados long"


def _listed(spark: SparkSession, pattern: str) -> list[tuple[str, int | None, str, int, int]]:
    """(path, year folder, name, size, time) of the landed files; a name Spark would pass over is an error."""
    import re
    hidden = files.hidden_files(spark, pattern)
    if hidden:
        raise ValueError(f"file names must not start with '_': {hidden}")
    out = []
    for path, name, size, time in files.list_data_files(spark, pattern, with_time=True):
        year = re.search(r"/(\d{4})/[^/]+$", path)
        out.append((path, int(year[1]) if year else None, name, size, time))
    return out


def tree(spark: SparkSession, listed: list[tuple], block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Hash tree of the listed files, all levels, as written once to the shared folder.

    Splits have exactly ``block_bytes`` whatever the other files are, as a session of its own
    counts the cost of opening a file as one block.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", str(block_bytes))
    own.conf.set("spark.sql.files.openCostInBytes", str(block_bytes))
    paths = [f[0] for f in listed if f[3]]
    known = own.createDataFrame([(f[0], f[1], f[2], f[3], f[4]) for f in listed],
                                "caminho string, ano int, arquivo string, tamanho long, modificado long") \
        .withColumn("caminho", text.listed_path(F.col("caminho")))
    if paths:
        sums = text.line_sums(own, paths)
    else:
        sums = own.createDataFrame([], "caminho string, inicio long, n long, soma decimal(38,0), pesada decimal(38,0)")
    zero = F.lit(0).cast("decimal(38,0)")
    leaves = known.join(sums, "caminho", "left").select(
        "ano", "arquivo", "tamanho", "modificado", F.lit(0).alias("nivel"),
        F.floor(F.coalesce("inicio", F.lit(0)) / F.lit(block_bytes)).cast("long").alias("pos"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.coalesce("soma", zero).alias("soma"), F.coalesce("pesada", zero).alias("pesada"))
    path = scratch_path(spark, "release-tree")
    leaves.withColumn("hash", F.md5(F.concat_ws("|", "n", "soma", "pesada"))).write.parquet(f"{path}/nivel=0")
    stored = spark.read.schema(STATE.replace(", carga long", "")).parquet(f"{path}/nivel=0").withColumn("nivel", F.lit(0))
    out = level = stored
    for k in range(1, LEVELS + 1):
        below = F.array_sort(F.collect_list(F.struct("pos", "hash")))
        level = level.groupBy("ano", "arquivo", "tamanho", "modificado", F.floor(F.col("pos") / FAN).cast("long").alias("pos")).agg(
            F.sum("n").alias("n"), F.sum("soma").cast("decimal(38,0)").alias("soma"), F.lit(None).cast("decimal(38,0)").alias("pesada"),
            F.md5(F.array_join(F.transform(below, lambda b: F.concat_ws(":", b["pos"].cast("string"), b["hash"])), "|")).alias("hash")) \
            .withColumn("nivel", F.lit(k)).select(out.columns)
        out = out.unionByName(level)
    full = scratch_path(spark, "release-tree")
    out.write.parquet(full)
    return spark.read.parquet(full)


def current_state(spark: SparkSession, state: str) -> DataFrame:
    """The stored trees, of each file the one written last."""
    if not files.list_data_files(spark, f"{state.rstrip('/')}/*"):
        return spark.createDataFrame([], STATE)
    rows = spark.read.schema(STATE).parquet(state)
    last = rows.where(F.col("nivel") == LEVELS).groupBy("ano", "arquivo").agg(F.max("carga").alias("carga"))
    same = [rows[c].eqNullSafe(last[c]) for c in ("ano", "arquivo", "carga")]
    return rows.join(last, same, "left_semi")


def changed_blocks(old: DataFrame, new: DataFrame) -> DataFrame:
    """(ano, arquivo, pos, n_old, n_new, pesada_old, soma_old): blocks that differ, are new (n_old
    NULL) or gone (n_new NULL), found from the roots down: nodes are joined only below nodes that differ."""
    differ = None
    for level in range(LEVELS, -1, -1):
        o, n = (t.where(F.col("nivel") == level) for t in (old, new))
        if differ is not None:
            above = differ.select(F.col("ano").alias("_a"), F.col("arquivo").alias("_f"), F.col("pos").alias("_p"))
            o, n = (t.join(above, t["ano"].eqNullSafe(F.col("_a")) & (t["arquivo"] == F.col("_f")) & (F.floor(t["pos"] / FAN) == F.col("_p")),
                           "left_semi") for t in (o, n))
        o = o.select(*[F.col(c).alias(f"{c}_old") for c in ("ano", "arquivo", "pos", "n", "soma", "pesada", "hash")])
        n = n.select(*[F.col(c).alias(f"{c}_new") for c in ("ano", "arquivo", "pos", "n", "hash")])
        both = o.join(n, F.col("ano_old").eqNullSafe(F.col("ano_new")) & (F.col("arquivo_old") == F.col("arquivo_new"))
                      & (F.col("pos_old") == F.col("pos_new")), "full")
        differ = both.where(~F.col("hash_old").eqNullSafe(F.col("hash_new"))).select(
            F.coalesce("ano_old", "ano_new").alias("ano"), F.coalesce("arquivo_old", "arquivo_new").alias("arquivo"),
            F.coalesce("pos_old", "pos_new").alias("pos"), "n_old", "n_new", "soma_old", "pesada_old")
    return differ


def _starts_alike(spark: SparkSession, asked: list[tuple], block_bytes: int) -> set[str]:
    """Paths whose block ``pos`` begins with the lines that the stored block had. ``asked``:
    (path, pos, lines, soma, pesada), one block a file; that block alone is numbered and compared."""
    if not asked:
        return set()
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", str(block_bytes))
    own.conf.set("spark.sql.files.openCostInBytes", str(block_bytes))
    want = own.createDataFrame(asked, "caminho string, pos long, antes long, soma decimal(38,0), pesada decimal(38,0)") \
        .withColumn("caminho", text.listed_path(F.col("caminho")))
    lines = own.read.option("lineSep", "\n").text([a[0] for a in asked]).select(
        text.scanned_path().alias("caminho"),
        F.floor(F.col("_metadata.file_block_start") / F.lit(block_bytes)).cast("long").alias("pos"),
        F.monotonically_increasing_id().alias("_at"), text.line_hash(F.decode(F.col("value").cast("binary"), text.LATIN1)).alias("_h"))
    numbered = lines.join(want, ["caminho", "pos"]).withColumn("_n", F.row_number().over(Window.partitionBy("caminho").orderBy("_at")))
    head = numbered.where(F.col("_n") <= F.col("antes")).groupBy("caminho", "antes", "soma", "pesada").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_h").alias("s"), F.sum(F.col("_h") * F.col("_n").cast("decimal(12,0)")).alias("p"))
    same = head.where((F.col("n") == F.col("antes")) & (F.col("s") == F.col("soma")) & (F.col("p") == F.col("pesada")))
    return {r["caminho"] for r in same.select("caminho").collect()}


def write_files(spark: SparkSession, listed: list[tuple], target: str) -> None:
    """Put the rows of the listed files in the place of those the table has of them. A file that
    has no data line any more leaves an empty place."""
    rows = text.layout_rows(spark, [f[0] for f in listed])
    places = _places(spark, target)
    before = {p: files.list_data_files(spark, _escaped(p)) for f in listed if (p := places.get((f[1], f[2])))}
    if text.groups_of(rows):
        with files.unsorted_writes(spark):
            (text.union_by_name(text.layout_frames(spark, rows, None))
             .withColumn(FILE, F.concat(F.lit("f_"), text.LINEAGE)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("ano", FILE).parquet(target))
    for p, there in before.items():
        if there and files.list_data_files(spark, _escaped(p)) == there:
            files.delete(spark, p)


def _places(spark: SparkSession, target: str) -> dict[tuple[int | None, str], str]:
    """(year, file name) -> folder of the table; folder names are URL-encoded where they must be."""
    from urllib.parse import unquote
    out = {}
    for folder in files.list_folders(spark, f"{target.rstrip('/')}/ano=*/{FILE}=*"):
        year, name = folder.rstrip("/").rsplit("/", 2)[1:]
        year = year.split("=", 1)[1]
        out[int(year) if year.isdigit() else None, unquote(name.split("=", 1)[1])[2:]] = folder
    return out


def _escaped(folder: str) -> str:
    """A pattern for the files of one folder, whatever its name."""
    return "".join("\\" + c if c in "[]{}*?\\" else c for c in folder) + "/*"


def read_files(spark: SparkSession, target: str) -> DataFrame:
    """The rows of all files, united by name."""
    return spark.read.option("mergeSchema", True).parquet(target).drop(FILE)


def load_releases(spark: SparkSession, root: str, target: str, state: str, block_bytes: int = BLOCK_BYTES,
                  only: list[str] | None = None) -> DataFrame:
    """Load what is new or changed under ``root/<year>/`` and tell per file what was found.

    situacao: ``novo``, ``igual`` (nothing read, or touched without a change), ``crescido``
    (the stored lines stand unchanged before new ones), ``reescrito``, or ``sumido`` (in the
    state but not landed any more; its rows stay). ``only``: paths to look at (others are left
    out of the report). A name that Spark would pass over is an error. ``blocos`` and
    ``blocos_alterados`` count all blocks and those that differ from the stored ones.
    """
    listed = _listed(spark, root.rstrip("/") + "/*/*")
    if only is not None:
        wanted = {p.replace("file:///", "file:/") for p in only}
        listed = [f for f in listed if f[0].replace("file:///", "file:/") in wanted]
    stored = current_state(spark, state)
    known = {(r["ano"], r["arquivo"]): r for r in stored.where(F.col("nivel") == LEVELS)
             .select("ano", "arquivo", "tamanho", "modificado", "n").collect()}                    # a short row per file
    opened = [f for f in listed if (k := known.get((f[1], f[2]))) is None or (k["tamanho"], k["modificado"]) != (f[3], f[4])]
    report = [(f[1], f[2], "igual", known[f[1], f[2]]["n"], None, 0) for f in listed if f not in opened]
    if only is None:
        here = {(f[1], f[2]) for f in listed}
        report += [(y, n, "sumido", r["n"], None, 0) for (y, n), r in known.items() if (y, n) not in here]
    if opened:
        new = tree(spark, opened, block_bytes)
        names = spark.createDataFrame([(f[1], f[2]) for f in opened], "_a int, _f string")
        old = stored.join(names, stored["ano"].eqNullSafe(F.col("_a")) & (stored["arquivo"] == F.col("_f")), "left_semi")
        path = scratch_path(spark, "release-changes")
        changed_blocks(old, new).write.parquet(path)
        blocks = spark.read.parquet(path)
        last_old = F.max(F.when(F.col("n_old").isNotNull(), F.struct("pos", "n_old", "soma_old", "pesada_old")))
        told = {(r["ano"], r["arquivo"]): r for r in blocks.groupBy("ano", "arquivo").agg(
            F.count(F.lit(1)).alias("changed"), F.count("n_old").alias("olds"), last_old.alias("last")).collect()}      # a row per file
        ends = {(r["ano"], r["arquivo"]): r["pos"] for r in old.where(F.col("nivel") == 0).groupBy("ano", "arquivo")
                .agg(F.max("pos").alias("pos")).collect()}
        counts = {(r["ano"], r["arquivo"]): r for r in new.where(F.col("nivel") == 0).groupBy("ano", "arquivo")
                  .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("blocks")).collect()}
        maybe = []
        for f in opened:
            t, k = told.get((f[1], f[2])), known.get((f[1], f[2]))
            # longer, and of the stored blocks only the last one differs: it may merely go on
            if k and t and f[3] > k["tamanho"] and t["olds"] == 1 and t["last"]["pos"] == ends[f[1], f[2]]:
                maybe.append((f[0], t["last"]["pos"], t["last"]["n_old"], t["last"]["soma_old"], t["last"]["pesada_old"]))
        grown = _starts_alike(spark, maybe, block_bytes)
        load = []
        for f in opened:
            t, k, c = told.get((f[1], f[2])), known.get((f[1], f[2])), counts[f[1], f[2]]
            if k is None:
                what = "novo"
            elif t is None and f[3] == k["tamanho"]:
                what = "igual"
            elif f[0].replace("file:///", "file:/") in grown or (t and f[3] > k["tamanho"] and t["olds"] == 0):
                what = "crescido"
            else:
                what = "reescrito"
            if what != "igual":
                load.append(f)
            report.append((f[1], f[2], what, c["n"], c["blocks"], t["changed"] if t and k else 0))
        if load:
            write_files(spark, load, target)
        last = stored.agg(F.max("carga").alias("c")).first()["c"]
        new.withColumn("carga", F.lit(0 if last is None else last + 1).cast("long")).coalesce(1).write.mode("append").parquet(state)
    return spark.createDataFrame(sorted(report, key=str), REPORT)
