"""Partitioned Parquet tables: year replacement with a guard, schema evolution,
compaction, retained snapshots, manifest, CSV export and key upserts.

Without a transactional table format (no Delta jars here) a replace is a dynamic
partition overwrite: only the partitions present in the written data are replaced,
other years are untouched. It is not isolated from concurrent readers; history and
time travel are provided by retained snapshots plus the run manifest. Staged years are
moved into place with an intent record (``files.replace_folder``); every load first
finishes or undoes what a stopped one left (``recover``).
"""
from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from microlake.sinks import files

PARTITION = "ano"


def guard_partition(df: DataFrame, ano: int | list[int], col: str = PARTITION) -> DataFrame:
    """Every row must belong to partition ``ano`` (or one of a list); a foreign or
    NULL year fails the write job itself, before anything is committed."""
    years = ano if isinstance(ano, (list, tuple)) else [ano]
    check = F.assert_true(F.col(col).isin(*years),
                          F.lit(f"row outside partition(s) {col}={years}"))
    return df.withColumn(col, F.coalesce(check.cast("int"), F.col(col).cast("int")))


class SchemaMismatch(ValueError):
    """A write whose columns do not fit the stored table."""


def write_problems(df: DataFrame, stored: DataFrame, merge_schema: bool = False, col: str = PARTITION) -> list[str]:
    """Why ``df`` must not be written into the table ``stored``: a column of another type
    always; a column too many or missing unless the schema may evolve."""
    new = {f.name: f.dataType.simpleString() for f in df.schema.fields if f.name != col}
    old = {f.name: f.dataType.simpleString() for f in stored.schema.fields if f.name != col}
    out = [f"{c}: {old[c]} stored, {new[c]} written" for c in sorted(new.keys() & old.keys()) if new[c] != old[c]]
    if not merge_schema:
        out += [f"{c}: not in the table" for c in sorted(new.keys() - old.keys())]
        out += [f"{c}: missing" for c in sorted(old.keys() - new.keys())]
    return out


def replace_partition(df: DataFrame, path: str, ano: int | list[int], merge_schema: bool = False,
                      col: str = PARTITION) -> None:
    """Replace only ``col = ano`` (first write creates the partitioned table).

    The written columns must be those of the stored table (types too); ``merge_schema``
    lets columns be added or left out, never retyped. A partition for which ``df`` has no
    row ends up empty: dynamic overwrite leaves such a folder alone, so one whose files the
    write did not change is removed afterwards.
    """
    spark = df.sparkSession
    recover(spark, path)
    years = ano if isinstance(ano, (list, tuple)) else [ano]
    folders = {y: f"{path.rstrip('/')}/{col}={y}" for y in years}
    if files.list_data_files(spark, f"{path.rstrip('/')}/{col}=*/*"):
        problems = write_problems(df, read_table(spark, path, merge_schema=True), merge_schema, col)
        if problems:
            raise SchemaMismatch(f"{path}: {'; '.join(problems)}")
    before = {y: files.list_data_files(spark, f"{p}/*") for y, p in folders.items()}
    with files.unsorted_writes(spark):
        (guard_partition(df, ano, col).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(col).parquet(path))
    for y, p in folders.items():
        if before[y] and files.list_data_files(spark, f"{p}/*") == before[y]:
            files.delete(spark, p)


def recover(spark: SparkSession, path: str) -> dict[str, str]:
    """Finish or undo the partition swaps that a stopped load left in the table (one listing)."""
    return files.recover_swaps(spark, path) if files.exists(spark, path) else {}


def write_table(df: DataFrame, path: str, col: str = PARTITION, files_per_partition: int | None = None) -> None:
    """Replace the whole table (schema included), partitioned by ``col``."""
    out = df.coalesce(files_per_partition) if files_per_partition else df
    with files.unsorted_writes(df.sparkSession):
        out.write.mode("overwrite").option("partitionOverwriteMode", "static") \
            .partitionBy(col).parquet(path)


def write_sized(df: DataFrame, path: str, target_bytes: int = 128 * 1024 * 1024, col: str = PARTITION,
                weight: Column | None = None) -> dict:
    """Replace the whole table with files of about ``target_bytes`` each: partition -> files written.

    One aggregate counts the bytes of each partition (``weight`` per row; by default the
    characters of its values as text, in UTF-8). A partition gets as many files as it has
    targets, one at least, and every file is a task of its own: a hot year is salted over
    several, small years take one each. The salt comes from the row and from the input
    partition it lies in, so rows that repeat are spread as far as their input is.
    """
    name = F.coalesce(F.col(col).cast("string"), F.lit("\u0000"))
    if weight is None:
        weight = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns), F.lit(0))
    counted = df.groupBy(F.col(col).alias("part"), name.alias("name")).agg(F.sum(weight.cast("long")).alias("bytes")).collect()     # a row per partition
    if not counted:
        write_table(df, path, col)
        return {}
    counted = sorted(counted, key=lambda r: r["name"])
    files_of = [max(1, round((r["bytes"] or 0) / target_bytes)) for r in counted]
    places = [x for r, first, n in zip(counted, (sum(files_of[:k]) for k in range(len(files_of))), files_of)
              for x in (F.lit(r["name"]), F.struct(F.lit(first).alias("first"), F.lit(n).alias("n")))]
    place = F.element_at(F.create_map(*places), name)
    file_no = place["first"] + F.pmod(F.xxhash64(row_hash(df.columns), F.spark_partition_id()), place["n"])
    (df.withColumn("_file", file_no.cast("int")).repartitionById(sum(files_of), "_file").drop("_file")
     .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(col).parquet(path))
    return {r["part"]: n for r, n in zip(counted, files_of)}


def read_table(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Read a table; with ``merge_schema`` columns added by later partitions appear
    (NULL for older ones) — without it they may be silently missing."""
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def read_partition(spark: SparkSession, path: str, ano: int, merge_schema: bool = False,
                   col: str = PARTITION) -> DataFrame:
    """One partition only: its folder is read with ``basePath`` (so ``ano`` stays a
    column), and a schema merge touches only that year's file footers."""
    return (spark.read.option("basePath", path).option("mergeSchema", merge_schema)
            .parquet(f"{path.rstrip('/')}/{col}={ano}"))


def row_hash(columns: list[str]) -> Column:
    """64-bit hash of a row. A NULL leaves ``xxhash64`` as it was, so the place of every
    NULL is hashed too: a value that moves between columns changes the hash."""
    cols = [F.col(f"`{c}`") for c in sorted(columns)]
    return F.xxhash64(*[x for c in cols for x in (c.isNull(), c)])


def content_hash(df: DataFrame) -> Column:
    """Order-insensitive checksum of all rows (exact decimal sum of 64-bit row hashes)."""
    return F.sum(row_hash(df.columns).cast("decimal(38,0)"))


def partition_stats(df: DataFrame, by: str = PARTITION) -> DataFrame:
    """Per partition: rows, files, bytes and checksum, from one scan of the table.

    Rows are first summed per file (one row a file leaves each task), then per partition.
    """
    per_file = (df.select("*", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_size").alias("_s"))
                .groupBy(by, "_f", "_s")
                .agg(F.count(F.lit(1)).alias("_n"), F.sum(row_hash(df.columns).cast("decimal(38,0)")).alias("_h")))
    return per_file.groupBy(by).agg(
        F.sum("_n").alias("qtd"), F.count(F.lit(1)).alias("arquivos"), F.sum("_s").alias("bytes"),
        F.sum("_h").cast("decimal(38,0)").alias("hash"))


def partition_bytes(spark: SparkSession, path: str, ano: int, col: str = PARTITION) -> int:
    """Bytes of one partition, from the file listing (no data is read)."""
    return sum(size for _, _, size in files.list_data_files(spark, f"{path}/{col}={ano}/*"))


def compact_partition(spark: SparkSession, path: str, ano: int, staging: str,
                      target_bytes: int = 128 * 1024 * 1024, col: str = PARTITION) -> int:
    """Rewrite one partition into ceil(bytes / target) files.

    The partition is written once, to a staging table; row count and checksum of both
    copies must agree; then the staged files are moved into the partition's place and the
    staging folder is removed. Returns the new file count.
    """
    recover(spark, path)
    n = max(1, math.ceil(partition_bytes(spark, path, ano, col) / target_bytes))
    part = read_partition(spark, path, ano, col=col)
    part.repartition(n).write.mode("overwrite").partitionBy(col).parquet(staging)
    staged = spark.read.parquet(staging)
    a = part.agg(F.count(F.lit(1)), content_hash(part)).first()
    b = staged.agg(F.count(F.lit(1)), content_hash(staged)).first()
    if tuple(a) != tuple(b):
        raise AssertionError(f"compaction changed partition {ano}: {a} vs {b}")
    files.replace_folder(spark, f"{staging.rstrip('/')}/{col}={ano}", f"{path.rstrip('/')}/{col}={ano}")
    files.delete(spark, staging)
    return n


def archive_snapshot(df: DataFrame, archive_path: str, snapshot_id: str,
                     col: str = PARTITION) -> None:
    """Append the current rows of a partition to the archive, tagged with a snapshot
    id (partitioned by year and snapshot), before it is replaced. An id that the archive
    holds already for one of the years is refused: its rows would mix with the new ones."""
    spark = df.sparkSession
    used = files.list_folders(spark, f"{archive_path.rstrip('/')}/{col}=*/snapshot_id={snapshot_id}")
    if used:
        years = {str(r[0]) for r in df.select(col).distinct().collect()}            # a row per year
        clash = sorted(y for y in (f.rsplit("/", 2)[1].split("=", 1)[1] for f in used) if y in years)
        if clash:
            raise ValueError(f"snapshot id {snapshot_id!r} is in use for {col} {clash}")
    (df.withColumn("snapshot_id", F.lit(snapshot_id)).write.mode("append")
       .partitionBy(col, "snapshot_id").parquet(archive_path))


def read_snapshot(spark: SparkSession, archive_path: str, snapshot_id: str) -> DataFrame:
    """Time travel by snapshot id (partition pruning on ``snapshot_id``)."""
    return (spark.read.parquet(archive_path).filter(F.col("snapshot_id") == snapshot_id)
            .drop("snapshot_id"))


def snapshots_older_than(snapshots: DataFrame, ts_col: str, cutoff: Column) -> DataFrame:
    """Snapshot ids to drop under a retention rule (an ordinary filter on the list)."""
    return snapshots.filter(F.col(ts_col) < cutoff)


def compare_versions(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join on the key; per column, how many rows changed (null-safe),
    plus rows only before / only after. One row per column."""
    value_cols = [c for c in before.columns if c not in keys and c in after.columns]
    b = before.select(*keys, *[F.col(c).alias(f"b_{c}") for c in value_cols],
                      F.lit(True).alias("_b"))
    a = after.select(*keys, *[F.col(c).alias(f"a_{c}") for c in value_cols],
                     F.lit(True).alias("_a"))
    j = b.join(a, keys, "full")
    both = F.col("_b").isNotNull() & F.col("_a").isNotNull()
    one = j.agg(
        F.count_if(F.col("_a").isNull()).alias("_only_before"),
        F.count_if(F.col("_b").isNull()).alias("_only_after"),
        *[F.count_if(both & ~F.col(f"b_{c}").eqNullSafe(F.col(f"a_{c}"))).alias(f"_c{i}")
          for i, c in enumerate(value_cols)],
        *[F.count_if(F.col(f"b_{c}").isNull() & F.col("_b").isNotNull()).alias(f"_nb{i}")
          for i, c in enumerate(value_cols)],
        *[F.count_if(F.col(f"a_{c}").isNull() & F.col("_a").isNotNull()).alias(f"_na{i}")
          for i, c in enumerate(value_cols)])
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("coluna"), F.col(f"_c{i}").alias("alteradas"),
                 F.col(f"_nb{i}").alias("nulos_antes"), F.col(f"_na{i}").alias("nulos_depois"))
        for i, c in enumerate(value_cols)]))
    return one.select("_only_before", "_only_after", rows.alias("r")).select(
        "r.*", F.col("_only_before").alias("so_antes"), F.col("_only_after").alias("so_depois"))


def source_problems(changes: DataFrame, keys: list[str], needed: list[str]) -> list[str]:
    """Why ``changes`` cannot be merged: keys that occur twice (a NULL is a key value like any
    other), rows without a value in a ``needed`` column. One aggregate; counts reach the driver."""
    per_key = changes.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"_null_{i}")
                                                                         for i, c in enumerate(needed)])
    row = per_key.agg(F.count_if(F.col("_n") > 1).alias("_twice"), *[F.sum(f"_null_{i}").alias(f"_null_{i}") for i in range(len(needed))]).first()
    out = [f"{row['_twice']} keys occur more than once"] if row["_twice"] else []
    return out + [f"{row[f'_null_{i}']} rows without {c}" for i, c in enumerate(needed) if row[f"_null_{i}"]]


def match(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on equal keys, a NULL equal to a NULL; the keys stand once, from the side that has them."""
    names = {k: f"_r_{k}" for k in keys}
    renamed = right.withColumnsRenamed(names)
    on = [F.col(k).eqNullSafe(F.col(r)) for k, r in names.items()]
    joined = left.join(renamed, on, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.select(*[F.coalesce(k, r).alias(k) for k, r in names.items()],
                         *[F.col(c) for c in left.columns if c not in keys], *[F.col(c) for c in right.columns if c not in keys])


def upsert_by_key(base: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """MERGE-like upsert: full outer join on the key (NULLs match), the change wins where
    present. Deletions and conditions: ``sinks.merge``."""
    cols = [c for c in base.columns if c not in keys]
    ch = changes.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in cols],
                        F.lit(True).alias("_new"))
    j = match(base, ch, keys, "full")
    return j.select(*keys, *[F.when(F.col("_new"), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c)
                             for c in cols])


def upsert_partitions(spark: SparkSession, path: str, changes: DataFrame, keys: list[str], staging: str,
                      col: str = PARTITION, keys_move: bool = False) -> list[int]:
    """Upsert ``changes`` into a stored table, reading and writing only the partitions they touch.

    By default a row is known by its key and partition: the same key in another partition is
    another row. With ``keys_move`` the key alone names a row of the whole table, and a change
    may carry it to another partition: those that hold a changed key now are touched too (found
    by a scan of the key columns alone), and the row leaves its old one. The merged partitions
    are written to a staging table and moved into place; one left without a row is removed;
    the others stay as they are. Returns the years.

    Changes that name one key twice or lack the partition are refused before anything is
    written; a NULL key matches the NULL key.
    """
    recover(spark, path)
    problems = source_problems(changes, keys if keys_move else [*keys, col], [col])
    if problems:
        raise ValueError(f"{path}: changes cannot be merged: {'; '.join(problems)}")
    stored, places = read_table(spark, path), changes.select(col)
    if keys_move:
        places = places.union(match(stored.select(*keys, col), changes.select(*keys), keys, "left_semi").select(col))
    years = sorted(r[0] for r in places.distinct().collect())       # a row per touched year
    if not years:
        return []
    touched = stored.filter(F.col(col).isin(years))
    merged = upsert_by_key(touched, changes, keys if keys_move else [*keys, col])
    replace_years(spark, merged, path, years, staging, col)
    return years


def replace_years(spark: SparkSession, rows: DataFrame, path: str, years: list[int], staging: str, col: str = PARTITION) -> None:
    """Write ``rows``, the new content of ``years``, to a staging table and move each year into place."""
    problems = write_problems(rows, read_table(spark, path), False, col)
    if problems:
        raise SchemaMismatch(f"{path}: {'; '.join(problems)}")
    rows.write.partitionBy(col).parquet(staging)
    for y in years:
        files.replace_folder(spark, f"{staging.rstrip('/')}/{col}={y}", f"{path.rstrip('/')}/{col}={y}")
    files.delete(spark, staging)


def export_csv(df: DataFrame, path: str) -> None:
    """One CSV file with header (small marts only)."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_csv_export(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    return files.exists(spark, path)


def storage_bytes(spark: SparkSession, paths) -> int:
    """Bytes on storage of a layer (files under the paths, recursively by glob
    level), from the file listing — no data is read."""
    patterns = [paths] if isinstance(paths, str) else list(paths)
    total = 0
    for p in patterns:
        for _, _, size in files.list_data_files(spark, p):
            total += size
    return total


def restore_snapshot(spark: SparkSession, archive_path: str, snapshot_id: str, path: str,
                     ano: int, col: str = PARTITION) -> None:
    """Put a retained snapshot of one year back in place (guarded partition replace)."""
    rows = read_snapshot(spark, archive_path, snapshot_id).filter(F.col(col) == ano)
    replace_partition(rows, path, ano, col=col)


def has_rows(df: DataFrame) -> bool:
    """Cheap existence test: stops at the first row instead of counting the table."""
    return not df.isEmpty()


def publish_year(spark: SparkSession, silver: DataFrame, bronze: DataFrame, path: str, ano: int,
                 staging: str, col: str = PARTITION, archive: str | None = None,
                 snapshot_id: str | None = None) -> int:
    """Gate before publish, in one pass over silver.

    The year's silver is written to a staging table while an ``Observation`` collects
    the gate metrics in that same job (no second scan); the gate compares them with
    the bronze count, and only a passing year is published: its staged files are moved
    into place, nothing is written twice. With ``archive`` the files of the year as it was
    are moved there in the same swap, as snapshot ``snapshot_id`` (an id used before is refused). A
    failing gate raises and leaves the published table as it was.
    """
    from pyspark.sql import Observation

    from microlake.operators import quality
    recover(spark, path)
    kept = f"{archive.rstrip('/')}/{col}={ano}/snapshot_id={snapshot_id}" if archive and snapshot_id else None
    if kept and files.list_data_files(spark, f"{kept}/*"):
        raise ValueError(f"snapshot id {snapshot_id!r} is in use for {col} {ano}")
    obs = Observation(f"gate_{ano}")
    replace_partition(silver.observe(obs, *quality.silver_metrics(col)), staging, ano, col=col)
    m = obs.get
    metrics = spark.createDataFrame(
        [(ano, m["qtd_silver"], m["nulos_remun"], m["nulos_uf"])],
        f"{col} int, qtd_silver bigint, nulos_remun bigint, nulos_uf bigint")
    bronze_counts = (bronze.filter(F.col(col) == ano).groupBy(col)
                     .agg(F.count(F.lit(1)).alias("qtd_bronze")))
    quality.enforce(quality.gate_rules(metrics, bronze_counts, col))
    folder = f"{path.rstrip('/')}/{col}={ano}"
    if files.list_data_files(spark, f"{path.rstrip('/')}/{col}=*/*"):
        problems = write_problems(spark.read.parquet(staging), read_table(spark, path, merge_schema=True), False, col)
        if problems:
            raise SchemaMismatch(f"{path}: {'; '.join(problems)}")
    files.replace_folder(spark, f"{staging.rstrip('/')}/{col}={ano}", folder, keep=kept)
    files.delete(spark, staging)
    return int(m["qtd_silver"])


def write_gold(spark: SparkSession, silver: DataFrame, root: str, files_per_mart: int = 4,
               years: list[int] | None = None) -> dict[str, str]:
    """Build and write the five marts with two scans of silver instead of five; with
    ``years`` only those years are read (partition filter) and replaced.

    The (ano, cod_uf) facts and the finer (ano, cod_uf, division, schooling) facts are
    written first under ``root/_fatos_*`` (this also cuts the lineage: a lost executor
    recomputes from these tables, not from silver); every mart is then derived from
    them and written with a few files, partitioned by year.
    """
    from microlake.operators import marts
    facts_path, fine_path = f"{root}/_fatos_uf_ano", f"{root}/_fatos_finos"
    def write(df: DataFrame, path: str) -> None:
        if years is None:
            write_table(df, path, files_per_partition=files_per_mart)
        else:
            replace_partition(df.coalesce(files_per_mart), path, years)

    def loaded(path: str) -> DataFrame:
        t = read_table(spark, path)
        return t if years is None else t.filter(F.col(PARTITION).isin(years))

    rows = silver if years is None else silver.filter(F.col(PARTITION).isin(years))
    # clustered by year: a file or two per year instead of one per shuffle task
    write(marts.state_year_facts(rows).repartition(PARTITION), facts_path)
    write(marts.fine_facts(marts.active(rows)).repartition(PARTITION), fine_path)
    built = marts.marts_from_facts(loaded(facts_path), loaded(fine_path), spark)
    out = {name: f"{root}/{name}" for name in built}
    with ThreadPoolExecutor(max_workers=len(built)) as pool:        # five small writes, submitted together
        list(pool.map(lambda name: write(built[name], out[name]), built))
    return out


# --- history and time travel ------------------------------------------------------------

HISTORY = "tabela string, ano int, operacao string, snapshot_id string, ts timestamp_ntz, linhas long, versao long"


def log_writes(spark: SparkSession, history: str, rows: list[tuple]) -> None:
    """Append operations (tabela, ano, operacao, snapshot_id, ts, linhas) to the history table: what
    was written when, and the id under which the archive keeps what the year held before.

    Each gets the next version of its table, counted from 0, in the order given; a version is
    stored and never changes, whatever times are logged later. One writer at a time.
    """
    next_of: dict[str, int] = {}
    if files.exists(spark, history):
        past = spark.read.schema(HISTORY).parquet(history).groupBy("tabela").agg(F.max("versao").alias("v"))
        next_of = {r["tabela"]: r["v"] + 1 for r in past.collect()}                 # a row per table
    numbered = []
    for row in rows:
        v = next_of.get(row[0], 0)
        next_of[row[0]] = v + 1
        numbered.append((*row, v))
    spark.createDataFrame(numbered, HISTORY.replace("timestamp_ntz", "string")).withColumn("ts", F.to_timestamp_ntz("ts")) \
        .coalesce(1).write.mode("append").parquet(history)


def log_write(spark: SparkSession, history: str, tabela: str, ano: int, operacao: str, snapshot_id: str,
              ts: str, linhas: int) -> None:
    """Append one operation to the history table."""
    log_writes(spark, history, [(tabela, ano, operacao, snapshot_id, ts, linhas)])


def table_history(spark: SparkSession, history: str) -> DataFrame:
    """The history, with the version each write got."""
    return spark.read.schema(HISTORY).parquet(history)


def read_as_of(spark: SparkSession, path: str, archive: str, history: str, tabela: str, ts: str,
               col: str = PARTITION) -> DataFrame:
    """The table as it was at ``ts``.

    The archive keeps, under a write's id, what a year held before that write. So a year's
    state at ``ts`` is what the first later write archived, nothing if that write was the
    year's first, and the current rows if no write came later. Only folders are chosen here.
    """
    writes = [r for r in table_history(spark, history).where(F.col("tabela") == tabela).orderBy("versao").collect()]
    moment = spark.sql("SELECT CAST(? AS TIMESTAMP_NTZ)", args=[ts]).first()[0]
    now, then = [], []
    for ano in sorted({r["ano"] for r in writes}):
        later = [r for r in writes if r["ano"] == ano and r["ts"] > moment]
        if not later:
            now.append(f"{path.rstrip('/')}/{col}={ano}")
        else:
            then.append(f"{archive.rstrip('/')}/{col}={ano}/snapshot_id={later[0]['snapshot_id']}")
    parts = [spark.read.option("basePath", base).option("mergeSchema", True).parquet(*found)
             for base, folders in ((path, now), (archive, then))
             if (found := [f for f in folders if files.list_data_files(spark, f + "/*")])]
    if not parts:
        return read_table(spark, path).filter(F.lit(False))
    parts = [p.drop("snapshot_id") for p in parts]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)


def expire_snapshots(spark: SparkSession, archive: str, expired: list[str], col: str = PARTITION) -> int:
    """Remove the folders of snapshots ``expired`` from the archive; returns how many were there."""
    gone = 0
    for folder in files.list_folders(spark, f"{archive.rstrip('/')}/{col}=*/snapshot_id=*"):
        if folder.rsplit("snapshot_id=", 1)[1] in set(expired):
            gone += files.delete(spark, folder)
    return gone
