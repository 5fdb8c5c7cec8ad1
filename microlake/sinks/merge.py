"""MERGE into a stored table: matched / not matched / delete clauses, one source row per key.

The table is partitioned by year and a key names one row of the whole table, so a correction
may have to find its row in another year than its own. A key index tells which years can hold
a key without reading their keys: per year, a bitmap over hashed key numbers, cut into buckets
of 32,768 bits. A set bit says that the year may hold such a key (different keys can share a
bit), a clear one that it does not. The keys of the years that remain are then read and
matched exactly. An index row carries a digest of its year's file listing; a year whose files
have changed since counts as one that may hold every key.
"""
from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from microlake.sinks import files, tables
from microlake.sinks.tables import PARTITION

#: Buckets of 32,768 bits; some sixteen bits a key keep one key in sixteen from a false hit.
BUCKETS = 64
_BITS = 32_768


@dataclass
class Merged:
    """What a merge did; ``read`` are the years whose keys were read, ``years`` those rewritten."""
    years: list[int]
    read: list[int]
    updated: int
    inserted: int
    deleted: int


def _key_number(keys: list[str], buckets: int) -> Column:
    return F.pmod(tables.row_hash(keys), F.lit(buckets * _BITS)).cast("long")


def _listing(spark: SparkSession, path: str, year, col: str) -> str:
    names = files.list_data_files(spark, f"{path.rstrip('/')}/{col}={year}/*")
    return hashlib.md5(repr([(n, s) for _, n, s in names]).encode()).hexdigest()


def _stored_years(spark: SparkSession, path: str, col: str) -> list[int]:
    return sorted(int(f.rsplit("=", 1)[1]) for f in files.list_folders(spark, f"{path.rstrip('/')}/{col}=*") if not f.endswith("__"))


def write_index(spark: SparkSession, path: str, index: str, keys: list[str], years: list[int] | None = None,
                buckets: int = BUCKETS, col: str = PARTITION) -> None:
    """(Re)build the key index of ``years`` (all by default): one scan of their key columns,
    bitmaps built by partial aggregation, a row per year and used bucket."""
    there = _stored_years(spark, path, col)
    years = there if years is None else years
    for year in set(years) - set(there):
        files.delete(spark, f"{index.rstrip('/')}/{col}={year}")
    todo = [y for y in years if y in there]
    if not todo:
        return
    number = _key_number(keys, buckets)
    seen = spark.createDataFrame([(y, _listing(spark, path, y, col), buckets) for y in todo], f"{col} int, listagem string, baldes int")
    bits = tables.read_table(spark, path).filter(F.col(col).isin(todo)).select(F.col(col), number.alias("n")) \
        .groupBy(col, F.bitmap_bucket_number("n").alias("balde")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("mapa"))
    bits.join(seen, col).select("balde", "mapa", "listagem", "baldes", col).repartition(col) \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(col).parquet(index)


def years_that_may_hold(spark: SparkSession, path: str, index: str | None, keys: list[str], wanted: DataFrame,
                        col: str = PARTITION) -> list[int]:
    """Stored years that can hold a key of ``wanted``: by the index where it is up to date, else all."""
    there = _stored_years(spark, path, col)
    if not index or not files.exists(spark, index):
        return there
    rows = spark.read.parquet(index)
    heads = {r[0]: (r["listagem"], r["baldes"]) for r in rows.select(col, "listagem", "baldes").distinct().collect()}     # a row per year
    fresh = {y: heads[y][1] for y in there if y in heads and heads[y][0] == _listing(spark, path, y, col)}
    hit: set[int] = set(there) - set(fresh)
    for buckets in sorted(set(fresh.values())):
        mine = [y for y, b in fresh.items() if b == buckets]
        numbers = wanted.select(_key_number(keys, buckets).alias("n")).distinct() \
            .select(F.bitmap_bucket_number("n").alias("balde"), F.bitmap_bit_position("n").cast("int").alias("bit"))
        octet = F.conv(F.hex(F.expr("substring(mapa, bit div 8 + 1, 1)")), 16, 10).cast("int")
        found = rows.filter(F.col(col).isin(mine)).join(numbers, "balde").withColumn("octet", octet) \
            .where(F.expr("(octet >> (bit % 8)) & 1 = 1"))
        hit |= {r[0] for r in found.select(col).distinct().collect()}
    return sorted(hit)


def merge(spark: SparkSession, path: str, source: DataFrame, keys: list[str], staging: str, update: str | None = "true",
          insert: str | None = "true", delete: str | None = None, index: str | None = None, col: str = PARTITION) -> Merged:
    """Merge ``source`` into the table at ``path`` by key, a NULL key equal to a NULL key.

    Clauses are SQL conditions over ``s`` (the source row) and ``t`` (the stored row), tried
    in this order; None leaves a clause out:

    * matched and ``delete``: the stored row goes;
    * matched and ``update``: the source row takes its place, in the source row's year;
    * not matched and ``insert``: the source row is added (``t`` is all NULL);
    * else nothing changes.

    The source holds the table's columns and may hold more for the conditions. A key that
    occurs twice in it, and a row without a year that would be written, are refused before
    anything is written. Only years that hold a matched key or receive a row are read whole
    and rewritten, each moved into place by ``files.replace_folder``; with ``index`` only the
    years it names have their keys read, and it is brought up to date.
    """
    tables.recover(spark, path)
    problems = tables.source_problems(source, keys, [])
    if problems:
        raise ValueError(f"{path}: source cannot be merged: {'; '.join(problems)}")
    stored = tables.read_table(spark, path)
    columns, extra = stored.columns, [c for c in source.columns if c not in stored.columns]
    problems = tables.write_problems(source.select(*[c for c in columns if c in source.columns]), stored, False, col)
    if problems:
        raise tables.SchemaMismatch(f"{path}: {'; '.join(problems)}")
    read = years_that_may_hold(spark, path, index, keys, source.select(*keys), col)
    s = source.select(F.struct(*columns, *extra).alias("s"), *[F.col(k).alias(f"_s_{k}") for k in keys])

    def against(rows: DataFrame, how: str) -> DataFrame:
        on = [F.col(f"t.{k}").eqNullSafe(F.col(f"_s_{k}")) for k in keys]
        joined = rows.select(F.struct(*rows.columns).alias("t")).join(s, on, how)
        both = F.col("t").isNotNull() & F.col("s").isNotNull()

        def when(clause: str | None) -> Column:
            return F.coalesce(F.expr(clause), F.lit(False)) if clause else F.lit(False)

        what = F.when(both & when(delete), "delete").when(both & when(update), "update") \
            .when(F.col("t").isNull() & when(insert), "insert").otherwise("keep")
        return joined.withColumn("what", what)

    narrow = stored.filter(F.col(col).isin(read)) if set(read) != set(_stored_years(spark, path, col)) else stored
    counts = against(narrow, "right").groupBy("what", F.col(f"t.{col}").alias("old"), F.col(f"s.{col}").alias("new")) \
        .agg(F.count(F.lit(1)).alias("n")).collect()                                     # a row per pair of years
    acts = [r for r in counts if r["what"] != "keep"]
    homeless = sum(r["n"] for r in acts if r["what"] != "delete" and r["new"] is None)
    if homeless:
        raise ValueError(f"{path}: source cannot be merged: {homeless} rows without {col}")
    years = sorted({y for r in acts for y in ([r["old"]] if r["what"] == "delete" else [r["old"], r["new"]]) if y is not None})
    total = {w: sum(r["n"] for r in acts if r["what"] == w) for w in ("update", "insert", "delete")}
    if years:
        merged = against(stored.filter(F.col(col).isin(years)), "full")
        # a source row whose match lies in a year that stays as it is would look unmatched here: such rows only kept their match
        kept_elsewhere = against(narrow, "right").where(F.col("t").isNotNull() & (F.col("what") == "keep") & ~F.col(f"t.{col}").isin(years)) \
            .select(*[F.col(f"_s_{k}").alias(k) for k in keys])
        merged = merged.join(kept_elsewhere.withColumnsRenamed({k: f"_k_{k}" for k in keys}).withColumn("_elsewhere", F.lit(True)),
                             [F.col(f"_s_{k}").eqNullSafe(F.col(f"_k_{k}")) for k in keys], "left") \
            .where(F.col("t").isNotNull() | F.col("_elsewhere").isNull())
        out = merged.where((F.col("what") != "delete") & ((F.col("what") != "keep") | F.col("t").isNotNull())) \
            .select(F.when(F.col("what") == "keep", F.col("t")).otherwise(F.struct(*[F.col(f"s.{c}").alias(c) for c in columns])).alias("r")) \
            .select("r.*")
        tables.replace_years(spark, out, path, years, staging, col)
        if index:
            write_index(spark, path, index, keys, years, _buckets(spark, index), col)
    return Merged(years, read, total["update"], total["insert"], total["delete"])


def _buckets(spark: SparkSession, index: str) -> int:
    if not files.exists(spark, index):
        return BUCKETS
    row = spark.read.parquet(index).agg(F.max("baldes").alias("b")).first()
    return row["b"] or BUCKETS
