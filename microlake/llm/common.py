"""Small helpers shared by the training-data operators."""
from __future__ import annotations

import sys
import types

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from microlake.session import scratch_path

#: Words of the contracts: runs of anything but blank, \\t, \\n, \\v, \\f, \\r.
WORD_BREAK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; Spark's reader opens any store the session knows."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(spark: SparkSession, df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors: the committed files hold one
    successful attempt of every task, so values made per task (ranks, partition numbers)
    stay fixed for all later reads.
    """
    path = scratch_path(spark, f"llm-{name}")
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused_name(df: DataFrame, stem: str) -> str:
    """A column name that no column of ``df`` has, compared as Spark does (case-insensitive)."""
    taken = {c.lower() for c in df.columns}
    name, k = stem, 0
    while name.lower() in taken:
        k += 1
        name = f"{stem}_{k}"
    return name


def text_or_empty(col: str = "text"):
    """The text, null read as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def unsigned_hex(col):
    """16 lowercase hex digits of a signed 64-bit column."""
    return F.lpad(F.lower(F.hex(col)), 16, "0")


def per_worker(slot: str, key, make):
    """What ``make()`` returns, kept by this Python process for its later tasks under ``slot``.

    Spark reuses worker processes, but a function sent to them by value brings fresh module
    globals each time; what shall outlive a task is kept in an entry of ``sys.modules``. A
    slot holds one thing at a time: another ``key`` replaces it, so memory stays bounded.
    """
    kept = sys.modules.setdefault("_kept_by_worker", types.ModuleType("_kept_by_worker")).__dict__
    held = kept.get(slot)
    if held is None or held[0] != key:
        kept.pop(slot, None)                # the old thing goes before the new one is made
        held = kept[slot] = (key, make())
    return held[1]
