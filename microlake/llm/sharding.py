"""Sharding by longest-processing-time scheduling, in two levels of bounded size.

Documents with equal text form a group that stays together. Groups of at least one
``shards * fineness``-th of all bytes - there are at most ``shards * fineness`` - are
scheduled one by one; all smaller groups are first gathered by their digest into
``shards * fineness`` bundles, which count as groups of their own. Heavy groups and bundles,
sorted by size, go to the least-loaded shard through a heap. What the driver sorts is
bounded by ``2 * shards * fineness`` entries for any corpus, and shards differ by about one
bundle at most, or by the size of a single group too large to balance.
"""
from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, text_or_empty

SHARDS, FINENESS = 24, 256


def least_loaded(sizes: list[tuple[int, str]], shards: int) -> dict[str, int]:
    """Shard of every (size, name), largest first, ties by name; equal loads go to the lower shard."""
    heap = [(0, k) for k in range(shards)]
    out = {}
    for size, name in sorted(sizes, key=lambda x: (-x[0], x[1])):
        load, k = heapq.heappop(heap)
        out[name] = k
        heapq.heappush(heap, (load + size, k))
    return out


def shard(spark: SparkSession, docs: DataFrame, shards: int = SHARDS, fineness: int = FINENESS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per document row.

    Law ``bytes``: shards near equal in size. Size is the text's UTF-8 bytes plus 8. Null
    and empty texts are one group; repeated rows stay; null doc_ids are placed like any;
    an empty table gives no rows; other columns are not read. Slots run gapless from 0 in
    each shard; which row of a shard has which slot depends on the places of the rows in the
    stored files, so that rows repeated without end do not meet in one task.
    """
    text = text_or_empty()
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("text_key"),
                       F.monotonically_increasing_id().alias("place"))
    slim = stored(spark, slim, "shard-rows")
    groups = slim.groupBy("text_key").agg(F.sum("size").alias("bytes"))
    bundles = shards * fineness
    total = slim.agg(F.sum("size").alias("n")).first()["n"] or 0
    heavy_from = max(1, -(-total // bundles))
    name = F.when(F.col("bytes") >= heavy_from, F.hex("text_key")) \
        .otherwise(F.concat(F.lit("b"), F.pmod(F.xxhash64("text_key"), F.lit(bundles))))
    sizes = groups.select(name.alias("name"), "bytes").groupBy("name").agg(F.sum("bytes").alias("bytes")).collect()
    plan = least_loaded([(r["bytes"], r["name"]) for r in sizes], shards)
    heavy = [(bytes.fromhex(k), v) for k, v in plan.items() if k[0] != "b"]
    light = [(int(k[1:]), v) for k, v in plan.items() if k[0] == "b"]
    heavy_map = spark.createDataFrame(heavy, "heavy_key binary, heavy_shard int")        # both hold at most
    light_map = spark.createDataFrame(light, "bundle long, light_shard int")             # shards * fineness rows
    placed = slim.withColumn("in_bundle", F.pmod(F.xxhash64("text_key"), F.lit(bundles))) \
        .join(F.broadcast(heavy_map), F.col("text_key") == F.col("heavy_key"), "left") \
        .join(F.broadcast(light_map), F.col("in_bundle") == F.col("bundle"), "left") \
        .select("doc_id", "size", "text_crc32", "place", F.coalesce("heavy_shard", "light_shard").alias("shard"))
    return _with_slots(spark, placed).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def _with_slots(spark: SparkSession, placed: DataFrame, slice_rows: int = 50_000) -> DataFrame:
    """Gapless slots without one task per shard: rows are numbered within slices of a shard,
    and the slices start where those before them end. A row's slice comes from its stored place,
    never from its values: repeated rows spread like any others."""
    rows = placed.count()
    slices = max(1, -(-rows // slice_rows))           # rows of a slice of one shard stay few at any size
    cut = placed.withColumn("slice", F.pmod(F.xxhash64("place"), F.lit(slices)))
    sizes = cut.groupBy("shard", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("shard", "slice", (F.sum("n").over(Window.partitionBy("shard").orderBy("slice")) - F.col("n")).alias("before"))
    numbered = cut.withColumn("rank", F.row_number().over(
        Window.partitionBy("shard", "slice").orderBy("doc_id", "place")))
    return numbered.join(before, ["shard", "slice"]).withColumn("slot", (F.col("before") + F.col("rank") - 1).cast("long"))
