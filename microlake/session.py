"""Session builder and shared-folder helpers."""
from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions_for(shuffle_bytes: int, cores: int,
                           target_bytes: int = TARGET_PARTITION_BYTES) -> int:
    """Shuffle width so each partition holds about ``target_bytes`` (fits executor
    memory without spilling), rounded up to a multiple of the cores so the last wave
    is full: 6 GB on 4 cores -> 48; never fewer than two waves, so one slow task does
    not idle the other cores. AQE then coalesces partitions that turn out small."""
    n = max(1, -(-shuffle_bytes // target_bytes))
    return max(2 * cores, -(-n // cores) * cores)


def build_session(
    app_name: str = "microlake",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with AQE, ANSI left on and a fixed UTC clock.

    On a cluster ``master`` stays None (spark-submit decides) and shuffle partitions
    are sized from the data: total shuffle bytes / ~128 MB, rounded to a multiple of
    the cores; AQE then coalesces what is too small and splits skewed joins.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.files.maxPartitionBytes": "128m",
        # unhinted broadcasts stay tiny: a fact table's join partner shuffles, as it does at
        # scale, which also spreads a scan that a single row group keeps in one task
        "spark.sql.autoBroadcastJoinThreshold": "256k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names it (a path every executor and the driver can reach) and gets an error
    if it does not. Only a local master with it unset — tests — has a private folder made.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="microlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/microlake/{name}-{uuid.uuid4().hex}"
