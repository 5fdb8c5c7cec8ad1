"""Incremental bronze load with Structured Streaming.

A stream lists landed files (names only: ``binaryFile`` without its content), so each new name
is handed over exactly once: the file source remembers processed names in its checkpoint,
and ``trigger(availableNow=True)`` drains whatever is new and stops. The files of a batch
are read with the batch reader, by layout - extensions say nothing - and put into the place of
their year and name, which a repeated batch overwrites: no row twice, none lost. What the file
source cannot see - a known name that was released again, a name it passes over - is found by
``sources.releases``: changed files replace their rows, a hidden name is an error. The
checkpoint must live in the shared folder (``spark.checkpoint.dir``), never on a local disk.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from microlake.sinks import files
from microlake.sources import releases

_LISTING = "path string, modificationTime timestamp, length long, content binary"


def listing_stream(spark: SparkSession, glob: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """(path) of landed files, as a stream; no file is opened."""
    r = spark.readStream.format("binaryFile").schema(_LISTING)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(glob).select("path")


def load_landing_incrementally(spark: SparkSession, root: str, target: str, checkpoint: str,
                               max_files_per_trigger: int | None = None) -> str:
    """Load the files under ``root/<year>/`` that are new or have changed into ``target``.

    Any extension or none, and any number of layouts, also within one batch. Each new
    file's header is read once. The state of the loaded files (sizes, times, hash trees) is
    kept beside the checkpoint. Returns ``target``.
    """
    pattern, state = root.rstrip("/") + "/*/*", checkpoint.rstrip("/") + "-releases"
    hidden = files.hidden_files(spark, pattern)
    if hidden:
        raise ValueError(f"file names must not start with '_': {hidden}")

    def batch(listing: DataFrame, number: int) -> None:
        paths = [r["path"] for r in listing.collect()]          # a short row per new file
        if paths:
            releases.load_releases(spark, root, target, state, only=paths)

    stream = listing_stream(spark, pattern, max_files_per_trigger)
    query = (stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    releases.load_releases(spark, root, target, state)          # known names that were released again
    return target


def read_sink(spark: SparkSession, target: str) -> DataFrame:
    """Rows of all files, united by name."""
    return releases.read_files(spark, target)
