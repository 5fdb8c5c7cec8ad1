"""First lines of many files in one job: a Python data source for Spark.

``spark.read.format("first_lines")`` takes the paths, deals them to parallel tasks, and each
task reads the first kilobytes of its files through pyarrow. Paths go out and one short row
per file comes back; a file's size does not matter. A store or a compression that pyarrow
cannot open here is left to Spark's own reader (``opens_directly`` tells).
"""
from __future__ import annotations

import json
import re
import sys

from pyarrow import ArrowException
from pyarrow import fs as arrow_fs
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # executors need pyarrow, not this code

CHUNK = 4096                    # bytes read at a time; most headers fit in one
FILES_PER_TASK = 200
_ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}                     # Hadoop's names of a store -> Arrow's
_UNPACKED = {".gz": "gzip", ".bz2": "bz2"}                      # by the file's ending, as Spark does
_SPARK_ONLY = (".lz4", ".snappy", ".deflate", ".zst", ".xz")    # framed otherwise by Hadoop


def _open(path: str):
    """A stream over a file as the listing names it: ``file:/a b``, ``s3a://bucket/key`` or a plain path."""
    scheme, rest = re.match(r"(?:([A-Za-z][A-Za-z0-9+.-]*):)?(.*)", path, re.S).groups()
    if scheme in (None, "file"):
        store, name = arrow_fs.LocalFileSystem(), "/" + rest.lstrip("/")
    else:
        host, _, key = rest[2:].partition("/")
        store, base = arrow_fs.FileSystem.from_uri(f"{_ARROW_SCHEMES.get(scheme, scheme)}://{host}/")
        name = f"{base.rstrip('/')}/{key}"
    packed = next((codec for end, codec in _UNPACKED.items() if path.endswith(end)), None)
    return store.open_input_stream(name, compression=packed)


def opens_directly(path: str) -> bool:
    """Whether pyarrow opens this file from here; viewfs or a store without its client is Spark's alone."""
    if path.endswith(_SPARK_ONLY):
        return False
    try:
        with _open(path):
            return True
    except (OSError, ArrowException):
        return False


def first_line_of(path: str, encoding: str) -> str:
    """First line with more than spaces, as the CSV reader takes its header; ends at LF, CR or CRLF. '' if none.

    Reads on in small chunks until that line ends, so a file of one endless line is read whole.
    """
    line = b""
    with _open(path) as stream:
        while chunk := stream.read(CHUNK):
            *ended, rest = re.split(rb"[\r\n]", chunk)
            for part in ended:
                if (line + part).strip(b" "):
                    return (line + part).decode(encoding)
                line = b""
            line += rest
    return line.decode(encoding) if line.strip(b" ") else ""


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class FirstLinesReader(DataSourceReader):
    def __init__(self, paths: list[str], tasks: int, encoding: str):
        self.paths, self.tasks, self.encoding = paths, tasks, encoding

    def partitions(self):
        return [Files(self.paths[k::self.tasks]) for k in range(self.tasks)]

    def read(self, partition: Files):
        for path in partition.paths:
            yield path, first_line_of(path, self.encoding)


class FirstLines(DataSource):
    """Options: ``paths`` (JSON list), ``tasks``, ``encoding``."""

    @classmethod
    def name(cls) -> str:
        return "first_lines"

    def schema(self) -> str:
        return "caminho string, header string"

    def reader(self, schema) -> FirstLinesReader:
        return FirstLinesReader(json.loads(self.options["paths"]), int(self.options["tasks"]), self.options["encoding"])


def read_first_lines(spark: SparkSession, paths: list[str], encoding: str):
    """(caminho, header), one row per path."""
    spark.dataSource.register(FirstLines)
    tasks = min(len(paths), max(spark.sparkContext.defaultParallelism, -(-len(paths) // FILES_PER_TASK)))
    return (spark.read.format("first_lines").option("paths", json.dumps(paths))
            .option("tasks", tasks).option("encoding", encoding).load())
