"""URL filters over a sorted digest array.

Rules are strings host + path (``example.net/en/``). Their 64-bit xxhash keys are sorted
into one array, their full strings stored beside it in the same order, and both written to
one file in the shared folder, which Spark hands to every executor once. Tasks memory-map
that file. For each url the host's suffixes at label borders, each with the path's prefixes
of the lengths that occur in rules, are hashed and probed by vectorised binary search; a key
that is found counts only if the stored string equals the probed one, so a collision of
digests never decides. The longest rule that fits wins.

A rule list over ``block_bytes`` is measured first and split by digest into blocks of that
size: one file, and one probe of the urls, for each.
"""
from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from microlake.session import scratch_path

BLOCK_BYTES = 64 << 20
_HEAD = "<4sQQQ"
_MAGIC = b"SDA1"
_VERDICTS = ("allow", "block")


# --- the array ----------------------------------------------------------------------

def build_array(rules: Iterable[tuple[str, str]]) -> bytes:
    """File image: sorted digests, string offsets, verdicts, path lengths that occur, strings.

    ``rules``: (rule, verdict); a rule without a slash has an empty path; the host is
    lower-cased. Equal rules with unlike verdicts: block wins. Rules that share a digest
    stand next to each other.
    """
    best: dict[bytes, int] = {}
    for rule, verdict in rules:
        if rule is None or verdict is None:
            continue
        if verdict not in _VERDICTS:
            raise ValueError(f"verdict {verdict!r} of rule {rule!r} is neither allow nor block")
        host, slash, path = rule.partition("/")
        key = (lower_ascii(host) + slash + path).encode()
        best[key] = max(best.get(key, 0), _VERDICTS.index(verdict))
    keys = sorted(best, key=lambda k: (xxhash.xxh64_intdigest(k), k))
    digests = np.array([xxhash.xxh64_intdigest(k) for k in keys], dtype="<u8")
    ends = np.cumsum([0, *map(len, keys)]).astype("<u8")
    lengths = sorted({len(k.decode().partition("/")[2]) + ("/" in k.decode()) for k in keys})
    return b"".join([struct.pack(_HEAD, _MAGIC, len(keys), len(lengths), sum(map(len, keys))), digests.tobytes(), ends.tobytes(),
                     np.array(lengths, dtype="<u8").tobytes(), bytes(best[k] for k in keys), b"".join(keys)])


class DigestArray:
    """A rule file, memory-mapped."""

    def __init__(self, path: str):
        raw = np.memmap(path, dtype=np.uint8, mode="r")
        magic, n, n_lengths, size = struct.unpack(_HEAD, raw[:struct.calcsize(_HEAD)].tobytes())
        if magic != _MAGIC:
            raise ValueError(f"{path} holds no digest array")
        at = struct.calcsize(_HEAD)

        def part(dtype: str, count: int) -> np.ndarray:
            nonlocal at
            out = raw[at:at + count * np.dtype(dtype).itemsize].view(dtype)
            at += count * np.dtype(dtype).itemsize
            return out

        self.digests, self.ends = part("<u8", n), part("<u8", n + 1)
        self.lengths, self.verdicts, self.strings = part("<u8", n_lengths).tolist(), part("u1", n), part("u1", size)

    def string(self, k: int) -> str:
        return self.strings[int(self.ends[k]):int(self.ends[k + 1])].tobytes().decode()

    def find(self, probes: list[str]) -> np.ndarray:
        """Place of each probed string in the array, or -1."""
        out = np.full(len(probes), -1, np.int64)
        if not len(self.digests) or not probes:
            return out
        keys = np.fromiter((xxhash.xxh64_intdigest(p) for p in probes), np.uint64, len(probes))
        at = np.searchsorted(self.digests, keys)
        hits = np.flatnonzero(self.digests[np.minimum(at, len(self.digests) - 1)] == keys)
        for i in hits.tolist():
            k = int(at[i])
            while k < len(self.digests) and self.digests[k] == keys[i]:
                if self.string(k) == probes[i]:     # the stored string confirms the digest
                    out[i] = k
                    break
                k += 1
        return out

    def best(self, hosts: list[str], paths: list[str]) -> list[tuple[str, str] | None]:
        """(rule, verdict) of the longest fitting rule of each url, or None."""
        best: list[int] = [-1] * len(hosts)
        probes, owners = [], []

        def settle() -> None:
            found = self.find(probes)
            for i in np.flatnonzero(found >= 0).tolist():
                u, k = owners[i], int(found[i])
                if best[u] < 0 or len(self.string(k)) > len(self.string(best[u])):
                    best[u] = k
            probes.clear()
            owners.clear()

        for u, (host, path) in enumerate(zip(hosts, paths)):
            suffix = host
            while suffix:
                for n in self.lengths:
                    if n <= len(path):
                        probes.append(suffix + path[:n])
                        owners.append(u)
                suffix = suffix.partition(".")[2]
            if len(probes) >= 100_000:
                settle()
        settle()
        return [(self.string(k), _VERDICTS[self.verdicts[k]]) if k >= 0 else None for k in best]


def lower_ascii(s: str) -> str:
    return s.encode().lower().decode()


# --- Spark --------------------------------------------------------------------------

def _publish(spark: SparkSession, image: bytes) -> str:
    """Write a rule file to the shared folder, let Spark fetch it to every executor; its name there."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "url-rules") + ".sda")
    stream = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path)
    try:
        for k in range(0, len(image), 1 << 20):
            stream.write(bytearray(image[k:k + (1 << 20)]))
    finally:
        stream.close()
    sc.addFile(path.toString())
    return path.getName()


def _blocks(rules: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    rows = rules.select(F.col("rule").cast("string").alias("rule"), F.col("verdict").cast("string").alias("verdict"))
    total = rows.agg(F.sum(F.octet_length("rule") + 64).alias("n")).first()["n"] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        block = rows if n == 1 else rows.where(F.pmod(F.xxhash64(F.lower("rule")), F.lit(n)) == k)
        yield [(r["rule"], r["verdict"]) for r in block.collect()]


def _probe(file: str, at: tuple[int, int, int]):
    def run(batches):
        array = DigestArray(SparkFiles.get(file))
        for batch in batches:
            hosts, paths, old = (batch.column(k).to_pylist() for k in at)
            new = array.best(hosts, paths)
            rules, verdicts = batch.column(at[2]).to_pylist(), batch.column(at[2] + 1).to_pylist()
            for k, hit in enumerate(new):
                if hit and (old[k] is None or len(hit[0]) > len(old[k])):
                    rules[k], verdicts[k] = hit
            cols = list(batch.columns)
            cols[at[2]], cols[at[2] + 1] = pa.array(rules, pa.string()), pa.array(verdicts, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names)

    return run


def host_of(url: str = "url"):
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: str = "url"):
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge(spark: SparkSession, pages: DataFrame, rules: DataFrame, default: str = "allow",
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per page row.

    ``rules``: (rule, verdict allow or block). A rule fits its own host and every subdomain
    if the path starts with the rule's path; the longest fitting rule decides; without one
    rule is null and the verdict is ``default``. Null urls and urls without ``://`` have
    empty host and path. Repeated rows and null page_ids stay; empty tables of pages or
    rules work; other columns are not read.
    """
    out = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")) \
        .select("page_id", host_of().alias("host"), path_of().alias("path"),
                F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    for block in _blocks(rules, block_bytes):
        out = out.mapInArrow(_probe(_publish(spark, build_array(block)), (1, 2, 3)),
                             "page_id long, host string, path string, rule string, verdict string")
    return out.withColumn("verdict", F.coalesce("verdict", F.lit(default)))
