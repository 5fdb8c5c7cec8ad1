"""Best-fit packing by exact-complement hashing.

Pieces of at most ``capacity`` tokens are put into as few sequences as possible. The plan
needs only how many pieces each length has, a table of at most ``capacity`` rows whatever
the corpus: lengths are taken from the longest down, and the gap a piece leaves is looked
up among the single, pair and triple sums of the lengths still available. A combination
that fills the gap exactly is consumed as often as the counts allow. What no combination
fills goes best-fit, longest first, into the open sequence with the least room. The plan is
a list of runs (length, first rank, count, first sequence, offset), and Spark hands each
piece its place from its rank among the pieces of its length.
"""
from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored
from .tokens import token_path, worker_encoder

CAPACITY = 2048
TOKENIZER, KIND, END_ID = "byte_bpe_50k.json", "byte_level", 0


# --- the plan: a table over lengths ------------------------------------------------

def _complement(gap: int, left: np.ndarray) -> tuple[int, ...] | None:
    """One, two or three available lengths whose sum is ``gap``, longest first; else None.

    ``left[n]``: pieces of length n still available.
    """
    if gap < 1:
        return None
    if left[gap] > 0:
        return (gap,)
    have = left > 0
    pair = _pair(gap, left, have)
    if pair:
        return pair
    for a in np.flatnonzero(have[1:gap - 1])[::-1] + 1:
        a = int(a)
        if 3 * a < gap:
            break                       # a is the longest of the three
        left[a] -= 1
        have[a] = left[a] > 0
        pair = _pair(gap - a, left, have, a)
        left[a] += 1
        have[a] = True
        if pair:
            return (a, *pair)
    return None


def _pair(gap: int, left: np.ndarray, have: np.ndarray, most: int | None = None) -> tuple[int, int] | None:
    """Two available lengths (none over ``most``) whose sum is ``gap``, longest first; else None."""
    if gap < 2:
        return None
    fits = np.flatnonzero(have[1:gap] & have[gap - 1:0:-1]) + 1      # n and gap - n both available
    fits = fits[2 * fits >= gap]
    if most is not None:
        fits = fits[fits <= most]
    for a in fits[::-1]:
        if 2 * a != gap or left[a] > 1:
            return int(a), int(gap - a)
    return None


def packing_plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Runs (length, first rank, count, first sequence, offset) and the number of sequences.

    Every piece of every length is in exactly one run; an empty table gives no runs.
    """
    if any(not 1 <= n <= capacity for n in counts):
        raise ValueError(f"lengths must lie in 1..{capacity}")
    left = np.zeros(capacity + 1, dtype=np.int64)
    for n, c in counts.items():
        left[n] = c
    used = np.zeros(capacity + 1, dtype=np.int64)
    runs: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def place(length: int, count: int, sequence: int, offset: int) -> None:
        runs.append((length, int(used[length]), count, sequence, offset))
        used[length] += count
        left[length] -= count

    residual: list[tuple[int, int]] = []
    for n in range(capacity, 0, -1):
        while left[n] > 0:
            left[n] -= 1
            rest = _complement(capacity - n, left) if n < capacity else ()
            left[n] += 1
            if rest is None:
                break
            parts = (n, *rest)
            times = min(int(left[p]) // parts.count(p) for p in set(parts))
            offset = 0
            for p in parts:
                place(p, times, sequences, offset)
                offset += p
            sequences += times
        if left[n] > 0:
            residual.append((n, int(left[n])))      # may still serve as a part of a later combination

    # best fit, longest first: open runs of sequences by the room they have left
    rooms: list[int] = []
    open_runs: dict[int, list[tuple[int, int]]] = {}

    def put_back(room: int, sequence: int, count: int) -> None:
        if room > 0 and count > 0:
            if room not in open_runs:
                insort(rooms, room)
                open_runs[room] = []
            open_runs[room].append((sequence, count))

    for n, _ in residual:
        while left[n] > 0:
            k = bisect_left(rooms, n)
            if k == len(rooms):
                each = capacity // n                # full sequences of this length alone
                times, odd = divmod(int(left[n]), each)
                if times:
                    for j in range(each):
                        place(n, times, sequences, j * n)
                    put_back(capacity - each * n, sequences, times)
                    sequences += times
                if odd:
                    for j in range(odd):
                        place(n, 1, sequences, j * n)
                    put_back(capacity - odd * n, sequences, 1)
                    sequences += 1
                continue
            room = rooms[k]
            sequence, count = open_runs[room].pop()
            if not open_runs[room]:
                del open_runs[room], rooms[k]
            times = min(count, int(left[n]))
            place(n, times, sequence, capacity - room)
            put_back(room - n, sequence, times)
            put_back(room, sequence + times, count - times)
    return runs, sequences


# --- pieces -------------------------------------------------------------------------

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("part", T.IntegerType()),
    T.StructField("rank", T.LongType()),
])


def _cut(path: str, kind: str, end_id: int, capacity: int):
    """Encode and cut; ``rank`` counts the pieces of a length within the task ``part``."""
    arrow = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                       ("length", pa.int64()), ("ids_crc32", pa.int64()), ("part", pa.int32()), ("rank", pa.int64())])

    def run(batches):
        encoder = worker_encoder(path, kind)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64).tolist()
        for batch in batches:
            rows, names = [], batch.column(0).to_pylist()
            for first, ids, ends in encoder.blocks(batch.column(1), end_id):
                octets, a = memoryview(ids.tobytes()), 0
                for k, b in enumerate(ends.tolist()):
                    n, begin, piece = b - a, 0, 0
                    size = n % capacity or capacity
                    while begin < n:
                        at = a + begin
                        rows.append((names[first + k], piece, begin, size, zlib.crc32(octets[4 * at:4 * (at + size)]), part, seen[size]))
                        seen[size] += 1
                        begin, piece, size = begin + size, piece + 1, capacity
                    a = b
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)] if rows
                                             else [pa.array([], f.type) for f in arrow], schema=arrow)

    return run


def pack(spark: SparkSession, docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None,
         kind: str = KIND, end_id: int = END_ID) -> DataFrame:
    """Pack the encoded documents (``doc_id``, ``text``) into sequences of at most ``capacity`` ids.

    A document is its ids and ``end_id``; only longer ones are cut, the first piece taking
    the remainder. Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset, one
    row per piece. Null and empty texts are the end id alone; strings of special tokens in a
    text are ordinary text; repeated rows and null doc_ids
    are packed as any other; an empty table gives no rows; other columns are not read.
    """
    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_cut(tokenizer or token_path(TOKENIZER), kind, end_id, capacity), PIECES)
    pieces = stored(spark, cut, "pieces")
    per_part = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    runs, _ = packing_plan(counts, capacity)
    plan = spark.createDataFrame(runs, "run_length long, run_rank long, run_count long, run_sequence long, offset long")
    before = per_part.select(
        "length", "part",
        (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    ranked = pieces.join(before, ["length", "part"]).withColumn("rank", F.col("rank") + F.col("before"))
    # the plan has few rows per length, at most capacity lengths: a proven bound for the broadcast
    placed = ranked.join(F.broadcast(plan), (F.col("length") == F.col("run_length")) & (F.col("rank") >= F.col("run_rank"))
                         & (F.col("rank") < F.col("run_rank") + F.col("run_count")))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32",
                         (F.col("run_sequence") + F.col("rank") - F.col("run_rank")).alias("sequence_id"), "offset")
