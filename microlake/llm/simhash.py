"""SimHash near-duplicates with pigeonring filtering.

Fingerprints of 64 bits link where at most ``distance`` bits differ. The bits lie in a ring
of ``distance + 1`` segments. If a pair differs in at most ``distance`` bits, then some
segment starts a chain of consecutive segments around the ring along which the differences
summed over the first l segments never exceed l * distance / (distance + 1), rounded down:
0 in the first, at most 1 in the first two, 2 in the first three, and so on. So

* candidates share the start segment exactly and, as the next two segments together differ
  in at most two bits, all but two of the parts these two are cut into. Three parts give
  three keys of about 22 bits per start segment, 15 rows per distinct fingerprint; more parts
  give longer keys (six: fifteen of about 30 bits), and their number grows with that of the
  distinct fingerprints, so that runs of random ones stay short;
* candidates go on only if their whole chain stays within its budgets; then the full
  Hamming distance decides.

Only distinct fingerprints are linked, so copies cost nothing. Rows of one key meet in a
sorted run. A task emits the links of a run, or for a longer run a spanning forest of them,
never all pairs of a group. Runs over ``heavy_run`` are not held: their rows go to a second
pass with the longest keys. What is heavy even there is alike in some thirty bits; its bits
that vary at all are cut into eight parts, of which any pair within the distance shares all
but ``distance``. Each pass makes a fixed number of keys a row, so rows and forests grow in
proportion. Only a run that is heavy under those keys too is compared block against block.
"""
from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored, unsigned_hex, unused_name
from .components import components

SHINGLE, DISTANCE, SEED = 4, 4, 42
HEAVY_RUN = 4096
MORE_PARTS = 3
_EXPECTED_RUN = 64
_FOREST_RUN = 16
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_BLOCK = 1 << 16


# --- fingerprints -------------------------------------------------------------------

def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of the text's word shingles, repeats included.

    A-Z are lower-cased; words are runs of anything but ASCII white space; fewer words than
    a shingle count as one shingle; no word (null, empty, blank texts) gives zero. A bit is
    set if over half of the shingle hashes (XXH64) have it. Shingles are hashed in blocks,
    so memory beside the text stays bounded.
    """
    words = (text or "").encode("utf-8").translate(_LOWER).split()
    n = len(words)
    if n == 0:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if n <= shingle:
        return digest(joined, seed)
    lens = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lens + 1) - 1
    starts = (ends - lens)[:n - shingle + 1]
    stops = ends[shingle - 1:]
    ones = np.zeros(64)
    for k in range(0, len(starts), _BLOCK):
        h = np.array([digest(joined[a:b], seed) for a, b in zip(starts[k:k + _BLOCK].tolist(), stops[k:k + _BLOCK].tolist())],
                     dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += np.ones(len(h), np.float32) @ bits.astype(np.float32)       # exact: counts stay below 2 ** 24
    over = np.packbits(2 * ones > len(starts), bitorder="little")
    return int.from_bytes(over.tobytes(), "little")


def _fingerprints(shingle: int, seed: int):
    def run(batches):
        for batch in batches:
            marks = np.array([fingerprint(x.as_py(), shingle, seed) for x in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks.view(np.int64), pa.int64())],
                                             names=["doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fp): one row per document row, the fingerprint as a signed 64-bit integer."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_fingerprints(shingle, seed), "doc_id long, fp long")


# --- candidates ---------------------------------------------------------------------

def ring(distance: int) -> list[int]:
    """Bit masks of the ``distance + 1`` segments, as equal as 64 bits allow."""
    m = distance + 1
    cuts = [64 * k // m for k in range(m + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]


def key_masks(distance: int, more: int = 0) -> list[tuple[int, int]]:
    """(start segment, bit mask) of each candidate key; ``more`` parts than the fewest make longer keys."""
    segments = ring(distance)
    m = len(segments)
    if m < 4:                               # chains too short for parts: the start segment alone
        return list(enumerate(segments))
    masks = []
    for start in range(m):
        bits = [b for s in (segments[(start + 1) % m], segments[(start + 2) % m]) for b in range(64) if s >> b & 1]
        budget = 3 * distance // m          # of the first three segments; the first has none
        parts = budget + 1 + more
        cut = [sum(1 << b for b in bits[len(bits) * k // parts:len(bits) * (k + 1) // parts]) for k in range(parts)]
        masks += [(start, segments[start] | sum(cut[k] for k in some)) for some in combinations(range(parts), parts - budget)]
    return masks


def more_parts(distance: int, n: int) -> int:
    """The fewest additional parts with which a run of ``n`` random fingerprints is expected to stay short."""
    for more in range(MORE_PARTS):
        if n >> min(mask.bit_count() for _, mask in key_masks(distance, more)) < _EXPECTED_RUN:
            return more
    return MORE_PARTS


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _chain_links(a: np.ndarray, b: np.ndarray, slots: np.ndarray, orders: np.ndarray, budgets: list[int]) -> np.ndarray:
    """Which pairs keep every budget along the chain from their key's start; the last is the full distance."""
    differ = a ^ b
    alive = np.arange(len(differ))
    total = np.zeros(len(differ), np.int64)
    for l, budget in enumerate(budgets):
        total[alive] += np.bitwise_count(differ[alive] & orders[slots[alive], l])
        alive = alive[total[alive] <= budget]
    return alive


def _link_runs(distance: int, masks: list[tuple[int, int]], keys: int, heavy_run: int | None):
    """Sorted rows (slot, key columns ..., fp) -> links (a, b), and rows of heavy runs (slot, k1, a, at)."""
    segments = ring(distance)
    m = len(segments)
    budgets = [(l + 1) * distance // m for l in range(m)]
    orders = np.array([[segments[(start + l) % m] for l in range(m)] for start, _ in masks], dtype=np.uint64)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("slot", pa.int32()), ("key", pa.int64()), ("at", pa.int64())])

    def links_of(slot: np.ndarray, fp: np.ndarray, sizes: np.ndarray):
        """Links within consecutive runs of the given sizes."""
        first, second = [], []
        ends = np.cumsum(sizes)
        end_of = np.repeat(ends, sizes)
        short = np.repeat(sizes <= _FOREST_RUN, sizes)
        place = np.arange(len(fp))
        for step in range(1, int(min(_FOREST_RUN, sizes.max(initial=1)))):
            i = place[short & (place + step < end_of)]
            if not len(i):
                break
            ok = i[_chain_links(fp[i], fp[i + step], slot[i], orders, budgets)]
            first.append(fp[ok])
            second.append(fp[ok + step])
        for k in np.flatnonzero(sizes > _FOREST_RUN):
            run, s = fp[ends[k] - sizes[k]:ends[k]], slot[ends[k] - 1]
            waiting, frontier = np.ones(len(run), bool), []
            for seed in range(len(run)):                # breadth first: every member is compared once from its own side
                if not waiting[seed]:
                    continue
                waiting[seed] = False
                frontier.append(seed)
                while frontier:
                    x = frontier.pop()
                    rest = np.flatnonzero(waiting)
                    if not len(rest):
                        frontier.clear()
                        break
                    near = rest[_chain_links(run[rest], np.broadcast_to(run[x], len(rest)), np.full(len(rest), s), orders, budgets)]
                    waiting[near] = False
                    frontier.extend(near.tolist())
                    first.append(np.broadcast_to(run[x], len(near)))
                    second.append(run[near])
        if not first:
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        return np.concatenate(first), np.concatenate(second)

    def output(a, b=None, slot=None, key=None, at=None):
        n = len(a)
        cols = [a.view(np.int64), b.view(np.int64) if b is not None else None, slot, key, at]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) if c is not None else pa.nulls(n, f.type)
                                           for c, f in zip(cols, schema)], schema=schema)

    def run(batches):
        held = None                 # rows of the run that is not known to be over
        gone = 0                    # rows of that run already passed on as heavy
        for batch in batches:
            cols = [np.asarray(batch.column(k)).astype(np.int64) for k in range(keys)]
            cols.append(np.asarray(batch.column(keys)).astype(np.int64).view(np.uint64))
            if not len(cols[0]):
                continue
            if held is not None:
                cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
            change = np.zeros(len(cols[0]), bool)
            change[0] = True
            for c in cols[:keys]:
                change[1:] |= c[1:] != c[:-1]
            begins = np.flatnonzero(change)
            last = int(begins[-1])
            sizes = np.diff(begins)
            done = [c[:last] for c in cols]
            held = [c[last:].copy() for c in cols]
            if gone and len(sizes):             # the run that was heavy ends here
                n = int(sizes[0])
                yield output(done[-1][:n], slot=done[0][:n], key=done[1][:n], at=np.arange(gone, gone + n))
                done, sizes, gone = [c[n:] for c in done], sizes[1:], 0
            if heavy_run is not None:
                for k in np.flatnonzero(sizes > heavy_run):
                    b = int(sizes[:k].sum())
                    part = [c[b:b + int(sizes[k])] for c in done]
                    yield output(part[-1], slot=part[0], key=part[1], at=np.arange(len(part[0])))
                keep = np.repeat(sizes <= heavy_run, sizes)
                done, sizes = [c[keep] for c in done], sizes[sizes <= heavy_run]
            a, b = links_of(done[0], done[-1], sizes)
            if len(a):
                yield output(a, b)
            if heavy_run is not None and (gone or len(held[0]) > heavy_run):
                n = len(held[0]) - 1            # one row stays: it marks the run
                yield output(held[-1][:n], slot=held[0][:n], key=held[1][:n], at=np.arange(gone, gone + n))
                held, gone = [c[n:] for c in held], gone + n
        if held is not None:
            if gone:
                yield output(held[-1], slot=held[0], key=held[1], at=np.arange(gone, gone + len(held[0])))
            else:
                a, b = links_of(held[0], held[-1], np.array([len(held[0])]))
                if len(a):
                    yield output(a, b)

    return run


_LINKS = "a long, b long, slot int, key long, at long"


def _keyed(marks: DataFrame, masks: list[tuple[int, int]], start: str | None = None) -> DataFrame:
    """Sorted rows (slot, key, fp) of every key of every mark, or of the keys of its ``start`` segment only."""
    keyed = [F.struct(F.lit(k).alias("slot"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("key"), F.lit(s).alias("start"))
             for k, (s, mask) in enumerate(masks)]
    rows = marks.select("*", F.explode(F.array(*keyed)).alias("k"))
    if start:
        rows = rows.where(F.col("k.start") == F.col(start))
    return rows.select("k.slot", "k.key", "fp").repartition("slot", "key").sortWithinPartitions("slot", "key")


def _varying_keys(distance: int, more: int = 4):
    """Rows (slot, key, varying, fp) -> (slot, key, part, sub, fp): ``sub`` has the bits of ``more`` of the
    ``distance + more`` parts that the run's varying bits are cut into, ``part`` numbers the choice."""
    schema = pa.schema([("slot", pa.int32()), ("key", pa.int64()), ("part", pa.int32()), ("sub", pa.int64()), ("fp", pa.int64())])

    def masks_of(varying: int) -> list[int]:
        bits = [b for b in range(64) if varying >> b & 1]
        n = distance + more
        cut = [sum(1 << b for b in bits[len(bits) * k // n:len(bits) * (k + 1) // n]) for k in range(n)]
        return [sum(cut[k] for k in some) for some in combinations(range(n), more)]

    def run(batches):
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            varying = np.asarray(batch.column(2)).astype(np.int64).view(np.uint64)
            for v in np.unique(varying).tolist():
                if v not in known:
                    if len(known) > 10_000:
                        known.clear()
                    known[v] = np.array(masks_of(v), np.uint64)
                rows = np.flatnonzero(varying == v)
                masks = known[v]
                for k in range(0, len(rows), 4096):
                    some = rows[k:k + 4096]
                    fp = np.asarray(batch.column(3)).astype(np.int64)[some].view(np.uint64)
                    each = pa.array(np.repeat(some, len(masks)))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(each), batch.column(1).take(each), pa.array(np.tile(np.arange(len(masks), dtype=np.int32), len(some))),
                         pa.array((fp[:, None] & masks[None, :]).ravel().view(np.int64)), pa.array(np.repeat(fp, len(masks)).view(np.int64))], schema=schema)

    return run


def links(spark: SparkSession, marks: DataFrame, distance: int = DISTANCE, heavy_run: int = HEAVY_RUN) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``marks`` (fp) that join all within ``distance`` bits.

    Every pair within the distance is linked, directly or through others within it; no link
    joins a pair beyond it.
    """
    more = more_parts(distance, marks.count())
    masks, longest = key_masks(distance, more), key_masks(distance, MORE_PARTS)
    found = stored(spark, _keyed(marks, masks).mapInArrow(_link_runs(distance, masks, 2, heavy_run), _LINKS), "simhash-links")
    out = [found.where(F.col("b").isNotNull()).select("a", "b")]
    if len(longest) > len(masks):
        # a pair of a heavy run whose chain begins at the run's segment shares a longest key of that segment
        starts = F.array(*[F.lit(s) for s, _ in masks])
        again = found.where(F.col("at").isNotNull()).select(F.element_at(starts, F.col("slot") + 1).alias("start"), F.col("a").alias("fp")).distinct()
        found = stored(spark, _keyed(again, longest, "start").mapInArrow(_link_runs(distance, longest, 2, heavy_run), _LINKS), "simhash-links")
        out.append(found.where(F.col("b").isNotNull()).select("a", "b"))
        masks = longest
    # heavy keys of one start segment mostly hold the same rows: one run per value of that segment
    segments = list(enumerate(ring(distance)))
    starts, values = (F.array(*[F.lit(x) for x in xs]) for xs in ([s for s, _ in masks], [_signed(x) for _, x in segments]))
    heavy = found.where(F.col("at").isNotNull()).select(F.element_at(starts, F.col("slot") + 1).alias("slot"), F.col("a").alias("fp")) \
        .withColumn("key", F.col("fp").bitwiseAND(F.element_at(values, F.col("slot") + 1))).select("slot", "key", "fp").distinct()
    masks = segments
    varying = heavy.groupBy("slot", "key").agg(F.bit_or("fp").bitwiseXOR(F.bit_and("fp")).alias("varying"))
    rows = heavy.join(varying, ["slot", "key"]).select("slot", "key", "varying", "fp") \
        .mapInArrow(_varying_keys(distance), "slot int, key long, part int, sub long, fp long") \
        .repartition("slot", "key", "part", "sub").sortWithinPartitions("slot", "key", "part", "sub")
    found = stored(spark, rows.mapInArrow(_link_runs(distance, masks, 4, heavy_run), _LINKS), "simhash-links")
    out.append(found.where(F.col("b").isNotNull()).select("a", "b"))
    heavy = found.where(F.col("at").isNotNull()).select("slot", "key", F.col("a").alias("fp")).distinct()
    blocks = heavy.groupBy("slot", "key").agg(F.ceil(F.count(F.lit(1)) / heavy_run).alias("blocks"))
    pairs = heavy.join(blocks, ["slot", "key"]).withColumn("block", F.pmod(F.xxhash64("fp"), "blocks")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))) \
        .select("slot", "key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "fp") \
        .repartition("slot", "key", "low", "high").sortWithinPartitions("slot", "key", "low", "high")
    out.append(pairs.mapInArrow(_link_runs(distance, masks, 4, None), _LINKS).select("a", "b"))
    return reduce(DataFrame.union, out)


def _classes(spark: SparkSession, firsts: DataFrame, distance: int, heavy_run: int) -> DataFrame:
    """(fp, first, root) for ``firsts`` (fp, first): the first row of each distinct fingerprint, and the
    first row of its component. Components are formed on the first rows themselves, so the root
    is the answer: no join gathers a component under one key."""
    firsts = stored(spark, firsts.select("fp", "first"), "simhash-marks")
    pairs = links(spark, firsts.select("fp"), distance, heavy_run)
    named = [firsts.select(F.col("fp").alias(f"{x}_fp"), F.col("first").alias(f"{x}_first")) for x in ("a", "b")]
    pairs = pairs.join(named[0], F.col("a") == F.col("a_fp")).join(named[1], F.col("b") == F.col("b_fp")) \
        .select(F.col("a_first").alias("a"), F.col("b_first").alias("b"))
    linked = components(spark, pairs)
    return firsts.join(linked, firsts["first"] == linked["node"], "left").select("fp", "first", F.coalesce("root", "first").alias("root"))


def near_duplicates(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
                    seed: int = SEED, heavy_run: int = HEAVY_RUN) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per document row.

    component_id: the least doc_id reachable over links, its own included. Null, empty and
    blank texts share fingerprint zero and are linked like any other; repeated rows stay;
    null doc_ids are carried and never the least unless all of a component are null; an
    empty table gives no rows; other columns are not read.
    """
    marks = stored(spark, fingerprints(docs, shingle, seed), "simhash-docs")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"))).alias("first")
    firsts = marks.groupBy("fp").agg(first).select("fp", F.struct("first.no_id", "first.doc_id", "fp").alias("first"))
    classes = stored(spark, _classes(spark, firsts, distance, heavy_run), "simhash-classes")
    return marks.join(classes.select("fp", F.col("root.doc_id").alias("component_id")), "fp") \
        .select("doc_id", unsigned_hex(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
             seed: int = SEED, heavy_run: int = HEAVY_RUN) -> DataFrame:
    """The rows of ``docs`` with one document of each component: the least doc_id, nulls last.

    Of repeated rows with that doc_id one stays. All columns are kept, whatever their names.
    """
    fp, row = unused_name(docs, "fp"), unused_name(docs, "row_no")
    fields = docs.schema.fieldNames()
    marked = docs.withColumn(row, F.monotonically_increasing_id()) \
        .mapInArrow(_append_mark(fields.index("text"), shingle, seed, fp),
                    T.StructType([*docs.schema.fields, T.StructField(row, T.LongType()), T.StructField(fp, T.LongType())]))
    # written once: the row numbers are those of the committed files, whatever tasks run again
    marked = stored(spark, marked, "simhash-rows")
    slim = marked.select(F.col(row).alias("row_no"), F.col(fp).alias("fp"), F.col("doc_id").alias("doc_id"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_no")).alias("first")
    classes = _classes(spark, slim.groupBy("fp").agg(first), distance, heavy_run)
    kept = classes.where(F.col("root") == F.col("first")).select(F.col("first.row_no").alias(row))
    return marked.join(kept, row, "left_semi").select(*[F.col(f"`{c}`") for c in fields])


def _append_mark(at: int, shingle: int, seed: int, name: str):
    def run(batches):
        for batch in batches:
            marks = np.array([fingerprint(x.as_py(), shingle, seed) for x in batch.column(at)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(marks.view(np.int64), pa.int64())],
                                             names=[*batch.schema.names, name])

    return run
