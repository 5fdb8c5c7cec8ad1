"""Benchmark decontamination by pigeonhole edit matching.

A test item of m normalised characters may occur in a document with up to
``floor(error_rate * m)`` edits. It is split into one piece more than that budget, so
wherever it occurs at least one piece stands unchanged (pigeonhole). All pieces go into one
Aho-Corasick automaton that runs over the whole document; around each piece hit, Myers'
bit-parallel algorithm finds the least edit distance of the item to any substring, and only
a distance within the budget is a match.

The items are the query set: they are read in blocks of at most ``block_chars`` characters
(sizes are measured, blocks are formed by Spark; rows that repeat an item count once there).
A Python worker process builds a block's automaton once and keeps it for its later tasks: some
64 MB per million item characters, so a full block takes about 130 MB. A larger benchmark means
more passes over the documents, never a larger broadcast.
"""
from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import per_worker, unused_name

ERROR_RATE = 0.08
MIN_FUZZY_CHARS = 40
BLOCK_CHARS = 2_000_000

MATCHES = "doc_id long, item_id long, distance int, budget int, first_char int, last_char int"


def normalise(text: str | None) -> str:
    """Lower case, white space runs as one blank, none at the ends."""
    return " ".join((text or "").lower().split())


def budget_of(length: int, error_rate: float = ERROR_RATE, min_fuzzy: int = MIN_FUZZY_CHARS) -> int:
    """Edits allowed for an item: none for short ones, which must stand whole."""
    return int(error_rate * length) if length >= min_fuzzy else 0


def pieces_of(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` consecutive pieces, as equal as they can be, with their places."""
    n = budget + 1
    cuts = [len(item) * k // n for k in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(masks: dict[str, int], m: int, text: str, budget: int) -> tuple[int, int] | None:
    """(distance, end) of the best substring of ``text`` within ``budget`` edits; the first of equals.

    ``masks``: per character the bits of its places in the item of ``m`` characters.
    """
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = budget + 1, -1
    get = masks.get
    for j, c in enumerate(text):
        eq = get(c, 0)
        x = eq | minus
        d0 = (((eq & plus) + plus) ^ plus) | x
        up = minus | (full & ~(d0 | plus))
        down = plus & d0
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = up << 1                         # a match may start anywhere: no cost above
        down = down << 1
        plus = (down | ~(d0 | up)) & full
        minus = up & d0 & full
        if score < best:
            best, end = score, j + 1
            if not score:
                break
    return (best, end) if best <= budget else None


def start_of(item: str, text: str, end: int, distance: int) -> int:
    """Where a stretch of ``text`` begins that ends at ``end`` and lies ``distance`` edits from ``item``.

    Myers' recurrence over both read backwards, with the text's side tied to ``end``. Of
    several beginnings the one that makes the stretch as long as the item counts, or next to
    that, the longer one first.
    """
    m, masks = len(item), defaultdict(int)
    for i, c in enumerate(reversed(item)):
        masks[c] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best = (m, 1, end) if score == distance else None
    for n in range(1, min(end, m + distance) + 1):
        eq = masks.get(text[end - n], 0)
        x = eq | minus
        d0 = (((eq & plus) + plus) ^ plus) | x
        up = minus | (full & ~(d0 | plus))
        down = plus & d0
        score += bool(up & top) - bool(down & top)
        up, down = (up << 1) | 1, down << 1
        plus, minus = (down | ~(d0 | up)) & full, up & d0 & full
        if score == distance:
            found = (abs(n - m), n < m, end - n)
            best = found if best is None else min(best, found)
    return best[2] if best else max(0, end - m)


class Matcher:
    """Pieces of a block of items, and the verification of their hits."""

    def __init__(self, items: Iterable[tuple], error_rate: float = ERROR_RATE, min_fuzzy: int = MIN_FUZZY_CHARS):
        """``items``: (id, text), or (id, text, times) for a row that occurs so often."""
        ids = defaultdict(list)
        for item_id, text, *times in items:
            norm = normalise(text)
            if norm:                        # an item without a character occurs nowhere
                ids[norm].append((item_id, times[0] if times else 1))
        self.items = list(ids.items())
        self.budgets = [budget_of(len(t), error_rate, min_fuzzy) for t, _ in self.items]
        self.masks: list[dict[str, int]] = []
        places = defaultdict(list)
        for k, (text, _) in enumerate(self.items):
            masks: dict[str, int] = defaultdict(int)
            for i, c in enumerate(text):
                masks[c] |= 1 << i
            self.masks.append(dict(masks))
            for at, piece in pieces_of(text, self.budgets[k]):
                places[piece].append((k, at))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()
        self.empty = not places

    def _whole(self, text: str, start: int, end: int) -> bool:
        return not (start > 0 and text[start - 1].isalnum() and text[start].isalnum()
                    or end < len(text) and text[end].isalnum() and text[end - 1].isalnum())

    def matches(self, text: str) -> Iterator[tuple[int | None, int, int, int, int]]:
        """(item_id, distance, budget, first, last) of the best place of every item that occurs; places in normalised text."""
        if self.empty:
            return
        near: dict[int, list[int]] = defaultdict(list)      # item -> places where its start would lie
        for end, (n, where) in self.automaton.iter(text):
            for k, at in where:
                near[k].append(end + 1 - n - at)
        for k, starts in near.items():
            item, item_ids = self.items[k]
            m, budget = len(item), self.budgets[k]
            best = None
            exact = [s for s in starts if s >= 0 and text.startswith(item, s)]
            if budget == 0:
                exact = [s for s in exact if m >= MIN_FUZZY_CHARS or self._whole(text, s, s + m)]
            if exact:
                s = min(exact)
                best = (0, s, s + m)
            elif budget:
                spans: list[list[int]] = []                 # windows that touch are one
                for s in sorted(set(starts)):
                    a, b = max(0, s - budget), min(len(text), s + m + budget)
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = b
                    else:
                        spans.append([a, b])
                for a, b in spans:
                    hit = myers(self.masks[k], m, text[a:b], budget)
                    if hit and (best is None or hit[0] < best[0]):
                        best = (hit[0], None, a + hit[1])
            if best:
                first = best[1] if best[1] is not None else start_of(item, text, best[2], best[0])
                for item_id, times in item_ids:
                    for _ in range(times):
                        yield item_id, best[0], budget, first, best[2]


def _blocks(spark: SparkSession, items: DataFrame, block_chars: int) -> Iterator[list[tuple[int | None, str | None, int]]]:
    """Items (id, text, times) of one block after another; only one is ever on the driver."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .groupBy("item_id", "text").agg(F.count(F.lit(1)).alias("times"))
    total = rows.agg(F.sum(F.length("text") + 1).alias("n")).first()["n"] or 0
    n = max(1, -(-total // block_chars))
    for k in range(n):
        block = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield sorted(((r["item_id"], r["text"], r["times"]) for r in block.collect()), key=repr)


def _own_matcher(shared, key, error_rate, min_fuzzy):
    """The block's matcher, built once by a Python worker process and kept for its later tasks."""
    return per_worker("decontam-matcher", (key, error_rate, min_fuzzy), lambda: Matcher(shared.value, error_rate, min_fuzzy))


def _key_of(block: list) -> str:
    return hashlib.sha256(repr(block).encode("utf-8", "surrogatepass")).hexdigest()


def _match_batches(matcher, key, error_rate, min_fuzzy):
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int32()), ("budget", pa.int32()),
                        ("first_char", pa.int32()), ("last_char", pa.int32())])

    def run(batches):
        own = _own_matcher(matcher, key, error_rate, min_fuzzy)
        for batch in batches:
            rows = [(doc_id, *hit) for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1))
                    for hit in own.matches(normalise(text.as_py()))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame, error_rate: float = ERROR_RATE,
                 min_fuzzy: int = MIN_FUZZY_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, distance, budget, first_char, last_char): each item found in each document row.

    Documents without a match have no row. Places count normalised characters. Items with
    equal text give a row each; null or blank items and texts match nothing; items under
    ``min_fuzzy`` characters must occur unchanged and, as whole words; repeated document
    rows repeat their matches; empty tables give no rows; other columns are not read.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for block in _blocks(spark, items, block_chars):
        shared = spark.sparkContext.broadcast(block)        # at most block_chars characters
        found = slim.mapInArrow(_match_batches(shared, _key_of(block), error_rate, min_fuzzy), MATCHES)
        out = found if out is None else out.union(found)
    return out


def _flag_batches(at, matcher, key, error_rate, min_fuzzy, name):
    def run(batches):
        own = _own_matcher(matcher, key, error_rate, min_fuzzy)
        for batch in batches:
            flags = [next(own.matches(normalise(t.as_py())), None) is not None for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(flags, pa.bool_())], names=[*batch.schema.names, name])

    return run


def drop_contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame, error_rate: float = ERROR_RATE,
                      min_fuzzy: int = MIN_FUZZY_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` in which no item occurs, with all their columns.

    One narrow pass per block of items. Rows are judged each on their own, so repeated rows
    and null doc_ids need no key; null texts stay.
    """
    flag = unused_name(docs, "contaminated")
    fields = docs.schema.fieldNames()
    out = docs
    for block in _blocks(spark, items, block_chars):
        shared = spark.sparkContext.broadcast(block)
        out = out.mapInArrow(_flag_batches(fields.index("text"), shared, _key_of(block), error_rate, min_fuzzy, flag),
                             T.StructType([*docs.schema.fields, T.StructField(flag, T.BooleanType())])) \
            .where(~F.col(flag)).drop(flag)
    return out
