"""Runs of repeated words, found with a dictionary of basic factors.

A run is a stretch of consecutive words with smallest period q, at least ``max(least,
times * q)`` words long, that no neighbouring word extends keeping period q. A text's basic
factors are its stretches of 1, 2, 4, 8, ... words; equal factors of one length share a
name, and the names of length 2L are the pairs of names of length L. For each length L the
successor of a factor is its next equal one. Where successors no farther than 2L apart form
an arithmetic progression of three or more, their difference is proposed as a period:

* every run is proposed. With L the least power of two from q up, the factors at the run's
  first places recur after exactly q words (nearer ones would give the run a smaller period),
  and two steps of q behind the start still lie in the run, as 2q + L < 4q;
* a proposed q is the smallest period of what it extends to: a smaller one would divide q and
  bring the successor nearer.

Proposals are extended word by word to both sides, in blocks; those that reach the same
stretch are one run. A factor that occurs once has no repeated factor around it, so only
places with a repeated name go on to the next length.
"""
from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST, TIMES = 6, 4
_FLUSH_BYTES = 4 << 20
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])
RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _reach(symbols: np.ndarray, a: int, b: int, step: int) -> int:
    """How many words from places ``a`` and ``b`` on (``step`` 1) or back (-1) are equal; a < b."""
    room = len(symbols) - b if step > 0 else a + 1
    done, block = 0, 32
    while done < room:
        size = min(block, room - done)
        if step > 0:
            differ = symbols[a + done:a + done + size] != symbols[b + done:b + done + size]
        else:
            differ = (symbols[a - done - size + 1:a - done + 1] != symbols[b - done - size + 1:b - done + 1])[::-1]
        first = int(differ.argmax())
        if differ[first]:
            return done + first
        done, block = done + size, 4 * block
    return done


def find_runs(symbols: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period. ``times`` is at least 4."""
    if times < 4:
        raise ValueError("three equal steps are certain only for runs of four periods or more")
    n = len(symbols)
    found: set[tuple[int, int, int]] = set()
    if n < least:
        return []
    symbols = np.asarray(symbols, dtype=np.int64)
    places, key, size = np.arange(n), symbols, 1
    while len(places) and size < n:
        order = np.argsort(key, kind="stable")              # by name, then place
        names, at = key[order], places[order]
        same = names[1:] == names[:-1]
        if not same.any():
            break
        here, gaps = at[:-1][same], (at[1:] - at[:-1])[same]
        near = gaps <= 2 * size
        succ = np.zeros(n, dtype=np.int64)
        succ[here[near]] = gaps[near]
        starts = np.flatnonzero(succ)
        starts = starts[succ[starts + succ[starts]] == succ[starts]]        # three in progression
        if len(starts):
            q = succ[starts]
            fresh = np.ones(len(starts), bool)
            fresh[1:] = (np.diff(starts) != 1) | (np.diff(q) != 0)
            begins = np.flatnonzero(fresh)
            lasts = np.append(begins[1:], len(starts)) - 1
            over: dict[int, int] = {}                       # per period: where the last stretch at this length ends
            for i, j, p in zip(starts[begins].tolist(), starts[lasts].tolist(), q[begins].tolist()):
                if i + p < over.get(p, 0):
                    continue
                first = i - _reach(symbols, i - 1, i - 1 + p, -1) if i else 0
                sure = j + p + size                         # from i + p up to here words repeat those p places earlier
                end = sure + _reach(symbols, sure - p, sure, 1)
                over[p] = end
                if end - first >= max(least, times * p):
                    found.add((first, end - first, p))
        # names of the repeated factors, and the places where both halves of the next length are repeated
        grouped = np.zeros(len(at), bool)
        grouped[1:] |= same
        grouped[:-1] |= same
        number = np.cumsum(np.append(True, ~same))
        name_of = np.zeros(n, dtype=np.int64)
        name_of[at[grouped]] = number[grouped]              # from 1; 0: occurs once
        places = np.sort(at[grouped])
        places = places[places + size < n]
        second = name_of[places + size]
        places, second = places[second > 0], second[second > 0]
        key = name_of[places] * (int(number[-1]) + 1) + second
        size *= 2
    return sorted(found, key=lambda r: (r[0], r[2]))


def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but ASCII white space, as UTF-8."""
    return (text or "").encode("utf-8").split()


def _numbered(words: list[bytes]) -> np.ndarray:
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one blank, each run cut to its first period."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return b" ".join(compress(words, keep.tolist()))


def _map(least: int, times: int):
    def output(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)

    def run(batches):
        rows, held = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_py())
                runs = find_runs(_numbered(words), least, times)
                kept = collapse(words, runs)
                rows.append((doc_id, len(words), runs and [{"start": s, "length": n, "period": q} for s, n, q in runs], kept.decode("utf-8")))
                held += len(kept)
                if held >= _FLUSH_BYTES:
                    yield output(rows)
                    rows, held = [], 0
        if rows:
            yield output(rows)

    return run


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): doc_id, n_words, runs, collapsed.

    ``runs`` lists every run (start, length, period, in words) by start, then period;
    ``collapsed`` is the text's words joined by one blank without those that stand in a run
    behind its first period. Null, empty and blank texts have no word, no run and an empty
    collapsed text; repeated rows and null doc_ids stay as they are; an empty table gives no
    rows; other columns are not read. Whole texts are read: memory beside one batch of rows
    grows with the longest text only.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_map(least, times), RUNS)
