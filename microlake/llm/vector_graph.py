"""Near-duplicate embeddings with a robust-pruned flat graph.

Distinct vectors are the nodes of one graph without layers, and a link joins two whose cosine
is at least ``threshold``.

1. *Overlapping shards.* Leaders are fitted on a bounded sample: vectors spread apart, moved to
   the mean of those nearest to them. A node joins its nearest leader and others whose cosine
   is at most ``margin`` less (``overlap`` at most), so that close nodes share a shard. Shards
   over ``cap`` are split the same way by leaders of their own. A shard whose sample lies in
   one spot cannot be split without parting links: its nodes are cut into blocks, and every
   pair of blocks is a shard.
2. *Graph.* Within a shard nodes enter in growing batches: a greedy search from the shard's
   medoid gives each node's candidates, robust pruning picks its neighbours (one that is far
   closer to a neighbour already picked is left out), edges back are added and pruned again.
   The adjacency lists that a node gets in its shards are united.
3. *Search.* In each shard every node is looked up in the united graph: greedy search from the
   medoid, then the range grows along edges in both directions from all that was found, as
   long as it meets nodes within the threshold. Cosines are computed in double and decide.
4. *Counts without pairs.* A task marks the links of its shard and puts out, per node, a
   number and the least node of its component in the shard. A pair that several shards hold
   counts in the least of them. Components over shards are joined by large and small stars.
5. *Audit.* The links of a bounded sample of vectors are counted by comparison with all
   vectors; if less than ``recall`` of them was found, shards overlap more and the work is
   done again.

A shard's task holds ``cap`` vectors and a matrix of cap x cap marks. The work of shards in
one spot grows with their number of links, each of which the counts must see.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored
from .components import components
from .vectors import binary_rows, by_length, typed, usable

THRESHOLD, CAP, OVERLAP, MARGIN = 0.9, 4096, 4, 0.1
DEGREE, BEAM, WIDTH, ALPHA = 24, 32, 4, 1.2
FIT_ROWS, LEADERS, APART, LEVELS = 8192, 256, 0.8, 6
AUDIT_ROWS, RECALL, TRIES = 512, 0.97, 3
_BATCH = 512
_SALT_ROWS = 50_000


# --- one shard: graph and search ----------------------------------------------------

def _best(sims: np.ndarray, keep: int) -> np.ndarray:
    """Columns of the ``keep`` greatest entries of each row."""
    if sims.shape[1] <= keep:
        return np.broadcast_to(np.arange(sims.shape[1]), sims.shape)
    return np.argpartition(-sims, keep - 1, axis=1)[:, :keep]


def _first_of_each(values: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Mask of one place per distinct value; ``room`` is scratch space indexed by value."""
    at = np.arange(len(values), dtype=room.dtype)
    room[values] = at
    return room[values] == at


def greedy(x: np.ndarray, edges: np.ndarray, queries: np.ndarray, start: int, beam: int = BEAM, width: int = WIDTH):
    """(ids, cosines) of the ``beam`` nearest nodes met on the way from ``start``; -1 where fewer.

    ``edges``: neighbours of each node, -1 where none. Each step visits the neighbours of the
    ``width`` best nodes of every query's beam that are still to do; it ends when none is left.
    """
    count, n = len(queries), len(x)
    ids = np.full((count, beam), -1, np.int64)
    sims = np.full((count, beam), -np.inf, np.float32)
    todo = np.zeros((count, beam), bool)
    ids[:, 0], sims[:, 0], todo[:, 0] = start, queries @ x[start], True
    seen = np.zeros(count * n, bool)
    seen[np.arange(count) * n + start] = True
    room = np.empty(count * n, np.int32)
    live = np.arange(count)
    while len(live):
        pick = _best(np.where(todo[live], sims[live], -np.inf), width)
        open_ = np.take_along_axis(todo[live], pick, 1)
        go = open_.any(axis=1)
        live, pick, open_ = live[go], pick[go], open_[go]
        if not len(live):
            break
        todo[live[:, None], pick] = False
        near = np.where(open_[:, :, None], edges[np.where(open_, ids[live[:, None], pick], 0)], -1).reshape(len(live), -1)
        flat = live[:, None] * n + near
        fresh = near >= 0
        fresh[fresh] = ~seen[flat[fresh]]
        values = flat[fresh]
        first = _first_of_each(values, room)
        fresh[fresh] = first
        seen[values] = True
        got = np.full(near.shape, -np.inf, np.float32)
        row, _ = np.nonzero(fresh)
        got[fresh] = np.einsum("ij,ij->i", x[near[fresh]], queries[live[row]])
        all_ids = np.hstack([ids[live], near])
        all_sims = np.hstack([sims[live], got])
        all_todo = np.hstack([todo[live], fresh])
        top = _best(all_sims, beam)
        sims[live] = np.take_along_axis(all_sims, top, 1)
        ids[live] = np.where(sims[live] > -np.inf, np.take_along_axis(all_ids, top, 1), -1)
        todo[live] = np.take_along_axis(all_todo, top, 1)
    return ids, sims


def prune(x: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """Robust pruning: at most ``degree`` of each node's candidates (-1: none; distinct), nearest first.

    A candidate goes if it lies, by a factor ``alpha``, nearer to a neighbour picked before
    than to the node itself.
    """
    far = 1 - np.einsum("ijk,ik->ij", x[candidates], x[nodes])          # half the squared distance of unit vectors
    far[(candidates < 0) | (candidates == nodes[:, None])] = np.inf
    order = np.argsort(far, axis=1)
    candidates, far = np.take_along_axis(candidates, order, 1), np.take_along_axis(far, order, 1)
    vectors = x[candidates]
    between = 1 - vectors @ vectors.transpose(0, 2, 1)
    alive, rows = far < np.inf, np.arange(len(nodes))
    out = np.full((len(nodes), degree), -1, np.int64)
    for k in range(degree):
        j = alive.argmax(axis=1)
        any_ = alive[rows, j]
        if not any_.any():
            break
        out[:, k] = np.where(any_, candidates[rows, j], -1)
        alive &= alpha * alpha * between[rows, j] > far
        alive[rows, j] = False
    return out


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, int]:
    """(edges, medoid) of the graph over the unit rows of ``x``."""
    n = len(x)
    edges = np.full((n, degree), -1, np.int64)
    medoid = int((x @ x.mean(axis=0)).argmax())
    order = np.random.default_rng(n).permutation(n)
    order = np.concatenate([[medoid], order[order != medoid]])
    done = 1
    while done < n:
        batch = order[done:done + min(max(done, 16), _BATCH)]
        done += len(batch)
        found, _ = greedy(x, edges, x[batch], medoid, beam)
        within = x[batch] @ x[batch].T                      # nodes that enter together do not meet in the graph
        np.fill_diagonal(within, -np.inf)
        beside = batch[_best(within, min(8, len(batch) - 1))] if len(batch) > 1 else np.zeros((1, 0), np.int64)
        chosen = prune(x, batch, _distinct(np.hstack([found, beside])), degree, alpha)
        edges[batch] = chosen
        _add_back(x, edges, batch, chosen, degree, alpha)
    return edges, medoid


def _distinct(rows: np.ndarray) -> np.ndarray:
    """Repeated entries of a row become -1."""
    rows = np.sort(rows, axis=1)
    rows[:, 1:][rows[:, 1:] == rows[:, :-1]] = -1
    return rows


def _add_back(x, edges, batch, chosen, degree, alpha) -> None:
    """Edges from the chosen neighbours back to the nodes of the batch; full lists are pruned."""
    src, k = np.nonzero(chosen >= 0)
    dst, src = chosen[src, k], batch[src]
    if not len(dst):
        return
    order = np.lexsort((-np.einsum("ij,ij->i", x[src], x[dst]), dst))
    src, dst = src[order], dst[order]
    nodes, first, count = np.unique(dst, return_index=True, return_counts=True)
    rank = np.arange(len(dst)) - np.repeat(first, count)
    keep = rank < 3 * degree
    new = np.full((len(nodes), int(min(count.max(), 3 * degree))), -1, np.int64)
    new[np.repeat(np.arange(len(nodes)), count)[keep], rank[keep]] = src[keep]
    merged = _distinct(np.hstack([edges[nodes], new]))
    full = (merged >= 0).sum(axis=1) > degree
    for part in np.array_split(np.flatnonzero(full), max(1, -(-int(full.sum()) // _BATCH))):
        if len(part):
            edges[nodes[part]] = prune(x, nodes[part], merged[part], degree, alpha)
    edges[nodes[~full]] = -np.sort(-merged[~full], axis=1)[:, :degree]


def _both_ways(edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ends, reach): node k's neighbours, along edges from it and to it, are ``reach[ends[k]:ends[k + 1]]``."""
    n = len(edges)
    src, k = np.nonzero(edges >= 0)
    dst = edges[src, k]
    both = np.unique(np.concatenate([src * n + dst, dst * n + src]))
    return np.searchsorted(both, np.arange(n + 1) * n), both % n


def links(unit: np.ndarray, edges: np.ndarray, medoid: int, threshold: float = THRESHOLD, beam: int = BEAM) -> np.ndarray:
    """Matrix of marks: which rows of ``unit`` (double) the range search finds linked, in either direction."""
    n, x = len(unit), unit.astype(np.float32)
    found = np.zeros((n, n), bool)
    ends, reach = _both_ways(edges)
    for begin in range(0, n, _BATCH):
        mine = np.arange(begin, min(begin + _BATCH, n))
        ids, sims = greedy(x, edges, x[mine], medoid, beam)
        seen = np.zeros(len(mine) * n, bool)
        room = np.empty(len(mine) * n, np.int32)
        row, k = np.nonzero((ids >= 0) & (sims >= threshold - 1e-4))
        hit = row * n + ids[row, k]
        hit = hit[np.einsum("ij,ij->i", unit[mine[row]], unit[hit % n]) >= threshold]
        front = np.concatenate([np.arange(len(mine)) * n + mine, hit])      # the node itself is a place to grow from
        front = front[_first_of_each(front, room)]
        seen[front] = True
        found[mine[front // n], front % n] = True
        while len(front):
            grown = []
            for part in np.array_split(front, -(-len(front) // 16_384)):
                node = part % n
                count = ends[node + 1] - ends[node]
                step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
                flat = np.repeat(part - node, count) + reach[np.repeat(ends[node], count) + step]
                flat = flat[~seen[flat]]
                flat = flat[_first_of_each(flat, room)]
                seen[flat] = True
                if len(flat):
                    close = np.concatenate([np.einsum("ij,ij->i", unit[mine[f // n]], unit[f % n]) >= threshold
                                            for f in np.array_split(flat, -(-len(flat) // 65_536))])
                    grown.append(flat[close])
            front = np.concatenate(grown) if grown else front[:0]
            found[mine[front // n], front % n] = True
    found |= found.T
    np.fill_diagonal(found, False)
    return found


def least_of_component(found: np.ndarray) -> np.ndarray:
    """The least row of each row's component under the marks."""
    n = len(found)
    label, waiting = np.arange(n), found.any(axis=1)
    for seed in np.flatnonzero(waiting).tolist():
        if not waiting[seed]:
            continue
        front = np.array([seed])
        waiting[seed] = False
        while len(front):
            front = np.flatnonzero(found[front].any(axis=0) & waiting)
            waiting[front] = False
            label[front] = seed
    return label


# --- Spark: nodes and shards --------------------------------------------------------

def _units(raw: np.ndarray) -> np.ndarray:
    """Rows of length one, in double."""
    wide = raw.astype(np.float64)
    wide = wide / np.abs(wide).max(axis=1, keepdims=True)       # neither overflow nor underflow in the squares
    return wide / np.sqrt(np.einsum("ij,ij->i", wide, wide))[:, None]


def _matrix(column, item: str) -> np.ndarray:
    cells = column.to_pylist()
    return np.frombuffer(b"".join(cells), item).reshape(len(cells), -1)


def _encode(item: str):
    def run(batches):
        for batch in batches:
            mask, first, length, flat = usable(batch.column(1))
            codes: list[bytes | None] = [None] * len(mask)
            for rows, matrix in by_length(mask, first, length, flat):
                for k, code, zero in zip(rows.tolist(), binary_rows(matrix.astype(item)), (~matrix.any(axis=1)).tolist()):
                    codes[k] = None if zero else code
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.binary())], names=["vec_id", "vector"])

    return run


_KEY = T.StructType([T.StructField("no_id", T.BooleanType()), T.StructField("id", T.LongType()), T.StructField("node", T.LongType())])


def _leaders(item: str, most: int, per_leader: int):
    schema = pa.schema([("shard", pa.int64()), ("leaders", pa.binary()), ("k", pa.int32()), ("octets", pa.int32())])

    def run(table: pa.Table) -> pa.Table:
        x = _units(_matrix(table.column("vector"), item)).astype(np.float32)
        want = min(most, max(2, -(-int(table.column("n")[0].as_py()) // per_leader)))
        picked = [x[0]]
        for v in x[1:]:
            if len(picked) == want:
                break
            if (np.array(picked) @ v).max() < APART:
                picked.append(v)
        centres = np.array(picked)
        for _ in range(4):
            nearest = (x @ centres.T).argmax(axis=1)
            total = np.zeros_like(centres)
            np.add.at(total, nearest, x)
            norm = np.linalg.norm(total, axis=1, keepdims=True)
            centres = np.where(norm > 0, total / np.where(norm > 0, norm, 1), centres)
        apart = [0]
        for k in range(1, len(centres)):
            if (centres[apart] @ centres[k]).max() < 0.95:
                apart.append(k)
        centres = centres[apart]
        return pa.table({"shard": table.column("shard")[:1], "leaders": pa.array([centres.astype("<f4").tobytes()], pa.binary()),
                         "k": pa.array([len(centres)], pa.int32()),
                         "octets": pa.array([len(table.column("vector")[0].as_py())], pa.int32())}).cast(schema)

    return run


def _assign(item: str, overlap: int, margin: float):
    """Rows (shard, salt, head, node, vector), heads first -> (shard, part, node, vector)."""
    schema = pa.schema([("shard", pa.int64()), ("part", pa.int32()), ("node", pa.int64()), ("vector", pa.binary())])

    def run(batches):
        centres, of = None, None
        for batch in batches:
            shards, heads = np.asarray(batch.column(0)), np.asarray(batch.column(1).is_valid())
            cuts = np.flatnonzero(np.concatenate([[True], (shards[1:] != shards[:-1]) | heads[1:] | heads[:-1], [True]]))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if heads[a]:
                    of, dim = shards[a], len(batch.column(3)[a].as_py()) // np.dtype(item).itemsize
                    centres = np.frombuffer(batch.column(1)[a].as_py(), "<f4").reshape(-1, dim)
                    continue
                if centres is None or of != shards[a]:
                    raise ValueError("a shard without leaders")
                vectors = batch.column(3).slice(a, b - a)
                sims = _units(_matrix(vectors, item)).astype(np.float32) @ centres.T
                top = np.argsort(-sims, axis=1)[:, :overlap]
                best = np.take_along_axis(sims, top, 1)
                row, k = np.nonzero(best >= best[:, :1] - margin)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shards[a:b][row]), pa.array(top[row, k].astype(np.int32)), batch.column(2).slice(a, b - a).take(pa.array(row)),
                     vectors.take(pa.array(row))], schema=schema)

    return run


def shards(spark: SparkSession, nodes: DataFrame, item: str, cap: int = CAP, overlap: int = OVERLAP, margin: float = MARGIN) -> DataFrame:
    """(shard, node, vector): overlapping shards of at most ``cap`` of ``nodes`` (node, vector).

    Vectors of different length share no shard.
    """
    placed = nodes.select(F.octet_length("vector").cast("long").alias("shard"), "node", "vector")
    done = None
    for level in range(LEVELS + 1):
        over = stored(spark, placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cap), "graph-over")
        if over.isEmpty():
            break
        fits = placed.join(over.select("shard"), "shard", "left_anti")
        wide = placed.join(over, "shard")
        hashed = Window.partitionBy("shard").orderBy(F.xxhash64("vector"), "node")
        sample = wide.withColumn("r", F.row_number().over(hashed)).where(F.col("r") <= FIT_ROWS).select("shard", "n", "vector")
        led = stored(spark, sample.groupBy("shard").applyInArrow(_leaders(item, LEADERS, cap // (2 * min(overlap, 3))),
                                                                 "shard long, leaders binary, k int, octets int"), "graph-leaders")
        loose = (F.col("k") > 1) & F.lit(level < LEVELS)
        salts = F.greatest(F.lit(1), F.ceil(F.col("n") / _SALT_ROWS)).cast("int")
        rows = wide.join(led.where(loose).select("shard"), "shard") \
            .select("shard", F.pmod(F.xxhash64("node"), salts).cast("int").alias("salt"), F.lit(None).cast("binary").alias("head"), "node", "vector")
        # the head of a shard's rows in each salt: its leaders, and a blank of a vector's length
        heads = led.where(loose).join(over, "shard") \
            .select("shard", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.col("leaders").alias("head"), F.lit(-1).cast("long").alias("node"),
                    F.expr("cast(repeat('0', octets) as binary)").alias("vector"))
        split = rows.union(heads).repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.col("head").isNull()) \
            .select("shard", "head", "node", "vector").mapInArrow(_assign(item, overlap, margin), "shard long, part int, node long, vector binary") \
            .select(F.xxhash64("shard", "part").alias("shard"), "node", "vector")
        half = cap // 2
        blocks = F.ceil(F.col("n") / F.lit(half * 0.9)).cast("int")                # hashed blocks vary in size
        tight = wide.join(led.where(~loose).select("shard"), "shard") \
            .withColumn("block", F.pmod(F.xxhash64("node", F.lit(level)), blocks).cast("int")) \
            .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))) \
            .select(F.xxhash64("shard", F.least("block", "other"), F.greatest("block", "other"), F.lit("pair")).alias("shard"), "node", "vector")
        fits = fits.union(tight)
        done = fits if done is None else done.union(fits)
        placed = stored(spark, split, "graph-shards")
    done = placed if done is None else done.union(placed)
    return stored(spark, done, "graph-placed")


# --- Spark: graph, links and result -------------------------------------------------

def _build_shard(item: str):
    schema = pa.schema([("node", pa.int64()), ("shard", pa.int64()), ("near", pa.list_(pa.int64()))])

    def run(table: pa.Table) -> pa.Table:
        nodes = table.column("node").to_numpy()
        edges, _ = build(_units(_matrix(table.column("vector"), item)).astype(np.float32))
        near = np.where(edges >= 0, nodes[edges], -1)
        lists = [row[ok].tolist() for row, ok in zip(near, edges >= 0)]
        return pa.table({"node": nodes, "shard": table.column("shard"), "near": pa.array(lists, pa.list_(pa.int64()))}).cast(schema)

    return run


def _search_shard(item: str, threshold: float):
    key = pa.struct([("no_id", pa.bool_()), ("id", pa.int64()), ("node", pa.int64())])
    schema = pa.schema([("key", key), ("n", pa.int64()), ("least", key)])

    def run(table: pa.Table) -> pa.Table:
        keys = table.column("key").to_pylist()
        order = sorted(range(len(keys)), key=lambda k: (keys[k]["no_id"], keys[k]["id"] or 0, keys[k]["node"]))
        table, keys = table.take(order), [keys[k] for k in order]           # the least row of a component is its least key
        nodes, shard = np.array([k["node"] for k in keys], np.int64), table.column("shard")[0].as_py()
        unit = _units(_matrix(table.column("vector"), item))
        near = table.column("near").combine_chunks()
        sizes, flat = np.diff(np.asarray(near.offsets)), np.asarray(near.flatten())
        by_node = np.argsort(nodes)
        at = np.minimum(np.searchsorted(nodes, flat, sorter=by_node), len(nodes) - 1)
        local = np.where(nodes[by_node[at]] == flat, by_node[at], -1)       # neighbours of other shards are left out here
        edges = np.full((len(nodes), int(sizes.max(initial=1))), -1, np.int64)
        row = np.repeat(np.arange(len(nodes)), sizes)
        edges[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = local
        edges = -np.sort(-edges, axis=1)
        edges = edges[:, :max(1, int((edges >= 0).sum(axis=1).max()))]
        medoid = int((unit @ unit.mean(axis=0)).argmax())
        found = links(unit, edges, medoid, threshold)
        lists = table.column("shards").combine_chunks()
        own, owner = np.asarray(lists.flatten()), np.repeat(np.arange(len(nodes)), np.diff(np.asarray(lists.offsets)))
        lower = own < shard
        names, place = np.unique(own[lower], return_inverse=True)
        member = np.zeros((len(nodes), len(names)), np.float32)
        member[owner[lower], place] = 1
        copies = table.column("copies").to_numpy().astype(np.int64)
        counts = np.zeros(len(nodes), np.int64)
        for a in range(0, len(nodes), _BATCH):
            counted = found[a:a + _BATCH] & ~(member[a:a + _BATCH] @ member.T > 0)
            row, col = np.nonzero(counted)
            np.add.at(counts, row + a, copies[col])
        label = least_of_component(found)
        some = np.flatnonzero(found.any(axis=1)).tolist()
        return pa.table({"key": pa.array([keys[k] for k in some], key), "n": pa.array(counts[some], pa.int64()),
                         "least": pa.array([keys[label[k]] for k in some], key)}).cast(schema)

    return run


def _audit(item: str, asked: dict[int, list[tuple[int, bytes]]], threshold: float):
    """Links of the asked vectors (by length in bytes) among a task's nodes."""
    def run(batches):
        total: dict[int, int] = {}
        for batch in batches:
            cells, copies = batch.column(1).to_pylist(), np.asarray(batch.column(0)).astype(np.int64)
            sizes = np.array([len(c) for c in cells])
            for octets, some in asked.items():
                rows = np.flatnonzero(sizes == octets)
                if len(rows):
                    mine = _units(np.frombuffer(b"".join(c for _, c in some), item).reshape(len(some), -1))
                    theirs = _units(np.frombuffer(b"".join(cells[k] for k in rows.tolist()), item).reshape(len(rows), -1))
                    got = (mine @ theirs.T >= threshold) @ copies[rows]
                    for (node, _), c in zip(some, got.tolist()):
                        total[node] = total.get(node, 0) + c
        if total:
            yield pa.RecordBatch.from_pydict({"node": pa.array(list(total), pa.int64()), "n": pa.array(list(total.values()), pa.int64())})

    return run


def _recall(spark: SparkSession, nodes: DataFrame, counted: DataFrame, item: str, threshold: float, rows: int) -> float:
    """Share of the links of a bounded sample of vectors, least hashes first, that ``counted`` (key, n) has."""
    sample = nodes.select("node", "copies", "vector").orderBy(F.xxhash64("vector"), "node").limit(rows).collect()       # rows vectors
    asked: dict[int, list[tuple[int, bytes]]] = {}
    for r in sample:
        asked.setdefault(len(r["vector"]), []).append((r["node"], bytes(r["vector"])))
    true = nodes.select("copies", "vector").mapInArrow(_audit(item, asked, threshold), "node long, n long") \
        .groupBy("node").agg(F.sum("n").alias("n")).collect()
    own = {r["node"]: r["copies"] for r in sample}
    want = sum(max(0, r["n"] - own[r["node"]]) for r in true)
    ids = list(own)
    got = counted.where(F.col("key.node").isin(ids)).agg(F.sum("n").alias("n")).first()["n"] or 0
    return min(1.0, got / want) if want else 1.0


def near_duplicates(spark: SparkSession, vectors: DataFrame, threshold: float = THRESHOLD, cap: int = CAP, overlap: int = OVERLAP,
                    margin: float = MARGIN, audit_rows: int = AUDIT_ROWS, recall: float = RECALL, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept, audit_recall.

    n_links counts the other rows linked directly, component_id is the least vec_id reachable
    by links (its own included), kept says that it is the row's own. Vectors that are null,
    empty or zero or hold null or non-finite entries, and vectors of different length, link
    with nothing; equal vectors always link; repeated rows stay; a null vec_id is the least
    only where all of a component are null; an empty table gives no rows; other columns are
    not read. audit_recall is the share of an audited sample's links that were found (1 where
    the sample has none); under ``recall`` the work is repeated with wider overlaps, and the
    last of three tries stands.
    """
    slim = typed(vectors, id_col, vector_col)
    item = "<f4" if slim.schema["vector"].dataType.elementType == T.FloatType() else "<f8"
    rows = stored(spark, slim.mapInArrow(_encode(item), "vec_id long, vector binary"), "graph-rows")
    distinct = rows.where(F.col("vector").isNotNull()).groupBy("vector") \
        .agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"))
    nodes = stored(spark, distinct.select(F.monotonically_increasing_id().alias("node"), "id", "copies", "vector"), "graph-nodes")
    key = F.struct(F.col("id").isNull().alias("no_id"), "id", "node").alias("key")
    for attempt in range(TRIES):
        placed = shards(spark, nodes.select("node", "vector"), item, cap, overlap + 2 * attempt, margin * (1 + attempt))
        graph = placed.groupBy("shard").applyInArrow(_build_shard(item), "node long, shard long, near array<long>")
        united = graph.groupBy("node").agg(F.collect_set("shard").alias("shards"), F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
        ready = stored(spark, united.join(nodes, "node").select(F.explode("shards").alias("shard"), key, "copies", "vector", "near", "shards"),
                       "graph-united")
        found = stored(spark, ready.groupBy("shard").applyInArrow(_search_shard(item, threshold), T.StructType([
            T.StructField("key", _KEY), T.StructField("n", T.LongType()), T.StructField("least", _KEY)])), "graph-found")
        counted = stored(spark, found.groupBy("key").agg(F.sum("n").alias("n")), "graph-counted")
        reached = _recall(spark, nodes, counted, item, threshold, audit_rows) if audit_rows else None
        if reached is None or reached >= recall:
            break
    joined = components(spark, found.select(F.col("key").alias("a"), F.col("least").alias("b")))
    told = nodes.join(counted.select(F.col("key.node").alias("node"), "n"), "node", "left") \
        .join(joined.select(F.col("node.node").alias("node"), F.col("root.id").alias("root"), F.lit(True).alias("linked")), "node", "left") \
        .select("vector", "copies", F.coalesce("n", F.lit(0)).alias("n"), F.when(F.col("linked"), F.col("root")).otherwise(F.col("id")).alias("root"))
    out = rows.join(told, "vector", "left")
    root = F.when(F.col("copies").isNull(), F.col("vec_id")).otherwise(F.col("root"))
    return out.select("vec_id", F.coalesce(F.col("n") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"), root.alias("component_id"),
                      F.col("vec_id").eqNullSafe(root).alias("kept"), F.lit(reached).cast("double").alias("audit_recall"))
