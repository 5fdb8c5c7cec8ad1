import random
import re

import numpy as np
import pytest
import xxhash
from llm_inputs import documents, edge_texts, prose

from microlake.llm import simhash
from microlake.llm.components import components


def slow_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[k:k + 4]) for k in range(len(words) - 3)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(values, distance):
    """Least index reachable for each value, by all pairs."""
    arr, root = np.array(values, dtype=np.uint64), list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(arr)):
        for b in np.flatnonzero(np.bitwise_count(arr ^ arr[a]) <= distance).tolist():
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return [find(x) for x in range(len(arr))]


def test_fingerprint():
    rng = random.Random(3)
    for text in [*edge_texts()[:8], *edge_texts()[9:], *(prose(rng, n) for n in (1, 2, 3, 4, 5, 90)), "A b\x0bC\x1cd É"]:
        assert simhash.fingerprint(text) == slow_fingerprint(text)


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 4, 5, 7])
def test_every_pair_within_the_distance_shares_a_key(distance):
    rng = random.Random(distance)
    masks = [m for _, m in simhash.key_masks(distance)]
    budgets = [(k + 1) * distance // (distance + 1) for k in range(distance + 1)]
    segments = simhash.ring(distance)
    assert sum(segments) == (1 << 64) - 1
    for _ in range(4000):
        x = sum(1 << b for b in rng.sample(range(64), rng.randint(0, distance)))
        starts = [s for s, m in simhash.key_masks(distance) if not x & m]
        assert any(not x & m for m in masks)
        assert any(all(sum((x & segments[(s + j) % len(segments)]).bit_count() for j in range(k + 1)) <= b
                       for k, b in enumerate(budgets)) for s in starts)


def cluster(rng, n):
    """A dense group whose members differ in few bits of one centre, and strangers."""
    centre, out = rng.getrandbits(64), set()
    while len(out) < n:
        out.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
    return sorted(out | {rng.getrandbits(64) for _ in range(n // 2)})


@pytest.mark.parametrize("heavy_run", [8, 40, 4096])
def test_links_connect_what_is_near_and_nothing_else(spark, heavy_run):
    values = cluster(random.Random(heavy_run), 500)
    marks = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long")
    got = simhash.links(spark, marks, 4, heavy_run)
    pairs = {(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in got.collect()}
    assert all((a ^ b).bit_count() <= 4 for a, b in pairs)
    place = {v: k for k, v in enumerate(values)}
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(place[a]), find(place[b])
        root[max(x, y)] = min(x, y)
    assert [find(x) for x in range(len(values))] == classes(values, 4)
    if heavy_run == 4096:       # all links of short runs, forests of longer ones: never all pairs
        assert got.count() <= 15 * 8 * len(values)


def test_near_duplicates(spark):
    rng = random.Random(11)
    base = prose(rng, 300)
    near = [base.replace(" ", "  ", k) + " end" * (k % 3) for k in range(6)]
    texts = edge_texts() + near + [base] * 20 + [prose(rng, 60) for _ in range(30)]
    rows = simhash.near_duplicates(spark, documents(spark, texts)).collect()
    assert len(rows) == len(texts)
    marks = [slow_fingerprint(t) if len(t or "") < 100_000 else simhash.fingerprint(t) for t in texts]
    want = classes(marks, 4)
    for r in rows:
        assert r["fingerprint"] == f"{marks[r['doc_id']]:016x}"
        assert r["component_id"] == want[r["doc_id"]]


def test_near_duplicates_with_null_and_repeated_ids(spark):
    docs = documents(spark, ["a b c d e", "a b c d e", "a b c d e", None, ""], [None, 9, 9, None, None])
    got = sorted((r["component_id"] is None, r["component_id"], r["doc_id"]) for r in simhash.near_duplicates(spark, docs).collect()
                 if r["doc_id"] is not None)
    assert got == [(False, 9, 9), (False, 9, 9)]
    assert simhash.near_duplicates(spark, docs).where("component_id IS NULL").count() == 2
    assert simhash.near_duplicates(spark, docs.limit(0)).count() == 0


def test_keep_one(spark):
    rng = random.Random(4)
    base = prose(rng, 200)
    texts = [base, base, base + " more", "lone text here now", None, "", base]
    docs = documents(spark, texts, [5, 3, 8, 1, 2, None, 3])
    kept = simhash.keep_one(spark, docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3]
    assert simhash.keep_one(spark, docs.limit(0)).count() == 0
    twice = simhash.keep_one(spark, kept)
    assert sorted(r["doc_id"] for r in twice.collect()) == [1, 2, 3]


def test_components_of_a_long_path_and_a_hub(spark):
    path = [(k, k + 1) for k in range(100, 160)]
    hub = [(7, k) for k in range(1000, 1200)]
    links = spark.createDataFrame(path + hub + [(3, 3), (None, 4), (159, 100)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(spark, links).collect()}
    assert got == {**{k: 100 for k in range(100, 161)}, 7: 7, **{k: 7 for k in range(1000, 1200)}}
    assert components(spark, links.limit(0)).count() == 0


def test_longer_keys_lose_no_pair():
    rng = np.random.default_rng(9)
    for more in range(4):
        masks = simhash.key_masks(4, more)
        for _ in range(400):
            a = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
            b = a
            for k in rng.choice(64, 4, replace=False).tolist():
                b ^= 1 << k
            assert any((a ^ b) & mask == 0 for _, mask in masks)
    assert [len(simhash.key_masks(4, k)) for k in range(4)] == [15, 30, 50, 75]
    assert simhash.more_parts(4, 1 << 20) == 0 and 0 < simhash.more_parts(4, 1 << 30) <= 2 < simhash.more_parts(4, 1 << 35)


def test_links_of_a_heavy_run_grow_with_its_rows(spark):
    # all alike in 48 bits, so even the longest keys are heavy; the rest lies in 16 bits, where many are close
    rng = np.random.default_rng(10)
    fps = rng.choice(1 << 16, 8_000, replace=False).astype(np.int64) << 44
    counts = []
    for n in (2_000, 8_000):
        marks = spark.createDataFrame([(int(x),) for x in fps[:n]], "fp long")
        got = simhash.links(spark, marks, heavy_run=512)
        counts.append(got.count())
        assert got.where("bit_count(a ^ b) > 4").isEmpty()
        linked = {r["node"]: r["root"] for r in components(spark, got).collect()}
        assert len(linked) == n and set(linked.values()) == {int(min(fps[:n]))}
    assert counts[1] < 5 * counts[0]
