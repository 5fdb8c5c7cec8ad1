import hashlib
import random
import zlib

import numpy as np
import pytest
from llm_inputs import documents, edge_texts, prose

from microlake.llm import queries, runs, vector_graph, whitening
from microlake.llm.common import table

VECTOR_SCHEMA = "vec_id long, embedding array<float>, label int, vector string, node string, shard string, n int, x string, component int"


def vectors(spark, rows):
    """Rows (vec_id, vector) with clashing extra columns."""
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "a", "b", "c", 2, "d", 3)
                                  for i, v in rows], VECTOR_SCHEMA).repartition(3)


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


# --- whitening ----------------------------------------------------------------------

def eigen(x):
    q = np.unique(np.floor(256 * np.asarray(x, np.float32).astype(float)), axis=0)
    c = q - q.mean(axis=0)
    e, v = np.linalg.eigh(c.T @ c / len(q))
    return q, e[::-1], v[:, ::-1]


def same_as_eigen(rows, x, components, unique=True):
    q, e, v = eigen(x)
    n, s = len(q), q.sum(axis=0)
    got = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(got) == len(rows) == len(x) * components
    ints = np.floor(256 * np.asarray(x, np.float32).astype(float))
    for k in range(components):
        white = np.array([got[i, k + 1]["whitened"] for i in range(len(x))])
        want = (ints - s / n) @ v[:, k] / np.sqrt(e[k])
        if unique:
            assert np.abs(white - want * np.sign(white @ want)).max() < 1e-9
        assert abs(got[0, k + 1]["explained"] - e[k] / e.sum()) < 1e-12
    for i in range(len(x)):
        assert got[i, 1]["deviation"] == int(((n * ints[i] - s) ** 2).sum())
    assert {r["n"] for r in rows} == {n} and all(r["identity_error"] < 1e-9 for r in rows)


def test_whitening_equals_the_covariance_eigenvectors(spark):
    rng = np.random.default_rng(4)
    x = (rng.standard_normal((400, 12)) * np.linspace(2, 0.2, 12)).astype(np.float32)
    x = np.vstack([x, x[:30]])                              # repeated vectors count once in the fit
    same_as_eigen(whitening.whiten(spark, vectors(spark, enumerate(x))).collect(), x, 4)


def test_whitening_finds_equal_eigenvalues(spark):
    d = np.array([5, 5, 5, 3, 2.5, 2, 1, 1, 1, 1])
    x = np.vstack([np.diag(d), -np.diag(d)])
    same_as_eigen(whitening.whiten(spark, vectors(spark, enumerate(x)), components=5).collect(), x, 5, unique=False)


def test_whitening_of_few_dimensions_ranks_and_rows(spark):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((50, 3)) @ rng.standard_normal((3, 9))
    q, e, _ = eigen(x[:3])
    rows = whitening.whiten(spark, vectors(spark, enumerate(x[:3]))).collect()
    assert len(rows) == 3 * 2                               # three rows span two directions about their mean
    assert abs(sum(r["explained"] for r in rows if r["vec_id"] == 0) - 1) < 1e-12
    assert whitening.whiten(spark, vectors(spark, enumerate(x[:1]))).count() == 0
    assert whitening.whiten(spark, vectors(spark, [(1, [1, 2]), (2, [1, 2])])).count() == 0
    assert whitening.whiten(spark, vectors(spark, enumerate(x)).limit(0)).schema.fieldNames() == \
        ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_whitening_leaves_out_what_it_cannot_use(spark):
    rng = np.random.default_rng(7)
    x = rng.standard_normal((40, 4)).astype(np.float32)
    odd = [(100, None), (101, []), (102, [1, None, 2, 3]), (103, [float("nan"), 1, 2, 3]), (104, [float("inf"), 1, 2, 3]), (105, [1, 2, 3])]
    rows = whitening.whiten(spark, vectors(spark, [*enumerate(x), *odd, (None, x[0]), (5, x[5])])).collect()
    assert len(rows) == 4 * 42 and sum(r["vec_id"] is None for r in rows) == 4
    once = {(r["vec_id"], r["component"]): r for r in rows if r["vec_id"] is not None}          # row 5 stands twice
    same_as_eigen(list(once.values()), x, 4)
    assert {r["n"] for r in rows} == {40}
    assert not {r["vec_id"] for r in rows} & set(range(100, 106))


def test_whitening_of_huge_entries(spark):
    x = np.array([[1e300, 0], [-1e300, 1], [3e9, 2], [0, 5]])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = {(r["vec_id"], r["component"]): r for r in whitening.whiten(spark, df).collect()}
    assert rows[0, 1]["deviation"] is None and rows[3, 1]["n"] == 4


# --- near-duplicate vectors ---------------------------------------------------------

def linked(rows):
    """n_links and component by all pairs."""
    ok = [k for k, (_, v) in enumerate(rows) if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    n_links, group = [0] * len(rows), list(range(len(rows)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for length in {len(rows[k][1]) for k in ok}:
        mine = [k for k in ok if len(rows[k][1]) == length]
        u = unit(np.array([rows[k][1] for k in mine], np.float32).astype(float))
        close = u @ u.T >= 0.9
        for a, k in enumerate(mine):
            n_links[k] = int(close[a].sum()) - 1
            for b in np.flatnonzero(close[a]):
                x, y = root(k), root(mine[b])
                group[max(x, y)] = min(x, y)
    least = {}
    for k, (i, _) in enumerate(rows):
        r = root(k)
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return sorted(((i, n_links[k], least[root(k)]) for k, (i, _) in enumerate(rows)), key=str)


def clusters(rng, groups, dim=16):
    out = []
    for size, spread in groups:
        centre = rng.standard_normal(dim)
        out += [centre + spread * rng.standard_normal(dim) for _ in range(size)]
    return [v.astype(np.float32).tolist() for v in out]


@pytest.mark.parametrize("cap", [64, 4096])
def test_vector_links_equal_all_pairs(spark, cap):
    rng = np.random.default_rng(11)
    found = clusters(rng, [(1, 0)] * 150 + [(2, 0.1)] * 40 + [(90, 0.12), (200, 0.02), (30, 0.3), (30, 0.4)])
    rows = list(enumerate(found)) + [(10_000 + k, found[k % 3]) for k in range(40)]             # many copies of three
    rows += [(20_000, None), (20_001, []), (20_002, [0.0] * 16), (20_003, [1, None] * 8), (20_004, [float("nan")] * 16),
             (20_005, [1.0, 2.0]), (20_006, [1.0, 2.0]), (None, found[5]), (None, None), (20_007, found[7]), (20_007, found[400])]
    rng.shuffle(rows)
    got = vector_graph.near_duplicates(spark, vectors(spark, rows), cap=cap).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=str) == linked(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got) and {r["audit_recall"] for r in got} == {1.0}


def test_vector_links_of_nothing(spark):
    assert vector_graph.near_duplicates(spark, vectors(spark, [(1, [1.0])]).limit(0)).count() == 0
    rows = vector_graph.near_duplicates(spark, vectors(spark, [(1, [1.0, 0.0]), (2, None)])).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in rows) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_one_spot_of_distinct_vectors_is_cut_into_blocks(spark):
    rng = np.random.default_rng(12)
    rows = list(enumerate(clusters(rng, [(500, 0.03)], 8)))
    got = vector_graph.near_duplicates(spark, vectors(spark, rows), cap=128).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(499, 0)}


def test_graph_reaches_pairs_just_over_the_threshold():
    rng = np.random.default_rng(13)
    p = unit(rng.standard_normal((500, 64)))
    r = rng.standard_normal(p.shape)
    r = unit(r - (r * p).sum(axis=1, keepdims=True) * p)
    x = np.vstack([p, 0.901 * p + np.sqrt(1 - 0.901 ** 2) * r])[rng.permutation(1000)]
    edges, medoid = vector_graph.build(x.astype(np.float32))
    true = x @ x.T >= 0.9
    np.fill_diagonal(true, False)
    found = vector_graph.links(x, edges, medoid)
    assert (edges >= 0).sum(axis=1).max() <= vector_graph.DEGREE and not (found & ~true).any()
    assert found.sum() >= 0.99 * true.sum()


# --- runs ---------------------------------------------------------------------------

def plain_runs(w, least=6, times=4):
    """Every run by trying every period."""
    n, out = len(w), set()
    for q in range(1, n // times + 1):
        i = 0
        while i < n - q:
            if w[i] == w[i + q]:
                j = i
                while j < n - q and w[j] == w[j + q]:
                    j += 1
                smaller = any(all(w[t] == w[t + r] for t in range(i, j + q - r)) for r in range(1, q))
                if j + q - i >= max(least, times * q) and not smaller:
                    out.add((i, j + q - i, q))
                i = j
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    rng = random.Random(3)
    for _ in range(1500):
        n, k = rng.randint(0, 90), rng.choice([1, 2, 2, 3, 5])
        w = [rng.randrange(k) for _ in range(n)]
        for _ in range(rng.randint(0, 3)):
            a, p = rng.randrange(n + 1), rng.randint(1, 9)
            for i in range(a, min(n, a + rng.randint(1, 60))):
                if i >= p:
                    w[i] = w[i - p]
        assert runs.find_runs(np.array(w, np.int64)) == plain_runs(w), w
    with pytest.raises(ValueError):
        runs.find_runs(np.zeros(9, np.int64), times=3)


def test_long_runs_take_no_square_time():
    w = np.arange(200_000) % 40_000
    assert runs.find_runs(w) == [(0, 200_000, 40_000)]
    assert runs.find_runs(np.zeros(200_000, np.int64)) == [(0, 200_000, 1)]


def test_periodic_runs(spark):
    texts = edge_texts() + ["a b a b a b a b c", "x " * 30, "no run here at all", "p q r " * 5 + "end end end end end end"]
    rows = sorted(runs.periodic_runs(documents(spark, texts, [*range(len(texts) - 1), None])).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"]))
    for text, row in zip(texts, rows):
        words = (text or "").encode().split()
        want = plain_runs(words) if len(words) < 200 else [(r["start"], r["length"], r["period"]) for r in row["runs"]]
        assert [(r["start"], r["length"], r["period"]) for r in row["runs"]] == want and row["n_words"] == len(words)
        gone = {k for s, n, q in want for k in range(s + q, s + n)}
        assert row["collapsed"] == b" ".join(w for k, w in enumerate(words) if k not in gone).decode()
    assert rows[-4]["collapsed"] == "a b c" and rows[-1]["collapsed"] == "p q r end" and rows[-1]["doc_id"] is None
    assert runs.periodic_runs(documents(spark, ["a"]).limit(0)).count() == 0


def test_op13_equals_the_contract(spark):
    rng = random.Random(8)
    texts = edge_texts()[:-4] + [prose(rng, rng.randint(1, 120)) for _ in range(150)] + ["solo"] * 20
    texts = [t if t is None or len(t) < 5000 else t[:900] for t in texts]
    docs = documents(spark, texts, [None if k == 2 else k for k in range(len(texts))])
    found = {}
    for r in runs.periodic_runs(queries.with_periods(docs)).collect():
        found[r["doc_id"]] = [(x["start"], x["length"], x["period"]) for x in r["runs"]]
    planted = 0
    for k, text in enumerate(texts):
        i = None if k == 2 else k
        words = (text or "").encode().split()
        h, n = zlib.crc32(str(i).encode()), len(words)
        g = h // 10
        if i is not None and h % 10 == 0 and n:
            a, original = g % n, list(words)
            p = 1 + (n - a) // (3 + g % 8)
            words = [original[a + (j - a) % p] if j >= a else w for j, w in enumerate(words)]
            planted += 1
        assert found[i] == plain_runs(words), k
    assert planted > 10


def test_op13_digests(spark):
    rows = {r["doc_id"]: r for r in queries.op13_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    texts = {r["doc_id"]: r for r in runs.periodic_runs(queries.with_periods(table(spark, "/root/testdata/sf0.001", "documents"))).collect()}
    assert rows.keys() == texts.keys()
    some = 0
    for i, r in rows.items():
        listed = [(x["start"], x["length"], x["period"]) for x in texts[i]["runs"]]
        best = min(listed, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        some += bool(listed)
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(listed), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if listed else None)
        assert r["runs_sha256"] == hashlib.sha256("".join("%d,%d,%d\n" % x for x in listed).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(texts[i]["collapsed"].encode()).hexdigest()
    assert some
