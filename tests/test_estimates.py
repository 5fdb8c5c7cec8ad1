"""Sketches, samples, drift, digests and complementary suppression against plain computations."""
import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from microlake.operators import digests, disclosure, estimates
from microlake.sinks import tables


# --- sketches ---------------------------------------------------------------------------

def test_merged_sketches_give_medians_within_the_bound(spark):
    rng = random.Random(1)
    rows = [(g, s, rng.lognormvariate(0, 1) if g != "none" else None) for g in ("a", "b", "none") for s in range(9) for _ in range(400 * (s + 1))]
    df = spark.createDataFrame(rows, "g string, s int, v double").repartition(5)
    facts = estimates.sketch_facts(df, "v", ["g", "s"])
    found = {r["g"]: r for r in estimates.rank_within(estimates.merged_quantile(facts, ["g"]), df, "v", ["g"]).collect()}
    assert found["none"]["quantil"] is None and found["none"]["qtd_valor"] == 0
    for g in ("a", "b"):
        v = sorted(x for k, _, x in rows if k == g)
        rank = sum(x < found[g]["quantil"] for x in v) / len(v)
        assert abs(rank - 0.5) <= estimates.RANK_ERROR and found[g]["ok"] and found[g]["qtd"] == len(v)
    wrong = estimates.rank_within(estimates.merged_quantile(facts, ["g"], 0.55), df, "v", ["g"]).where("g = 'a'").first()
    assert not wrong["ok"] and 0.03 < wrong["erro_posto"] < 0.07


# --- samples ----------------------------------------------------------------------------

def test_stratified_sample_is_exact_mergeable_and_blind_to_order(spark):
    rows = [("hot" if k % 3 else f"s{k % 7}", k, k % 5) for k in range(3000)] + [(None, k, 0) for k in range(3)] + [("hot", 7, 2), ("hot", 7, 1)]
    df = spark.createDataFrame(rows, "s string, id int, x int")
    want = defaultdict(list)
    for s, i, x in rows:
        want[s].append((hashlib.md5(f"42|{i}".encode()).hexdigest(), i, x))
    want = {s: sorted(v)[:20] for s, v in want.items()}
    for parts in (1, 7):
        got = defaultdict(list)
        for r in estimates.stratified_sample(df.repartition(parts).orderBy(F.rand()), ["s"], ["id"], 20).collect():
            got[r["s"]].append((hashlib.md5(f"42|{r['id']}".encode()).hexdigest(), r["id"], r["x"]))
        assert {s: sorted(v) for s, v in got.items()} == want
    halves = [estimates.stratified_sample(df.where(c), ["s"], ["id"], 20) for c in ("id % 2 = 0", "id % 2 <> 0")]
    merged = estimates.merge_samples(halves[0].union(halves[1]), ["s"], ["id"], 20)
    whole = estimates.stratified_sample(df, ["s"], ["id"], 20)
    assert merged.exceptAll(whole).isEmpty() and merged.count() == whole.count()
    assert "WindowGroupLimit" in whole._jdf.queryExecution().executedPlan().toString()


# --- drift ------------------------------------------------------------------------------

def test_drift_sees_shifts_nulls_and_missing_groups(spark):
    old = [(y, float(k % 10), "x" if k % 2 else "y") for y in (1, 2, 3) for k in range(100)]
    new = [(1, v, c) for y, v, c in old if y == 1]                                              # as before
    new += [(2, v + 5 if v < 5 else v, None if v == 0 else c) for y, v, c in old if y == 2]      # shifted; a tenth NULL
    new += [(4, 1.0, "x")]
    a, b = (estimates.column_profile(spark.createDataFrame(r, "g int, v double, c string"), {"v": (0.0, 10.0)}, ["c"], ["g"], 10) for r in (old, new))
    got = {(r["g"], r["coluna"]): r for r in estimates.profile_drift(a, b, ["g"], 0.1, 0.05).collect()}
    assert got[1, "v"]["ok"] and got[1, "v"]["distancia"] == 0 and got[1, "c"]["ok"]
    assert abs(got[2, "v"]["distancia"] - 0.5) < 1e-9 and not got[2, "v"]["ok"]
    assert abs(got[2, "c"]["nulos_depois"] - 0.1) < 1e-9 and not got[2, "c"]["ok"]
    assert not got[3, "v"]["ok"] and got[3, "v"]["nulos_depois"] is None and not got[4, "c"]["ok"]


def test_profile_bins(spark):
    rows = [(-1.0,), (0.0,), (9.99,), (10.0,), (11.0,), (None,)]
    got = {r["faixa"]: r["qtd"] for r in estimates.column_profile(spark.createDataFrame(rows, "v double"), {"v": (0.0, 10.0)}, [], [], 10).collect()}
    assert got == {"abaixo": 1, "0": 1, "9": 2, "acima": 1, "nulo": 1}


# --- digests ----------------------------------------------------------------------------

def test_digest_comparison_equals_the_full_join(spark, tmp_dir):
    rng = random.Random(3)
    old = [(k, rng.choice([None, "a", "b"]), k % 4 + 2000) for k in range(2000)]
    new = {k: (k, v, y) for k, v, y in old}
    for k in rng.sample(range(2000), 30):
        new[k] = (k, rng.choice([None, "c"]), new[k][2])
    del new[5], new[17]
    new[9] = (9, "moved", 2000 + (new[9][2] - 2000 + 1) % 4)
    new[5000] = (5000, None, 2003)
    for name, rows in (("a", old), ("b", list(new.values()))):
        tables.write_table(spark.createDataFrame(rows, "k int, v string, ano int"), f"{tmp_dir}/{name}")
        digests.write_digests(spark, f"{tmp_dir}/{name}", f"{tmp_dir}/d{name}", ["k"], 64)
    full = tables.compare_versions(*[tables.read_table(spark, f"{tmp_dir}/{n}") for n in "ab"], ["k"])
    fast = digests.compare_by_digest(spark, f"{tmp_dir}/a", f"{tmp_dir}/b", f"{tmp_dir}/da", f"{tmp_dir}/db", ["k"])
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, full.collect()))
    differ = digests.differing_buckets(spark, f"{tmp_dir}/da", f"{tmp_dir}/db").count()
    assert 25 <= differ <= 40
    same = digests.compare_by_digest(spark, f"{tmp_dir}/a", f"{tmp_dir}/a", f"{tmp_dir}/da", f"{tmp_dir}/da", ["k"])
    nulls = sum(v is None for _, v, _ in old)
    assert {r["coluna"]: (r["alteradas"], r["nulos_antes"], r["nulos_depois"], r["so_antes"]) for r in same.collect()} == \
        {"v": (0, nulls, nulls, 0), "ano": (0, 0, 0, 0)}
    digests.write_digests(spark, f"{tmp_dir}/b", f"{tmp_dir}/other", ["k"], 32)
    with pytest.raises(ValueError):
        digests.compare_by_digest(spark, f"{tmp_dir}/a", f"{tmp_dir}/b", f"{tmp_dir}/da", f"{tmp_dir}/other", ["k"])


def test_only_differing_partitions_are_read(spark, tmp_dir):
    rows = [(k, "a", k % 4 + 2000) for k in range(400)]
    for name, change in (("a", 0), ("b", 1)):
        tables.write_table(spark.createDataFrame([(k, "z" if change and k == 6 else v, y) for k, v, y in rows], "k int, v string, ano int"),
                           f"{tmp_dir}/{name}")
        digests.write_digests(spark, f"{tmp_dir}/{name}", f"{tmp_dir}/d{name}", ["k"], 16)
    out = digests.compare_by_digest(spark, f"{tmp_dir}/a", f"{tmp_dir}/b", f"{tmp_dir}/da", f"{tmp_dir}/db", ["k"])
    assert {r["coluna"]: r["alteradas"] for r in out.collect()} == {"v": 1, "ano": 0}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan and "(ano#" in plan and "= 2002)" in plan


# --- complementary suppression ----------------------------------------------------------

def determined(rows):
    """Withheld cells whose value the published cells and totals fix: those in which no vector of the null space moves."""
    withheld = [r for r in rows if r["supressao"]]
    if not withheld:
        return []
    lines = [[(w["g"], w["y"]) == key for w in withheld] for key in {(r["g"], r["y"]) for r in rows if r["total_grupo_publicado"]}]
    lines += [[w["u"] == u for w in withheld] for u in {r["u"] for r in rows if r["total_unidade_publicado"]}]
    if not lines:
        return []
    a = np.array(lines, float)
    _, s, v = np.linalg.svd(a)
    null = v[int((s > 1e-9).sum()):]
    return [w for k, w in enumerate(withheld) if not len(null) or np.abs(null[:, k]).max() < 1e-9]


@pytest.mark.parametrize("seed", range(4))
def test_no_withheld_cell_follows_from_the_totals(spark, seed):
    rng = random.Random(seed)
    rows = [(g, f"{g}{u}", y, rng.choice([3, 8, 40, 90, 500])) for g, units in (("n", 4), ("s", 2), ("x", 1), ("c", 3))
            for u in range(units) for y in range(2000, 2000 + rng.randint(1, 6)) if rng.random() < 0.85]
    rows += [(None, None, 2000, 2), (None, "q", 2000, 50), ("y", "y0", 2000, 5)]
    df = spark.createDataFrame(rows, "g string, u string, y int, n int")
    got = disclosure.suppress(df, "g", "u", "y", "n", 10).collect()
    assert len(got) == len(rows) and not determined(got) and not any(r["recuperavel"] for r in got)
    assert all((r["supressao"] == "primaria") == (r["n"] < 10) for r in got)
    assert any(r["supressao"] == "complementar" for r in got)


def test_the_cheapest_rectangle_is_taken_and_a_lone_cell_hides_its_totals(spark):
    n = {("a", 1): 5, ("b", 1): 50, ("c", 1): 60, ("a", 2): 70, ("b", 2): 500, ("c", 2): 20}
    df = spark.createDataFrame([("g", u, y, v) for (u, y), v in n.items()] + [("lone", "z", 1, 4), ("lone", "z", 2, 40)], "g string, u string, y int, n int")
    got = {(r["u"], r["y"]): r for r in disclosure.suppress(df, "g", "u", "y", "n", 10).collect()}
    assert {k for k, r in got.items() if r["supressao"]} == {("a", 1), ("c", 1), ("a", 2), ("c", 2), ("z", 1)}
    assert not got["z", 1]["total_grupo_publicado"] and not got["z", 2]["total_unidade_publicado"] and got["z", 2]["total_grupo_publicado"]
    assert disclosure.suppress(df.limit(0), "g", "u", "y", "n", 10).count() == 0
