"""A key holding over a third of the rows: results stay exact (checked against a
pandas brute force on a small fixture) and aggregation is partial before shuffling."""
from decimal import Decimal

import pandas as pd
from pyspark.sql import functions as F

from microlake.operators import dims, joins, marts, windows
from microlake.plans import inspect
from microlake.queries import inputs

SF = "/root/testdata/sf0.001"


def _skewed_silver(spark):
    s = inputs.silver(spark, SF)
    hot = s.withColumn("cod_uf", F.lit("26")).withColumn("ano", F.lit(1996))
    return s.unionByName(hot)        # the (1996, '26') group now holds > 1/2 of all rows


def test_hot_group_marts_are_exact(spark):
    s = _skewed_silver(spark)
    emp = marts.employment(marts.active(s), dims.state_dim(spark))
    got = {(r["ano"], r["cod_uf"]): (r["qtd_vinculos"], r["massa_salarial_dez_nom"]) for r in emp.collect()}
    pdf = s.filter("vinculo_ativo").select("ano", "cod_uf", "remun_dezembro_nom").toPandas()
    pdf["cod_uf"] = pdf["cod_uf"].fillna("<null>")
    def sql_sum(x):            # SQL sum: NULLs ignored, all-NULL gives NULL
        vals = [v for v in x if v is not None]
        return sum(vals) if vals else None

    exp = pdf.groupby(["ano", "cod_uf"]).agg(n=("remun_dezembro_nom", "size"),
                                            m=("remun_dezembro_nom", sql_sum))
    exp_d = {(a, None if u == "<null>" else u): (int(r.n), None if r.m is None else Decimal(r.m))
             for (a, u), r in exp.iterrows()}
    assert got == exp_d
    total = s.count()
    assert got[(1996, "26")][0] > 0 and s.filter("ano = 1996 AND cod_uf = '26'").count() * 3 > total


def test_aggregates_are_partial_before_the_shuffle(spark):
    s = _skewed_silver(spark)
    for df in (marts.employment(marts.active(s), dims.state_dim(spark)),
               marts.separation(s, dims.state_dim(spark)),
               windows.latest_per_key(s.withColumn("t", F.lit(1)), ["cod_uf"], "ano", "t", ["idade"])):
        plan = inspect.plan_text(df)
        assert "partial_" in plan, plan


def test_hot_key_group_stat_and_top1(spark):
    base = spark.createDataFrame([(1 if i % 3 else i, i % 7, float(i)) for i in range(300)],
                                 "k int, g int, v double")
    per_row = windows.group_stat_per_row(base, "k", F.avg("v"), "media").toPandas()
    pdf = base.toPandas()
    exp = pdf.groupby("k")["v"].mean()
    assert all(abs(r.media - exp[r.k]) < 1e-9 for r in per_row.itertuples())
    assert len(per_row) == 300
    top = joins.top1_via_join(base, "k", "v").toPandas()
    exp_top = pdf[pdf.v == pdf.groupby("k")["v"].transform("max")]
    assert sorted(map(tuple, top[["k", "v"]].values)) == sorted(map(tuple, exp_top[["k", "v"]].values))


def test_join_kind_counts_match_pandas(spark):
    left = spark.createDataFrame([(1,)] * 50 + [(2,), (3,), (None,)], "k int")
    right = spark.createDataFrame([(1,)] * 3 + [(3,), (4,), (None,)], "k int")
    got = {r["tipo"]: r["qtd"] for r in joins.join_kind_counts(left, right, "k", "k").collect()}
    lp, rp = left.toPandas(), right.toPandas()
    inner = len(lp.dropna().merge(rp.dropna(), on="k"))
    assert got["inner"] == inner == 151
    assert got["left"] == inner + 2 and got["right"] == inner + 2 and got["full"] == inner + 4
    assert got["left_semi"] == 51 and got["left_anti"] == 2


def test_ranks_at_scale_equal_window_ranks_on_a_hot_group(spark):
    base = spark.createDataFrame([(0 if i % 3 else i, (i * 7) % 11, i) for i in range(600)]
                                 + [(None, 5, 1000), (None, None, 1001)], "g int, v int, id int")
    a = windows.rank_variants(base, ["g"], [F.col("v").desc()]).drop("row_number")
    b = windows.ranks_at_scale(base, ["g"], [("v", True)], partitions=5)
    r = multiset_difference_cols(a, b)
    assert r["iguais"], r


def multiset_difference_cols(a, b):
    from microlake.operators.compare import multiset_difference
    return multiset_difference(a.select(*b.columns), b).first()


def test_ranks_do_not_hang_on_exchange_reuse(spark):
    """Range bounds are sampled: both branches must read one written cut."""
    from microlake.operators import windows
    rows = spark.range(400_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'a' WHEN id % 7 = 0 THEN NULL ELSE 'b' END AS g",
                                           "CAST(xxhash64(id) % 5000 AS INT) AS v")
    old = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = windows.ranks_at_scale(rows, ["g"], [("v", True)], partitions=16).distinct()
        want = windows.rank_variants(rows, ["g"], [windows.F.col("v").desc()]).select("g", "v", "rank", "dense_rank").distinct()
        assert got.select(*want.columns).exceptAll(want).count() == 0 and got.count() == want.count()
    finally:
        spark.conf.set("spark.sql.exchange.reuse", old)
