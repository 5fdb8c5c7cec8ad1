"""Plan shape: broadcasts, shuffles, pushdown, pruning, ranked filter."""
from pyspark.sql import functions as F

from microlake.operators import dims, marts, windows
from microlake.plans import inspect
from microlake.queries import inputs
from microlake.sinks import tables

SF = "/root/testdata/sf0.001"


def test_marts_broadcast_the_dimension_and_shuffle_once(spark):
    s = inputs.silver(spark, SF)
    emp = marts.employment(marts.active(s), dims.state_dim(spark))
    assert inspect.uses_broadcast_join(emp)
    assert "HashAggregate" in inspect.plan_text(emp) or "ObjectHashAggregate" in inspect.plan_text(emp)


def test_active_filter_and_columns_reach_the_scan(spark):
    s = inputs.silver(spark, SF)
    emp = marts.employment(marts.active(s), dims.state_dim(spark))
    schemas = " ".join(inspect.read_schemas(emp))
    assert "l_linestatus" in schemas and "l_comment" not in schemas and "l_discount" not in schemas
    assert "o_totalprice" not in schemas


def test_label_join_has_no_shuffle(spark):
    people = spark.createDataFrame([("26", 1)], "cod_uf string, x int")
    assert not inspect.has_shuffle(dims.label(people, dims.state_dim(spark), "cod_uf"))


def test_top_industry_uses_window_group_limit(spark):
    s = inputs.silver(spark, SF)
    top = marts.top_industry(marts.active(s), dims.state_dim(spark), 10)
    top.collect()
    assert inspect.has_window_group_limit(top)


def test_partition_pruning(spark, tmp_dir):
    path = tmp_dir + "/p"
    df = spark.range(100).select("id", (F.col("id") % 3 + 2020).cast("int").alias("ano"))
    tables.write_table(df, path)
    q = tables.read_table(spark, path).filter(F.col("ano") == 2021)
    assert inspect.partition_filters(q)
    assert q.count() == 33


def test_latest_per_key_is_an_aggregate(spark):
    h = spark.createDataFrame([(1, "c", 10, "e1", "x"), (1, "c", 20, "e2", "y"), (1, "c", 20, "e3", "z")],
                              "aula int, check string, ts int, detalhe string, status string")
    out = windows.latest_per_key(h, ["aula", "check"], "ts", "detalhe", ["status"])
    assert "Window" not in inspect.plan_text(out)
    assert out.first()["status"] == "z"


def test_raw_rows_shuffle_lineitem_once_and_sort_nothing(spark):
    plan = inspect.plan_text(inputs.raw(spark, SF))
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert plan.index("ShuffledHashJoin") < plan.index("o_custkey")       # orders meet customer below it
