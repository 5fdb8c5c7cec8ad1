"""Same results under the physical strategies large inputs get: no automatic
broadcast (sort-merge joins), AQE off, another shuffle width."""
import pytest

import __spark_entry__ as entry_mod
from microlake.operators.compare import multiset_difference

SF = "/root/testdata/sf0.001"
NAMES = ["mart_employment", "mart_top_industry", "geo_enrich", "top1_via_join", "group_avg_per_row",
         "join_kinds", "upsert_by_join", "per_capita", "domain_violations", "dictionary_conformance",
         "rank_variants", "silver_by_file"]
SCALE_CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1",
              "spark.sql.adaptive.enabled": "false",
              "spark.sql.shuffle.partitions": "7"}


@pytest.mark.parametrize("name", NAMES)
def test_result_is_strategy_independent(spark, name):
    q = entry_mod.queries()[name]
    default_rows = q(spark, SF).collect()
    old = {k: spark.conf.get(k, None) for k in SCALE_CONF}
    try:
        for k, v in SCALE_CONF.items():
            spark.conf.set(k, v)
        scaled = q(spark, SF)
        plan_rows = scaled.collect()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    a = spark.createDataFrame(default_rows, scaled.schema)
    b = spark.createDataFrame(plan_rows, scaled.schema)
    r = multiset_difference(a, b).first()
    assert r["iguais"], (name, r)
