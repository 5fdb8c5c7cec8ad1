"""Layer contracts end to end: landed text -> bronze -> silver -> gold, gate, totals."""
from pyspark.sql import functions as F

from microlake import config
from microlake.operators import dims, marts, quality
from microlake.operators.silver import to_silver
from microlake.queries import inputs, landing
from microlake.sinks import tables
from microlake.sources import text

SF = "/root/testdata/sf0.001"


def test_layers_keep_every_row_and_totals_reconcile(spark):
    root = landing.landing(spark, SF)
    bronze = text.read_landing(spark, root)
    assert all(t == "string" for c, t in bronze.dtypes if c != "ano")
    silver = to_silver(bronze, keep=[])
    assert silver.count() == bronze.count() == inputs.raw(spark, SF).count()

    assert quality.enforce(quality.layer_gate(silver, bronze)) > 0
    assert quality.check_contract(spark, silver, config.SILVER_CONTRACT, "silver") is silver

    states = dims.state_dim(spark)
    gold = marts.all_marts(silver, spark)
    active = silver.filter("vinculo_ativo").count()
    assert gold["gold_emprego_uf_ano"].agg(F.sum("qtd_vinculos")).first()[0] == active
    assert gold["gold_desligamento_uf_ano"].agg(F.sum("qtd_vinculos_no_ano")).first()[0] == silver.count()
    assert gold["gold_top_cnae_uf_ano"].agg(F.max("posicao")).first()[0] <= 10
    orphans = {r[0] for r in gold["gold_emprego_uf_ano"].filter(F.col("uf").isNull())
               .select("cod_uf").collect()}
    assert orphans <= {None, "18", "19", "20", "30", "34"}
    years_s = {r[0] for r in silver.select("ano").distinct().collect()}
    years_g = {r[0] for r in gold["gold_emprego_uf_ano"].select("ano").distinct().collect()}
    assert years_s == years_g and len(years_s) >= 2
    assert dict(marts.employment(marts.active(silver), states).dtypes)["massa_salarial_dez_nom"] == "decimal(28,2)"


def test_gate_fails_loudly(spark):
    raw = inputs.raw(spark, SF)
    broken = to_silver(raw).withColumn("cod_uf", F.lit(None).cast("string"))
    try:
        quality.enforce(quality.layer_gate(broken, raw))
        raise AssertionError("gate should fail")
    except quality.GateFailed as ex:
        assert "nulo_uf" in str(ex)


def test_restore_snapshot_and_existence(spark, tmp_dir):
    path, arch = tmp_dir + "/t", tmp_dir + "/a"
    base = spark.range(10).select("id", F.lit(2022).cast("int").alias("ano"))
    tables.replace_partition(base, path, 2022)
    tables.archive_snapshot(tables.read_table(spark, path), arch, "v0")
    tables.replace_partition(base.filter("id < 3"), path, 2022)
    assert tables.read_table(spark, path).count() == 3
    tables.restore_snapshot(spark, arch, "v0", path, 2022)
    assert tables.read_table(spark, path).count() == 10
    assert tables.has_rows(base) and not tables.has_rows(base.filter("id < 0"))


def test_publish_only_after_the_gate(spark, tmp_dir):
    raw = inputs.raw(spark, SF).filter(F.col("ano") == 1997)
    good = to_silver(raw)
    n = tables.publish_year(spark, good, raw, tmp_dir + "/silver", 1997, tmp_dir + "/stage1")
    assert n == raw.count()
    bad = good.withColumn("cod_uf", F.lit(None).cast("string"))
    try:
        tables.publish_year(spark, bad, raw, tmp_dir + "/silver", 1997, tmp_dir + "/stage2")
        raise AssertionError("gate should fail")
    except quality.GateFailed:
        pass
    published = tables.read_table(spark, tmp_dir + "/silver")
    assert published.filter(F.col("cod_uf").isNotNull()).count() > 0     # untouched


def test_dimension_keys_and_orphan_allow_list(spark):
    from microlake.operators import joins
    dup = spark.createDataFrame([("26", "PE"), ("26", "XX")], "cod_uf string, uf string")
    assert dims.duplicate_keys(dup, "cod_uf").count() == 1
    try:
        dims.checked(dup, "cod_uf")
        raise AssertionError("duplicate key should raise")
    except ValueError:
        pass
    assert dims.checked(dims.dim_state(spark), "cod_uf").count() == 27
    s = inputs.silver(spark, SF)
    all_orphans = {r[0] for r in joins.orphan_codes(s, dims.dim_state(spark), "cod_uf").collect()}
    rest = {r[0] for r in joins.orphan_codes(s, dims.dim_state(spark), "cod_uf", ["18", "19"]).collect()}
    assert rest == all_orphans - {"18", "19"}


def test_load_years_end_to_end_and_rerun(spark, tmp_dir):
    from microlake import stages
    from microlake.operators import manifest as mf
    root = landing.landing(spark, SF)
    lake = tmp_dir + "/lake"
    stages.load_year(spark, root, 1995, lake, "r1", "2024-01-01 00:00:00")
    stages.load_year(spark, root, 1999, lake, "r2", "2024-01-02 00:00:00")
    stages.load_year(spark, root, 1995, lake, "r3", "2024-01-03 00:00:00")   # rerun
    p = stages.paths(lake)
    raw = inputs.raw(spark, SF)
    silver = tables.read_table(spark, p["silver"])
    got = {r["ano"]: r["count"] for r in silver.groupBy("ano").count().collect()}
    exp = {r["ano"]: r["count"] for r in raw.filter(F.col("ano").isin(1995, 1999)).groupBy("ano").count().collect()}
    assert got == exp
    emp = tables.read_table(spark, p["gold"] + "/gold_emprego_uf_ano")
    assert emp.agg(F.sum("qtd_vinculos")).first()[0] == silver.filter("vinculo_ativo").count()
    runs = {r["ano"]: r for r in mf.rerun_consistency(mf.read_manifest(spark, p["manifest"])).collect()}
    assert runs[1995]["execucoes"] == 2 and runs[1995]["ok"] and runs[1999]["execucoes"] == 1
