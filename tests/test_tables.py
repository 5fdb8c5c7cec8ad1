"""Partition replace with guard, evolution, compaction, snapshots, upsert."""
import pytest
from pyspark.sql import functions as F

from microlake.sinks import files, tables


def _ids(spark, n, ano):
    return spark.range(n).select(F.col("id"), F.lit(ano).cast("int").alias("ano"))


def test_replace_partition_keeps_other_years_and_rejects_foreign_rows(spark, tmp_dir):
    path = tmp_dir + "/t"
    tables.replace_partition(_ids(spark, 100, 2022), path, 2022)
    tables.replace_partition(_ids(spark, 7, 2023), path, 2023)
    tables.replace_partition(_ids(spark, 50, 2022), path, 2022)
    counts = {r["ano"]: r["count"] for r in tables.read_table(spark, path).groupBy("ano").count().collect()}
    assert counts == {2022: 50, 2023: 7}
    with pytest.raises(Exception):
        tables.replace_partition(_ids(spark, 5, 2023), path, 2022)
    counts = {r["ano"]: r["count"] for r in tables.read_table(spark, path).groupBy("ano").count().collect()}
    assert counts == {2022: 50, 2023: 7}


def test_schema_evolution_needs_merge(spark, tmp_dir):
    path = tmp_dir + "/e"
    tables.replace_partition(_ids(spark, 3, 2022), path, 2022)
    tables.replace_partition(_ids(spark, 2, 2023).withColumn("novo", F.lit("x")), path, 2023,
                             merge_schema=True)
    merged = tables.read_table(spark, path, merge_schema=True)
    assert "novo" in merged.columns
    got = {r["ano"]: r["n"] for r in merged.groupBy("ano").agg(F.count("novo").alias("n")).collect()}
    assert got == {2022: 0, 2023: 2}


def test_compaction_preserves_rows(spark, tmp_dir):
    path = tmp_dir + "/c"
    tables.write_table(_ids(spark, 1000, 2022).repartition(8), path)
    before = tables.partition_stats(tables.read_table(spark, path)).first()
    assert before["arquivos"] == 8
    n = tables.compact_partition(spark, path, 2022, tmp_dir + "/c_stage")
    after = tables.partition_stats(tables.read_table(spark, path)).first()
    assert n == 1 and after["arquivos"] == 1
    assert (after["qtd"], after["hash"]) == (before["qtd"], before["hash"])


def test_snapshot_and_compare(spark, tmp_dir):
    path, arch = tmp_dir + "/s", tmp_dir + "/arch"
    tables.replace_partition(_ids(spark, 10, 2022).withColumn("v", F.col("id") * 2), path, 2022)
    tables.archive_snapshot(tables.read_table(spark, path), arch, "s1")
    tables.replace_partition(_ids(spark, 12, 2022).withColumn("v", F.when(F.col("id") < 3, -1)
                                                              .otherwise(F.col("id") * 2)), path, 2022)
    old = tables.read_snapshot(spark, arch, "s1")
    assert old.count() == 10
    diff = {r["coluna"]: r for r in tables.compare_versions(old, tables.read_table(spark, path), ["id"]).collect()}
    assert diff["v"]["alteradas"] == 3 and diff["v"]["so_depois"] == 2 and diff["v"]["so_antes"] == 0


def test_upsert(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    ch = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    out = {r["k"]: r["v"] for r in tables.upsert_by_key(base, ch, ["k"]).collect()}
    assert out == {1: "a", 2: "B", 3: "c"}


def test_empty_replacement_clears_the_year(spark, tmp_dir):
    path = tmp_dir + "/t"
    tables.replace_partition(_ids(spark, 5, 2022).unionByName(_ids(spark, 4, 2023)), path, [2022, 2023])
    tables.replace_partition(_ids(spark, 3, 2022).filter("false"), path, 2022)
    assert {r["ano"]: r["count"] for r in tables.read_table(spark, path).groupBy("ano").count().collect()} == {2023: 4}
    tables.replace_partition(_ids(spark, 2, 2023), path, [2022, 2023])
    assert tables.read_table(spark, path).count() == 2


def test_writes_must_fit_the_table(spark, tmp_dir):
    path = tmp_dir + "/t"
    tables.replace_partition(_ids(spark, 5, 2022).withColumn("v", F.lit("a")), path, 2022)
    bad = {"extra": _ids(spark, 5, 2022).withColumn("v", F.lit("a")).withColumn("w", F.lit(1)),
           "missing": _ids(spark, 5, 2022),
           "retyped": _ids(spark, 5, 2022).withColumn("v", F.lit("a")).withColumn("id", F.col("id").cast("string"))}
    for name, df in bad.items():
        with pytest.raises(tables.SchemaMismatch):
            tables.replace_partition(df, path, 2022)
        if name == "retyped":
            with pytest.raises(tables.SchemaMismatch):
                tables.replace_partition(df, path, 2023, merge_schema=True)
        else:
            tables.replace_partition(df.withColumn("ano", F.lit(2030)), path, 2030, merge_schema=True)
    assert tables.read_table(spark, path, merge_schema=True).filter("ano = 2022").count() == 5


def test_checksum_sees_where_a_null_stands(spark):
    a = spark.createDataFrame([(None, 5)], "x int, y int")
    b = spark.createDataFrame([(5, None)], "x int, y int")
    assert a.agg(tables.content_hash(a)).first() != b.agg(tables.content_hash(b)).first()


def test_publish_archives_and_travels_in_time(spark, tmp_dir):
    from microlake.operators.silver import to_silver
    from microlake.queries import inputs
    raw = inputs.raw(spark, "/root/testdata/sf0.001").filter(F.col("ano") == 1997)
    silver, arch, hist = tmp_dir + "/silver", tmp_dir + "/arch", tmp_dir + "/hist"
    part = raw.filter(F.pmod(F.xxhash64(*raw.columns), F.lit(2)) == 0)
    for k, rows in enumerate((raw, part)):
        n = tables.publish_year(spark, to_silver(rows), rows, silver, 1997, f"{tmp_dir}/stage{k}", archive=arch, snapshot_id=f"r{k}")
        tables.log_write(spark, hist, "silver", 1997, "replace", f"r{k}", f"2024-01-0{k + 1} 00:00:00", n)
        assert not tables.table_exists(spark, f"{tmp_dir}/stage{k}")
    count = lambda ts: tables.read_as_of(spark, silver, arch, hist, "silver", ts).count()
    assert (count("2024-01-01 12:00:00"), count("2024-01-02 12:00:00"), count("2023-01-01 00:00:00")) == (raw.count(), part.count(), 0)
    assert [r["versao"] for r in tables.table_history(spark, hist).orderBy("versao").collect()] == [0, 1]
    assert tables.expire_snapshots(spark, arch, ["r1"]) == 1 and count("2024-01-01 12:00:00") == 0


def test_upsert_touches_only_its_partitions(spark, tmp_dir):
    path = tmp_dir + "/t"
    tables.write_table(_ids(spark, 5, 2020).unionByName(_ids(spark, 5, 2021)).withColumn("v", F.lit("a")), path)
    untouched = tables.files.list_data_files(spark, path + "/ano=2020/*", with_time=True)
    changes = spark.createDataFrame([(4, 2021, "b"), (9, 2021, "c")], "id long, ano int, v string")
    assert tables.upsert_partitions(spark, path, changes, ["id"], tmp_dir + "/stage") == [2021]
    rows = {(r["ano"], r["id"]): r["v"] for r in tables.read_table(spark, path).collect()}
    assert len(rows) == 11 and rows[2021, 4] == "b" and rows[2021, 9] == "c" and rows[2020, 4] == "a"
    assert tables.files.list_data_files(spark, path + "/ano=2020/*", with_time=True) == untouched
    assert tables.upsert_partitions(spark, path, changes.limit(0), ["id"], tmp_dir + "/stage") == []


def test_upsert_moves_a_key_to_its_new_partition(spark, tmp_dir):
    path = tmp_dir + "/t"
    rows = [(1, 2020, "a"), (2, 2020, "a"), (3, 2021, "a"), (4, 2022, "a"), (5, 2023, "a")]
    tables.write_table(spark.createDataFrame(rows, "id long, ano int, v string"), path)
    untouched = tables.files.list_data_files(spark, path + "/ano=2023/*", with_time=True)
    # 1 moves, 4 leaves its year empty, 6 is new in a year of its own
    changes = spark.createDataFrame([(1, 2021, "b"), (4, 2021, "b"), (6, 2024, "c")], "id long, ano int, v string")
    assert tables.upsert_partitions(spark, path, changes, ["id"], tmp_dir + "/stage", keys_move=True) == [2020, 2021, 2022, 2024]
    got = sorted((r["id"], r["ano"], r["v"]) for r in tables.read_table(spark, path).collect())
    assert got == [(1, 2021, "b"), (2, 2020, "a"), (3, 2021, "a"), (4, 2021, "b"), (5, 2023, "a"), (6, 2024, "c")]
    assert not tables.files.exists(spark, path + "/ano=2022")
    assert tables.files.list_data_files(spark, path + "/ano=2023/*", with_time=True) == untouched


def test_upsert_query_lets_keys_move(spark, monkeypatch):
    from microlake.queries import tables as queries
    orders = queries._orders(spark, "/root/testdata/sf0.001")
    moved = orders.withColumn("ano", F.when(F.col("o_orderstatus") == "P", 2001).otherwise(F.col("ano")))
    calls = iter([orders])                      # stored as they are, changed with another year
    monkeypatch.setattr(queries, "_orders", lambda *_: next(calls, moved))
    out = queries.upsert_by_join(spark, "/root/testdata/sf0.001")
    n = orders.filter("o_orderstatus = 'P'").count()
    assert n and out.count() == orders.count() + n == out.select("o_orderkey").distinct().count()


def test_run_history_sees_a_load_that_is_not_repeatable(spark, monkeypatch):
    from microlake.queries import inputs, lake
    from microlake.queries import tables as queries
    raw, loads = inputs.raw(spark, "/root/testdata/sf0.001"), []

    def shrinking(*_):                          # every load after the first lacks rows of 1996
        loads.append(1)
        return raw if len(loads) == 1 else raw.filter("ano <> 1996 OR idade > '40'")

    monkeypatch.setattr(lake, "_LAKE", {})
    monkeypatch.setattr(inputs, "raw", shrinking)
    got = {r["ano"]: r for r in queries.run_history(spark, "/root/testdata/sf0.001").collect()}
    assert len(loads) == 2 and {r["execucoes"] for r in got.values()} == {2}
    assert [y for y, r in got.items() if not r["ok"]] == [1996] and got[1996]["contagens_distintas_silver"] == 2


def test_files_follow_the_counted_bytes(spark, tmp_dir):
    rows = spark.range(0, 10_000, 1, 7).selectExpr("id", "'same text' AS v", "CAST(CASE WHEN id % 10 < 6 THEN 2022 WHEN id % 10 = 9 THEN NULL "
                                                   "ELSE 2000 + id % 10 END AS INT) AS ano")
    path = tmp_dir + "/t"
    made = tables.write_sized(rows.withColumn("id", F.lit(1)), path, target_bytes=14 * 1000)        # equal rows, 14 bytes each
    sizes = {}
    for r in tables.read_table(spark, path).groupBy("ano", F.col("_metadata.file_path").alias("f")).count().collect():
        sizes.setdefault(r["ano"], []).append(r["count"])
    assert made == {2022: 6, 2006: 1, 2007: 1, 2008: 1, None: 1}
    assert {y: len(n) for y, n in sizes.items() if y != 2022} == {2006: 1, 2007: 1, 2008: 1, None: 1}
    assert 2 <= len(sizes[2022]) <= 6                       # equal rows are told apart by their input partition alone
    assert sum(sizes[2022]) == 6000 and sum(map(sum, sizes.values())) == 10_000
    assert tables.write_sized(rows, tmp_dir + "/s", target_bytes=1000, weight=F.lit(1))[2022] == 6
    hot = [r["count"] for r in spark.read.parquet(tmp_dir + "/s").where("ano = 2022").groupBy(F.col("_metadata.file_path")).count().collect()]
    assert len(hot) == 6 and max(hot) < 2 * min(hot)
    assert tables.write_sized(rows.limit(0), tmp_dir + "/e") == {}


def _settings_of_writes(monkeypatch, *formats):
    """What the setting of side-by-side files is whenever a partitioned write starts."""
    from pyspark.sql import DataFrameWriter
    seen = []
    for name in formats:
        real = getattr(DataFrameWriter, name)

        def write(self, *args, real=real, **kwargs):
            seen.append(self._spark.conf.get(files._WRITERS, None))
            return real(self, *args, **kwargs)

        monkeypatch.setattr(DataFrameWriter, name, write)
    return seen


def test_partitioned_writes_do_not_sort_their_rows(spark, tmp_dir, monkeypatch):
    before = spark.conf.get(files._WRITERS, None)
    seen = _settings_of_writes(monkeypatch, "parquet")
    df = spark.range(200).select("id", (F.col("id") % 40 + 1990).cast("int").alias("ano")).coalesce(1)   # more years than open files
    tables.write_table(df, tmp_dir + "/t")
    tables.replace_partition(df.where("ano = 1991"), tmp_dir + "/t", 1991)
    assert seen == [str(files.OPEN_FILES)] * 2 and spark.conf.get(files._WRITERS, None) == before
    assert {tuple(r) for r in tables.read_table(spark, tmp_dir + "/t").collect()} == {(k, k % 40 + 1990) for k in range(200)}


def test_overlapping_unsorted_writes_restore_the_setting(spark):
    before = spark.conf.get(files._WRITERS, None)
    a, b = files.unsorted_writes(spark), files.unsorted_writes(spark)
    a.__enter__(), b.__enter__()
    a.__exit__(None, None, None)
    assert spark.conf.get(files._WRITERS) == str(files.OPEN_FILES)
    b.__exit__(None, None, None)
    assert spark.conf.get(files._WRITERS, None) == before


def test_rows_of_landed_files_are_written_unsorted(spark, tmp_dir, monkeypatch):
    import os

    from microlake.sources import releases
    os.makedirs(tmp_dir + "/land/2020")
    with open(tmp_dir + "/land/2020/a.txt", "w") as f:
        f.write("x;y\n1;2\n")
    seen = _settings_of_writes(monkeypatch, "parquet")
    releases.write_files(spark, releases._listed(spark, tmp_dir + "/land/*/*"), tmp_dir + "/bronze")
    assert seen == [str(files.OPEN_FILES)]
