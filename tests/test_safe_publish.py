"""Swaps that stop between any two steps, refused ids, stored versions, corrections that are refused."""
import pytest
from pyspark.sql import functions as F

from microlake.sinks import files, tables


def _rows(spark, n, ano, v="a"):
    return spark.range(n).select("id", F.lit(v).alias("v"), F.lit(ano).cast("int").alias("ano"))


class Stop(Exception):
    pass


def _stop_at(n):
    def between(step):
        if step == n:
            raise Stop

    return between


@pytest.mark.parametrize("step", [1, 2, 3, 4])
@pytest.mark.parametrize("keep", [False, True])
def test_a_stopped_swap_is_finished_or_undone(spark, tmp_dir, step, keep):
    path, stage = tmp_dir + "/t", tmp_dir + "/s"
    kept = tmp_dir + "/archive/ano=2022/snapshot_id=r1" if keep else None
    tables.replace_partition(_rows(spark, 10, 2022, "old"), path, 2022)
    tables.replace_partition(_rows(spark, 4, 2023, "old"), path, 2023)
    _rows(spark, 7, 2022, "new").write.partitionBy("ano").parquet(stage)
    with pytest.raises(Stop):
        files.replace_folder(spark, stage + "/ano=2022", path + "/ano=2022", kept, _stop_at(step))
    assert tables.recover(spark, path) == {"ano=2022": "undone" if step == 1 else "finished"}
    got = {(r["ano"], r["v"]): r["count"] for r in tables.read_table(spark, path).groupBy("ano", "v").count().collect()}
    assert got == {(2022, "old"): 10, (2023, "old"): 4} if step == 1 else {(2022, "new"): 7, (2023, "old"): 4}
    assert not [f for f in files.list_folders(spark, path + "/*") if "/_aside" in f] and not tables.recover(spark, path)
    if keep:
        assert bool(files.list_data_files(spark, kept + "/*")) == (step > 1)


def test_a_swap_whose_new_folder_is_lost_is_undone(spark, tmp_dir):
    path, stage = tmp_dir + "/t", tmp_dir + "/s"
    tables.replace_partition(_rows(spark, 10, 2022), path, 2022)
    _rows(spark, 7, 2022).write.partitionBy("ano").parquet(stage)
    with pytest.raises(Stop):
        files.replace_folder(spark, stage + "/ano=2022", path + "/ano=2022", None, _stop_at(2))
    files.delete(spark, stage)
    assert tables.recover(spark, path) == {"ano=2022": "undone"}
    assert tables.read_table(spark, path).count() == 10


@pytest.mark.parametrize("step", [1, 2, 3, 4])
def test_the_next_load_recovers_first(spark, tmp_dir, step):
    path, stage = tmp_dir + "/t", tmp_dir + "/s"
    tables.replace_partition(_rows(spark, 10, 2022), path, 2022)
    _rows(spark, 7, 2022).write.partitionBy("ano").parquet(stage)
    with pytest.raises(Stop):
        files.replace_folder(spark, stage + "/ano=2022", path + "/ano=2022", None, _stop_at(step))
    tables.replace_partition(_rows(spark, 3, 2023), path, 2023)
    got = {r["ano"]: r["count"] for r in tables.read_table(spark, path).groupBy("ano").count().collect()}
    assert got == {2022: 10 if step == 1 else 7, 2023: 3}


def test_used_snapshot_ids_are_refused(spark, tmp_dir):
    path, archive = tmp_dir + "/t", tmp_dir + "/a"
    tables.replace_partition(_rows(spark, 10, 2022), path, 2022)
    tables.archive_snapshot(tables.read_table(spark, path), archive, "s1")
    with pytest.raises(ValueError, match="in use"):
        tables.archive_snapshot(tables.read_table(spark, path), archive, "s1")
    tables.archive_snapshot(_rows(spark, 2, 2023), archive, "s1")               # another year under the same run
    assert tables.read_snapshot(spark, archive, "s1").count() == 12


def test_versions_stay_when_an_earlier_time_is_logged_later(spark, tmp_dir):
    h = tmp_dir + "/h"
    tables.log_write(spark, h, "t", 2022, "replace", "b", "2024-02-01 00:00:00", 5)
    tables.log_write(spark, h, "u", 2022, "replace", "b", "2024-02-01 00:00:00", 5)
    tables.log_writes(spark, h, [("t", 2022, "replace", "a", "2024-01-01 00:00:00", 4), ("t", 2023, "replace", "c", "2023-01-01 00:00:00", 4)])
    assert {(r["tabela"], r["snapshot_id"]): r["versao"] for r in tables.table_history(spark, h).collect()} == \
        {("t", "b"): 0, ("u", "b"): 0, ("t", "a"): 1, ("t", "c"): 2}


def _table(spark, path):
    rows = [(1, "a", 2022), (2, "b", 2022), (None, "n", 2023), (4, "d", 2023)]
    tables.write_table(spark.createDataFrame(rows, "k int, v string, ano int"), path)


@pytest.mark.parametrize("move", [False, True])
@pytest.mark.parametrize("changes,why", [([(1, "x", None)], "without ano"), ([(1, "x", 2022), (1, "y", 2022)], "more than once"),
                                         ([(None, "x", 2022), (None, "y", 2022)], "more than once")])
def test_corrections_that_would_lose_or_double_rows_are_refused(spark, tmp_dir, move, changes, why):
    path = tmp_dir + "/t"
    _table(spark, path)
    with pytest.raises(ValueError, match=why):
        tables.upsert_partitions(spark, path, spark.createDataFrame(changes, "k int, v string, ano int"), ["k"], tmp_dir + "/s", keys_move=move)
    assert tables.read_table(spark, path).count() == 4


def test_a_null_key_matches_the_null_key(spark, tmp_dir):
    path = tmp_dir + "/t"
    _table(spark, path)
    changes = spark.createDataFrame([(None, "N", 2022), (4, "D", 2023)], "k int, v string, ano int")
    assert tables.upsert_partitions(spark, path, changes, ["k"], tmp_dir + "/s", keys_move=True) == [2022, 2023]
    assert {(r["k"], r["v"], r["ano"]) for r in tables.read_table(spark, path).collect()} == \
        {(1, "a", 2022), (2, "b", 2022), (None, "N", 2022), (4, "D", 2023)}
