"""Merge clauses against a plain rule; the key index; refused sources."""
import random

import pytest
from pyspark.sql import functions as F

from microlake.sinks import files, merge, tables

SCHEMA = "k int, v string, ano int"


def _rows(spark, path):
    return sorted(((r["k"], r["v"], r["ano"]) for r in tables.read_table(spark, path).collect()), key=str)


def _plain(base, source):
    """op D deletes, U updates, I inserts, K keeps; by key, whatever the year."""
    out = {k: (k, v, y) for k, v, y in base}
    for k, v, y, op in source:
        if k in out and op == "D":
            del out[k]
        elif (k in out and op == "U") or (k not in out and op == "I"):
            out[k] = (k, v, y)
    return sorted(out.values(), key=str)


CLAUSES = {"delete": "s.op = 'D'", "update": "s.op = 'U'", "insert": "s.op = 'I'"}


@pytest.mark.parametrize("indexed", [False, True])
def test_merge_equals_the_plain_rule(spark, tmp_dir, indexed):
    rng = random.Random(5)
    path, index = tmp_dir + "/t", tmp_dir + "/i" if indexed else None
    base = [(k, f"v{k}", 2018 + k % 4) for k in range(300)] + [(None, "null", 2019)]
    tables.write_table(spark.createDataFrame(base, SCHEMA), path)
    if indexed:
        merge.write_index(spark, path, index, ["k"])
    for step in range(2):
        keys = [*rng.sample(range(400), 60), *([None] if step else [])]
        source = [(k, f"n{step}", rng.choice([2018, 2019, 2020, 2021, 2025]), rng.choice("DUIK")) for k in keys]
        done = merge.merge(spark, path, spark.createDataFrame(source, "k int, v string, ano int, op string"), ["k"],
                           f"{tmp_dir}/s{step}", index=index, **CLAUSES)
        want = _plain(base, source)
        assert _rows(spark, path) == want
        before = {b[0]: b for b in base}
        assert (done.deleted, done.updated, done.inserted) == (
            sum(k in before and op == "D" for k, *_, op in source), sum(k in before and op == "U" for k, *_, op in source),
            sum(k not in before and op == "I" for k, *_, op in source))
        base = want


def test_a_moved_key_is_found_without_reading_all_years(spark, tmp_dir):
    path, index = tmp_dir + "/t", tmp_dir + "/i"
    tables.write_table(spark.range(2000).selectExpr("CAST(id AS INT) AS k", "'a' AS v", "CAST(2000 + id % 10 AS INT) AS ano"), path)
    merge.write_index(spark, path, index, ["k"])
    change = spark.createDataFrame([(13, "moved", 2009)], SCHEMA)           # stands in 2003
    done = merge.merge(spark, path, change, ["k"], tmp_dir + "/s", index=index)
    assert done.years == [2003, 2009] and 2003 in done.read and len(done.read) <= 2
    assert [r["ano"] for r in tables.read_table(spark, path).where("k = 13").collect()] == [2009]
    assert merge.years_that_may_hold(spark, path, index, ["k"], change.select("k")) == [2009]
    # files written by someone else: the year is read whatever its bitmap says
    tables.replace_partition(spark.createDataFrame([(50_001, "x", 2005)], SCHEMA), path, 2005)
    assert 2005 in merge.years_that_may_hold(spark, path, index, ["k"], change.select("k"))
    done = merge.merge(spark, path, spark.createDataFrame([(50_001, "y", 2005)], SCHEMA), ["k"], tmp_dir + "/s2", index=index)
    assert done.updated == 1 and done.inserted == 0


def test_rows_that_keep_their_match_are_not_inserted_twice(spark, tmp_dir):
    path = tmp_dir + "/t"
    tables.write_table(spark.createDataFrame([(1, "a", 2020), (2, "b", 2021)], SCHEMA), path)
    source = spark.createDataFrame([(1, "A", 2020), (2, "B", 2020)], SCHEMA)
    done = merge.merge(spark, path, source, ["k"], tmp_dir + "/s", update="t.v = 'a'")
    assert _rows(spark, path) == [(1, "A", 2020), (2, "b", 2021)] and done.years == [2020]


def test_a_year_left_empty_is_removed(spark, tmp_dir):
    path = tmp_dir + "/t"
    tables.write_table(spark.createDataFrame([(1, "a", 2020), (2, "b", 2021)], SCHEMA), path)
    merge.merge(spark, path, spark.createDataFrame([(2, "b", 2021)], SCHEMA), ["k"], tmp_dir + "/s", delete="true")
    assert _rows(spark, path) == [(1, "a", 2020)]
    assert [f.rsplit("/", 1)[1] for f in files.list_folders(spark, path + "/ano=*")] == ["ano=2020"]
    assert merge.merge(spark, path, spark.createDataFrame([], SCHEMA), ["k"], tmp_dir + "/s2").years == []


def test_refused_sources(spark, tmp_dir):
    path = tmp_dir + "/t"
    tables.write_table(spark.createDataFrame([(1, "a", 2020), (2, None, 2021)], SCHEMA), path)
    for rows, why in (([(1, "x", 2020), (1, "y", 2020)], "more than once"), ([(None, "x", 2020), (None, "y", 2020)], "more than once"),
                      ([(5, "x", None)], "without ano")):
        with pytest.raises(ValueError, match=why):
            merge.merge(spark, path, spark.createDataFrame(rows, SCHEMA), ["k"], tmp_dir + "/s")
    with pytest.raises(tables.SchemaMismatch):
        merge.merge(spark, path, spark.createDataFrame([(1, 2, 2020)], "k int, v int, ano int"), ["k"], tmp_dir + "/s")
    merge.merge(spark, path, spark.createDataFrame([(1, "x", None)], SCHEMA), ["k"], tmp_dir + "/s", delete="true")     # writes no row
    assert tables.read_table(spark, path).where(F.col("v").isNotNull()).count() == 0
