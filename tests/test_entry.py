"""Driver contract: entry() runs; registered queries agree with their DuckDB oracle."""
import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry_mod

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
# a fast, representative subset; tools/oracle_check.py runs all of them
SAMPLE = ["mart_employment", "mart_pay_gap", "mart_top_industry", "silver_invalid_to_null",
          "safe_decimal", "orphan_state_codes", "group_avg_per_row", "null_profile", "layer_gate",
          "rows_per_source_file", "replace_partition", "dictionary_conformance", "row_sentences",
          "rank_variants", "hash_sample", "dictionary_export", "join_kinds"]


def _norm(v):
    if isinstance(v, float):
        return ("f", None if math.isnan(v) else round(v, 6))
    if isinstance(v, decimal.Decimal):
        return ("d", str(v))
    if isinstance(v, (dt.date, dt.datetime)):
        return ("t", v.isoformat())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "qtd_vinculos" in df.columns


def test_every_oracle_has_a_query():
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())
    assert len(entry_mod.queries()) >= 90


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    df = entry_mod.queries()[name](spark, SF)
    cur = con.execute(entry_mod.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, cur.fetchall())
