"""Declared rules: every kind, all reasons of a row, one scan."""
import pytest

from microlake.operators import rules
from microlake.operators.rules import Rule

ALL = [Rule("faixa", "range", "n", low=0, high=9), Rule("lista", "domain", "s", values=("a", "b")), Rule("forma", "pattern", "p", pattern=r"\d{2}"),
       Rule("tipo", "type", "t", type="decimal"), Rule("cheio", "filled", "s"), Rule("quase", "filled", "p", limit=0.5),
       Rule("chave", "key", columns=("k", "n"))]
ROWS = [(1, "5", "a", "12", "1,5"), (2, "10", "c", "123", "x"), (3, None, None, " ", ""), (4, "-1", "b", None, "1.234,5"), (1, "5", "b", "7x", "2"),
        (None, None, "a", "11", "3"), (None, None, "a", "11", "3"), (5, "abc", " ", "01", "4")]
REASONS = [["chave"], ["faixa", "lista", "forma", "tipo"], ["cheio"], ["faixa"], ["forma", "chave"], ["chave"], ["chave"], ["cheio"]]


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(ROWS)], "i int, k int, n string, s string, p string, t string").repartition(3)


def test_report_counts_every_rule_in_one_scan(rows):
    out = rules.report(rows, ALL)
    got = {r["regra"]: (r["linhas"], r["violacoes"], r["ok"]) for r in out.collect()}
    assert got == {"faixa": (8, 2, False), "lista": (8, 1, False), "forma": (8, 2, False), "tipo": (8, 1, False), "cheio": (8, 2, False),
                   "quase": (8, 2, True), "chave": (8, 2, False)}
    assert {r["violacoes"] for r in rules.report(rows.limit(0), ALL).collect()} == {0}


def test_bad_rows_carry_all_their_reasons(rows):
    good, bad = rules.set_aside(rows, ALL)
    assert {r["i"]: r["motivos"] for r in bad.collect()} == {i: r for i, r in enumerate(REASONS) if r} and good.count() == 0
    narrow = [r for r in ALL if r.kind != "key"]
    good, bad = rules.set_aside(rows, narrow)
    assert {r["i"] for r in good.collect()} == {0, 5, 6} and good.columns == rows.columns
    assert "Exchange" not in rules.with_reasons(rows.sparkSession.range(3).selectExpr("'1' n", "'a' s", "'12' p", "'1' t"), narrow) \
        ._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r["motivos"]) for r in rules.with_reasons(rows, []).collect()} == {()}


def test_unknown_kinds_are_refused():
    with pytest.raises(ValueError):
        Rule("x", "odd", "c")
    with pytest.raises(ValueError):
        Rule("x", "type", "c", type="date")
