"""Files released again: what changed is found, listed and loaded; fingerprints of bytes."""
import os

import pytest

from microlake.sources import releases, text
from microlake.streaming import incremental

HEAD = "Município;Idade\n"


def _write(path, content, time=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(content.encode("latin-1"))
    if time:
        os.utime(path, (time, time))


def _body(n, age=30, first=0):
    return "".join(f"{261160 + (first + k) % 9};{age}\n" for k in range(n))


def _report(df):
    return {r["arquivo"]: (r["situacao"], r["linhas"], r["blocos"], r["blocos_alterados"]) for r in df.collect()}


def test_rewritten_grown_touched_and_gone(spark, tmp_dir):
    land, target, state = (f"{tmp_dir}/{x}" for x in ("land", "bronze", "state"))
    load = lambda: _report(releases.load_releases(spark, land, target, state, block_bytes=1000))
    for k, name in enumerate(("a.txt", "b.txt", "c.txt", "d.txt", "e f+%41.txt")):
        _write(f"{land}/2022/{name}", HEAD + _body(1000, 20 + k), 1_700_000_000)
    first = load()
    assert {n: r[0] for n, r in first.items()} == dict.fromkeys(first, "novo") and first["a.txt"][1:3] == (1001, 11)
    assert {r[0] for r in load().values()} == {"igual"}

    lines = (HEAD + _body(1000, 20)).splitlines(keepends=True)
    lines[450] = "999999;20\n"                                  # in place, same length: block 4 of 0..10
    _write(f"{land}/2022/a.txt", "".join(lines), 1_700_000_100)
    _write(f"{land}/2022/b.txt", HEAD + _body(1000, 21) + _body(300, 55), 1_700_000_100)
    _write(f"{land}/2022/c.txt", HEAD + _body(1000, 22), 1_700_000_100)        # touched only
    os.remove(f"{land}/2022/d.txt")
    _write(f"{land}/2023/g.txt", "", 1_700_000_100)
    got = load()
    assert got == {"a.txt": ("reescrito", 1001, 11, 1), "b.txt": ("crescido", 1301, 14, 4), "c.txt": ("igual", 1001, 11, 0),
                   "d.txt": ("sumido", 1001, None, 0), "e f+%41.txt": ("igual", 1001, None, 0), "g.txt": ("novo", 0, 1, 0)}
    rows = releases.read_files(spark, target)
    assert {(r["arquivo_origem"], r["count"]) for r in rows.groupBy("arquivo_origem").count().collect()} == \
        {("a.txt", 1000), ("b.txt", 1300), ("c.txt", 1000), ("d.txt", 1000), ("e f+%41.txt", 1000)}
    assert rows.where("municipio = '999999'").count() == 1
    assert {r[0] for n, r in load().items() if n != "d.txt"} == {"igual"}

    _write(f"{land}/2022/b.txt", HEAD, 1_700_000_200)           # only a header is left: its rows go
    _write(f"{land}/2022/a.txt", "x" + "".join(lines)[1:] + "261160;1\n", 1_700_000_200)         # longer, and changed before
    assert {n: load_r[0] for n, load_r in load().items()} | {"d.txt": ""} == \
        {"a.txt": "reescrito", "b.txt": "reescrito", "c.txt": "igual", "d.txt": "", "e f+%41.txt": "igual", "g.txt": "igual"}
    assert releases.read_files(spark, target).where("arquivo_origem = 'b.txt'").count() == 0


def test_a_longer_file_with_another_last_block_is_rewritten(spark, tmp_dir):
    land, target, state = (f"{tmp_dir}/{x}" for x in ("land", "bronze", "state"))
    _write(f"{land}/2022/a.txt", HEAD + _body(20), 1_700_000_000)
    releases.load_releases(spark, land, target, state)
    _write(f"{land}/2022/a.txt", HEAD + _body(19) + "261160;77\n" + _body(5), 1_700_000_100)
    assert _report(releases.load_releases(spark, land, target, state))["a.txt"][0] == "reescrito"
    _write(f"{land}/2022/a.txt", HEAD + _body(19) + "261160;77\n" + _body(5) + _body(1), 1_700_000_200)
    assert _report(releases.load_releases(spark, land, target, state))["a.txt"][0] == "crescido"


def test_the_stream_loads_rewritten_files_and_refuses_hidden_names(spark, tmp_dir):
    land, target, ckpt = (f"{tmp_dir}/{x}" for x in ("land", "bronze", "ckpt"))
    _write(f"{land}/2022/a.txt", HEAD + _body(3), 1_700_000_000)
    _write(f"{land}/2022/b.txt", HEAD + _body(2), 1_700_000_000)
    incremental.load_landing_incrementally(spark, land, target, ckpt)
    assert incremental.read_sink(spark, target).count() == 5
    _write(f"{land}/2022/a.txt", HEAD + _body(4, 44), 1_700_000_100)
    incremental.load_landing_incrementally(spark, land, target, ckpt)
    rows = incremental.read_sink(spark, target)
    assert sorted((r["arquivo_origem"], r["idade"]) for r in rows.collect()) == [("a.txt", "44")] * 4 + [("b.txt", "30")] * 2
    _write(f"{land}/2022/_c.txt", HEAD + _body(1))
    with pytest.raises(ValueError, match="_c.txt"):
        incremental.load_landing_incrementally(spark, land, target, ckpt)


def test_fingerprints_see_blank_lines_empty_files_and_order(spark, tmp_dir):
    contents = {"a": "h\nx\ny\n", "b": "h\n\nx\n\ny\n", "c": "h\ny\nx\n", "d": "", "e": "h\nx\ny", "f": "h\nx\ny\n", "g h+.txt": "é\n"}
    for name, content in contents.items():
        _write(f"{tmp_dir}/2022/{name}", content)
    rows = {r["arquivo"]: r for r in text.fingerprints(spark, tmp_dir + "/2022/*").collect()}
    assert {n: r["linhas"] for n, r in rows.items()} == {"a": 3, "b": 5, "c": 3, "d": 0, "e": 3, "f": 3, "g h+.txt": 1}
    assert {n: r["tamanho"] for n, r in rows.items()} == {n: len(c.encode("latin-1")) for n, c in contents.items()}
    mark = {n: (r["checksum"], r["sequencia"]) for n, r in rows.items()}
    assert mark["a"] == mark["e"] == mark["f"] and mark["a"] != mark["b"] and mark["d"] == (0, 0)
    assert mark["a"][0] == mark["c"][0] and mark["a"][1] != mark["c"][1]
    assert all(r["ano"] == 2022 and r["modificado"] is not None for r in rows.values())


def test_fingerprints_do_not_depend_on_splits(spark, tmp_dir):
    _write(f"{tmp_dir}/2022/a", "".join(f"line {k}\n" for k in range(20_000)))
    pattern = tmp_dir + "/2022/*"
    whole = text.fingerprints(spark, pattern).collect()
    other = spark.newSession()
    other.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    other.conf.set("spark.sql.files.openCostInBytes", "1000")
    assert text.fingerprints(other, pattern).collect() == whole and text.line_sums(other, pattern).count() > 20
    plan = text.line_sums(spark, pattern)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan
