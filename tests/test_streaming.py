"""Incremental load: each landed file is processed once."""
import os

from microlake.streaming import incremental


def _write(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="latin-1") as f:
        f.write(content)


def test_only_new_files_are_loaded(spark, tmp_dir):
    land, target, ckpt = tmp_dir + "/land", tmp_dir + "/bronze", tmp_dir + "/ckpt"
    _write(land + "/2022/a.txt", "Município;Idade\n261160;30\n230440;41\n")
    incremental.load_landing_incrementally(spark, land, target, ckpt)
    assert incremental.read_sink(spark, target).count() == 2
    _write(land + "/2023/b.txt", "Município;Idade\n355030;22\n")
    incremental.load_landing_incrementally(spark, land, target, ckpt)
    df = incremental.read_sink(spark, target)
    assert df.count() == 3
    assert {r["ano"]: r["arquivo_origem"] for r in df.select("ano", "arquivo_origem").distinct().collect()} == \
        {2022: "a.txt", 2023: "b.txt"}
    incremental.load_landing_incrementally(spark, land, target, ckpt)   # nothing new
    assert incremental.read_sink(spark, target).count() == 3


def test_layouts_and_extensions_mix(spark, tmp_dir):
    """.TXT, .txt, no extension, two layouts of one extension, an empty file; one more file between runs."""
    land, target, ckpt = tmp_dir + "/land", tmp_dir + "/bronze", tmp_dir + "/ckpt"
    _write(land + "/2022/a.TXT", "Município;Idade\n261160;30\n")
    _write(land + "/2022/a.txt", "Município;Idade\n230440;41\n")
    _write(land + "/2022/plain", "Idade,Município\n50,355030\n")
    _write(land + "/2022/b.txt", '"Município";"Sexo"\n"110001";"1"\n')
    _write(land + "/2022/empty.txt", "")
    incremental.load_landing_incrementally(spark, land, target, ckpt, max_files_per_trigger=2)
    _write(land + "/2023/c.odd.name", "Município;Idade\n431490;22\n")
    incremental.load_landing_incrementally(spark, land, target, ckpt)
    rows = {(r["arquivo_origem"], r["ano"], r["municipio"], r["idade"]) for r in incremental.read_sink(spark, target).collect()}
    assert rows == {("a.TXT", 2022, "261160", "30"), ("a.txt", 2022, "230440", "41"), ("plain", 2022, "355030", "50"),
                    ("b.txt", 2022, "110001", None), ("c.odd.name", 2023, "431490", "22")}
