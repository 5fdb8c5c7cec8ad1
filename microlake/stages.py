"""The load of one year as plain composed functions: bronze -> gated silver -> gold
-> manifest. Each stage reads what the previous one wrote (a written table cuts the
lineage, so a lost executor recomputes from storage, not from the text files), and all
paths live under one lake root on shared storage."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from microlake import config
from microlake.operators import manifest, quality
from microlake.operators.silver import to_silver_stored
from microlake.session import scratch_path
from microlake.sinks import tables
from microlake.sources import text


def paths(lake_root: str) -> dict[str, str]:
    root = lake_root.rstrip("/")
    return {"bronze": f"{root}/bronze", "silver": f"{root}/silver", "gold": f"{root}/gold",
            "manifest": f"{root}/ops_manifest", "archive": f"{root}/silver_archive", "headers": f"{root}/ops_headers",
            "history": f"{root}/ops_history"}


def bronze_year(spark: SparkSession, folder: str, ano: int, bronze_path: str,
                rows: list | None = None) -> None:
    """Every file of the year's folder, in whatever layouts, replaces that year in the
    bronze table (new columns are merged into the table schema)."""
    tables.replace_partition(text.read_year(spark, folder, ano, rows), bronze_path, ano,
                             merge_schema=True)


def silver_year(spark: SparkSession, folder: str, ano: int, bronze_path: str,
                silver_path: str, rows: list | None = None, archive: str | None = None,
                snapshot_id: str | None = None) -> int:
    """Typed silver of the year, column presence decided per source file, contract
    checked, gated on a staging copy and only then published; the year as it was moves to
    ``archive`` as snapshot ``snapshot_id``."""
    b = tables.read_partition(spark, bronze_path, ano, merge_schema=True)
    rows = rows if rows is not None else text.landed_rows(spark, folder.rstrip("/") + "/*")
    s = to_silver_stored(b, rows)
    quality.check_contract(spark, s, config.SILVER_CONTRACT, "silver")
    return tables.publish_year(spark, s, b, silver_path, ano, scratch_path(spark, f"silver-stage-{ano}"),
                               archive=archive, snapshot_id=snapshot_id)


def gold_years(spark: SparkSession, silver_path: str, gold_root: str, years: list[int] | None = None) -> dict[str, str]:
    """The marts of ``years`` (None: all). Every mart is keyed by year, so a load aggregates
    and replaces the years it loaded, not the whole of silver."""
    return tables.write_gold(spark, tables.read_table(spark, silver_path), gold_root, years=years)


def record_run(spark: SparkSession, p: dict[str, str], run_id: str, ts: str, ano: int) -> DataFrame:
    """A manifest row per layer of the year: operation, snapshot id, rows."""
    layers = {
        "bronze": tables.read_partition(spark, p["bronze"], ano),
        "silver": tables.read_partition(spark, p["silver"], ano),
        "gold_vinculos_ativos": tables.read_table(spark, f"{p['gold']}/gold_emprego_uf_ano")
        .filter(F.col("ano") == ano),
    }
    rows = manifest.manifest_rows(manifest.layer_counts(layers), run_id, ts, list(layers))
    manifest.append_manifest(rows, p["manifest"])
    return rows


def load_years(spark: SparkSession, raw_root: str, years: list[int], lake_root: str,
               run_id: str, ts: str) -> dict[str, str]:
    """raw_root/<ano>/ (any files, any extension) of each year -> bronze and silver per
    year, the gold marts of these years once, one manifest row per layer and year. The
    silver that a year replaces stays as snapshot ``run_id`` in the archive."""
    p = paths(lake_root)
    for ano in years:
        folder = f"{raw_root.rstrip('/')}/{ano}"
        rows = text.landed_rows(spark, folder + "/*", p["headers"])      # headers read once per file
        bronze_year(spark, folder, ano, p["bronze"], rows)
        n = silver_year(spark, folder, ano, p["bronze"], p["silver"], rows, p["archive"], run_id)
        tables.log_write(spark, p["history"], "silver", ano, "replace", run_id, ts, n)
    gold = gold_years(spark, p["silver"], p["gold"], years)
    for ano in years:
        record_run(spark, p, run_id, ts, ano)
    return gold


def load_year(spark: SparkSession, raw_root: str, ano: int, lake_root: str, run_id: str,
              ts: str) -> None:
    """``load_years`` of one year."""
    load_years(spark, raw_root, [ano], lake_root, run_id, ts)
