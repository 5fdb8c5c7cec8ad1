"""Bronze, silver and the marts of the stand-in rows as stored tables."""
from __future__ import annotations

from pyspark.sql import SparkSession

from microlake.operators.silver import to_silver
from microlake.queries import inputs
from microlake.session import scratch_path
from microlake.sinks import tables

_LAKE: dict = {}


def load(spark: SparkSession, sf: str) -> dict[str, str]:
    """Bronze from the inputs and silver from bronze, in folders of their own: every call loads anew."""
    bronze, silver = scratch_path(spark, "lake-bronze"), scratch_path(spark, "lake-silver")
    tables.write_table(inputs.raw(spark, sf), bronze)
    tables.write_table(to_silver(tables.read_table(spark, bronze)), silver)
    return {"bronze.vinculos": bronze, "silver.vinculos": silver}


def stored(spark: SparkSession, sf: str) -> dict[str, str]:
    """Dictionary name -> path; written once per application and input."""
    key = (spark.conf.get("spark.app.id"), sf)
    if key not in _LAKE:
        layers = load(spark, sf)
        gold = tables.write_gold(spark, tables.read_table(spark, layers["silver.vinculos"]), scratch_path(spark, "lake-gold"))
        _LAKE[key] = {**layers, **{name.replace("gold_", "gold.", 1): path for name, path in gold.items()}}
    return _LAKE[key]
