"""Nested JSON -> flat dimension (municipality list as published by a localities API)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# explicit nested schema: nothing is inferred, unknown fields are ignored
MUNICIPALITY_SCHEMA = (
    "id long, nome string, "
    "`regiao-imediata` struct<`regiao-intermediaria`: struct<UF: struct<sigla: string, "
    "regiao: struct<nome: string>>>>"
)


def read_nested(spark: SparkSession, path: str, schema: str = MUNICIPALITY_SCHEMA,
                multiline: bool = False) -> DataFrame:
    """JSON lines (or one JSON array per file with ``multiline``); gzip is detected
    from the file extension."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def flatten_municipalities(df: DataFrame) -> DataFrame:
    """id -> 6-char code (the 7th digit is a check digit), name, state, region."""
    uf = F.col("`regiao-imediata`.`regiao-intermediaria`.UF")
    return df.select(
        F.substring(F.col("id").cast("string"), 1, 6).alias("cod_municipio"),
        F.col("nome").alias("nome_municipio"),
        uf.getField("sigla").alias("uf"),
        uf.getField("regiao").getField("nome").alias("regiao"),
    )
