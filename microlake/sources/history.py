"""JSON-lines histories (check results, run manifests) read with a fixed schema."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
CHECK_HISTORY_SCHEMA = ("ts timestamp_ntz, aula int, check string, status string, "
                        "detalhe string, origem string, _corrupt_record string")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Blank lines are skipped by the reader; malformed lines land in ``_corrupt_record``
    (PERMISSIVE) instead of failing or vanishing."""
    return (spark.read.schema(schema)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record")
            .option("timestampNTZFormat", TS_FORMAT)
            .json(path))


def write_jsonl(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append history rows as JSON lines; timestamps keep microseconds."""
    df.write.mode(mode).option("timestampNTZFormat", TS_FORMAT).json(path)


def read_check_history(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, CHECK_HISTORY_SCHEMA)
