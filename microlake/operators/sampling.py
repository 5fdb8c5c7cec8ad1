"""Deterministic sampling for distribution estimates."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hash_sample(df: DataFrame, keys: list[str], percent: int, seed: int = 42,
                portable: bool = False) -> DataFrame:
    """Deterministic ~percent% sample: a row is kept when the hash of its key falls in
    the first ``percent`` of 100 buckets. Unlike ``head``, it does not depend on file
    order (sorted sources make ``head`` a biased sample); unlike ``sample`` it picks
    the same rows on every run and every partitioning.

    ``portable``: bucket from the first 32 bits of md5('seed|k1|k2..'), which any SQL
    engine can recompute (slower than the default xxhash64)."""
    if portable:
        text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
        bucket = F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(100))
    else:
        bucket = F.pmod(F.xxhash64(F.lit(seed), *[F.col(k) for k in keys]), F.lit(100))
    return df.filter(bucket < percent)
