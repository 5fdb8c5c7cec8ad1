"""Plan assertions used by tests: shuffles, broadcasts, pushdown and pruning."""
from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str | None = None) -> str:
    """Text of ``explain`` (physical plan by default, or 'formatted' / 'extended')."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode) if mode else df.explain()
    return buf.getvalue()


_SHUFFLE = re.compile(r"(?<!Broadcast)Exchange")


def has_shuffle(df: DataFrame) -> bool:
    """True if the plan has an Exchange that is not a BroadcastExchange."""
    return bool(_SHUFFLE.search(plan_text(df)))


def shuffle_count(df: DataFrame) -> int:
    return len(_SHUFFLE.findall(plan_text(df)))


def uses_broadcast_join(df: DataFrame) -> bool:
    return "BroadcastHashJoin" in plan_text(df)


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[([^\n]*)\]", plan_text(df, "formatted"))


def partition_filters(df: DataFrame) -> list[str]:
    return [p for p in re.findall(r"PartitionFilters: \[([^\n]*)\]", plan_text(df, "formatted")) if p]


def read_schemas(df: DataFrame) -> list[str]:
    """ReadSchema of every scan (formatted mode prints them untruncated)."""
    return re.findall(r"ReadSchema: (struct<[^\n]*>)", plan_text(df, "formatted"))


def has_window_group_limit(df: DataFrame) -> bool:
    return "WindowGroupLimit" in plan_text(df)
