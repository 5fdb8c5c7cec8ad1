"""Typed-column expressions for dirty text. Every rule is a JVM Column expression.

ANSI mode stays on: an invalid value becomes NULL through ``try_*`` functions instead
of failing the job, and no row is ever removed.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from microlake import config


def _has(df: DataFrame, name: str) -> bool:
    return name in df.columns


def optional_text(df: DataFrame, name: str) -> Column:
    """Trimmed string, or a typed NULL when the layout lacks the column."""
    return F.trim(F.col(name)) if _has(df, name) else F.lit(None).cast("string")


def int_of(c: Column) -> Column:
    """Text -> int: ``'02'`` is 2; ``''``, ``'1.5'`` and junk are NULL."""
    return F.trim(c).try_cast("int")


def safe_int(df: DataFrame, name: str) -> Column:
    return int_of(F.col(name)) if _has(df, name) else F.lit(None).cast("int")


def decimal_of(c: Column, precision: int = 18, scale: int = 2) -> Column:
    """Text -> decimal in both historical formats.

    With a comma it is the local format (``1.234,56``): dots are thousands separators
    and the comma is the decimal mark. Without a comma the text is read as is
    (``7771.49``). Invalid text or overflow gives NULL; rounding is HALF_UP.
    """
    v = F.trim(c)
    local = F.replace(F.replace(v, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    text = F.when(F.instr(v, ",") > 0, local).otherwise(v)
    return text.try_cast(f"decimal({precision},{scale})")


def safe_decimal(df: DataFrame, name: str, precision: int = 18, scale: int = 2) -> Column:
    if not _has(df, name):
        return F.lit(None).cast(f"decimal({precision},{scale})")
    return decimal_of(F.col(name), precision, scale)


def pay_of(c: Column) -> Column:
    """Pay: empty or NULL text means no pay in the period (0); invalid text is NULL.
    Missing text is read as the text '0' before the decimal rule."""
    return decimal_of(F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit("0")))


def pay_amount(df: DataFrame, name: str) -> Column:
    """Pay column; an absent column (layout without it) stays NULL, not 0."""
    return pay_of(F.col(name)) if _has(df, name) else F.lit(None).cast("decimal(18,2)")


def flag_of(c: Column) -> Column:
    """'1' -> true, anything else -> false, NULL stays NULL ('01' is false)."""
    return F.trim(c) == "1"


def date_of(c: Column, fmt: str | None = None) -> Column:
    """Text -> date; malformed text is NULL (plain to_date raises under ANSI)."""
    return F.try_to_date(c) if fmt is None else F.try_to_date(c, F.lit(fmt))


def keep_if_matches(c: Column, pattern: str) -> Column:
    """Value rule, not a row filter: keep the value when it matches, else NULL."""
    return F.when(c.rlike(pattern), c)


def keep_if_between(c: Column, low: int, high: int) -> Column:
    return F.when(c.between(low, high), c)


def region_of(state_code: Column, regions: dict[str, str] | None = None) -> Column:
    """Macro-region from the first digit of a state code; unknown digit -> NULL."""
    regions = config.REGIONS if regions is None else regions
    lookup = F.create_map(*[F.lit(x) for kv in sorted(regions.items()) for x in kv])
    return F.try_element_at(lookup, F.substring(state_code, 1, 1))


def band_of(c: Column, bounds: list[tuple[float, str]], top: str) -> Column:
    """Chained CASE: first bound with value < bound wins; NULL value -> NULL band."""
    expr = None
    for bound, label in bounds:
        expr = F.when(c < bound, label) if expr is None else expr.when(c < bound, label)
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(top))


def pay_band(c: Column) -> Column:
    return band_of(c, config.PAY_BANDS, config.PAY_BAND_TOP)


def age_band(c: Column) -> Column:
    return band_of(c, config.AGE_BANDS, config.AGE_BAND_TOP)


def local_number(c: Column, decimals: int = 2) -> Column:
    """1234567.891 -> '1.234.567,89' (dot thousands, comma decimals)."""
    return F.translate(F.format_number(c, decimals), ",.", ".,")


def decimal_comma(c: Column) -> Column:
    """1234.5 -> '1234,50' (two decimals, comma mark, no thousands separator)."""
    return F.replace(c.cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))
