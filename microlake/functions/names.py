"""Column-name normalisation (schema-time work on names, never per row)."""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from microlake import config


# fixed values: latin-1 letters with their ASCII base letter (headers are latin-1 text)
ACCENTED = "áàâãäåçéèêëíìîïñóòôõöúùûüýÿªº¹²³"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyao123"
# latin-1 spacing characters outside ASCII (no-break space, next line): separators
SPACING = "\u00a0\u0085"
_FOLD = str.maketrans(ACCENTED + SPACING, PLAIN + " " * len(SPACING))
_NON_ASCII = re.compile(r"[^\x00-\x7f]")
_SEPARATORS = re.compile(r"[^a-z0-9]+")


def normalize_name(name: str) -> str:
    """'Vl Remun Média (SM)' -> 'vl_remun_media_sm'.

    Lower case, accented letters folded to their base letter, non-ASCII spacing read as a
    blank, any other non-ASCII character dropped, every run of other characters turned into one '_', edges
    trimmed. The same rule as ``normalize_name_expr``, so names normalised on the
    driver and header strings normalised by Spark always agree.
    """
    folded = _NON_ASCII.sub("", name.strip().lower().translate(_FOLD))
    return _SEPARATORS.sub("_", folded).strip("_")


def normalized_names(names: list[str]) -> list[str]:
    out = [normalize_name(c) for c in names]
    dup = sorted({c for c in out if out.count(c) > 1})
    if dup:
        raise ValueError(f"column names collide after normalisation: {dup}")
    return out


def normalize_columns(df: DataFrame) -> DataFrame:
    """Normalise every column name; raise when two names collide."""
    return df.toDF(*normalized_names(df.columns))


def canonical_renames(columns: list[str], renames: dict[str, str] | None = None) -> dict[str, str]:
    """Renames that apply to these columns; an existing canonical name is never overwritten."""
    renames = config.CANONICAL_NAMES if renames is None else renames
    present = set(columns)
    return {old: new for old, new in renames.items() if old in present and new not in present}


def canonicalize(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """Rename layout-specific names to canonical ones in a single projection."""
    mapping = canonical_renames(df.columns, renames)
    return df.withColumnsRenamed(mapping) if mapping else df


def normalize_name_expr(c: Column) -> Column:
    """``normalize_name`` as a Column expression, for header strings held as data."""
    s = F.translate(F.lower(F.trim(c)), ACCENTED + SPACING, PLAIN + " " * len(SPACING))
    s = F.regexp_replace(s, r"[^\x00-\x7f]", "")
    s = F.regexp_replace(s, r"[^a-z0-9]+", "_")
    return F.regexp_replace(s, r"^_+|_+$", "")
