"""Arrow batches of vectors as numpy matrices."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def typed(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id long, vector array of float or double); other element types become double."""
    kind = vectors.schema[vector_col].dataType
    if not isinstance(kind, T.ArrayType):
        raise ValueError(f"{vector_col} is not an array column")
    col = F.col(vector_col)
    if not isinstance(kind.elementType, (T.FloatType, T.DoubleType)):
        col = col.cast("array<double>")
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), col.alias("vector"))


def usable(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(mask, first, length, flat) of a list column: mask marks vectors that are neither null nor
    empty and hold no null or non-finite entry; vector k is ``flat[first[k]:first[k] + length[k]]``.
    """
    offsets = np.asarray(column.offsets).astype(np.int64)
    flat = pc.fill_null(column.values, float("nan")) if column.values.null_count else column.values
    flat = flat.to_numpy(zero_copy_only=False)
    first, length = offsets[:-1], np.diff(offsets)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    mask = (length > 0) & (bad[offsets[1:]] == bad[first])
    if column.null_count:
        mask &= np.asarray(column.is_valid())
    return mask, first, length, flat


def by_length(mask: np.ndarray, first: np.ndarray, length: np.ndarray, flat: np.ndarray):
    """(rows, matrix) for each length among the marked vectors."""
    for d in np.unique(length[mask]).tolist():
        rows = np.flatnonzero(mask & (length == d))
        yield rows, flat[first[rows][:, None] + np.arange(d)]


def binary_rows(matrix: np.ndarray) -> list[bytes]:
    """The bytes of each row."""
    raw, step = np.ascontiguousarray(matrix).tobytes(), matrix.shape[1] * matrix.itemsize
    return [raw[k:k + step] for k in range(0, len(raw), step)]
