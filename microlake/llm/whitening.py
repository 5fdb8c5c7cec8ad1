"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Entries are scaled and rounded down to integers x; the fit list is every distinct x-vector
once, n rows. With X its rows minus their mean, alternating products p = Xv and w = Xᵀu build
orthonormal bases U and V with X V = U B, B upper bidiagonal. Its singular values over
sqrt(n) are the deviations along the components, which are V times its right singular
vectors.

* One Spark job per step. A task computes its rows' part of p, and from it the parts of
  Uᵀp, Xᵀp and |p|²; Spark adds them up, so the driver gets a few numbers per dimension.
* A row of U is a function of that row of X and of numbers the driver has (V and the
  coefficients of B), so tasks compute it again in every step and no state of n rows is
  kept: a lost executor costs its tasks and nothing else.
* Full reorthogonalisation on both sides: Uᵀp is measured and taken out in every step (a
  second job measures again if that cancels much of p), w against V on the driver, twice.
* A run ends when the leading triplets' residuals vanish next to the largest singular value,
  or when nothing is left in the space. Equal eigenvalues hide behind one another in a
  single run, so further runs start orthogonal to what was found, until the largest value
  they can still hold lies below the components kept.
"""
from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored
from .vectors import binary_rows, by_length, typed, usable

COMPONENTS, SCALE = 4, 256
SEED = 20_011
_BLOCK = 4096
_TINY = 1e-14                   # of the largest singular value
_LONG = float(1 << 62)


# --- integers -----------------------------------------------------------------------

def integers(matrix: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * entry), computed in double; beyond 64 bits the nearest 64-bit integer."""
    x = np.floor(scale * matrix.astype(np.float64))
    out = np.clip(x, -9.2e18, 9.2e18).astype(np.int64)
    out[x >= 2.0 ** 63] = (1 << 63) - 1
    out[x <= -2.0 ** 63] = -(1 << 63)
    return out


def _coded(x: np.ndarray) -> list[bytes]:
    """Equal integer vectors have equal codes: the fewest of 1, 2, 4 or 8 bytes that hold all entries."""
    need = np.ones(len(x), np.int64)
    low, high = x.min(axis=1), x.max(axis=1)
    for size in (1, 2, 4):
        need[(low < -(1 << (8 * size - 1))) | (high >= 1 << (8 * size - 1))] = 2 * size
    out: list[bytes] = [b""] * len(x)
    for size in np.unique(need).tolist():
        rows = np.flatnonzero(need == size)
        for k, code in zip(rows.tolist(), binary_rows(x[rows].astype(f"<i{size}"))):
            out[k] = bytes([size]) + code
    return out


def _decoded(codes: list[bytes], dim: int) -> np.ndarray:
    sizes = np.frombuffer(b"".join(c[:1] for c in codes), np.uint8)
    out = np.empty((len(codes), dim), np.int64)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        out[rows] = np.frombuffer(b"".join(codes[k][1:] for k in rows.tolist()), f"<i{size}").reshape(-1, dim)
    return out


def _quantise(scale: int):
    def run(batches):
        for batch in batches:
            for _, matrix in by_length(*usable(batch.column(0))):
                yield pa.RecordBatch.from_pydict({"dim": pa.array([matrix.shape[1]] * len(matrix), pa.int32()),
                                                  "x": pa.array(_coded(integers(matrix, scale)), pa.binary())})

    return run


def _blocks(batches, dim: int):
    """Integer matrices of bounded height from batches whose first column holds codes."""
    for batch in batches:
        codes = batch.column(0).to_pylist()
        for k in range(0, len(codes), _BLOCK):
            yield _decoded(codes[k:k + _BLOCK], dim)


def _sums(dim: int):
    schema = pa.schema([("at", pa.int32()), ("s", pa.decimal128(38, 0))])

    def run(batches):
        total = [0] * dim
        for x in _blocks(batches, dim):
            exact = x if float(np.abs(x.astype(np.float64)).max(initial=0)) * len(x) < _LONG else x.astype(object)
            total = [a + int(b) for a, b in zip(total, exact.sum(axis=0))]
        if any(total):
            yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array(list(map(Decimal, total)), schema.field(1).type)],
                                             schema=schema)

    return run


# --- the distributed products -------------------------------------------------------

def _summed(fit: DataFrame, part) -> np.ndarray:
    """Element-wise total of the one row of numbers that ``part`` makes of each task's rows."""
    def run(batches):
        out = part(batches)
        if out is not None:
            yield pa.RecordBatch.from_pydict({"v": pa.array([out.tolist()], pa.list_(pa.float64()))})

    row = fit.mapInArrow(run, "v array<double>").select(array_to_vector("v").alias("v")).agg(Summarizer.sum(F.col("v")).alias("s")).first()
    return row["s"].toArray()


def _left(t: np.ndarray, upper: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
    """Rows of U, the last column not yet scaled, from rows ``t`` of X V: U (upper + diagonal) = X V."""
    u = np.empty_like(t)
    for k in range(t.shape[1]):
        u[:, k] = t[:, k] - u[:, :k] @ upper[:k, k]
        if k < len(diagonal):
            u[:, k] /= diagonal[k]
    return u


def _product(mean: np.ndarray, v: np.ndarray, upper: np.ndarray, diagonal: np.ndarray):
    """Of p = X v_k - U (coefficients): the parts of Uᵀp, Xᵀp, |p|² and of |X|²."""
    dim, k = v.shape

    def part(batches):
        out, seen = np.zeros(k - 1 + dim + 2), False
        for x in _blocks(batches, dim):
            centred = x - mean
            u = _left(centred @ v, upper, diagonal)
            p = u[:, -1]
            out[:k - 1] += u[:, :-1].T @ p
            out[k - 1:-2] += centred.T @ p
            out[-2] += p @ p
            out[-1] += np.einsum("ij,ij->", centred, centred)
            seen = True
        return out if seen else None

    return part


def _spread(mean: np.ndarray, scaled: np.ndarray):
    """Sums and products of the whitened columns."""
    dim, m = scaled.shape

    def part(batches):
        out, seen = np.zeros(m + m * m), False
        for x in _blocks(batches, dim):
            white = (x - mean) @ scaled
            out[:m] += white.sum(axis=0)
            out[m:] += (white.T @ white).ravel()
            seen = True
        return out if seen else None

    return part


def _orthogonal(w: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    for _ in range(2):
        for basis in bases:
            w = w - basis @ (basis.T @ w)
    return w


@dataclass
class _Run:
    """Singular triplets of one run, largest first."""
    values: np.ndarray
    right: np.ndarray
    sure: np.ndarray                # whose residual vanishes
    whole: bool                     # nothing is left of the space
    square: float                   # |X|²


def _bidiagonalise(fit: DataFrame, mean: np.ndarray, locked: np.ndarray, start: np.ndarray, want: int, largest: float,
                   least: float | None) -> _Run:
    """One run orthogonal to ``locked``; ends with ``want`` sure triplets, or, if ``least`` is given, as soon as the
    largest value it can reach is sure to lie below it."""
    dim = len(mean)
    v = start[:, None]
    upper, diagonal = np.zeros((0, 0)), np.zeros(0)
    products = np.zeros((dim, 0))                       # Xᵀu of the finished u
    square = 0.0
    while True:
        k = v.shape[1]
        upper = np.pad(upper, ((0, k - len(upper)), (0, k - len(upper))))
        if k > 1:
            upper[k - 2, k - 1] = beta                  # noqa: F821  of the step before
        for _ in range(3):
            total = _summed(fit, _product(mean, v, upper, diagonal))
            along, w, norm, square = total[:k - 1], total[k - 1:-2], total[-2], total[-1]
            largest = max(largest, float(np.sqrt(norm)))
            kept = norm - along @ along
            upper[:k - 1, k - 1] += along
            w = w - products @ along
            if kept > 0.5 * norm or norm <= (_TINY * largest) ** 2:
                break
        alpha = float(np.sqrt(max(kept, 0.0)))
        if alpha <= _TINY * largest:                    # X v lies in the span of U: the last column has no u of its own
            return _triplets(_bidiagonal(diagonal, upper)[:k - 1], v, 0.0, largest, True, square)
        diagonal = np.append(diagonal, alpha)
        products = np.hstack([products, (w / alpha)[:, None]])
        w = _orthogonal(products[:, -1] - alpha * v[:, -1], locked, v)
        beta = float(np.linalg.norm(w))
        whole = beta <= _TINY * largest or k + locked.shape[1] >= dim
        bidiagonal = _bidiagonal(diagonal, upper)
        run = _triplets(bidiagonal, v, 0.0 if whole else beta, largest, whole, square)
        if whole or run.sure[:want].sum() == want:
            return run
        if least is not None and k >= 4:
            rest = _residual(bidiagonal, beta)[0]
            if rest <= 1e-3 * run.values[0] and run.values[0] + rest < least:
                return run
        v = np.hstack([v, (w / beta)[:, None]])


def _bidiagonal(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    return np.diag(np.pad(diagonal, (0, len(upper) - len(diagonal)))) + np.diag(np.diag(upper, 1), 1)


def _residual(bidiagonal: np.ndarray, beta: float) -> np.ndarray:
    left, _, _ = np.linalg.svd(bidiagonal)
    return beta * np.abs(left[-1])


def _triplets(bidiagonal: np.ndarray, v: np.ndarray, beta: float, largest: float, whole: bool, square: float) -> _Run:
    k = bidiagonal.shape[1]
    if not len(bidiagonal):
        return _Run(np.zeros(k), v, np.ones(k, bool), whole, square)
    left, values, right = np.linalg.svd(bidiagonal)
    values = np.append(values, np.zeros(k - len(values)))
    sure = np.ones(k, bool) if whole else beta * np.abs(left[-1]) <= _TINY * max(largest, values[0])
    return _Run(values, v @ right.T, sure, whole, square)


# --- the operator -------------------------------------------------------------------

@dataclass
class Whitening:
    """What ``fit`` finds; a few numbers per dimension."""
    dim: int
    n: int
    sums: list[int]
    components: np.ndarray          # dim x components, unit columns
    variances: np.ndarray           # eigenvalues of the covariance, falling
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def fit(spark: SparkSession, vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE,
        id_col: str = "vec_id", vector_col: str = "embedding") -> Whitening | None:
    """Leading components of the distinct x-vectors, or None where no row can be used.

    Rows whose vector is null, empty or holds null or non-finite entries are left out. If
    vectors differ in length, the most frequent length among the distinct ones counts (the
    greater of equally frequent ones) and rows of another length are left out. A component
    needs a variance: vectors that all agree have none, and fewer dimensions or rows than
    ``components`` give fewer.
    """
    rows = typed(vectors, id_col, vector_col).select("vector").mapInArrow(_quantise(scale), "dim int, x binary")
    distinct = stored(spark, rows.distinct(), "whitening-fit")
    counts = distinct.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    if counts is None:
        return None
    dim, n = counts["dim"], counts["n"]
    listed = distinct.where(F.col("dim") == dim).select("x")
    sums = [0] * dim
    for r in listed.mapInArrow(_sums(dim), "at int, s decimal(38,0)").groupBy("at").agg(F.sum("s").alias("s")).collect():   # dim rows
        sums[r["at"]] = int(r["s"])
    model = Whitening(dim, n, sums, np.zeros((dim, 0)), np.zeros(0), 0.0, 0.0)
    mean, rng = model.mean, np.random.default_rng(SEED)
    locked, values, right, largest = np.zeros((dim, 0)), np.zeros(0), np.zeros((dim, 0)), 0.0
    while locked.shape[1] < dim:
        start = _orthogonal(rng.standard_normal(dim), locked)
        enough = len(values) >= components
        run = _bidiagonalise(listed, mean, locked, start / np.linalg.norm(start), components if not enough else 1, largest,
                             float(values[components - 1]) if enough else None)
        model.trace = run.square / n
        largest = max(largest, float(run.values[0]))
        best = run.values[run.sure & (run.values > _TINY * largest)]
        if enough and (not len(best) or best[0] <= values[components - 1]):
            break                                       # nothing left that is larger than the components kept
        if run.square <= 0:
            break
        locked = np.hstack([locked, run.right[:, run.sure]])
        values, right = np.append(values, run.values[run.sure]), np.hstack([right, run.right[:, run.sure]])
        order = np.argsort(-values, kind="stable")
        values, right = values[order], right[:, order]
        if run.square - (values ** 2).sum() <= 1e-13 * run.square:
            break                                       # all variance is found
    held = values[:components] > 1e-12 * max(largest, 1e-300)
    model.components, model.variances = right[:, :components][:, held], values[:components][held] ** 2 / n
    m = len(model.variances)
    if m:
        total = _summed(listed, _spread(mean, model.components / np.sqrt(model.variances)))
        centre = total[:m] / n
        model.identity_error = float(np.abs(total[m:].reshape(m, m) / n - np.outer(centre, centre) - np.eye(m)).max())
    return model


_OUT = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                  ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)², exact; None beyond 64 bits."""
    most = n * float(np.abs(x.astype(np.float64)).max(initial=0)) + float(max(map(abs, sums)))
    if most ** 2 * x.shape[1] < _LONG:
        d = n * x - np.array(sums, np.int64)
        return np.einsum("ij,ij->i", d, d).tolist()
    totals = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x.tolist()]
    return [t if t < 1 << 63 else None for t in totals]


def _transform(model: Whitening, scale: int):
    mean, scaled = model.mean, model.components / np.sqrt(model.variances)
    m, explained = len(model.variances), (model.variances / model.trace if model.trace else model.variances)

    def run(batches):
        for batch in batches:
            mask, first, length, flat = usable(batch.column(1))
            ids = batch.column(0)
            rows = np.flatnonzero(mask & (length == model.dim))
            for k in range(0, len(rows), _BLOCK):
                part = rows[k:k + _BLOCK]
                x = integers(flat[first[part][:, None] + np.arange(model.dim)], scale)
                white = ((x - mean) @ scaled).ravel()
                each = np.repeat(np.arange(len(part)), m)
                deviation = pa.array(_deviations(x, model.n, model.sums), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(part[each])), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(part))),
                     pa.array(np.full(len(each), model.n)), deviation.take(pa.array(each)), pa.array(white),
                     pa.array(np.tile(explained, len(part))), pa.array(np.full(len(each), model.identity_error))], schema=_OUT)

    return run


def whiten(spark: SparkSession, vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Usable rows and the number of components as in ``fit``; repeated rows and null ids stay
    as they are and count once in the fit; an empty table, or one whose vectors all agree,
    gives no rows; other columns are not read. deviation is null beyond 64 bits.
    """
    model = fit(spark, vectors, components, scale, id_col, vector_col)
    if model is None or not len(model.variances):
        return spark.createDataFrame([], OUT)
    return typed(vectors, id_col, vector_col).mapInArrow(_transform(model, scale), OUT)
