"""Whitening of embeddings by QDWH spectral divide and conquer.

1. Entries become integers, so their sums are exact; the covariance is summed from entries less the
   rounded mean, also integers, and corrected by what the rounding left, in whole numbers.  Partial
   sums have the size of the dimensions, whatever the number of rows.
2. The covariance less a shift has an orthogonal polar factor, its matrix sign, by the dynamically
   weighted Halley iteration in QR form (QDWH).  Half of it and the identity is the projector on the
   eigenvalues above the shift.  Bases of its range and of the rest split the matrix in two, and each is
   split again until a part is one component, or a multiple of the identity.  Parts that hold none of
   the leading components asked for are left as they are.
3. The components over the roots of their eigenvalues travel to the tasks (dimensions x components
   numbers) and every row is projected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Columns of a row of the summed matrix.
BLOCK = 64
_EPS = np.finfo(float).eps


# --------------------------------------------------------------------------- spectral divide and conquer

def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix without an eigenvalue at zero, by QDWH."""
    n = len(a)
    x, low, eye = a / np.linalg.norm(a), _EPS, np.eye(len(a))
    for _ in range(20):
        l2 = low * low
        d = np.cbrt(4 * (1 - l2) / (l2 * l2))
        wa = np.sqrt(1 + d) + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - l2) / (l2 * np.sqrt(1 + d)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
        y = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        y, moved = (y + y.T) / 2, np.linalg.norm(y - x)
        x, low = y, min(1.0, low * (wa + wb * l2) / (1 + wc * l2))
        if low > 1 - 10 * _EPS and moved <= np.cbrt(_EPS):
            break
    return x


def split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of two invariant subspaces of a symmetric matrix that is no multiple of the
    identity: of the eigenvalues above a shift, and of those below."""
    n, mean = len(a), np.trace(a) / len(a)
    spread = np.linalg.norm(a - mean * np.eye(n)) / n  # some eigenvalue lies so far above the mean, and below
    small = np.cumsum(np.tile([1.0, -1.0], n + 1) * np.arange(1, 2 * n + 3)) / (n + 2)  # between -1 and 1, none twice
    for shift in (float(np.median(np.diag(a))), mean, *(mean + 0.9 * spread * small)):
        off = a - shift * np.eye(n)
        if not off.any():
            continue
        sign = polar(off)
        rank = int(round((np.trace(sign) + n) / 2))
        # an eigenvalue at the shift leaves no orthogonal factor
        if not 0 < rank < n or np.linalg.norm(sign @ sign - np.eye(n)) > 1e-8:
            continue
        upper = (sign + np.eye(n)) / 2
        basis = np.linalg.qr(upper @ np.random.default_rng(n).standard_normal((n, rank)))[0]
        basis = np.linalg.qr(upper @ basis)[0]
        whole = np.linalg.qr(basis, mode="complete")[0]
        return basis, whole[:, rank:]
    raise ArithmeticError("no shift splits the matrix")


def components(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns."""
    level = 4 * _EPS * np.linalg.norm(a) * np.sqrt(len(a))
    todo, found, missing = [np.eye(len(a))], [], min(k, len(a))
    while todo and missing > 0:  # the last part holds the largest eigenvalues
        basis = todo.pop()
        part = basis.T @ a @ basis
        part = (part + part.T) / 2
        if len(part) == 1 or np.linalg.norm(part - np.trace(part) / len(part) * np.eye(len(part))) <= level:
            found.append(basis)
            missing -= len(part)
            continue
        upper, lower = split(part)
        todo += [basis @ lower, basis @ upper]
    vectors = np.linalg.qr(np.hstack(found))[0] if found else np.zeros((len(a), 0))
    inside = vectors.T @ a @ vectors
    values = np.diag(inside).copy()
    # what rounding left between components, to first order
    gap = values[None, :] - values[:, None]
    turn = np.where(np.abs(gap) > 100 * level, inside / np.where(gap == 0, 1, gap), 0)
    vectors = np.linalg.qr(vectors + vectors @ turn)[0]
    values = np.sum(vectors * (a @ vectors), axis=0)
    order = np.argsort(-values, kind="stable")[:k]
    return values[order], vectors[:, order]


# --------------------------------------------------------------------------- rows

@dataclass
class Whitening:
    """What ``fit`` learns: ``n`` vectors of ``len(sums)`` dimensions, and per component its eigenvalue,
    unit vector (columns) and share of the trace (nan if there is no variance)."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray

    @property
    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean as whole numbers and the rest."""
        whole = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        return np.array(whole, np.int64), np.array([(s - self.n * w) / self.n for s, w in zip(self.sums, whole)])


def _rows(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold ``dim`` finite numbers, and these as integers."""
    size = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)  # a null is nan
    right = size == dim
    values = flat[np.repeat(right, np.maximum(size, 0))].reshape(-1, dim)
    finite = np.isfinite(values).all(axis=1)
    with np.errstate(over="ignore"):
        whole = np.clip(np.floor(SCALE * values[finite]), -(2.0 ** 62), 2.0 ** 62).astype(np.int64) + SHIFT
    return np.flatnonzero(right)[finite], whole


def _vectors(df: DataFrame, column: str) -> DataFrame:
    return df.select(df[f"`{column}`"].cast("array<double>").alias("v"))


def fit(df: DataFrame, column: str = "embedding", k: int = 8) -> Whitening:
    """The leading ``k`` components of all usable vectors of ``df`` (see ``whiten``)."""
    rows = _vectors(df, column)
    size = rows.where("v IS NOT NULL").groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    common = size.orderBy(F.desc("n"), F.desc("size")).first()
    dim = common.size if common else 0
    if not dim:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), np.zeros(0))

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(dim, np.int64), np.zeros(dim, np.int64)
        for batch in batches:
            _, x = _rows(batch.column(0), dim)
            n, high, low = n + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(high), pa.array(low), pa.array(np.full(dim, n))],
                                         ["i", "high", "low", "n"])

    found = rows.mapInArrow(totals, "i int, high long, low long, n long").groupBy("i").agg(*[F.sum(c).alias(c) for c in ("high", "low", "n")])
    found = sorted(found.collect())
    n, sums = found[0].n, [(r.high << 32) + r.low for r in found]
    if not n:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), np.zeros(0))
    made = Whitening(n, sums, np.zeros(0), np.zeros((dim, 0)), np.zeros(0))
    whole, _ = made.centre
    names = [f"s{j}" for j in range(BLOCK)]

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, -(-dim // BLOCK) * BLOCK))
        for batch in batches:
            _, x = _rows(batch.column(0), dim)
            y = (x - whole).astype(float)
            total[:, :dim] += y.T @ y
        for b in range(0, dim, BLOCK):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(np.full(dim, b, np.int32)),
                                              *[pa.array(total[:, b + j]) for j in range(BLOCK)]], ["i", "b", *names])

    schema = f"i int, b int, {', '.join(f'{c} double' for c in names)}"
    parts = rows.mapInArrow(products, schema).groupBy("i", "b").agg(*[F.sum(c).alias(c) for c in names])
    product = np.zeros((dim, -(-dim // BLOCK) * BLOCK))
    for r in parts.collect():  # dimensions squared
        product[r.i, r.b:r.b + BLOCK] = r[2:]
    rest = [s - n * int(w) for s, w in zip(sums, whole)]
    cov = np.array([[(n * int(product[i, j]) - rest[i] * rest[j]) / (n * n) for j in range(dim)] for i in range(dim)])
    cov, trace = (cov + cov.T) / 2, float(np.trace(cov))
    made.values, made.vectors = components(cov, k)
    made.explained = made.values / trace if trace > 0 else np.full(len(made.values), np.nan)
    return made


def whiten(df: DataFrame, model: Whitening, column: str = "embedding", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default), ``deviation`` and ``whitened`` of the usable rows.

    Dropped are rows whose vector is null, holds a null or non-finite entry, or has another number of
    entries than the most frequent one (of equally frequent ones the largest); if that is zero, all go.
    Entries beyond 2**62 / 1024 count as that much.  ``deviation`` is the exact sum over dimensions of
    (n * x - S)**2, null where it is more than a long holds.  ``whitened`` has a number for each
    component, null for those without variance (as all are if the rows are equal).  Rows with equal
    vectors have equal results, other columns and repeated rows do no harm, and an empty table gives no
    rows.  A kept column with the name of a new one (all in lower case) is replaced by it.
    """
    fields = [T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))]
    names = [c for c in (df.columns if keep is None else keep) if c.lower() not in ("deviation", "whitened")]
    schema = T.StructType([df.schema[c] for c in names] + fields)
    if not model.n:
        return df.sparkSession.createDataFrame([], schema)
    dim, n, (whole, rest) = len(model.sums), model.n, model.centre
    # as many digits as the matrix gives
    sure = model.values > dim * _EPS * max(model.values[0], 0)
    matrix = np.where(sure, model.vectors / np.sqrt(np.where(sure, model.values, 1)), np.nan)
    exact, wrapped = model.sums, np.array([s % (1 << 64) for s in model.sums], np.uint64)
    out_names, last, types = [f.name for f in schema], len(names), [to_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = _rows(batch.column(last), dim)
            y = (x - whole) - rest
            rough = (y * y).sum(axis=1) * float(n) * float(n)
            off = (x.astype(np.uint64) * np.uint64(n) - wrapped).view(np.int64)  # exact where the sum fits
            deviation, fits = (off * off).sum(axis=1), rough < 0.999 * 2.0 ** 63
            for r in np.flatnonzero((rough > 0.999 * 2.0 ** 63) & (rough < 1.001 * 2.0 ** 63)):
                total = sum((n * int(v) - s) ** 2 for v, s in zip(x[r], exact))
                if total < 1 << 63:
                    deviation[r], fits[r] = total, True
            flat = (y @ matrix).ravel()
            offs = np.arange(len(rows) + 1, dtype=np.int32) * matrix.shape[1]
            made = [pa.array(deviation, types[0], mask=~fits),
                    pa.ListArray.from_arrays(pa.array(offs), pa.array(flat, mask=np.isnan(flat))).cast(types[1])]
            kept = [batch.column(i).take(pa.array(rows)) for i in range(last)]
            yield pa.RecordBatch.from_arrays(kept + made, out_names)

    own = "_vector"
    while own in names:
        own = f"_{own}"
    return df.select(*[df[f"`{c}`"] for c in names], df[f"`{column}`"].cast("array<double>").alias(own)).mapInArrow(run, schema)


def identity_error(whitened: DataFrame, column: str = "whitened") -> float | None:
    """Largest absolute entry of the whitened vectors' covariance (divisor n) less the identity, over the
    components with variance; None without any."""
    w = F.col(column)
    size = whitened.select(F.filter(w, lambda x: x.isNotNull()).alias("w")).where(F.size("w") > 0)
    first = size.first()
    if first is None:
        return None
    k = len(first.w)  # the same for all rows

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))  # the first row and column: sums and the number of rows
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            x = np.hstack([np.ones((len(x), 1)), x])
            total += x.T @ x
        i, j = np.indices(total.shape, np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], ["i", "j", "s"])

    total = np.zeros((k + 1, k + 1))
    for r in size.mapInArrow(sums, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        total[r.i, r.j] = r.s
    mean = total[0, 1:] / total[0, 0]
    return float(np.abs(total[1:, 1:] / total[0, 0] - np.outer(mean, mean) - np.eye(k)).max())
