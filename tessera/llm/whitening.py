"""Whitening of integer-scaled embeddings by principal components.

1. Row count and sums of every dimension: partial sums of Arrow batches, exact
   in 64 bits (an overflow is an error, not a wrapped number).
2. Centred covariance: every partition multiplies its centred rows and emits
   one matrix as (row, column, value), added up by a grouped aggregate. Centring
   comes first and in integers (``x - round(mean)``, then the mean's remainder),
   so a large common offset costs no digits.
3. On the driver, on one matrix of dimensions x dimensions (at most
   MAX_DIMENSIONS squared, whatever the number of rows): Householder
   reflections to a tridiagonal matrix, bisection by Sturm counts for the
   leading eigenvalues, inverse iteration for their vectors, with
   reorthogonalisation among near eigenvalues.
4. Projection: the components travel with the task, each row is centred and
   multiplied. The covariance of what comes out is measured in the same way as
   in 2 and compared with the identity.

Defined results: vectors that are null or hold null or non-finite entries are
left out of everything; shorter vectors count as padded with zeros; rows without
id and repeated rows count as rows of their own; with no remaining row, or
vectors that are all equal, there is no component and no output row; of equal
eigenvalues any orthonormal basis is taken; eigenvalues that are zero to the
precision of the matrix have no component. Entries from 2**30 on do not fit the
integer form and fail the job. Only the named columns are read, so others may
have any name. Texts do not occur here.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import scratch_path
from tessera.sources.tables import read_table

SCALE, OFFSET, COMPONENTS = 64.0, 1_000_000, 32
MAX_DIMENSIONS = 2048  # of a vector: bounds the matrix on the driver
MAX_ENTRY = 2.0 ** 30  # beyond it sums of integer entries could leave 64 bits
CLUSTER_GAP = 1e-3  # eigenvalues nearer than this share of the norm are one cluster
EPS = float(np.finfo(np.float64).eps)


# --- the matrix of dimensions: eigenvalues and eigenvectors -------------------

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, off-diagonal, q) with ``a = q t q'`` by Householder
    reflections."""
    a = np.array(a, np.float64)
    n = len(a)
    q = np.eye(n)
    for k in range(n - 2):
        x = a[k + 1:, k]
        norm = float(np.sqrt((x * x).sum()))
        if norm == 0.0:
            continue
        v, turned = x.copy(), -norm if x[0] >= 0 else norm
        v[0] -= turned
        v /= np.sqrt((v * v).sum())
        rest = a[k + 1:, k + 1:]
        w = rest @ v
        w -= (v @ w) * v
        rest -= 2.0 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1:, k] = 0.0
        a[k, k + 1:] = 0.0
        a[k + 1, k] = a[k, k + 1] = turned
        q[:, k + 1:] -= 2.0 * np.outer(q[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def sturm_count(diag: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Number of eigenvalues of the tridiagonal matrix below each value."""
    tiny = np.finfo(np.float64).tiny * 1e10
    count = np.zeros(len(at), np.int64)
    pivot = np.ones(len(at))
    with np.errstate(over="ignore"):  # an infinite pivot has the right sign
        for i in range(len(diag)):
            pivot = diag[i] - at - (off[i - 1] ** 2 / pivot if i else 0.0)
            pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
            count += pivot < 0
    return count


def leading_eigenvalues(diag: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection."""
    n = len(diag)
    reach = np.abs(np.concatenate([[0.0], off])) + np.abs(np.concatenate([off, [0.0]]))
    low = np.full(k, float((diag - reach).min()))
    high = np.full(k, float((diag + reach).max()))
    edge = EPS * max(np.abs(low).max(), np.abs(high).max())
    low, high = low - edge, high + edge
    want = n - 1 - np.arange(k)  # eigenvalues below the one looked for
    for _ in range(200):
        mid = (low + high) / 2
        if np.all((mid <= low) | (mid >= high)):
            break
        below = sturm_count(diag, off, mid) > want
        high, low = np.where(below, mid, high), np.where(below, low, mid)
    return (low + high) / 2


def _solve_shifted(diag: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray, floor: float) -> np.ndarray:
    """Solve (t - shift) x = b by elimination with row exchanges; a zero pivot
    becomes ``floor``."""
    n = len(diag)
    main, up, up2, x = diag - shift, np.append(off, 0.0), np.zeros(n), b.copy()
    for i in range(n - 1):
        low = off[i]
        if abs(low) > abs(main[i]):
            main[i], low = low, main[i]
            up[i], main[i + 1] = main[i + 1], up[i]
            up2[i], up[i + 1] = up[i + 1], up2[i]
            x[i], x[i + 1] = x[i + 1], x[i]
        elif main[i] == 0.0:
            main[i] = floor
        f = low / main[i]
        main[i + 1] -= f * up[i]
        up[i + 1] -= f * up2[i]
        x[i + 1] -= f * x[i]
    if abs(main[n - 1]) < floor:
        main[n - 1] = floor
    for i in range(n - 1, -1, -1):
        right = (up[i] * x[i + 1] if i + 1 < n else 0.0) + (up2[i] * x[i + 2] if i + 2 < n else 0.0)
        x[i] = (x[i] - right) / (main[i] if main[i] != 0.0 else floor)
        if abs(x[i]) > 1e200:  # only the direction counts
            x /= 1e200
    return x


def inverse_iteration(diag: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of the tridiagonal matrix for the given
    falling eigenvalues. Vectors of one cluster of near eigenvalues are made
    orthogonal to each other in every iteration."""
    n, k = len(diag), len(values)
    norm = float(np.abs(diag).max() + 2 * (np.abs(off).max() if n > 1 else 0.0))
    floor = max(EPS * norm, np.finfo(np.float64).tiny)
    rng = np.random.default_rng(20240)
    out = np.zeros((n, k))
    first = 0
    shift = np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER_GAP * norm:
            first = j
        # equal eigenvalues are told apart by the last digit
        shift = min(float(value), shift - 2 * floor) if j > first else float(value)
        x = rng.standard_normal(n)
        for _ in range(6):
            x = _solve_shifted(diag, off, shift, x / np.sqrt((x * x).sum()), floor)
            x /= np.abs(x).max()
            for _ in range(2):
                x -= out[:, first:j] @ (out[:, first:j].T @ x)
        out[:, j] = x / np.sqrt((x * x).sum())
    return out


def leading_components(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of a symmetric matrix: the
    ``k`` largest that are positive beyond its rounding errors, falling."""
    n = len(matrix)
    if not n or not np.abs(matrix).max():
        return np.zeros(0), np.zeros((n, 0))
    if n == 1:
        return matrix[0, :k].copy(), np.ones((1, min(k, 1)))
    diag, off, q = tridiagonal(matrix)
    values = leading_eigenvalues(diag, off, min(k, n))
    values = values[values > n * EPS * np.abs(values).max()]
    return values, q @ inverse_iteration(diag, off, values)


# --- the rows -----------------------------------------------------------------

def valid_vectors(df: DataFrame, vector: str, keep: list[str]) -> DataFrame:
    """(keep..., v): rows whose vector has no null or non-finite entry."""
    x = F.col(vector)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    huge = F.exists(x, lambda v: F.abs(v) >= MAX_ENTRY)
    checked = F.when(huge, F.raise_error(F.lit(f"a component of {MAX_ENTRY:.0f} or more has no integer form"))).otherwise(x)
    return df.filter(x.isNotNull() & ~bad).select(*keep, checked.cast("array<double>").alias("v"))


def _rows(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Rows of a list column as one matrix, short ones padded with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(sizes), dim))
    out[np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(s) for s in sizes])] = flat
    return out


@dataclass(frozen=True)
class Scaling:
    """How an entry becomes a number: floor(scale * v) + offset, or v itself
    where ``scale`` is None."""
    scale: float | None = SCALE
    offset: int = OFFSET

    def apply(self, v: np.ndarray) -> np.ndarray:
        return v if self.scale is None else np.floor(self.scale * v).astype(np.int64) + self.offset


@dataclass(frozen=True)
class Means:
    """Row count and exact sums; ``base`` is the rounded mean, ``rest`` what
    the mean has beyond it."""
    n: int
    sums: tuple

    @property
    def base(self) -> np.ndarray:
        return np.array([(2 * s + self.n) // (2 * self.n) if isinstance(s, int) else 0 for s in self.sums])

    @property
    def rest(self) -> np.ndarray:
        return np.array([(s - self.n * int(b)) / self.n for s, b in zip(self.sums, self.base)])

    def centre(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base).astype(np.float64) - self.rest


def means(vectors: DataFrame, scaling: Scaling, dim: int) -> Means:
    """Row count and per-dimension sums of ``v``."""
    kind = "double" if scaling.scale is None else "bigint"

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = scaling.apply(_rows(b.column("v"), dim))
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(x.sum(axis=0)),
                                                  pa.array(np.full(dim, len(x), np.int64))], names=["i", "s", "n"])

    parts = vectors.select("v").mapInArrow(partial, f"i int, s {kind}, n bigint")
    found = parts.groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).orderBy("i").collect()  # one row a dimension
    return Means(found[0]["n"] if found else 0, tuple(r["s"] for r in found))


def centred_covariance(vectors: DataFrame, scaling: Scaling, centre: Means, dim: int) -> np.ndarray:
    """Covariance (divisor n) of ``v``; rows are centred before they are
    multiplied."""
    if not centre.n:
        return np.zeros((dim, dim))
    row, col = np.triu_indices(dim)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((dim, dim)), False
        for b in batches:
            if b.num_rows:
                x = centre.centre(scaling.apply(_rows(b.column("v"), dim)))
                total, seen = total + x.T @ x, True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(row.astype(np.int32)), pa.array(col.astype(np.int32)), pa.array(total[row, col])],
                                             names=["i", "j", "s"])

    parts = vectors.select("v").mapInArrow(partial, "i int, j int, s double")
    found = parts.groupBy("i", "j").agg(F.sum("s").alias("s")).toArrow()  # one row an entry of the matrix
    i, j, s = (found.column(c).to_numpy() for c in ("i", "j", "s"))
    out = np.zeros((dim, dim))
    out[i, j] = out[j, i] = s / centre.n
    return out


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: ``axes`` holds a component's direction a column,
    ``values`` their eigenvalues."""
    scaling: Scaling
    dim: int
    centre: Means
    values: np.ndarray
    axes: np.ndarray
    trace: float

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if self.trace else self.values

    def transform(self, vectors: DataFrame) -> DataFrame:
        """The columns of ``vectors`` but ``v``, with ``deviation`` (exact sum
        of (n x - s)**2) and ``whitened`` (one number a component)."""
        fit, keep = self, [c for c in vectors.columns if c != "v"]
        scaled = self.axes / np.sqrt(self.values)

        def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = fit.scaling.apply(_rows(b.column("v"), fit.dim))
                out = fit.centre.centre(x) @ scaled
                offsets = pa.array(np.arange(len(out) + 1, dtype=np.int32) * out.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [b.column(c) for c in keep] + [fit.deviation(x), pa.ListArray.from_arrays(offsets, pa.array(out.reshape(-1)))],
                    names=[*keep, "deviation", "whitened"])

        return vectors.mapInArrow(project, _with_results(vectors))

    def deviation(self, x: np.ndarray) -> pa.Array:
        """Exact integers, in Python's arithmetic where 64 bits do not hold
        them; NULL beyond 38 digits."""
        n = self.centre.n
        left = x - self.centre.base
        over = np.array([s - n * int(b) for s, b in zip(self.centre.sums, self.centre.base)], dtype=object)
        most = n * int(np.abs(left).max(initial=0)) + n
        if most * most * max(1, self.dim) < 2 ** 63:
            d = n * left - over.astype(np.int64)
            return pa.array((d * d).sum(axis=1)).cast(pa.decimal128(38, 0), safe=False)
        d = n * left.astype(object) - over
        return pa.array([Decimal(int(v)) if v < 10 ** 38 else None for v in (d * d).sum(axis=1)], pa.decimal128(38, 0))


def fit(vectors: DataFrame, scaling: Scaling = Scaling(), components: int = COMPONENTS) -> Whitening:
    """Fit on all rows of ``vectors`` (``v`` as ``valid_vectors`` gives it)."""
    dim = vectors.agg(F.max(F.size("v"))).first()[0] or 0
    if dim > MAX_DIMENSIONS:
        raise ValueError(f"{dim} dimensions > {MAX_DIMENSIONS}")
    if not dim:
        return Whitening(scaling, 0, Means(0, ()), np.zeros(0), np.zeros((0, 0)), 0.0)
    centre = means(vectors, scaling, dim)
    matrix = centred_covariance(vectors, scaling, centre, dim)
    values, axes = leading_components(matrix, components)
    return Whitening(scaling, dim, centre, values, axes, float(np.trace(matrix)))


def _with_results(vectors: DataFrame) -> T.StructType:
    """Schema of transformed rows: the columns but ``v``, and the results."""
    return T.StructType([f for f in vectors.schema.fields if f.name != "v"] + [
        T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("whitened", T.ArrayType(T.DoubleType()))])


def identity_error(whitened: DataFrame, k: int) -> float:
    """Largest absolute entry of the covariance of the array column
    ``whitened`` minus the identity."""
    plain = Scaling(None, 0)
    v = whitened.select(F.col("whitened").alias("v"))
    cov = centred_covariance(v, plain, means(v, plain, k), k)
    return float(np.abs(cov - np.eye(k)).max(initial=0.0))


def whitened_rows(df: DataFrame, vector: str = "embedding", keep: tuple[str, ...] = ("vec_id",),
                  components: int = COMPONENTS) -> tuple[DataFrame, Whitening, float]:
    """(rows with ``deviation`` and ``whitened``, the fit, the identity error).
    The rows are a written table, so measuring them does not project twice."""
    spark = df.sparkSession
    vectors = valid_vectors(df, vector, list(keep))
    model = fit(vectors, components=components)
    if not len(model.values):
        return spark.createDataFrame([], _with_results(vectors)), model, 0.0
    path = scratch_path(spark, "whitened")
    model.transform(vectors).write.parquet(path)
    rows = spark.read.parquet(path)
    return rows, model, identity_error(rows, len(model.values))


def _literal(values: np.ndarray) -> Column:
    return F.array(*[F.lit(float(v)) for v in values]).cast("array<double>")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 32 leading components of every vector, whitened. ``deviation`` is
    NULL where it does not fit 64 bits."""
    rows, model, error = whitened_rows(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return (rows.select("vec_id", "deviation", F.posexplode("whitened").alias("pos", "whitened"))
            .select("vec_id", (F.col("pos") + 1).cast("int").alias("component"),
                    F.lit(model.centre.n).cast("bigint").alias("n"),
                    F.col("deviation").try_cast("bigint").alias("deviation"), "whitened",
                    F.get(_literal(model.explained), F.col("pos")).alias("explained"),
                    F.lit(error).alias("identity_error")))
