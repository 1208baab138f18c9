"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Vectors become integers, x = floor(256 c).  The *fit list* holds each distinct x once, packed into blocks
of bounded bytes.  On its centred rows X the bidiagonalisation alternates distributed products

    alpha_j u_j = X v_j - beta_{j-1} u_{j-1}        beta_j v_{j+1} = X^T u_j - alpha_j v_j

both with full reorthogonalisation, and the singular values and right vectors of the small bidiagonal
matrix give deviations and components.  A left vector has an entry per row; it is never stored, as
u_j = X p_j with a p_j of one vector's length, so a task that runs again needs the block and the p_j alone.
One job a step: a pass takes y = X q for the next left vector before its reorthogonalisation and returns
its products with all left vectors, with itself and X^T y; what reorthogonalisation takes from y it takes
from X^T y by the X^T u_j known.  The driver holds vectors of one row's length and the bidiagonal matrix.

The steps end when the wanted components have converged and what the basis has not captured (the
squared norm of X less that of the matrix) is below the last wanted squared value, so that no component,
not even a second one of an equal value, can be missing; at the latest after as many steps as dimensions.

Defined results: a row is dropped if its vector is null, empty, holds a null or non-finite entry or one
with |256 c| of 2^63 or more, or has not the table's dimension (the commonest length, of equally common
ones the greater).  Components with a deviation of zero are not returned: a table whose vectors are all
equal gives no rows, as does an empty one.  ``deviation`` is null where it exceeds a long.  Rows with the
same vec_id (or none) are returned as often as they occur.  Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlab.llm.common import keep

SCALE = 256
BLOCK_BYTES = 2 << 20           # of packed vectors in a row of the fit list
PART_BYTES = 32 << 20           # of packed vectors in a partition of it; of small lists, a partition a core
SMALLEST = 2048                 # with at least so many vectors
ZERO = 1e-13                    # of the norm of X: smaller values are rounding


@dataclass
class Fit:
    n: int                      # vectors in the fit list
    total: np.ndarray           # S: sums per dimension (integers)
    basis: np.ndarray           # components as columns, by falling deviation
    values: np.ndarray          # eigenvalues of the covariance
    trace: float
    steps: int

    @property
    def mean(self) -> np.ndarray:
        return self.total / self.n

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.basis / np.sqrt(self.values)


def _integers(column: pa.Array, dim: int) -> tuple:
    """(places of the valid vectors, their integers as a matrix)."""
    long = np.asarray(pc.fill_null(pc.list_value_length(column), -1)) == dim
    place = np.flatnonzero(long)
    values = column.take(pa.array(place)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dim)
    with np.errstate(invalid="ignore", over="ignore"):
        values = np.floor(values * SCALE)
    valid = (np.abs(values) < 2.0 ** 63).all(axis=1)         # also false for NaN (null) and infinities
    return place[valid], values[valid].astype("<i8")


def dimension(df: DataFrame, vector: str = "embedding") -> tuple:
    """The commonest length of a vector and the number of such vectors, (0, 0) if there is none."""
    sizes = df.select(F.size(F.col(vector)).alias("d")).where("d > 0").groupBy("d").count()
    most = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    return (most["d"], most["count"]) if most else (0, 0)


def fit_list(df: DataFrame, dim: int, most: int, vector: str = "embedding") -> DataFrame:
    """The distinct integer vectors, packed: (block, n), in partitions sized for ``most`` vectors."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = max(1, -(-most * dim * 8 // PART_BYTES), min(cores, most // SMALLEST))

    def pack(batches):
        for batch in batches:
            _, x = _integers(batch.column(0), dim)
            yield pa.RecordBatch.from_arrays([pa.array([row.tobytes() for row in x], pa.binary())], ["x"])

    def blocks(batches):
        held, size = [], 0
        for batch in batches:
            for x in batch.column(0).to_pylist():
                held.append(x)
                size += len(x)
                if size >= BLOCK_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)]), pa.array([len(held)])], ["block", "n"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)]), pa.array([len(held)])], ["block", "n"])

    distinct = df.select(F.col(vector).alias("v")).mapInArrow(pack, "x binary").distinct()
    return keep(distinct.coalesce(parts).mapInArrow(blocks, "block binary, n long"))


def _sums(of_block, dim: int, arrow: pa.DataType):
    """One row a task: the sum of ``of_block`` over its blocks."""
    def sums(batches):
        total = None
        for batch in batches:
            for data in batch.column(0).to_pylist():
                part = of_block(np.frombuffer(data, "<i8").reshape(-1, dim))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(arrow))], ["part"])
    return sums


def block_sums(fit: DataFrame, dim: int, of_block) -> np.ndarray:
    """Sum over all blocks of ``of_block(matrix)``, a vector of fixed length."""
    parts = fit.select("block").mapInArrow(_sums(of_block, dim, pa.float64()), "part array<double>")
    return parts.select(array_to_vector("part").alias("part")).agg(Summarizer.sum(F.col("part")).alias("s")).first()["s"].toArray()


def column_totals(fit: DataFrame, dim: int) -> np.ndarray:
    """Exact sums per dimension."""
    parts = fit.select("block").mapInArrow(_sums(lambda x: x.sum(axis=0), dim, pa.int64()), "part array<long>")
    rows = parts.select(F.posexplode("part").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("s")).collect()
    return np.array([r["s"] for r in sorted(rows, key=lambda r: r["i"])], np.int64)


def _orthogonal(v: np.ndarray, basis: np.ndarray) -> np.ndarray:
    for _ in range(2):
        v = v - basis @ (basis.T @ v)
    return v


def bidiagonalise(fit: DataFrame, mean: np.ndarray, norm2: float, want: int, tolerance: float = 1e-15) -> tuple:
    """(right vectors, singular values, steps) of the centred fit list, the ``want`` greatest or more."""
    dim, rng = len(mean), np.random.default_rng(0)
    norm = np.sqrt(norm2)
    least = ZERO * norm
    v = rng.standard_normal(dim)
    v /= np.linalg.norm(v)
    right, left = v[:, None], np.zeros((dim, 0))            # columns v_j, and p_j with u_j = X p_j
    known = np.zeros((dim, 0))                              # columns X^T u_j
    alphas, betas = [], []
    while True:
        q = right[:, -1] - (betas[-1] * left[:, -1] if betas else 0.0)
        both = np.column_stack([left, q])

        def products(x, both=both):
            c = x - mean
            y = c @ both
            return np.concatenate([y.T @ y[:, -1], c.T @ y[:, -1]])
        sums = block_sums(fit, dim, products)
        j = left.shape[1]
        dots, square, z = sums[:j], sums[j], sums[j + 1:]
        q, z = q - left @ dots, z - known @ dots            # reorthogonalised against all left vectors
        alpha = np.sqrt(max(square - dots @ dots, 0.0))
        if alpha <= least:
            alpha, p, z = 0.0, np.zeros(dim), np.zeros(dim)
        else:
            p, z = q / alpha, z / alpha
        known = np.column_stack([known, z])
        left = np.column_stack([left, p])
        alphas.append(alpha)
        j = len(alphas)
        b = np.diag(alphas) + np.diag(betas, 1)
        u, values, vt = np.linalg.svd(b)
        r = _orthogonal(z - alpha * right[:, -1], right)
        beta = np.linalg.norm(r)
        wanted = min(want, j)
        converged = np.max(beta * np.abs(u[-1, :wanted])) <= tolerance * values[0]
        missing = norm2 - np.sum(b * b)
        if j == dim or j >= want and converged and missing < values[want - 1] ** 2:
            return right @ vt.T, values, j
        if beta <= least:                                   # the space is used up: go on outside it
            beta, r = 0.0, _orthogonal(rng.standard_normal(dim), right)
        betas.append(beta)
        right = np.column_stack([right, r / np.linalg.norm(r)])


def fit_components(fit: DataFrame, dim: int, want: int) -> Fit | None:
    """Components of the fit list's covariance; None for a list without spread."""
    n = fit.agg(F.sum("n")).first()[0]
    if not n:
        return None
    total = column_totals(fit, dim)
    mean = total / n
    norm2 = float(block_sums(fit, dim, lambda x: np.array([np.sum((x - mean) ** 2)]))[0])
    if norm2 <= 0:
        return None
    basis, values, steps = bidiagonalise(fit, mean, norm2, min(want, dim))
    keeps = min(want, int(np.sum(values > ZERO * np.sqrt(norm2))))
    basis = basis[:, :keeps]
    basis = basis / np.linalg.norm(basis, axis=0) * np.sign(basis[np.argmax(np.abs(basis), axis=0), range(keeps)])
    return Fit(n, total, basis, values[:keeps] ** 2 / n, norm2 / n, steps)


def identity_error(fit: DataFrame, dim: int, made: Fit) -> float:
    """Largest absolute entry of the whitened fit list's covariance less the identity."""
    k = len(made.values)
    middle = block_sums(fit, dim, lambda x: made.whiten(x).sum(axis=0)) / made.n

    def products(x):
        w = made.whiten(x) - middle
        return (w.T @ w).ravel()
    covariance = block_sums(fit, dim, products).reshape(k, k) / made.n
    return float(np.max(np.abs(covariance - np.eye(k))))


def deviations(x: np.ndarray, n: int, total: np.ndarray) -> tuple:
    """Sum over dimensions of (n x - S)^2 per row, exact, and whether it fits a long."""
    fits = np.sum((float(n) * x - total.astype(np.float64)) ** 2, axis=1) < 2.0 ** 63 * (1 - 1e-9)
    with np.errstate(over="ignore"):
        away = x * np.int64(n) - total                      # modulo 2^64: right wherever the sum fits
        return np.sum(away * away, axis=1), fits


def whiten(df: DataFrame, components: int = 4, vector: str = "embedding", id_column: str = "vec_id") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row per valid
    vector and component."""
    spark = df.sparkSession
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    dim, most = dimension(df, vector)
    fit = fit_list(df, dim, most, vector) if dim else None
    made = fit_components(fit, dim, components) if dim else None
    if made is None:
        return spark.createDataFrame([], schema)
    error, k = identity_error(fit, dim, made), len(made.values)
    explained = made.values / made.trace

    def rows(batches):
        for batch in batches:
            place, x = _integers(batch.column(1), dim)
            deviation, fits = deviations(x, made.n, made.total)
            m = len(place)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.repeat(place, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, made.n)), pa.array(np.repeat(deviation, k), mask=np.repeat(~fits, k)),
                 pa.array(made.whiten(x).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return df.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).alias("v")).mapInArrow(rows, schema)
