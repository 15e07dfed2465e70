"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

1. A component c becomes the whole number x = floor(scale * c) + offset; n and the sums S of each dimension are exact. The
   centred rows are (n * x - S) / n, with n * x - S exact.
2. Each step makes a right vector v (one number per dimension) and a left vector u = X w (one number per row; only its
   coefficients w are kept, a row's number follows from the row). A pass over all rows forms p = X v - beta * u_before,
   its products with all earlier left vectors, its norm and X'p at once. Taking the earlier left vectors out of p gives u
   and alpha; taking alpha * v and all earlier right vectors out of X'u gives the next v and beta. Both sides are thus
   orthogonalised against everything before, in every step. Where beta vanishes, an invariant subspace is exhausted and a
   fresh direction goes on, so that repeated deviations are all found.
3. The bidiagonal matrix of the alphas and betas is small. Its SVD gives the components, and its singular values, over the
   root of n, the deviations. Steps end when the residuals of the wanted components are at rounding error, or when every
   dimension has been used.
4. Two more passes measure how far the whitened rows' covariance is from the identity.

Each task reads its rows in packs of bounded size and gives one short row of sums; these meet in one task, which adds them
up and sends one row to the driver. So the driver holds a few vectors of the dimensions, whatever the number of rows.

Defined results: rows whose vector is null or holds a null, NaN or infinite entry take no part; missing dimensions of
shorter vectors count as 0; repeated rows and repeated or null ids count and are returned each; components without
variance (under 1e-12 of the whole) are left out, since nothing scales them to 1, so equal rows, or a single one, give no
rows; an empty table gives an empty result; other columns are ignored. Whole numbers beyond 2 ** 40 and deviations beyond
a long are refused by name.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, staged

PACK = "ids binary, matrix binary"
PACK_BYTES = 1 << 20
LARGEST = float(1 << 40)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and components (doubles) of the rows that take part."""
    x = F.transform(F.col("embedding"), lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vectors.where(F.col("embedding").isNotNull()).where(~bad).select(F.col("vec_id").cast("bigint").alias("id"), x.alias("x"))


def packs(rows: DataFrame, dims: int, scale: float, offset: int) -> DataFrame:
    """The rows of each task as packs of some ``PACK_BYTES``: ids (an Arrow column, for the nulls) and whole numbers."""
    most = max(1, PACK_BYTES // (8 * max(dims, 1)))

    def pack(batch: pa.RecordBatch) -> tuple[bytes, bytes]:
        matrix = np.full((len(batch), dims), offset, np.int64)
        x = batch["x"]
        flat = np.floor(x.flatten().to_numpy(zero_copy_only=False) * scale)
        if np.abs(flat).max(initial=0) > LARGEST:
            raise ValueError("whitening: a scaled component is beyond 2 ** 40")
        lengths = np.diff(x.offsets.to_numpy())
        row = np.repeat(np.arange(len(batch)), lengths)
        matrix[row, np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat.astype(np.int64) + offset
        sink = pa.BufferOutputStream()
        ids = pa.RecordBatch.from_arrays([batch["id"]], ["id"])
        with pa.ipc.new_stream(sink, ids.schema) as writer:
            writer.write_batch(ids)
        return sink.getvalue().to_pybytes(), matrix.tobytes()

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), most):
                ids, matrix = pack(batch.slice(i, most))
                yield pa.RecordBatch.from_arrays([pa.array([ids], pa.binary()), pa.array([matrix], pa.binary())], ["ids", "matrix"])

    ship(rows.sparkSession)
    return rows.mapInArrow(one, PACK)


def summed(packed: DataFrame, dims: int, f: Callable[[np.ndarray], np.ndarray], kind: type) -> np.ndarray | None:
    """The sum of ``f`` (an array of fixed length) over all packs; None without rows. One row per task, then one in all."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for matrix in batch["matrix"]:
                part = f(np.frombuffer(matrix.as_buffer(), np.int64).reshape(-1, dims))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([np.asarray(total, kind).tobytes()], pa.binary())], ["part"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for part in batch["part"]:
                part = np.frombuffer(part.as_buffer(), kind)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    out = packed.select("matrix").mapInArrow(partial, "part binary").repartition(1).mapInArrow(add, "part binary").collect()
    return np.frombuffer(out[0]["part"], kind) if out else None


def centred(matrix: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, exact."""
    return n * matrix - sums


class Bidiagonal:
    """The state on the driver: right vectors, coefficients of the left ones, X'u of each, the alphas and the betas."""

    def __init__(self, dims: int, seed: int = 7):
        self.rng, self.dims = np.random.default_rng(seed), dims
        self.v, self.w, self.xu = (np.zeros((dims, 0)) for _ in range(3))
        self.alpha, self.beta = [], []

    def fresh(self) -> np.ndarray | None:
        """A unit vector that is orthogonal to all right vectors; None if they span everything."""
        for _ in range(5):
            v = self.rng.standard_normal(self.dims)
            for _ in range(3):
                v -= self.v @ (self.v.T @ v)
            if self.v.shape[1] < self.dims and np.linalg.norm(v) > 1e-8:
                return v / np.linalg.norm(v)
        return None

    def svd(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Singular values (falling), components as columns, and the residual of each."""
        b = np.diag(self.alpha) + np.diag(self.beta[:-1], 1)
        left, sigma, right = np.linalg.svd(b)
        return sigma, self.v @ right.T, np.abs(self.beta[-1] * left[-1])


def bidiagonalise(packed: DataFrame, dims: int, n: int, sums: np.ndarray, wanted: int, tolerance: float = 1e-14) -> Bidiagonal:
    """Steps until the ``wanted`` largest components have settled or all dimensions are used."""
    state = Bidiagonal(dims)
    v, before = state.fresh(), 0.0
    while v is not None:
        w = state.w
        start = v - before * w[:, -1] if w.shape[1] else v  # p = X v - beta * u_before, as coefficients

        def products(matrix: np.ndarray, w: np.ndarray = w, start: np.ndarray = start) -> np.ndarray:
            x = centred(matrix, n, sums) / n
            p = x @ start
            return np.concatenate((x.T @ p, (x @ w).T @ p, [p @ p]))

        found = summed(packed, dims, products, np.float64)
        xp, up, pp = found[:dims], found[dims:-1], found[-1]
        largest = max(state.alpha, default=pp**0.5)
        alpha = max(pp - up @ up, 0.0) ** 0.5
        if alpha > 1e-13 * largest > 0:
            w_new, xu = (start - w @ up) / alpha, (xp - state.xu @ up) / alpha
        else:  # X v holds nothing new
            alpha, w_new, xu = 0.0, np.zeros(dims), np.zeros(dims)
        state.v, state.w, state.xu = np.c_[state.v, v], np.c_[w, w_new], np.c_[state.xu, xu]
        state.alpha.append(alpha)
        rest = xu.copy()
        for _ in range(2):
            rest -= state.v @ (state.v.T @ rest)
        beta = float(np.linalg.norm(rest))
        done = state.v.shape[1] == dims
        before = beta if beta > 1e-13 * largest and not done else 0.0
        state.beta.append(before)
        v = rest / beta if before else state.fresh()
        if before and state.v.shape[1] > wanted:
            sigma, _, residual = state.svd()
            if residual[:wanted].max() <= tolerance * sigma[0]:
                break
    return state


def whiten(
    vectors: DataFrame, components: int = 32, scale: float = 64.0, offset: int = 1_000_000, tolerance: float = 1e-14
) -> DataFrame:
    """For each row that takes part (vec_id, embedding) and each of its first ``components`` components: vec_id, component,
    n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    nothing = spark.createDataFrame([], schema)
    rows = usable(vectors)
    dims = rows.agg(F.max(F.size("x"))).first()[0] or 0
    if not dims:
        return nothing
    packed = staged(packs(rows, dims, scale, offset), "packs")
    totals = summed(packed, dims, lambda m: np.r_[m.sum(axis=0).astype(object), len(m)].astype(np.int64), np.int64)
    sums, n = totals[:-1].copy(), int(totals[-1])

    widest = summed(packed, dims, lambda m: widest_of(m, n, sums), np.int64)
    if int(widest[0]):
        raise ValueError("whitening: a deviation is beyond a long")
    variance = summed(packed, dims, lambda m: ((centred(m, n, sums) / n) ** 2).sum(axis=0), np.float64).sum()
    if not variance:
        return nothing
    sigma, basis, _ = bidiagonalise(packed, dims, n, sums, min(components, dims), tolerance).svd()
    e = sigma**2 / n
    trace = variance / n
    keep = min(components, int((e > 1e-12 * trace).sum()))
    project, explained = basis[:, :keep] / np.sqrt(e[:keep]), e[:keep] / trace

    def whitened(matrix: np.ndarray) -> np.ndarray:
        return (centred(matrix, n, sums) / n) @ project

    mean = summed(packed, dims, lambda m: whitened(m).sum(axis=0), np.float64) / n

    def spread(matrix: np.ndarray) -> np.ndarray:
        y = whitened(matrix) - mean
        return (y.T @ y).ravel()

    covariance = summed(packed, dims, spread, np.float64).reshape(keep, keep) / n
    error = float(np.abs(covariance - np.eye(keep)).max())

    def result(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, matrix in zip(batch["ids"], batch["matrix"], strict=True):
                ids = pa.ipc.open_stream(ids.as_buffer()).read_all()["id"].combine_chunks()
                x = np.frombuffer(matrix.as_buffer(), np.int64).reshape(-1, dims)
                deviation = (centred(x, n, sums) ** 2).sum(axis=1)
                size = len(x) * keep
                columns = [
                    ids.take(pa.array(np.repeat(np.arange(len(x)), keep))),
                    pa.array(np.tile(np.arange(1, keep + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(size, n, np.int64)),
                    pa.array(np.repeat(deviation, keep)),
                    pa.array(whitened(x).ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(size, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return packed.mapInArrow(result, schema)


def widest_of(matrix: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """[rows whose deviation a long can't hold], from doubles with room to spare."""
    d = float(n) * matrix.astype(float) - sums.astype(float)
    return np.array([((d**2).sum(axis=1) > 9.0e18).sum()], np.int64)
