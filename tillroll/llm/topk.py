"""Exact top-k inner products by MaxScore over shards.

Vectors are quantised to whole numbers. A term is a dimension with a sign; a vector is in the postings of the terms of
its components. For a query, a term's bound is the largest product that any vector of the shard has in it. Against the
threshold (the k-th best score so far) the terms are split: the largest bounds are essential, the rest, whose bounds sum
to less than the threshold, are not. A vector that is in no essential posting can't reach the threshold. The others get
their essential scores, and the remaining dimensions are probed, largest bound first, only for those whose score plus
the bounds still open reaches the threshold. Nothing is cut that could be among the best, so the result is exact.

Vectors are packed into shards of bounded size where they lie. The queries form blocks of bounded size (``BLOCK_BYTES``).
Each block in turn is broadcast, and every task takes it through the shards that it reads anyway, so a shard is read once
for a block and never shuffled (the stated query set against all rows). The best that a task has found so far for a query is
the threshold for its next shard; the best of the tasks merge per query.

Defined results: vectors that are null or hold a null, NaN or infinite component, and rows without an id, take no part;
missing dimensions count as 0; a query's own row is every row with its id; other repeated rows are candidates each; ties
go to the smaller id; a query without candidates has no rows; other columns are ignored. Vectors whose scores a long can't
hold are refused by name before anything is compared.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, staged

PACK = "ids binary, matrix binary, dims int"
#: Bytes of a block of queries: what is broadcast at a time.
BLOCK_BYTES = 64 << 20


def usable(vectors: DataFrame, scale: float) -> DataFrame:
    """id and quantised components (whole numbers as doubles) of the vectors that take part."""
    x = F.transform(F.col("embedding"), lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(~bad)
    return rows.select(F.col("vec_id").cast("bigint").alias("id"), F.transform(x, lambda v: F.floor(v * scale).cast("double")).alias("v"))


def packed(rows: DataFrame, size: int) -> DataFrame:
    """The rows of each task in packs of at most ``size``."""

    def pack(part: list[tuple[int, list[float]]]) -> pa.RecordBatch:
        dims = max(len(v) for _, v in part)
        matrix = np.zeros((len(part), dims))
        for i, (_, v) in enumerate(part):
            matrix[i, : len(v)] = v
        ids = np.array([i for i, _ in part], np.int64)
        return pa.RecordBatch.from_arrays([pa.array([ids.tobytes()], pa.binary()), pa.array([matrix.tobytes()], pa.binary()), pa.array([dims], pa.int32())], ["ids", "matrix", "dims"])

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part: list[tuple[int, list[float]]] = []
        for batch in batches:
            for row in zip(batch["id"].to_pylist(), batch["v"].to_pylist(), strict=True):
                part.append(row)
                if len(part) == size:
                    yield pack(part)
                    part = []
        if part:
            yield pack(part)

    ship(rows.sparkSession)
    return rows.mapInArrow(one, PACK)


def unpacked(ids: bytes, matrix: bytes, dims: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(matrix, np.float64).reshape(len(ids), dims)


class Shard:
    """Vectors with the largest and smallest component in each dimension."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, dims: int):
        self.ids = ids
        self.matrix = np.zeros((len(ids), dims))
        self.matrix[:, : matrix.shape[1]] = matrix
        self.high, self.low = self.matrix.max(axis=0), self.matrix.min(axis=0)
        self.columns = np.ascontiguousarray(self.matrix.T)

    def scores(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Exact scores: doubles while they hold whole numbers, else Python's integers."""
        x = self.matrix[rows]
        if np.abs(x).max(initial=0) * np.abs(q).max(initial=0) * max(len(q), 1) < 2.0**52:
            return x @ q
        return np.array([sum(int(a) * int(b) for a, b in zip(r, q, strict=True)) for r in x], object)

    def best(self, query_id: int, q: np.ndarray, k: int, floor: float = -np.inf, probe: int = 8) -> list[tuple[int, int]]:
        """The ``k`` best (id, score) that reach ``floor``, without rows of ``query_id``."""
        bound = np.maximum(0, np.maximum(q * self.high, q * self.low))
        order = np.argsort(-bound, kind="stable")
        open_after = np.concatenate((np.cumsum(bound[order][::-1])[::-1], [0.0]))  # sum of the bounds from term j on
        slack = 1e-12 * open_after[0]  # doubles round sums over 2 ** 53
        if open_after[0] + slack < floor:
            return []
        other = self.ids != query_id
        # the first threshold: exact scores of the vectors that lead in the strongest term
        lead = np.flatnonzero(other)
        if len(lead) > 8 * k and len(order):
            part = self.columns[order[0]][lead] * np.sign(q[order[0]])
            lead = lead[np.argpartition(-part, 8 * k)[: 8 * k]]
        first = self.scores(lead, q)
        if len(first) >= k:
            floor = max(floor, float(np.sort(first)[-k]))
        floor -= slack
        essential = int(np.searchsorted(-open_after, -floor, side="right")) if floor > -np.inf else len(order)
        essential = min(essential, len(order))  # terms from here on sum to less than the threshold
        signed = self.columns[order[:essential]] * q[order[:essential], None]
        rows = np.flatnonzero((signed > 0).any(axis=0) & other) if floor > 0 else np.flatnonzero(other)
        partial = signed[:, rows].sum(axis=0)
        for j in range(essential, len(order), probe):
            alive = partial + open_after[j] >= floor
            rows, partial = rows[alive], partial[alive]
            terms = order[j : j + probe]
            partial = partial + q[terms] @ self.columns[np.ix_(terms, rows)]
        rows = rows[partial >= floor]
        score = self.scores(rows, q)
        top = np.lexsort((self.ids[rows], -score.astype(float)))[: 4 * k] if score.dtype != object else range(len(rows))
        found = sorted(((int(self.ids[rows[i]]), int(score[i])) for i in top), key=lambda r: (-r[1], r[0]))
        return found[:k]


def refuse_large(*sides: DataFrame) -> None:
    """Raises if the largest component of each side and the dimensions allow a score beyond a long."""
    found = [s.agg(F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))).alias("x"), F.max(F.size("v")).alias("d")).first() for s in sides]
    (a, m), (b, n) = ((r["x"] or 0.0, r["d"] or 0) for r in found)
    if a * b * min(m, n) >= 2.0**63:
        raise ValueError("top_k: components are so large that a score may be beyond a long")


def block_of(packs: list) -> tuple[np.ndarray, np.ndarray]:
    """The ids and the matrix of several packs of queries."""
    parts = [unpacked(r["ids"], r["matrix"], r["dims"]) for r in packs]
    dims = max(m.shape[1] for _, m in parts)
    return np.concatenate([i for i, _ in parts]), np.concatenate([np.pad(m, ((0, 0), (0, dims - m.shape[1]))) for _, m in parts])


def search(shards: DataFrame, ids: np.ndarray, matrix: np.ndarray, k: int) -> DataFrame:
    """query_id, vec_id, score: each task's best for the queries."""
    spark = shards.sparkSession
    block = spark.sparkContext.broadcast((ids, matrix))

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, q_matrix = block.value
        found: list[list[tuple[int, int]]] = [[] for _ in q_ids]
        for batch in batches:
            for row in zip(*(batch[c] for c in ("ids", "matrix", "dims")), strict=True):
                own = unpacked(row[0].as_buffer(), row[1].as_buffer(), row[2].as_py())
                dims = max(own[1].shape[1], q_matrix.shape[1])
                shard = Shard(*own, dims)
                queries = np.pad(q_matrix, ((0, 0), (0, dims - q_matrix.shape[1])))
                for n, query_id in enumerate(q_ids.tolist()):
                    so_far = found[n]
                    floor = float(so_far[k - 1][1]) if len(so_far) == k else -np.inf
                    better = shard.best(query_id, queries[n], k, floor)
                    if better:
                        found[n] = sorted(so_far + better, key=lambda r: (-r[1], r[0]))[:k]
        for at in range(0, len(found), 1 << 14):
            rows = [(q, i, s) for q, own in zip(q_ids[at : at + (1 << 14)].tolist(), found[at : at + (1 << 14)], strict=True) for i, s in own]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["query_id", "vec_id", "score"])

    ship(spark)
    out = staged(shards.mapInArrow(one, "query_id bigint, vec_id bigint, score bigint"), "found")
    block.destroy()
    return out


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    scale: float = 256.0,
    shard_rows: int = 1024,
    block_rows: int = 1024,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """For each query row (vec_id, embedding): query_id, rank, vec_id, score of its ``k`` best rows in ``vectors``.

    ``block_rows`` queries go together to the driver, and as many of these as fit ``block_bytes`` make a block.
    """
    rows, asked = usable(vectors, scale), usable(queries, scale).dropDuplicates(["id"])
    refuse_large(asked, rows)
    shards = staged(packed(rows, shard_rows), "shards")
    packs = staged(packed(asked, block_rows), "queries")
    found = None
    for block in in_bytes(packs.toLocalIterator(), block_bytes):
        best = search(shards, *block_of(block), k)
        found = best if found is None else found.unionByName(best)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def in_bytes(packs: Iterator, most: int) -> Iterator[list]:
    """Packs of queries in lists of at most ``most`` bytes, or of one pack."""
    held, size = [], 0
    for pack in packs:
        if held and size + len(pack["matrix"]) > most:
            yield held
            held, size = [], 0
        held.append(pack)
        size += len(pack["matrix"])
    if held:
        yield held
