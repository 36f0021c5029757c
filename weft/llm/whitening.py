"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from .common import stored

# Bytes of vectors (as double) that one task of a pass multiplies.
TASK_BYTES = 32 << 20
# A direction counts as empty, and a component as found, at this share of the largest singular value.
TINY = 1e-13
# A component with less than this share of the first one's deviation counts as without variance: it is rounding.
LEAST_SHARE = 1e-7
SEED = 7


def whole(column: Column, scale: int) -> Column:
    """floor(scale * component), as long, of an array of numbers; null where the array or a component is null or not finite."""
    bad = F.exists(column, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.when(column.isNotNull() & ~bad, F.transform(column, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long")))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    lists = batch.column("x")
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


class _Centred:
    """Passes over the fit list (x array<long>), each over all of it: rows are centred, multiplied and summed in their tasks."""

    def __init__(self, rows: DataFrame, n: int, sums: np.ndarray):
        self.rows, self.n, self.mean = rows, n, sums / n

    def sums(self, per_matrix) -> np.ndarray:
        """The sum over all tasks of ``per_matrix`` (a vector of a fixed length) of their centred rows."""
        mean = self.mean

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                if batch.num_rows:
                    part = per_matrix(_matrix(batch) - mean)
                    total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["at", "part"])

        parts = self.rows.mapInArrow(run, "at long, part double").groupBy("at").agg(F.sum("part").alias("whole"))
        got = {r["at"]: r["whole"] for r in parts.collect()}  # as many numbers as a vector has, or a few times that
        return np.array([got[i] for i in range(len(got))])


def lanczos(centred: _Centred, dims: int, top: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``top`` largest eigenvalues of the covariance with their unit eigenvectors (rows), and the covariance's trace.

    Step k multiplies the rows by a direction (u = Xv, kept in parts by the
    tasks), takes out the earlier u, and multiplies back (X'u); the products
    with the earlier u and the sum of squares come from the same pass. As every
    u is X times a known vector p of as many numbers as the vectors have, tasks
    make the earlier u again from these instead of keeping them, and a lost
    executor loses nothing. v is orthogonalised against all earlier v. An empty
    direction is followed by a new one orthogonal to the rest, so equal
    singular values are all found. It ends when the ``top`` are exact to
    rounding and what is left of the trace is too little for a missed one, at
    the latest after as many steps as there are dimensions.
    """
    def products(v_now: np.ndarray, p: np.ndarray):
        def per_matrix(x: np.ndarray) -> np.ndarray:
            u = x @ v_now
            return np.concatenate([x.T @ u, (x @ p.T).T @ u if len(p) else np.zeros(0), [u @ u]])

        return centred.sums(per_matrix)

    trace = float(centred.sums(lambda x: np.array([np.einsum("ij,ij->", x, x)]))[0])
    rng = np.random.default_rng(SEED)
    v, p, w, diagonal = np.zeros((0, dims)), np.zeros((0, dims)), np.zeros((0, dims)), []  # w: X'u of each u
    upper: list[tuple[int, int, float]] = []  # what a v has of the u before it
    here, beta = None, 0.0
    while len(v) < dims and trace > 0:
        if here is None:
            here, beta = rng.standard_normal(dims), 0.0
            for _ in range(2):
                here -= v.T @ (v @ here)
            here /= np.linalg.norm(here)
        linked = beta > 0 and len(p) > 0
        raw = here - beta * p[-1] if linked else here
        got = products(raw, p)
        back, overlap, square = got[:dims], got[dims:-1], got[-1]
        v = np.vstack([v, here])
        if linked:
            upper.append((len(p) - 1, len(v) - 1, beta))
        alpha = np.sqrt(max(square - overlap @ overlap, 0.0))
        largest = np.sqrt(trace)
        if alpha <= TINY * largest:  # nothing of the rows is left in this direction
            here = None
            continue
        p_now = (raw - p.T @ overlap) / alpha
        w_now = (back - w.T @ overlap) / alpha
        diagonal.append((len(p), len(v) - 1, alpha))
        p, w = np.vstack([p, p_now]), np.vstack([w, w_now])
        follow = w_now.copy()
        for _ in range(2):
            follow -= v.T @ (v @ follow)
        beta = float(np.linalg.norm(follow))
        here = follow / beta if beta > TINY * largest else None
        values, vectors, left = _small_svd(diagonal + upper, len(p), len(v))
        missed = trace - float(values @ values)
        lasting = np.abs(left[-1, :top]) * (beta if here is not None else 0.0)
        if len(values) >= top and (lasting <= TINY * values[0]).all() and missed <= values[top - 1] ** 2:
            break
    if not len(p):
        return np.zeros(0), np.zeros((0, dims)), trace / centred.n
    values, vectors, _ = _small_svd(diagonal + upper, len(p), len(v))
    keep = values[:top] > LEAST_SHARE * values[0]
    return (values[:top] ** 2 / centred.n)[keep], (vectors[:top] @ v)[keep], trace / centred.n


def _small_svd(entries: list[tuple[int, int, float]], rows: int, columns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    b = np.zeros((rows, columns))
    for i, j, x in entries:
        b[i, j] = x
    left, values, right = np.linalg.svd(b, full_matrices=False)
    return values, right, left


def whiten(embeddings: DataFrame, top: int = 4, scale: int = 256) -> DataFrame:
    """Per remaining row of ``embeddings`` and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error.

    Each entry c becomes x = floor(scale * c). Rows take no part if their
    vector is null, empty or holds null or non-finite entries, or if it is not
    of the commonest length (of several the longest). The fit list is each
    distinct x vector once, n of them; all statistics are over it, with divisor
    n. Components are the ``top`` unit eigenvectors of the covariance by
    falling eigenvalue; without variance there is none, so a table with one
    distinct vector, or an empty one, gives no rows. deviation is the exact sum
    of (n * x - S)**2, as decimal(38, 0). Rows that repeat come out each.
    Other columns are ignored.
    """
    spark = embeddings.sparkSession
    rows = stored(embeddings.select("vec_id", whole(F.col("embedding"), scale).alias("x")).where("x IS NOT NULL AND size(x) > 0"), "vectors")
    lengths = rows.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("rows"))
    common = lengths.orderBy(F.desc("rows"), F.desc("dims")).first()
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if common is None:
        return spark.createDataFrame([], schema)
    dims = common["dims"]
    rows = rows.where(F.size("x") == dims)
    distinct = stored(rows.select("x").distinct(), "distinct-vectors")
    n = distinct.count()
    per_dim = distinct.select(F.posexplode("x").alias("at", "x")).groupBy("at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("s"), F.max(F.abs("x")).alias("most"))
    told = {r["at"]: r for r in per_dim.collect()}
    sums, most = [int(told[i]["s"]) for i in range(dims)], max(told[i]["most"] for i in range(dims))
    tasks = max(1, -(-8 * n * dims // TASK_BYTES))
    fit = distinct.repartition(tasks).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        centred = _Centred(fit, n, np.array(sums, np.float64))
        values, vectors, trace = lanczos(centred, dims, top)
        if not len(values):
            return spark.createDataFrame([], schema)
        project = vectors / np.sqrt(values)[:, None]
        k = len(values)
        covariance = centred.sums(lambda x: ((x @ project.T).T @ (x @ project.T)).ravel()).reshape(k, k) / n
    finally:
        fit.unpersist()
    error, explained = float(np.abs(covariance - np.eye(k)).max()), values / trace
    small, mean = dims * (2 * n * int(most) + 1) ** 2 < 2**62, centred.mean

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            x = _matrix(batch)
            if small:
                apart = n * x - np.array(sums, np.int64)
                deviation = [int(d) for d in np.einsum("ij,ij->i", apart, apart)]
            else:
                apart = x.astype(object) * n - np.array(sums, object)
                deviation = [int(d) for d in (apart * apart).sum(1)]
            from decimal import Decimal

            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, n)), pa.array([Decimal(d) for d in deviation for _ in range(k)], pa.decimal128(38, 0)),
                 pa.array(((x - mean) @ project.T).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(run, schema)
