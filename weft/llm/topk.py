"""Exact top-k search by inner product: a k-d tree per shard, best-first, with the kth score passed on."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

LEAF = 128
LEAST_SHARD, MOST_SHARD = 2048, 262_144
EXACT = 2**53  # whole numbers below are exact as doubles
LOWEST, HIGHEST = -(2**63), 2**63 - 1


def whole_numbers(vector: Column, factor: int = 1024) -> Column:
    """floor(factor * x) of each component, as double; null if the vector or a component is null or not finite."""
    fine = vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(fine, F.transform(vector, lambda x: F.floor(x.cast("double") * factor)))


class KdTree:
    """Median splits along the widest component, down to leaves of 128 rows; each node has its tight box and least id."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        self.order = np.arange(len(ids))
        lo, hi, least, self.spans, self.children = [], [], [], [], []
        waiting = [(0, len(ids), -1)]
        while waiting:
            a, b, parent = waiting.pop()
            rows = self.order[a:b]
            inside = vectors[rows]
            lo.append(inside.min(0))
            hi.append(inside.max(0))
            least.append(ids[rows].min())
            node = len(self.spans)
            self.spans.append((a, b))
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(node)
            spread = hi[-1] - lo[-1]
            if b - a > LEAF and spread.size and spread.max() > 0:
                middle = (b - a) // 2
                self.order[a:b] = rows[np.argpartition(inside[:, int(spread.argmax())], middle)]
                waiting += [(a, a + middle, node), (a + middle, b, node)]
        self.lo, self.hi, self.least = np.array(lo), np.array(hi), np.array(least)
        self.vectors, self.ids = vectors[self.order], ids[self.order]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The largest inner product that a point of each node's box can have with each query."""
        return np.maximum(queries, 0) @ self.hi.T + np.minimum(queries, 0) @ self.lo.T

    def search(self, query: np.ndarray, bounds: np.ndarray, own: int, uids: np.ndarray, k: int, floor: int) -> list[tuple[int, int]]:
        """Up to k (score, id), best first, ties to smaller ids; none below ``floor``, none with the uid ``own``."""
        best: list[tuple[int, int]] = []
        nodes = [(-bounds[0], int(self.least[0]), 0)]
        while nodes:
            bound, least, node = heapq.heappop(nodes)
            kth = best[-1] if len(best) == k else (-floor, LOWEST)
            if (bound, least) > kth and not (len(best) < k and -bound >= floor):
                if -bound < -kth[0]:
                    break
                continue
            if self.children[node]:
                for c in self.children[node]:
                    heapq.heappush(nodes, (-bounds[c], int(self.least[c]), c))
                continue
            a, b = self.spans[node]
            scores = self.vectors[a:b] @ query
            if scores.dtype == object:
                scores = np.minimum(np.maximum(scores, LOWEST), HIGHEST)
            fit = np.flatnonzero((scores >= -kth[0]) & (uids[a:b] != own))
            if len(fit):
                best = heapq.nsmallest(k, best + [(-int(scores[i]), int(self.ids[a + i])) for i in fit])
        return [(-s, i) for s, i in best]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(-1, dim)


def _search_partition(k: int):
    schema = [("query_uid", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by shard, its vectors before its queries: a tree per shard, then the queries as they come."""
        shard, held, tree = None, [], None
        for batch in batches:
            keys = list(zip(batch.column("dim").to_pylist(), batch.column("shard").to_pylist(), batch.column("asked").to_pylist()))
            cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if keys[a][:2] != shard:
                    shard, held, tree = keys[a][:2], [], None
                if not keys[a][2]:
                    held.append(part)
                    continue
                if not held:
                    continue
                dim = shard[0]
                if tree is None:
                    vectors = np.concatenate([_matrix(p.column("v"), dim) for p in held])
                    ids = np.concatenate([np.asarray(p.column("vec_id")) for p in held])
                    uids = np.concatenate([np.asarray(p.column("uid")) for p in held])
                    held = held[:1]
                    exact = not vectors.size or float(np.abs(vectors.astype(float)).max()) ** 2 * dim < EXACT
                    tree = KdTree(vectors.astype(float) if exact else vectors.astype(object), ids)
                    tree.uids = uids[tree.order]
                    tree.most = float(np.abs(vectors.astype(float)).max(initial=0.0))
                queries = _matrix(part.column("v"), dim)
                most = float(np.abs(queries.astype(float)).max(initial=0.0))
                exact = tree.vectors.dtype != object and most * tree.most * dim < EXACT
                if not exact and tree.vectors.dtype != object:
                    for name in ("vectors", "lo", "hi"):
                        setattr(tree, name, getattr(tree, name).astype(np.int64).astype(object))
                queries = queries.astype(float if exact else object)
                bounds, out = tree.bounds(queries), []
                for i, (uid, query_id, floor) in enumerate(zip(*(part.column(c).to_pylist() for c in ("uid", "vec_id", "floor")))):
                    for score, vec_id in tree.search(queries[i], bounds[i], uid, tree.uids, k, LOWEST if floor is None else floor):
                        out.append((uid, query_id, vec_id, score))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[j] for r in out], t) for j, (_, t) in enumerate(schema)], names=[n for n, _ in schema]
                )

    return run


def exact_top_k(vectors: DataFrame, asked: Column, k: int = 10, factor: int = 1024) -> DataFrame:
    """For every row of ``vectors`` (vec_id, embedding) that fulfils ``asked``, its k best rows other than itself.

    The score is the inner product of the components turned into floor(factor *
    x), in whole numbers; ties go to smaller vec_ids, a query with fewer
    candidates gets all. Returns query_id, rank (from 1), vec_id and score.

    Rows are dealt into shards by a hash, of 2,048 to 262,144 rows by the number
    of cores. A shard's rows stream into one task, which builds their k-d tree
    and then answers the queries batch by batch: boxes that cannot beat the
    query's kth score are never opened. Every query first visits its own shard;
    the kth score found there goes with it to all others.

    Rows with a null vec_id or an invalid vector take no part. Vectors are
    compared with those of the same length only. Rows with the same vec_id are
    candidates, and queries, of their own. An empty table gives no rows. Scores
    outside a long count as its least or largest number.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("long").alias("vec_id"),
        whole_numbers(F.col("embedding"), factor).alias("v"), F.coalesce(asked, F.lit(False)).alias("asks"),
    ).where("v IS NOT NULL AND vec_id IS NOT NULL")
    rows = stored(rows.withColumn("dim", F.size("v")), "vectors")
    n = rows.count()
    size = min(max(math.ceil(n / max(1, spark.sparkContext.defaultParallelism)), LEAST_SHARD), MOST_SHARD)
    shards = max(1, math.ceil(n / size))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int"))
    columns = ["dim", "shard", "asked", "uid", "vec_id", "floor", "v"]
    base = rows.select("dim", "shard", F.lit(False).alias("asked"), "uid", "vec_id", F.lit(None).cast("long").alias("floor"), "v")
    found_schema = "query_uid long, query_id long, vec_id long, score long"

    def visit(queries: DataFrame) -> DataFrame:
        both = base.unionByName(queries.select(*columns))
        return both.repartition("dim", "shard").sortWithinPartitions("dim", "shard", "asked").mapInArrow(_search_partition(k), found_schema)

    queries = rows.where("asks").withColumn("asked", F.lit(True)).withColumn("floor", F.lit(None).cast("long"))
    home = stored(visit(queries), "home-shard")
    floors = home.groupBy("query_uid").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("known"))
    away = (
        queries.drop("floor").join(floors, F.col("uid") == F.col("query_uid"), "left").withColumnRenamed("known", "floor")
        .withColumn("home", F.col("shard"))
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard <> home")
    )
    every = home.unionByName(visit(away))
    best = Window.partitionBy("query_uid").orderBy(F.desc("score"), "vec_id")
    return every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
