"""Approximate nearest neighbours by few stable projections, a kd-tree and a chi-square stopping test.

Largest inner products become nearest points by one added component,
sqrt(M^2 - |x|^2) with M the block's largest norm.  Points are projected to
`dims` dimensions by Gaussian (2-stable) vectors, so the squared projected
distance over the squared distance follows a chi-square law with `dims` degrees
of freedom.  A query takes the kd-tree's leaves by growing projected distance
and verifies their points exactly; it stops once, for a point as near as the
k-th found, that law gives a chance of at least `confidence` to lie within the
projected radius already searched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evallens.llm.common import stored
from evallens.llm.vectors import distinct_rows, matrix, usable

LEAF = 256


def chi2_quantile(p: float, dof: int) -> float:
    """Quantile of the chi-square law with an even number of degrees of freedom."""
    def cdf(x: float) -> float:
        term, s = 1.0, 1.0
        for i in range(1, dof // 2):
            term *= x / 2 / i
            s += term
        return 1 - math.exp(-x / 2) * s

    lo, hi = 0.0, 1.0
    while cdf(hi) < p:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if cdf(mid) < p else (lo, mid)
    return hi


class KdTree:
    """Median splits on the widest side down to leaves; `order` lists the points leaf by leaf."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        order, leaves, todo = np.arange(len(points)), [], [(0, len(points))]
        while todo:
            a, b = todo.pop()
            own = points[order[a:b]]
            lo, hi = own.min(axis=0), own.max(axis=0)
            if b - a <= leaf:
                leaves.append((a, b, lo, hi))
                continue
            mid = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(own[:, np.argmax(hi - lo)], mid)]
            todo += [(a, a + mid), (a + mid, b)]
        self.order = order
        self.start, self.stop = (np.array([x[i] for x in leaves]) for i in (0, 1))
        self.lo, self.hi = (np.stack([x[i] for x in leaves]) for i in (2, 3))

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """Squared distance from q to each leaf's box."""
        gap = np.maximum(self.lo - q, 0) + np.maximum(q - self.hi, 0)
        return (gap * gap).sum(axis=1)


class BlockIndex:
    """One block of vectors, projected and indexed once for all queries."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int, dims: int, confidence: float, seed: int):
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        # Of equal vectors no more than the k + 1 least ids can be among a query's k best.
        same = distinct_rows(x)
        by = np.argsort(same, kind="stable")
        nth = np.empty(len(by), dtype=np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(same[by])) + 1])
        nth[by] = np.arange(len(by)) - np.repeat(first, np.diff(np.append(first, len(by))))
        ids, x = ids[nth <= k], x[nth <= k]
        norm2 = np.einsum("ij,ij->i", x, x)
        self.k, self.top = k, norm2.max()
        self.normals = np.random.default_rng(seed).standard_normal((x.shape[1] + 1, dims))
        self.tree = KdTree(np.column_stack([x, np.sqrt(self.top - norm2)]) @ self.normals)
        self.ids, self.x = ids[self.tree.order], x[self.tree.order]
        self.enough = chi2_quantile(confidence, dims)

    def search(self, query_ids: np.ndarray, queries: np.ndarray):
        """(query position, id, score) of each query's k best of this block, as far as searched."""
        ids, x, k, tree = self.ids, self.x, self.k, self.tree
        projected = queries @ self.normals[:-1]
        out = []
        for i, q in enumerate(queries):
            bound = tree.bounds(projected[i])
            leaves = np.argsort(bound, kind="stable")
            q2, seen, got = float(q @ q), [], 0
            scores = np.full(len(ids), -np.inf)
            at, step = 0, 4
            while at < len(leaves):
                for leaf in leaves[at:at + step]:
                    a, b = tree.start[leaf], tree.stop[leaf]
                    scores[a:b] = x[a:b] @ q
                    seen.append(np.arange(a, b))
                    got += b - a
                at += step
                if got > k and at < len(leaves):
                    found = scores[np.concatenate(seen)]
                    kth = np.partition(found, -(k + 1))[-(k + 1)]  # one more, for the query's own row
                    if bound[leaves[at]] >= self.enough * max(self.top + q2 - 2 * kth, 0.0) and bound[leaves[at]] > 0:
                        break
            pos = np.concatenate(seen)
            pos = pos[ids[pos] != query_ids[i]]
            if len(pos) > k:
                kth = np.partition(scores[pos], -k)[-k]
                pos = pos[scores[pos] >= kth - 1e-9 * (abs(kth) + 1e-300)]
            exact = (x[pos] * q).sum(axis=1)
            best = np.lexsort((ids[pos], -exact))[:k]
            out.append((np.full(len(best), i), ids[pos][best], exact[best]))
        return tuple(np.concatenate(z) for z in zip(*out))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, dims: int = 8, confidence: float = 0.95,
            block_rows: int = 1 << 16, seed: int = 7) -> DataFrame:
    """The k rows of `vectors` with the largest inner product found, per row of `queries`.

    Both hold (vec_id, embedding).  Returns (query_id, rank from 1, vec_id,
    score), ties to the smaller vec_id; a query's own vec_id is no candidate.
    Rows go to blocks of about `block_rows` by a hash of the id, to smaller ones if
    there would be fewer blocks than cores.  A task holds one block at a time: it
    indexes the block, then streams all queries past it and returns k rows a query,
    of which the best k stay.  NULL ids, and vectors that are NULL, zero
    or hold NULL or non-finite components, take no part; vectors of another
    length than the query's neither.  Rows that repeat a vec_id are candidates of
    their own; queries that repeat one with another vector have a ranking each.
    Other columns are not read.
    """
    def rows(df: DataFrame, name: str) -> DataFrame:
        ok = df.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
        return stored(ok.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding"), name)

    data, asked = rows(vectors, "ann-data"), rows(queries, "ann-queries").distinct()
    n = data.count()
    blocks = max(1, -(-n // block_rows), min(data.sparkSession.sparkContext.defaultParallelism, n * 8 // block_rows))
    dim, zero = F.size("embedding").alias("dim"), F.lit(0)
    # A block's vectors come before the queries.
    left = data.select(dim, F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("b"), zero.alias("asks"), "vec_id", "embedding")
    right = asked.select(dim, F.explode(F.sequence(zero, F.lit(blocks - 1))).alias("b"), F.lit(1).alias("asks"), "vec_id", "embedding")
    dealt = left.unionByName(right).repartitionByRange(blocks, "b").sortWithinPartitions("dim", "b", "asks")
    dealt = dealt.withColumn("query", F.xxhash64("embedding"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, parts, index = None, [], None
        for batch in batches:
            keys = np.column_stack([batch.column(c).to_numpy() for c in ("dim", "b", "asks")])
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if lo == hi:
                    continue
                if here != tuple(keys[lo, :2]):
                    here, parts, index = tuple(keys[lo, :2]), [], None
                part = batch.slice(lo, hi - lo)
                ids, x = part.column("vec_id").to_numpy(), matrix(part.column("embedding"))
                if not keys[lo, 2]:
                    parts.append((ids, x))
                    continue
                if parts:
                    index = BlockIndex(*(np.concatenate(z) for z in zip(*parts)), k, dims, confidence, seed)
                    parts = []
                if index is not None:
                    at, vec, score = index.search(ids, x)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[at]), part.column("query").take(pa.array(at)), pa.array(vec), pa.array(score)],
                                                     names=["query_id", "query", "vec_id", "score"])

    found = dealt.mapInArrow(run, "query_id long, query long, vec_id long, score double")
    best = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
