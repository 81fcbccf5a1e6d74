"""Approximate nearest neighbours by a hash-prefix forest.

Every vector gets one long hash string per tree: the signs of its inner products with
random directions.  A tree is the sorted array of its strings.  A query descends each
tree to the longest prefix that it shares with some vector, and then all trees ascend
together, one bit at a time, until the vectors below the shared prefixes suffice; those
are compared exactly.

Vectors are dealt into blocks by a hash of their id and each block has its own forest, so
that a forest fits a task; the stated queries meet every block, in tiles.  Every vector is
indexed.  Within a block the candidates are bounded by the block, whatever the strings.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from probewatch.llm.common import settle

#: Trees, bits of a string, vectors of a block, queries of a tile, and how many vectors, as a
#: multiple of the block's and counted once per tree, the ascent gathers before it stops
#: (chosen for recall on vectors without clusters, see README).
TREES, BITS, BLOCK, TILE, SHARE = 48, 24, 8192, 2048, 0.75


def _directions(dim: int, trees: int, bits: int, seed: int = 17) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed + dim)).normal(size=(dim, trees * bits))


def _strings(vectors: np.ndarray, directions: np.ndarray, trees: int, bits: int) -> np.ndarray:
    """(trees, n) strings as numbers, first bit highest."""
    out = np.empty((trees, len(vectors)), np.int64)
    weights = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)
    for t in range(trees):
        out[t] = (vectors @ directions[:, t * bits:(t + 1) * bits] > 0) @ weights
    return out


class Forest:
    """Sorted arrays of hash strings over the vectors of one block.

    Strings are taken of vectors that are extended by one coordinate to equal length, so
    that the largest inner product is the smallest angle.
    """

    def __init__(self, vectors: np.ndarray, trees: int = TREES, bits: int = BITS):
        self.vectors, self.bits, self.trees = vectors, bits, trees
        squares = np.einsum("ij,ij->i", vectors, vectors)
        extra = np.sqrt(np.maximum(squares.max() - squares, 0)) if len(vectors) else squares
        self.directions = _directions(vectors.shape[1] + 1, trees, bits)
        strings = _strings(np.column_stack([vectors, extra]), self.directions, trees, bits)
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, 1)

    def search(self, queries: np.ndarray, wanted: int):
        """For each query the places of at least ``wanted`` vectors with the longest shared prefixes."""
        strings = _strings(np.column_stack([queries, np.zeros(len(queries))]), self.directions, self.trees, self.bits)
        lo = np.empty((self.trees, len(queries)), np.int64)
        hi = np.empty_like(lo)
        low_at, high_at = np.zeros_like(lo), np.zeros_like(lo)
        open_ = np.ones(len(queries), bool)
        # ascend all trees together: drop one more bit of the shared prefix at a time
        for drop in range(self.bits + 1):
            at = np.flatnonzero(open_)
            if not len(at):
                break
            for t in range(self.trees):
                prefix = strings[t, at] >> drop
                lo[t, at] = np.searchsorted(self.sorted[t], prefix << drop, "left")
                hi[t, at] = np.searchsorted(self.sorted[t], (prefix + 1) << drop, "left")
            reached = (hi[:, at] - lo[:, at]).sum(0) >= wanted
            if drop == self.bits:
                reached[:] = True
            done = at[reached]
            low_at[:, done], high_at[:, done] = lo[:, done], hi[:, done]
            open_[done] = False
        mark = np.zeros(len(self.vectors), bool)
        for q in range(len(queries)):
            mark[:] = False
            for t in range(self.trees):
                mark[self.order[t, low_at[t, q]:high_at[t, q]]] = True
            yield np.flatnonzero(mark)


def nearest(forest: Forest, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int, share: float = SHARE):
    """(query id, id, score) of the k best found of one block, a query itself excepted."""
    # so many below one tree at least that k of them are new to the query
    wanted = max(int(share * len(ids)), min(4 * k, len(ids)) * forest.trees)
    for q, places in enumerate(forest.search(queries, wanted)):
        scores = forest.vectors[places] @ queries[q]
        found = ids[places]
        other = found != query_ids[q]
        scores, found = scores[other], found[other]
        if len(scores) > k:
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            some = scores >= least
            scores, found = scores[some], found[some]
        best = np.lexsort((found, -scores))[:k]
        yield query_ids[q], found[best], scores[best]


def _search(k):
    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        out = ([], [], [])
        if vectors.num_rows and queries.num_rows:
            def matrix(t):
                return np.array(t.column("embedding").combine_chunks().flatten(), np.float64).reshape(t.num_rows, -1)
            ids = np.array(vectors.column("vec_id"), np.int64)
            for query, found, scores in nearest(Forest(matrix(vectors)), ids, matrix(queries), np.array(queries.column("query_id"), np.int64), k):
                out[0].append(np.full(len(found), query))
                out[1].append(found)
                out[2].append(scores)
        flat = [np.concatenate(x) if x else np.empty(0) for x in out]
        return pa.table({"query_id": pa.array(flat[0].astype(np.int64)), "vec_id": pa.array(flat[1].astype(np.int64)),
                         "score": pa.array(flat[2].astype(np.float64))})
    return run


def search(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k largest inner products found for each query.

    Queries are the rows whose vec_id is divisible by ``every``; candidates are all rows but
    the query's own.  Scores are exact, ties go to the smaller vec_id.  Vectors that are
    null, zero, empty or hold null or non-finite components, and rows without id, take no part;
    vectors of different length never meet.  Rows with equal ids are one candidate, the one with
    the largest score.  Other columns are ignored; an empty table gives an empty result.
    """
    part = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    part = part.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad
                      & F.exists("embedding", lambda x: x != 0)).withColumn("dim", F.size("embedding"))
    part = settle(part)
    n = part.count()
    blocks = max(1, -(-n // BLOCK))
    asked = part.where(F.col("vec_id") % every == 0)
    tiles = max(1, -(-asked.count() // TILE))
    index = part.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    index = index.withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))) if tiles > 1 else index.withColumn("tile", F.lit(0))
    asked = asked.select(F.col("vec_id").alias("query_id"), "embedding", F.col("dim").alias("qdim"),
                         F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(tiles)).cast("int").alias("qtile"),
                         F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("qblock"))
    found = index.groupBy("dim", "block", "tile").cogroup(asked.groupBy("qdim", "qblock", "qtile")).applyInArrow(
        _search(k), "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
