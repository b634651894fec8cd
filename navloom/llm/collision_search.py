"""Nearest neighbours by collision counting over query-centred windows.

A block of vectors is projected on `PROJECTIONS` random directions, and every projection is kept as a
sorted array. A query opens a window around its own projection in each array. While too few
neighbours are sure, the radius grows and all windows widen with it (virtual rehashing); only what a
wider window takes in anew is counted. Vectors that lie in the windows of at least `COLLISIONS` of the
arrays are verified by their exact distance; the search ends when as many as wanted are verified within
the radius, or all are.

Queries and vectors are cut into blocks of bounded size, each block of queries meets each block of
vectors, and the nearest of the blocks are merged, first in groups and then at once.

Defined results: vectors that are null, zero or hold null or non-finite components take no part,
neither do rows with null ids; vectors of other lengths are no candidates; rows with the query's own
id are not its candidates; equal rows are different candidates, but one query; rows of one id with other
vectors are a query each, ranked each from 1; with fewer candidates than wanted all are given; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from navloom.llm.embedding_dedup import matrix, usable

PROJECTIONS = 32
#: Share of the arrays whose windows a vector must lie in.
COLLISIONS = 0.6
#: Width of a window for radius 1, and the factor by which the radius grows.
WIDTH = 2.8
GROWTH = 1.2
FIRST_LOOK = 64
BLOCK = 8192
QUERIES = 1024
MERGED_AT_ONCE = 64


class SortedProjections:
    def __init__(self, vectors: np.ndarray, seed: int = 13):
        self.vectors = vectors
        self.directions = np.random.default_rng(seed).standard_normal((vectors.shape[1], PROJECTIONS))
        along = vectors @ self.directions
        self.order = np.argsort(along, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(along, self.order.T, axis=0).T.copy()

    def nearest(self, query: np.ndarray, other: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows (of those marked `other`) and distances of the vectors verified, enough for the wanted ones."""
        along = query @ self.directions
        everyone = int(other.sum())
        radius = self._first_radius(query, along, wanted)
        squares = np.full(len(self.vectors), np.nan)
        counts = np.zeros(len(self.vectors), np.int64)
        low = [int(np.searchsorted(s, a)) for s, a in zip(self.sorted, along, strict=True)]
        high = list(low)
        while True:
            half = WIDTH * radius / 2
            entered = []
            for j, (row, ordered, a) in enumerate(zip(self.order, self.sorted, along, strict=True)):
                # What a wider window takes in lies on both sides of the one before.
                first, end = np.searchsorted(ordered, (a - half, np.nextafter(a + half, np.inf)))
                entered += [row[first : low[j]], row[high[j] : end]]
                low[j], high[j] = min(first, low[j]), max(end, high[j])
            counts += np.bincount(np.concatenate(entered), minlength=len(counts))
            new = np.flatnonzero((counts >= COLLISIONS * PROJECTIONS) & other & np.isnan(squares))
            gap = self.vectors[new] - query
            squares[new] = np.einsum("ij,ij->i", gap, gap)
            verified = ~np.isnan(squares)
            if verified.sum() >= everyone or (squares[verified] <= radius * radius).sum() >= wanted:
                rows = np.flatnonzero(verified)
                return rows, np.sqrt(squares[rows])
            radius *= GROWTH

    def _first_radius(self, query: np.ndarray, along: np.ndarray, wanted: int) -> float:
        """The radius whose windows hold about as many vectors as are wanted, or half of the way to the nearest of
        `FIRST_LOOK` vectors spread over the block; only the number of rounds depends on it."""
        gaps = [np.abs(s[max(0, p - wanted) : p + wanted] - a).max() for s, a in zip(self.sorted, along, strict=True) for p in [int(np.searchsorted(s, a))]]
        looked = self.vectors[:: -(-len(self.vectors) // FIRST_LOOK)] - query
        nearest = float(np.sqrt(np.einsum("ij,ij->i", looked, looked).min()))
        spread = float(np.abs(self.sorted[:, [0, -1]]).max())
        return max(float(np.median(gaps)) * 2 / WIDTH, nearest / 2, spread * 1e-6, 1e-300)


def _search(wanted: int):
    def search(table: pa.Table) -> pa.Table:
        is_query = table["is_query"].to_numpy()
        ids, number, asked = table["id"].to_numpy(), np.flatnonzero(is_query), table["query"].to_numpy()
        vectors = matrix(table["embedding"].combine_chunks())
        rows = np.flatnonzero(~is_query)
        none = np.zeros(0, np.int64)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = [(none, none, none, np.zeros(0))]
        if len(rows) and len(number):
            index = SortedProjections(vectors[rows])
            for q in number.tolist():
                other = ids[rows] != ids[q]
                if not other.any():
                    continue
                near, distance = index.nearest(vectors[q], other, wanted)
                first = np.lexsort((ids[rows][near], distance))[:wanted]
                found.append((np.full(len(first), asked[q]), np.full(len(first), ids[q]), ids[rows][near[first]], distance[first]))
        query, query_id, vec, score = (np.concatenate(side) for side in zip(*found, strict=True))
        return pa.table({"query": query, "query_id": query_id, "vec_id": vec, "score": score})

    return search


def search(queries: DataFrame, vectors: DataFrame, wanted: int = 10) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) of each query's nearest vectors (vec_id, embedding)."""
    queries, vectors = (
        t.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
            F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("embedding"), F.size("embedding").alias("size")
        )
        for t in (queries, vectors)
    )
    blocks = max(1, math.ceil(vectors.count() / BLOCK))
    query_blocks = max(1, math.ceil(queries.count() / QUERIES))

    def numbered(n: int, seed: int):
        return F.pmod(F.xxhash64(F.lit(seed), "id", "embedding"), F.lit(n)).cast("int")

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    # A query is a different (id, vector); of rows equal in both one is asked, rows of one id with other vectors each are.
    queries = queries.dropDuplicates(["id", "embedding"]).withColumn("query", F.xxhash64("id", "embedding"))
    dealt = vectors.select("id", "embedding", "size", numbered(blocks, 1).alias("block"), every(query_blocks).alias("query_block"), F.lit(False).alias("is_query"), F.lit(0).cast("long").alias("query"))
    asked = queries.select("id", "embedding", "size", every(blocks).alias("block"), numbered(query_blocks, 2).alias("query_block"), F.lit(True).alias("is_query"), "query")
    met = dealt.union(asked).groupBy("size", "block", "query_block").applyInArrow(_search(wanted), "query long, query_id long, vec_id long, score double")
    order = [F.col("score"), F.col("vec_id")]
    in_groups = Window.partitionBy("query_id", "query", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, blocks // MERGED_AT_ONCE)))).orderBy(*order)
    best = met.withColumn("rank", F.row_number().over(in_groups)).where(F.col("rank") <= wanted)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "query").orderBy(*order)))
    return ranked.where(F.col("rank") <= wanted).select("query_id", "rank", "vec_id", "score")
