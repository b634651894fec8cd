"""Centroid clustering of whole-number vectors over a persisted matrix of dot products.

Components become integers (floor of `scale` times the component), so that every product, sum and
distance is exact. For every vector the table holds its dot product with every centroid. A round
assigns each vector to the centroid with the least |c|^2 - 2 v.c, sums the members of each centroid,
and replaces the centroids; then the products are not computed again but moved by v.(new - old), over
those components of a centroid only that changed. The moved table is written to the shared folder and
takes the place of the one before, which is deleted, so a lost executor costs a task of one round.
The driver sees centroids only: `clusters` * `width` numbers and one row of sums per centroid.

Defined results: vectors that are null, of another width, or with null or non-finite components are
left out; first centroids are the vectors of smallest SHA-256 of `seed`:id, where a null id counts as
the empty text and rows of equal id are ordered by their components; with fewer vectors than clusters
there are as many centroids as vectors; a centroid without members stays; equal distances go to the
smaller number; an empty table gives no rows; columns besides id and vector are not read. Components
beyond 2^27 after scaling raise, as 64-bit distances would not hold them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navloom.llm.shared import discard, keep

WIDTH = 64
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
SEED = 2
#: Largest component, so that a distance of `WIDTH` components stays below 2^62.
LARGEST = 1 << 27

_TABLE = "vec_id long, v array<int>, dots array<long>, cluster int, distance long"


def whole_numbers(vectors: DataFrame, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """vec_id and v, the integers of every vector that is kept."""
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    scaled = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    fits = F.forall("scaled", lambda x: F.abs(x) <= LARGEST)
    kept = vectors.select("vec_id", "embedding").where((F.size("embedding") == width) & finite)
    checked = kept.select("vec_id", scaled.alias("scaled")).select(
        "vec_id", F.when(fits, F.col("scaled")).otherwise(F.raise_error(F.lit("a component is too large"))).alias("scaled")
    )
    return checked.select("vec_id", F.transform("scaled", lambda x: x.cast("int")).alias("v"))


def first_centroids(whole: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors of smallest hash, in the order of their hashes."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = whole.orderBy(F.sha2(text, 256), "v").limit(clusters).select("v").collect()
    return np.array([row["v"] for row in rows], np.int64).reshape(len(rows), len(rows[0]["v"]) if rows else 0)


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(rows, -1)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    starts = pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1])
    return pa.ListArray.from_arrays(starts, pa.array(values.ravel(), kind))


def _assigned(batch: pa.RecordBatch, v: np.ndarray, dots: np.ndarray, centroids: np.ndarray) -> pa.RecordBatch:
    """The rows with their products, nearest centroid and squared distance; argmin takes the first of equals."""
    apart = (centroids * centroids).sum(axis=1)[None, :] - 2 * dots
    cluster = apart.argmin(axis=1)
    distance = apart[np.arange(len(v)), cluster] + (v * v).sum(axis=1)
    return pa.RecordBatch.from_arrays(
        [batch.column("vec_id"), _lists(v, pa.int32()), _lists(dots, pa.int64()), pa.array(cluster.astype(np.int32)), pa.array(distance)],
        names=["vec_id", "v", "dots", "cluster", "distance"],
    )


def _started(centroids: np.ndarray):
    """For mapInArrow: (vec_id, v) with all dot products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = _matrix(batch.column("v"), batch.num_rows)
                yield _assigned(batch, v, v @ centroids.T, centroids)

    return run


def _moved(old: np.ndarray, new: np.ndarray):
    """For mapInArrow: the table after the centroids went from `old` to `new`."""
    change = new - old
    moved = [(j, np.flatnonzero(row)) for j, row in enumerate(change) if row.any()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v, dots = (_matrix(batch.column(c), batch.num_rows) for c in ("v", "dots"))
                for j, parts in moved:
                    dots[:, j] += v[:, parts] @ change[j, parts]
                yield _assigned(batch, v, dots, new)

    return run


def _summed(clusters: int):
    """For mapInArrow: each task's sums of its members' components, a row per centroid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, members = None, np.zeros(clusters, np.int64)
        for batch in batches:
            if batch.num_rows:
                v, of = _matrix(batch.column("v"), batch.num_rows), batch.column("cluster").to_numpy()
                sums = np.zeros((clusters, v.shape[1]), np.int64) if sums is None else sums
                np.add.at(sums, of, v)
                members += np.bincount(of, minlength=clusters)
        if sums is not None:
            some = np.flatnonzero(members)
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)), pa.array(members[some]), _lists(sums[some], pa.int64())], names=["cluster", "members", "sums"]
            )

    return run


def means(table: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Floor of the mean of each centroid's members; a centroid without members as it was.

    Sums of all members may pass 64 bits, so they are added as decimals of 38 digits.
    """
    clusters, width = centroids.shape
    parts = table.select("v", "cluster").mapInArrow(_summed(clusters), "cluster int, members long, sums array<long>")
    numbers = parts.select("cluster", "members", F.posexplode("sums").alias("place", "sum"))
    total: Column = F.sum(F.col("sum").cast("decimal(38,0)"))
    added = numbers.groupBy("cluster", "place").agg(total.alias("sum"), F.sum("members").alias("members"))
    new = centroids.copy()
    for row in added.collect():
        new[row["cluster"], row["place"]] = int(row["sum"]) // row["members"]
    return new


def cluster(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    width: int = WIDTH,
    scale: int = SCALE,
    seed: int = SEED,
) -> tuple[DataFrame, np.ndarray]:
    """The table (vec_id, v, dots, cluster, distance) after the last round, and its centroids."""
    whole = whole_numbers(vectors, width, scale)
    centroids = first_centroids(whole, clusters, seed)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], _TABLE), np.zeros((0, width), np.int64)
    table = keep(whole.mapInArrow(_started(centroids), _TABLE), "dots")
    for _ in range(rounds):
        new = means(table, centroids)
        if (new == centroids).all():
            break
        before, table = table, keep(table.mapInArrow(_moved(centroids, new), _TABLE), "dots")
        discard(before)
        centroids = new
    return table, centroids
