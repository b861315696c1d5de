"""Centroid clustering with exact integers and Shallot's bounds.

Vectors become integers, so that every distance, centroid and tie is exact. Beside its vector
each row carries what it learnt: its centroid and an upper bound of the distance to it, the
second-nearest centroid, and a lower bound of the distance to all but its own. Where the bounds
cannot settle a row after the centroids moved, its search starts from the closer of the two
remembered centroids and goes through that one's neighbours in ascending order, until a
neighbour is too far away to beat the second-best distance so far; the ball shrinks with every
better one. Bounds are floating point with a margin, what they leave open is compared in
integers.

A round is one pass over the rows, which writes them to one of two folders in turn, and one
aggregate of a row per centroid. Only centroids, of which there are ``clusters``, pass through
the driver, so equal vectors or a cluster with most rows cost nothing more.

Rows whose vector is null, has another length, or has a null or non-finite component are left
out. A null id is clustered like any other and comes after all others as a start; rows with one
id are judged each by its vector, the least vector comes first among them as a start.
With fewer rows than ``clusters`` there are fewer centroids, and an empty table gives an empty
result. Components beyond 2**26 after scaling would not fit the distance's long: the operator
stops with a message. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices
from tidemark.session import new_folder, settle

CLUSTERS = 16
COMPONENTS = 64
SCALE = 64
ROUNDS = 3
MOST = 1 << 26
ROWS = 5000  # vectors that one step of a task holds
_MARGIN = 1e-9

STATE = "vec_id long, v array<int>, cluster int, second int, upper double, lower double"
ASSIGNED = "vec_id long, cluster int, distance long"


def integers(
    embeddings: DataFrame, vector: str, components: int = COMPONENTS, scale: int = SCALE
) -> DataFrame:
    """vec_id and ``v``, the floor of ``scale`` times each component, of the rows that are kept."""
    values = F.col(vector).cast("array<double>")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = embeddings.filter((F.size(values) == components) & ~F.coalesce(bad, F.lit(True)))
    scaled = F.transform(values, lambda x: F.floor(x * scale))
    return kept.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(
            scaled,
            lambda x: F.when(F.abs(x) <= MOST, x.cast("int")).otherwise(
                F.raise_error(F.lit("a component is too large for exact distances")).cast("int")
            ),
        ).alias("v"),
    )


def first_centroids(rows: DataFrame, clusters: int, seed: int = 1) -> np.ndarray:
    """The vectors whose ids have the least hashes, in the order of these."""
    named = rows.select(
        F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).alias("h"), "v"
    )
    found = named.orderBy(F.asc_nulls_last("h"), "v").limit(clusters).collect()
    return np.array([row.v for row in found], np.int64)


def squared(vectors: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact squared distances, row by row."""
    apart = vectors - others
    return np.einsum("ij,ij->i", apart, apart)


class Neighbours:
    """For each centroid the other ones by distance, and how far the nearest is."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        count = len(centroids)
        apart = centroids[:, None, :] - centroids[None, :, :]
        distance = np.sqrt((apart * apart).sum(axis=2).astype(np.float64))
        np.fill_diagonal(distance, -1.0)  # a centroid comes first in its own list
        self.order = np.argsort(distance, axis=1, kind="stable")[:, 1:]
        self.distance = np.take_along_axis(distance, self.order, axis=1)
        self.half = self.distance[:, 0] / 2 if count > 1 else np.full(count, np.inf)


def search(
    vectors: np.ndarray, one: np.ndarray, other: np.ndarray, near: Neighbours
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nearest and second-nearest centroid of each vector with their squared distances.

    ``one`` and ``other`` are where to start; ties go to the smaller number.
    """
    centroids = near.centroids
    d_one, d_other = squared(vectors, centroids[one]), squared(vectors, centroids[other])
    swap = (d_other < d_one) | ((d_other == d_one) & (other < one))
    center = np.where(swap, other, one)
    skip = np.where(swap, one, other)  # looked at already
    best, best_d = center.copy(), np.minimum(d_one, d_other)
    next_, next_d = skip.copy(), np.maximum(d_one, d_other)
    reach = np.sqrt(best_d.astype(np.float64))
    active = np.arange(len(vectors))
    for rank in range(near.order.shape[1]):
        # A centroid beyond this ball is farther than the second best so far.
        ball = reach[active] + np.sqrt(next_d[active].astype(np.float64))
        active = active[near.distance[center[active], rank] <= ball * (1 + _MARGIN)]
        if not active.size:
            break
        tried = near.order[center[active], rank]
        new = tried != skip[active]
        rows, tried = active[new], tried[new]
        d = squared(vectors[rows], centroids[tried])
        first = (d < best_d[rows]) | ((d == best_d[rows]) & (tried < best[rows]))
        second = ~first & ((d < next_d[rows]) | ((d == next_d[rows]) & (tried < next_[rows])))
        up, also = rows[first], rows[second]
        next_[up], next_d[up] = best[up], best_d[up]
        best[up], best_d[up] = tried[first], d[first]
        next_[also], next_d[also] = tried[second], d[second]
    return best, best_d, next_, next_d


def moved_bounds(
    cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, moves: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The bounds after each centroid moved by up to ``moves``."""
    farthest = int(moves.argmax())
    rest = np.delete(moves, farthest).max(initial=0.0)
    others = np.where(cluster == farthest, rest, moves[farthest])
    return (upper + moves[cluster]) * (1 + _MARGIN), (lower - others) * (1 - _MARGIN) - _MARGIN


def assign(
    vectors: np.ndarray,
    cluster: np.ndarray,
    second: np.ndarray,
    upper: np.ndarray,
    lower: np.ndarray,
    near: Neighbours,
) -> None:
    """Bring the four state arrays up to the centroids of ``near``, in place."""
    if len(near.centroids) == 1:
        return
    safe = np.maximum(lower, near.half[cluster] * (1 - _MARGIN))
    open_ = np.flatnonzero(upper >= safe)
    exact = squared(vectors[open_], near.centroids[cluster[open_]])
    upper[open_] = np.sqrt(exact.astype(np.float64)) * (1 + _MARGIN)
    open_ = open_[upper[open_] >= safe[open_]]
    best, best_d, next_, next_d = search(vectors[open_], cluster[open_], second[open_], near)
    cluster[open_], second[open_] = best, next_
    upper[open_] = np.sqrt(best_d.astype(np.float64)) * (1 + _MARGIN)
    lower[open_] = np.sqrt(next_d.astype(np.float64)) * (1 - _MARGIN)


def _vectors(column: pa.Array, components: int) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.int64).reshape(-1, components)


def _round(centroids: np.ndarray, moves: np.ndarray | None):
    """One assignment of state rows; without ``moves`` nothing is known of them yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = Neighbours(centroids)
        for whole in batches:
            for batch in slices(whole, ROWS):
                vectors = _vectors(batch["v"], centroids.shape[1])
                count = len(vectors)
                if moves is None:
                    cluster = np.zeros(count, np.int32)
                    second = np.full(count, min(1, len(centroids) - 1), np.int32)
                    upper, lower = np.full(count, np.inf), np.zeros(count)
                else:
                    cluster, second = (batch[name].to_numpy().copy() for name in ("cluster", "second"))
                    upper, lower = moved_bounds(
                        cluster, batch["upper"].to_numpy(), batch["lower"].to_numpy(), moves
                    )
                assign(vectors, cluster, second, upper, lower, near)
                yield pa.RecordBatch.from_arrays(
                    [batch["vec_id"], batch["v"], *map(pa.array, (cluster, second, upper, lower))],
                    names=["vec_id", "v", "cluster", "second", "upper", "lower"],
                )

    return run


def _distances(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, ROWS):
                cluster = batch["cluster"].to_numpy()
                apart = squared(_vectors(batch["v"], centroids.shape[1]), centroids[cluster])
                yield pa.RecordBatch.from_arrays(
                    [batch["vec_id"], batch["cluster"], pa.array(apart)],
                    names=["vec_id", "cluster", "distance"],
                )

    return run


def means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The floor of the mean of each cluster's vectors; an empty cluster keeps its centroid."""
    places = range(centroids.shape[1])
    # One row per cluster and task goes through the shuffle, and one per cluster to the driver.
    sums = state.groupBy("cluster").agg(
        F.count("*").alias("n"),
        F.array(*[F.sum(F.col("v")[place].cast("long")) for place in places]).alias("total"),
    )
    new = centroids.copy()
    for row in sums.collect():
        new[row.cluster] = [total // row.n for total in row.total]
    return new


def cluster(
    embeddings: DataFrame,
    vector: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    components: int = COMPONENTS,
    scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster and distance of each kept vector, and the final centroids."""
    spark = embeddings.sparkSession
    rows = settle(integers(embeddings, vector, components, scale))
    centroids = first_centroids(rows, clusters)
    if not len(centroids):
        return spark.createDataFrame([], ASSIGNED), centroids
    folder, state, moves = new_folder(spark, "centroids"), rows, None
    for turn in range(rounds + 1):
        state = settle(state.mapInArrow(_round(centroids, moves), STATE), f"{folder}/{turn % 2}")
        if turn < rounds:
            before, centroids = centroids, means(state, centroids)
            moves = np.sqrt(squared(centroids, before).astype(np.float64)) * (1 + _MARGIN)
    return settle(state.mapInArrow(_distances(centroids), ASSIGNED)), centroids


def clusters_with_inertia(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """Each vector's cluster and distance, the sums of these, and its centroid's checksum."""
    spark = embeddings.sparkSession
    assigned, centroids = cluster(embeddings, vector)
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    totals = {row.cluster: row.cluster_inertia for row in sums.collect()}  # one row per cluster
    written = [",".join(map(str, values)) for values in centroids.tolist()]
    known = [
        (place, total, sum(totals.values()), hashlib.sha256(written[place].encode()).hexdigest())
        for place, total in totals.items()
    ]
    table = spark.createDataFrame(
        known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return assigned.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
