import hashlib
import math
import random

import compare
import numpy as np
import pytest

from tidemark.llm import centroids, oracle, queries

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, v string, distance long"


def brute(rows, clusters=16, rounds=3, components=64):
    """The definition, with Python integers; rows are (vec_id, vector)."""
    kept = []
    for vec_id, vector in rows:
        if vector is None or len(vector) != components:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((vec_id, [math.floor(64 * float(np.float32(x))) for x in vector]))

    def place(row):
        known = row[0] is not None
        return (not known, hashlib.sha256(f"1:{row[0]}".encode()).hexdigest() if known else "", row[1])

    centers = [list(v) for _, v in sorted(kept, key=place)[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centers))

    for _ in range(rounds):
        members = [[] for _ in centers]
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        for n, group in enumerate(members):
            if group:
                centers[n] = [sum(x) // len(group) for x in zip(*group)]
    final = [(vec_id, *nearest(v)) for vec_id, v in kept]
    inertia = {}
    for _, d, n in final:
        inertia[n] = inertia.get(n, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted(
        (str(vec_id), n, d, inertia[n], sum(inertia.values()), sha[n]) for vec_id, d, n in final
    )


def found(frame):
    return sorted(
        (str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256)
        for r in frame.collect()
    )


def frame_of(spark, rows):
    full = [(i, v, 1, "c", "v", 9) for i, v in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


@pytest.mark.parametrize("kind", ["normal", "grid", "blobs"])
def test_against_brute_force(spark, kind):
    drawn = random.Random(kind)
    centers = [[drawn.gauss(0, 1) for _ in range(64)] for _ in range(9)]
    rows = []
    for i in range(250):
        if kind == "normal":
            vector = [drawn.gauss(0, 0.2) for _ in range(64)]
        elif kind == "grid":  # many ties: components of a few small integers
            vector = [drawn.choice([-1, 0, 0, 0, 1]) / 64 for _ in range(64)]
        else:
            vector = [x + drawn.gauss(0, 0.05) for x in drawn.choice(centers)]
        rows.append((i, vector))
    assert found(centroids.clusters_with_inertia(frame_of(spark, rows))) == brute(rows)


def test_awkward_rows(spark):
    drawn = random.Random(5)
    vector = lambda: [drawn.gauss(0, 1) for _ in range(64)]
    same = vector()
    rows = [(i, same) for i in range(30)]  # a third and more are one vector
    rows += [(100 + i, vector()) for i in range(20)]
    rows += [
        (1, None),
        (2, []),
        (3, vector()[:63]),
        (4, vector() + [0.0]),
        (5, [None] + vector()[:63]),
        (6, [float("nan")] + vector()[:63]),
        (7, [float("-inf")] + vector()[:63]),
        (8, [1e5] * 64),
        (None, vector()),
        (None, same),
        (9, same),
        (9, same),
        (10, vector()),
        (10, vector()),
    ]
    assert found(centroids.clusters_with_inertia(frame_of(spark, rows))) == brute(rows)


@pytest.mark.parametrize("count", [0, 1, 2, 5])
def test_few_rows(spark, count):
    rows = [(i, [float(i + j) for j in range(64)]) for i in range(count)]
    result = centroids.clusters_with_inertia(frame_of(spark, rows))
    assert found(result) == brute(rows)
    assert result.columns[:3] == ["vec_id", "cluster", "distance"]


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="too large"):
        centroids.clusters_with_inertia(frame_of(spark, [(1, [1e30] * 64)]))


def test_bounds_leave_most_rows_alone():
    """After a small move only rows near a border are searched, and all are right."""
    drawn = np.random.default_rng(3)
    centers = drawn.integers(-500, 500, (12, 64))
    vectors = centers[drawn.integers(0, 12, 4000)] + drawn.integers(-60, 60, (4000, 64))
    state = [
        np.zeros(4000, np.int32),
        np.ones(4000, np.int32),
        np.full(4000, np.inf),
        np.zeros(4000),
    ]
    centroids.assign(vectors, *state, centroids.Neighbours(centers))
    moved = centers + drawn.integers(-3, 4, centers.shape)
    moves = np.sqrt(centroids.squared(moved, centers))
    state[2], state[3] = centroids.moved_bounds(state[0], state[2], state[3], moves)
    asked = []
    real = centroids.search

    def counted(rows, *rest):
        asked.append(len(rows))
        return real(rows, *rest)

    centroids.search = counted
    try:
        centroids.assign(vectors, *state, centroids.Neighbours(moved))
    finally:
        centroids.search = real
    apart = ((vectors[:, None, :] - moved[None]) ** 2).sum(axis=2)
    assert (state[0] == apart.argmin(axis=1)).all()
    assert sum(asked) < 400


def test_query_against_sql(spark, folder):
    frame = queries.QUERIES["op11_shallot_centroids"](spark, folder)
    con = compare.connect(folder)
    assert compare.difference(frame, con, oracle.ORACLE["op11_shallot_centroids"]) is None
