"""Clusters against a plain integer k-means, bounds against full searches, and edge rows."""

import hashlib
import math

import numpy as np

from millrace.llm.centroids import choose_pivots, cluster_vectors, nearest


def expected(vectors, k, rounds, seed=3):
    """(vec_id, cluster, squared distance) per vector, and the centroids, in plain integers."""
    points = [(i, [math.floor(1024 * x) for x in v]) for i, v in vectors]
    first = sorted(points, key=lambda p: (hashlib.sha256(f"{seed}:{p[0]}".encode()).hexdigest(), p[1]))
    centres = [p for _, p in first[:k]]

    def assign():
        squares = [[sum((x - y) ** 2 for x, y in zip(p, c)) for c in centres] for _, p in points]
        return [(s.index(min(s)), min(s)) for s in squares]

    for _ in range(rounds):
        own = [[p for (_, p), (c, _) in zip(points, assign()) if c == i] for i in range(len(centres))]
        centres = [[sum(x) // len(ps) for x in zip(*ps)] if ps else c for ps, c in zip(own, centres)]
    return [(i, *a) for (i, _), a in zip(points, assign())], centres


def test_rounds_are_those_of_plain_k_means(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((4, 6)) * 3
    data = [(i, (centres[i % 4] + rng.standard_normal(6) * (0.2 + i % 3)).tolist()) for i in range(300)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(5)
    for rounds in (0, 1, 4):
        members, clusters = cluster_vectors(df, k=5, rounds=rounds, dims=6)
        want, centroids = expected(data, 5, rounds)
        assert sorted(tuple(r) for r in members.collect()) == sorted(want)
        found = {r["cluster"]: r for r in clusters.collect()}
        assert [found[c]["centroid"] for c in range(5)] == centroids
        assert sum(r["inertia"] for r in found.values()) == sum(w[2] for w in want)


def test_bounds_never_lose_the_nearest():
    rng = np.random.default_rng(6)
    for spread in (3, 200, 2**26):
        points = rng.integers(-spread, spread, (500, 64))
        centroids = np.concatenate([points[:6], points[:2], rng.integers(-spread, spread, (4, 64))])
        pivots = choose_pivots(points[:40], 7)
        squares = ((points[:, None] - centroids) ** 2).sum(-1)
        table = np.sqrt(((points[:, None] - pivots) ** 2).sum(-1).astype(float))
        cluster, best = nearest(points, table, pivots, centroids)
        assert (best == squares.min(1)).all() and (cluster == squares.argmin(1)).all()


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [
        (1, [0.5, -0.5], 9), (1, [0.5, -0.5], 8), (1, [3.0, 3.0], 7), (None, [0.25, 0.0], 7), (2, None, 7),
        (3, [], 7), (4, [1.0], 7), (5, [1.0, None], 7), (6, [nan, 1.0], 7), (7, [1.0, -inf], 7),
        (8, [1e30, 0.0], 7), (9, [1.0, 2.0, 3.0], 7),
    ]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, cluster int")
    members, clusters = cluster_vectors(df, k=8, dims=2)
    got = sorted((tuple(r) for r in members.collect()), key=repr)
    # Equal vectors are two centroids, of which the second stays without vectors.
    assert got == [(1, 0, 0), (1, 0, 0), (1, 2, 0), (None, 3, 0)]
    sizes = {r["cluster"]: (r["rows"], r["centroid"], int(r["inertia"])) for r in clusters.collect()}
    assert sizes == {0: (2, [512, -512], 0), 1: (0, [512, -512], 0), 2: (1, [3072, 3072], 0), 3: (1, [256, 0], 0)}
    members, clusters = cluster_vectors(df.where("false"), dims=2)
    assert members.collect() == [] and clusters.collect() == []
    floats = df.where("vec_id = 1").select("vec_id", df["embedding"].cast("array<float>").alias("embedding"))
    assert cluster_vectors(floats, k=1, dims=2)[1].first()["rows"] == 3
