"""Centroid clustering in exact integers, with a LAESA pivot table.

A vector becomes a point of integers, ``floor(scale * x)``. A few pivots are fixed once, and the
distance of every point to every pivot is stored next to the point in one written table. In a
round only the k x pivots distances between centroids and pivots are new: the triangle inequality
turns the differences into lower bounds for all centroids, and only those whose bound does not
exceed the best distance so far get their exact integer distance. The bounds are rounded down, so
the assignment is that of a full search, ties to the smaller number included.

A round is one narrow pass over the table. Each task returns one row per cluster with exact sums,
so only k rows per task are shuffled and k centroids reach the driver, however many vectors there
are and however many of them belong to one cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources import materialise

#: Components lie within this, so that a squared distance of 64 of them fits 63 bits.
LARGEST = 1 << 27
#: Vectors among which the pivots are chosen, the first by hash.
PIVOT_SAMPLE = 64


def _squares(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    gap = points - centre
    return np.einsum("ij,ij->i", gap, gap)


def choose_pivots(sample: np.ndarray, pivots: int) -> np.ndarray:
    """Up to ``pivots`` rows of ``sample``, each the farthest in total from those before it."""
    chosen = [0]
    total = np.sqrt(_squares(sample, sample[0]).astype(float))
    while len(chosen) < min(pivots, len(sample)):
        total[chosen] = -1.0
        chosen.append(int(total.argmax()))
        total += np.sqrt(_squares(sample, sample[chosen[-1]]).astype(float))
    return sample[chosen]


def nearest(
    points: np.ndarray, table: np.ndarray, pivots: np.ndarray, centroids: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each point; ``table`` has its distances to the pivots."""
    low = np.zeros((len(points), len(centroids)))
    for at, pivot in enumerate(pivots):
        own, far = table[:, at, None], np.sqrt(_squares(centroids, pivot).astype(float))
        # Rounding errors of the roots are far below this share of them.
        np.maximum(low, np.abs(own - far) - 1e-12 * (own + far), out=low)
    low = low * low * (1 - 1e-9)
    cluster = low.argmin(axis=1)
    gap = points - centroids[cluster]
    best = np.einsum("ij,ij->i", gap, gap)
    first = cluster.copy()
    for c, centre in enumerate(centroids):
        alive = np.flatnonzero((first != c) & (low[:, c] <= best))
        exact = _squares(points[alive], centre)
        closer = (exact < best[alive]) | ((exact == best[alive]) & (c < cluster[alive]))
        best[alive[closer]] = exact[closer]
        cluster[alive[closer]] = c
    return cluster, best


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)


def _points(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """vec_id and point of the vectors that have one."""
    numbers = F.col("embedding").cast("array<double>")
    # Infinities are too large, and so is NaN, the largest number of all.
    fits = F.forall(numbers, lambda x: F.coalesce(F.abs(x * scale) < LARGEST, F.lit(False)))
    point = F.transform(numbers, lambda x: F.floor(x * scale))
    sized = vectors.where(F.size("embedding") == dims).where(fits)
    return sized.select("vec_id", point.cast("array<int>").alias("point"))


def _hash(seed: int) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)


def cluster_vectors(
    vectors: DataFrame,
    k: int = 8,
    rounds: int = 10,
    dims: int = 64,
    scale: int = 1024,
    seed: int = 3,
    pivots: int = 8,
) -> tuple[DataFrame, DataFrame]:
    """Cluster the ``vectors`` (vec_id, embedding) by ``rounds`` of exact integer k-means.

    Returns the vectors (vec_id, cluster, distance) and the clusters (cluster, centroid, rows,
    inertia); distances are squared, the inertia is their sum as decimal(38,0).

    The centroids start as the ``k`` vectors with the smallest SHA-256 of ``<seed>:<vec_id>``; equal
    hashes are ordered by the vector. A round assigns every vector to its nearest centroid (ties: the
    smaller number) and moves each centroid to the floor of its vectors' mean; one without vectors
    stays. Rounds after which nothing moves are not run, as they would change nothing. After them all
    vectors are assigned once more.

    Vectors that are null, of another length, or hold a null or non-finite component are left
    out, and so are those with a component of :data:`LARGEST` or beyond after scaling, whose
    distances do not fit a long. Repeated rows and ids are rows like any other; a null id comes
    last at the start and is clustered. With fewer than ``k`` vectors each is a centroid, with
    none both results are empty. Other columns are ignored.
    """
    spark = vectors.sparkSession
    points = materialise(_points(vectors.select("vec_id", "embedding"), dims, scale))
    order = [_hash(seed).asc_nulls_last(), "point"]
    sample = points.orderBy(*order).limit(max(k, PIVOT_SAMPLE)).collect()  # bounded
    first = np.array([r["point"] for r in sample], np.int64).reshape(-1, dims)
    centroids = first[:k]
    chosen = choose_pivots(first, pivots) if len(first) else first
    width = len(chosen)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _matrix(batch.column(1), dims, np.int64)
            far = np.empty((len(at), width))
            for i, pivot in enumerate(chosen):
                far[:, i] = np.sqrt(_squares(at, pivot).astype(float))
            rows = np.arange(len(at) + 1, dtype=np.int32) * width
            listed = pa.ListArray.from_arrays(pa.array(rows), pa.array(far.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), listed], names=["vec_id", "point", "far"]
            )

    kind = points.schema["vec_id"].dataType.simpleString()
    table = materialise(points.mapInArrow(measure, f"vec_id {kind}, point array<int>, far array<double>"))

    def assigned(centres: np.ndarray) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at, far = _matrix(batch.column(1), dims, np.int64), _matrix(batch.column(2), width, float)
                cluster, distance = nearest(at, far, chosen, centres)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                    names=["vec_id", "cluster", "distance"],
                )

        return table.mapInArrow(run, f"vec_id {kind}, cluster int, distance long")

    def moved(centres: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = np.zeros(len(centres), np.int64)
            sums = np.zeros((len(centres), dims), np.int64)
            for batch in batches:
                at, far = _matrix(batch.column(1), dims, np.int64), _matrix(batch.column(2), width, float)
                cluster, _ = nearest(at, far, chosen, centres)
                rows += np.bincount(cluster, minlength=len(centres))
                for c in np.unique(cluster):
                    sums[c] += at[cluster == c].sum(axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(centres), dtype=np.int32)), pa.array(rows), pa.array(sums.tolist())],
                names=["cluster", "rows", "sums"],
            )

        parts = table.mapInArrow(run, "cluster int, rows long, sums array<long>")
        cells = parts.where("rows > 0").select("cluster", "rows", F.posexplode("sums").alias("pos", "part"))
        totals = cells.groupBy("cluster", "pos").agg(
            F.sum("rows").alias("rows"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total")
        )
        new = centres.copy()
        for cell in totals.collect():  # k x dims rows
            new[cell["cluster"], cell["pos"]] = int(cell["total"]) // cell["rows"]
        return new

    for _ in range(rounds if len(centroids) else 0):
        before, centroids = centroids, moved(centroids)
        if np.array_equal(before, centroids):
            break
    members = materialise(assigned(centroids))
    centres = spark.createDataFrame(
        [(c, row.tolist()) for c, row in enumerate(centroids)], "cluster int, centroid array<long>"
    )
    sizes = members.groupBy("cluster").agg(
        F.count("*").alias("rows"), F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")
    )
    none = F.lit(0)
    clusters = centres.join(sizes, "cluster", "left").select(
        "cluster", "centroid", F.coalesce("rows", none).alias("rows"),
        F.coalesce("inertia", none.cast("decimal(38,0)")).alias("inertia"),
    )
    return members, materialise(clusters)
