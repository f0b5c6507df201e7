"""User segments: clusters of user factors and what their members like."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from millrace.operators.counts import top_k
from millrace.operators.joins import lookup_join


def _vector(factors: DataFrame) -> Column:
    """The features as a vector: k-means refuses arrays that were stored as nullable."""
    is_array = isinstance(factors.schema["features"].dataType, ArrayType)
    return array_to_vector("features") if is_array else F.col("features")


def fit_segments(factors: DataFrame, k: int = 20, seed: int = 42, max_iter: int = 20) -> KMeansModel:
    """K-means on the ``features`` of the factors.

    The solver keeps the points while it runs, as vectors with their norms. It would not if the table were
    persisted here, and would decode every row in every iteration.
    """
    vectors = factors.select(_vector(factors).alias("_vector"))
    return KMeans(featuresCol="_vector", k=k, seed=seed, maxIter=max_iter, solver="row").fit(vectors)


def assign_segments(model: KMeansModel, factors: DataFrame) -> DataFrame:
    """id, features, prediction: the nearest centre of each user."""
    scored = model.transform(factors.withColumn("_vector", _vector(factors)))
    return scored.select("id", "features", "prediction")


def segment_spread(model: KMeansModel, assigned: DataFrame) -> DataFrame:
    """prediction, count, within, drift: squares within each segment, and how far its centre is from its mean.

    ``within`` is the sum of squared distances of the members to their mean, ``drift`` the squared distance from
    that mean to the fitted centre, so the cost of a segment is within + count * drift. Means and
    variances come from one aggregate over vectors, summed up within tasks first, so a hot segment
    is no hot key. Segments without members have no row.
    """
    moments = Summarizer.metrics("mean", "variance", "count").summary(_vector(assigned))
    found = assigned.groupBy("prediction").agg(moments.alias("m")).select(
        "prediction", F.col("m.count").alias("count"),
        vector_to_array("m.mean").alias("mean"), vector_to_array("m.variance").alias("variance"),
    )
    centres = assigned.sparkSession.createDataFrame(
        [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())],
        "prediction INT, centre ARRAY<DOUBLE>",
    )

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)

    gaps = F.zip_with("mean", "centre", lambda a, b: (a - b) * (a - b))
    return found.join(centres, "prediction").select(
        "prediction", "count", (total(F.col("variance")) * (F.col("count") - 1)).alias("within"), total(gaps).alias("drift")
    )


def largest_segments(assigned: DataFrame, k: int = 3, key: str = "prediction") -> DataFrame:
    """The ``k`` segments with the most rows: rank, key, count."""
    return top_k(assigned.groupBy(key).count(), key, k).select("rank", key, "count")


def members_of_largest(df: DataFrame, key: str) -> DataFrame:
    """The rows of the group that has the most rows (the smallest key among equals)."""
    # One row, by the limit in top_k.
    largest = F.broadcast(top_k(df.groupBy(key).count(), key, 1).select(key)).alias("r")
    same = F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    return df.alias("l").join(largest, same, "left_semi")


def segment_ratings(users: DataFrame, ratings: DataFrame, user_id: str = "id") -> DataFrame:
    """The ratings of the given users (one row per user), with the users' other columns."""
    return lookup_join(ratings, users.withColumnRenamed(user_id, "userId"), ["userId"])


def segment_genres(
    users: DataFrame,
    ratings: DataFrame,
    movies: DataFrame,
    min_rating: float = 4,
    k: int = 5,
    user_id: str = "id",
    by: Sequence[str] = (),
) -> DataFrame:
    """The ``k`` most frequent genres among the movies the users rated well: [by], rank, genre, count.

    ``by`` names columns of ``users``, such as the segment of each: all segments are ranked at once. Liked
    ratings are counted per movie before the movies are joined, so a popular movie is no hot key there.
    """
    liked = ratings.where(F.col("rating") >= min_rating).select("userId", "movieId")
    per_movie = (
        segment_ratings(users.select(user_id, *by), liked, user_id)
        .groupBy(*by, "movieId")
        .agg(F.count(F.lit(1)).alias("_likes"))
    )
    genres = per_movie.join(movies.select("movieId", "genres"), "movieId").select(
        *by, F.explode(F.split("genres", "[|]")).alias("genre"), "_likes"
    )
    counts = genres.groupBy(*by, "genre").agg(F.sum("_likes").alias("count"))
    return top_k(counts, "genre", k, by).select(*by, "rank", "genre", "count")
