"""Rating queries: ranks, time splits, recommendation, segments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import (
    als_experiment,
    assign_segments,
    concat_group,
    fit_als,
    fit_segments,
    hash_sample,
    hash_split,
    largest_segments,
    lookup_join,
    members_of_largest,
    normal_equations,
    normal_residuals,
    percent_rank_by,
    regression_metrics,
    segment_genres,
    segment_ratings,
    segment_spread,
    solve_factors,
    time_split,
    time_splits,
    user_factors,
)
from millrace.operators.recommend import TRAIN_FRACTIONS
from millrace.plans.inputs import RATING_KEY, RATINGS_SQL, bucket_sql, movies, ratings
from millrace.plans.registry import query
from millrace.sources import materialise, release

_KEYS = ", ".join(RATING_KEY)


def landed(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The ratings written once, as they are read for the thresholds and for each side."""
    return materialise(ratings(spark, sf_dir).select(*columns))


@query(
    "percent_rank_by_customer",
    f"""WITH {RATINGS_SQL}
    SELECT {_KEYS}, userId,
           round(percent_rank() OVER (PARTITION BY userId ORDER BY ts NULLS FIRST), 9)
             AS percent_rank
    FROM ratings""",
)
def percent_rank_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = percent_rank_by(ratings(spark, sf_dir), "ts", ["userId"])
    return ranked.select(*RATING_KEY, "userId", F.round("percent_rank", 9).alias("percent_rank"))


@query(
    "percent_rank_by_time",
    f"WITH {RATINGS_SQL} SELECT {_KEYS}, round(pr, 9) AS percent_rank FROM ranked",
)
def percent_rank_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = percent_rank_by(ratings(spark, sf_dir), "ts")
    return ranked.select(*RATING_KEY, F.round("percent_rank", 9).alias("percent_rank"))


@query(
    "time_split_counts",
    f"""WITH {RATINGS_SQL}
    SELECT p AS split, side, count(*) AS rows, count(DISTINCT userId) AS users,
           CAST(min(ts) AS VARCHAR) AS first_ts, CAST(max(ts) AS VARCHAR) AS last_ts
    FROM (SELECT p, CASE WHEN pr <= p THEN 'train' ELSE 'test' END AS side, userId, ts
          FROM ranked, (VALUES (0.5::DOUBLE), (0.65::DOUBLE), (0.8::DOUBLE)) AS f(p))
    GROUP BY p, side""",
)
def time_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = landed(spark, sf_dir, "userId", "ts")
    parts = [
        side.groupBy(F.lit(p).alias("split"), F.lit(name).alias("side")).agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_distinct("userId").alias("users"),
            F.min("ts").cast("string").alias("first_ts"),
            F.max("ts").cast("string").alias("last_ts"),
        )
        for p, sides in time_splits(rows, "ts", TRAIN_FRACTIONS).items()
        for name, side in zip(("train", "test"), sides)
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "hash_split_counts",
    f"""WITH {RATINGS_SQL}
    SELECT CASE WHEN b < 0.7 THEN 'train' ELSE 'test' END AS side, count(*) AS rows,
           CAST(sum(rating) AS DOUBLE) AS sum_rating
    FROM (SELECT rating, {bucket_sql(42, *RATING_KEY)} AS b FROM ratings) GROUP BY 1""",
)
def hash_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = hash_split(ratings(spark, sf_dir), RATING_KEY, [0.7, 0.3], seed=42)
    parts = [
        side.groupBy(F.lit(name).alias("side")).agg(
            F.count(F.lit(1)).alias("rows"), F.sum("rating").alias("sum_rating")
        )
        for name, side in (("train", train), ("test", test))
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "hash_sample",
    f"""WITH {RATINGS_SQL}
    SELECT {_KEYS}, userId, CAST(rating AS DOUBLE) AS rating FROM ratings
    WHERE {bucket_sql(7, *RATING_KEY)} < 0.01""",
)
def hash_sample_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = hash_sample(ratings(spark, sf_dir), RATING_KEY, 0.01, seed=7)
    return sample.select(*RATING_KEY, "userId", F.col("rating").cast("double").alias("rating"))


@query(
    "user_genre_text",
    f"""WITH {RATINGS_SQL}
    SELECT userId, CAST(0 AS BIGINT) AS part, string_agg(genres, '|' ORDER BY genres) AS genres
    FROM ratings JOIN movies USING (movieId) WHERE rating >= 4 GROUP BY userId""",
)
def user_genre_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    liked = ratings(spark, sf_dir).where("rating >= 4").select("userId", "movieId")
    genres = movies(spark, sf_dir).select("movieId", "genres")
    texts = concat_group(lookup_join(liked, genres, ["movieId"]), "userId", "genres")
    return texts.withColumnRenamed("text", "genres")


@query(
    "liked_ratings",
    f"""WITH {RATINGS_SQL}
    SELECT userId AS "user", movieId AS movie, CAST(rating * 20 AS DOUBLE) AS percent, count(*) AS copies
    FROM ratings WHERE l_linenumber <= 3 AND l_suppkey <> 7 AND rating >= 4
    GROUP BY userId, movieId, rating""",
)
def liked_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filters by text and by column, added, dropped and renamed columns."""
    rows = ratings(spark, sf_dir).where("l_linenumber <= 3").filter(F.col("l_suppkey") != 7)
    liked = rows.filter(F.col("rating") >= 4).withColumn("percent", F.col("rating") * 20)
    named = liked.drop(*RATING_KEY, "rating", "ts").toDF("user", "movie", "percent")
    return named.groupBy("user", "movie", "percent").agg(F.count(F.lit(1)).alias("copies"))


def _five_segments(rows: DataFrame) -> DataFrame:
    """Every user of the ratings with one of five segments: id, segment."""
    users = rows.select(F.col("userId").alias("id")).distinct()
    return users.withColumn("segment", F.col("id") % 5)


@query(
    "segment_rating_counts",
    f"""WITH {RATINGS_SQL}
    SELECT userId, count(*) AS rows, CAST(sum(rating) AS DOUBLE) AS total,
           CAST(userId % 5 AS INTEGER) AS segment
    FROM ratings GROUP BY userId""",
)
def segment_rating_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ratings(spark, sf_dir)
    return segment_ratings(_five_segments(rows), rows).groupBy("userId", "segment").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("rating").alias("total")
    )


@query(
    "segment_genres",
    f"""WITH {RATINGS_SQL}
    SELECT CAST(userId % 5 AS INTEGER) AS segment,
           CAST(row_number() OVER (PARTITION BY userId % 5 ORDER BY count(*) DESC, genre) AS INTEGER)
             AS rank, genre, count(*) AS "count"
    FROM (SELECT userId, unnest(string_split(genres, '|')) AS genre
          FROM ratings JOIN movies USING (movieId) WHERE rating >= 4)
    GROUP BY userId % 5, genre QUALIFY rank <= 5""",
)
def segment_genres_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ratings(spark, sf_dir)
    return segment_genres(_five_segments(rows), rows, movies(spark, sf_dir), by=["segment"])


@query(
    "largest_segment_members",
    f"""WITH {RATINGS_SQL},
    sizes AS (
      SELECT userId, count(*) AS n FROM ratings GROUP BY userId ORDER BY n DESC, userId LIMIT 1)
    SELECT {_KEYS}, userId FROM ratings WHERE userId IN (SELECT userId FROM sizes)""",
)
def largest_segment_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return members_of_largest(ratings(spark, sf_dir), "userId").select(*RATING_KEY, "userId")


@query(
    "largest_segments",
    f"""WITH {RATINGS_SQL}
    SELECT CAST(row_number() OVER (ORDER BY count(*) DESC, userId) AS INTEGER) AS rank, userId,
           count(*) AS "count"
    FROM ratings GROUP BY userId ORDER BY count(*) DESC, userId LIMIT 3""",
)
def largest_segments_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return largest_segments(ratings(spark, sf_dir), k=3, key="userId")


@query(
    "als_coverage",
    f"""WITH {RATINGS_SQL},
    train AS (SELECT * FROM ranked WHERE pr <= 0.8)
    SELECT count(*) AS rows, TRUE AS finite,
           (SELECT count(DISTINCT userId) FROM train) AS solved_users,
           (SELECT count(DISTINCT userId) FROM train) AS refitted_users
    FROM ranked WHERE pr > 0.8 AND userId IN (SELECT userId FROM train)
      AND movieId IN (SELECT movieId FROM train)""",
)
def als_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a fit can score, and that its users' factors solve their normal equations given the items'."""
    train, test = time_split(landed(spark, sf_dir, "userId", "movieId", "rating", "ts"), "ts", 0.8)
    model = fit_als(train, reg=0.1, seed=42)
    equations = materialise(normal_equations(train, model.itemFactors))
    release(spark)
    residuals = normal_residuals(equations, model.userFactors, reg=0.1)
    solved = residuals.where("residual < 1e-4").count()
    # Solved anew from the items alone, as for users that the model has not seen.
    again = solve_factors(equations, reg=0.1).withColumnRenamed("features", "again")
    gaps = F.array_max(F.transform(F.arrays_zip("features", "again"), lambda p: F.abs(p["features"] - p["again"])))
    size = F.array_max(F.transform("features", F.abs))
    same = model.userFactors.join(again, "id").where(gaps <= 1e-3 * (size + 1)).count()
    finite = F.col("prediction").isNotNull() & ~F.isnan("prediction")
    return model.transform(test).agg(
        F.count(F.lit(1)).alias("rows"), F.every(finite).alias("finite"),
        F.lit(solved).cast("long").alias("solved_users"), F.lit(same).cast("long").alias("refitted_users"),
    )


@query(
    "als_experiment",
    f"""WITH {RATINGS_SQL},
    splits AS (
      SELECT p, userId, movieId, pr <= p AS train
      FROM ranked, (VALUES (0.5::DOUBLE), (0.65::DOUBLE), (0.8::DOUBLE)) AS f(p))
    SELECT p AS split, setting, count(*) AS rows, TRUE AS mse_is_rmse_squared
    FROM splits t, (VALUES ('setting 1'), ('setting 2'), ('setting 3')) AS s(setting)
    WHERE NOT train
      AND (p, userId) IN (SELECT (p, userId) FROM splits WHERE train)
      AND (p, movieId) IN (SELECT (p, movieId) FROM splits WHERE train)
    GROUP BY p, setting""",
)
def als_experiment_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Landed there.
    table = als_experiment(ratings(spark, sf_dir).select("userId", "movieId", "rating", "ts"), ts="ts")
    close = F.abs(F.col("mse") - F.col("rmse") * F.col("rmse")) < 1e-9
    return table.select("split", "setting", "rows", close.alias("mse_is_rmse_squared"))


@query(
    "user_segments",
    f"""WITH {RATINGS_SQL}
    SELECT side, count(DISTINCT userId) AS users, TRUE AS all_nearest, TRUE AS rank_10,
           TRUE AS centres_are_means, TRUE AS cost_as_trained
    FROM (SELECT userId, CASE WHEN pr <= 0.8 THEN 'train' ELSE 'test' END AS side FROM ranked)
    GROUP BY side""",
)
def user_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Factors and clusters of each side of the split, checked against the fitted centres.

    Once k-means has settled its centres are their members' means, and the members' squares add up to its cost.
    """
    parts = []
    sides = time_split(landed(spark, sf_dir, "userId", "movieId", "rating", "ts"), "ts", 0.8)
    for name, side in zip(("train", "test"), sides):
        factors = user_factors(fit_als(side, seed=42))
        model = fit_segments(factors, k=20, seed=42, max_iter=300)
        distances = F.array(*[
            F.aggregate(
                F.zip_with("features", F.array(*[F.lit(float(x)) for x in centre]),
                           lambda a, b: (a - b) * (a - b)),
                F.lit(0.0), lambda total, x: total + x,
            )
            for centre in model.clusterCenters()
        ])
        assigned = assign_segments(model, factors).withColumn("_d", distances)
        own = F.get("_d", F.col("prediction"))
        spread = segment_spread(model, assign_segments(model, factors)).agg(
            F.sum(F.col("within") + F.col("count") * F.col("drift")).alias("cost"),
            F.sum("within").alias("within"), F.max("drift").alias("drift"),
        ).first()
        trained = model.summary.trainingCost
        as_trained = abs(spread["cost"] - trained) <= 1e-3 * trained
        # The solver stops when no centre moves by more than 1e-4.
        are_means = spread["cost"] - spread["within"] <= 1e-3 * trained and spread["drift"] <= 1e-3
        parts.append(
            assigned.groupBy(F.lit(name).alias("side")).agg(
                F.count(F.lit(1)).alias("users"),
                F.every(own <= F.array_min("_d") + 1e-9).alias("all_nearest"),
                F.every(F.size("features") == 10).alias("rank_10"),
                F.lit(are_means).alias("centres_are_means"),
                F.lit(as_trained).alias("cost_as_trained"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


@query(
    "rating_metrics_by_group",
    f"""WITH {RATINGS_SQL},
    means AS (SELECT movieId, avg(rating) AS pred FROM ratings GROUP BY movieId)
    SELECT r.userId % 10 AS user_group, count(*) AS rows,
           round(sqrt(avg((rating - pred) * (rating - pred))), 6) AS rmse,
           round(avg((rating - pred) * (rating - pred)), 6) AS mse,
           round(avg(abs(rating - pred)), 6) AS mae
    FROM ratings r JOIN means USING (movieId) GROUP BY 1""",
)
def rating_metrics_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ratings(spark, sf_dir)
    means = rows.groupBy("movieId").agg(F.avg("rating").alias("pred"), F.count("*").alias("n"))
    scored = lookup_join(rows, means, ["movieId"], rows_per_key="n").withColumn(
        "user_group", F.col("userId") % 10
    )
    metrics = regression_metrics(scored, "rating", "pred", by=["user_group"])
    return metrics.select("user_group", "rows", *[F.round(m, 6).alias(m) for m in ("rmse", "mse", "mae")])
