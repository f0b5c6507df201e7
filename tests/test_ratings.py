import pytest
from pyspark.ml.clustering import KMeans
from pyspark.sql import functions as F

from millrace.operators import (
    als_experiment,
    assign_segments,
    fit_als,
    fit_segments,
    largest_segments,
    members_of_largest,
    segment_genres,
    segment_spread,
    user_factors,
)
from tests.helpers import rows


@pytest.fixture(scope="module")
def ratings(spark):
    """40 users rate 12 of 30 movies each."""
    df = spark.range(480).selectExpr(
        "int(id % 40) AS userId", "int((id * 7) % 30) AS movieId",
        "double(1 + pmod(xxhash64(id), 5)) AS rating", "int(id) AS timestamp",
    )
    return df.cache()


def test_als_drops_what_it_has_not_seen(spark, ratings):
    model = fit_als(ratings, rank=3, max_iter=2)
    unseen = spark.createDataFrame([(0, 0), (999, 0), (0, 999)], "userId INT, movieId INT")
    assert rows(model.transform(unseen), "userId", "movieId") == [(0, 0)]
    factors = user_factors(model)
    assert factors.count() == 40
    assert factors.where(F.size("features") != 3).isEmpty()


def test_als_rejects_ids_beyond_int(spark):
    df = spark.createDataFrame([(2**40, 1, 3.0)], "userId BIGINT, movieId INT, rating DOUBLE")
    with pytest.raises(Exception, match="(?i)int"):
        fit_als(df, max_iter=1)


def test_experiment_has_a_row_per_cell(ratings):
    settings = {"a": {"rank": 2, "max_iter": 1}, "b": {"rank": 3, "max_iter": 1, "reg": 0.5}}
    table = als_experiment(ratings, [0.5, 0.8], settings).collect()
    assert [(r["split"], r["setting"]) for r in table] == [(0.5, "a"), (0.5, "b"), (0.8, "a"), (0.8, "b")]
    assert all(r["mse"] == pytest.approx(r["rmse"] ** 2) and r["rows"] > 0 for r in table)
    assert ratings.storageLevel.useMemory  # the caller's cache is still there


def test_segments(spark):
    factors = spark.range(29).selectExpr(
        "int(id) AS id", "array(float(id % 3 * 10), float(id % 3)) AS features"
    )
    assigned = assign_segments(fit_segments(factors, k=3, seed=1), factors)
    assert assigned.columns == ["id", "features", "prediction"]
    top = largest_segments(assigned, k=3).orderBy("rank").collect()
    assert [r["count"] for r in top] == [10, 10, 9]
    members = members_of_largest(assigned, "prediction")
    assert members.count() == 10 and members.select("prediction").distinct().count() == 1


def test_members_of_largest_may_be_the_null_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "g STRING, v INT")
    assert rows(members_of_largest(df, "g"), "v") == [(1,), (2,)]


def test_segment_genres(spark):
    users = spark.createDataFrame([(1,), (2,), (3,)], "id INT")
    movies = spark.createDataFrame(
        [(10, "t", "A|B"), (11, "t", "B|B"), (12, "t", None), (13, "t", ""), (14, "t", "Z")],
        "movieId INT, title STRING, genres STRING",
    )
    rated = spark.createDataFrame(
        [(1, 10, 4.0), (1, 11, 5.0), (2, 10, 3.5), (2, 12, 5.0), (3, 13, 4.0), (9, 14, 5.0),
         (1, 10, 4.0), (2, 99, 5.0)],
        "userId INT, movieId INT, rating DOUBLE",
    )
    assert rows(segment_genres(users, rated, movies)) == [(1, "B", 4), (2, "A", 2), (3, "", 1)]
    assert rows(segment_genres(users, rated, movies, min_rating=3, k=1)) == [(1, "B", 5)]
    only_null = users.where("id = 2")
    assert rows(segment_genres(only_null, rated, movies)) == []


def test_segment_spread_adds_up_to_the_cost(spark):
    points = [(i, [float(i % 5) * 10 + (i * 31 % 7) / 7, float(i % 3) + (i * 17 % 5) / 5]) for i in range(200)]
    points += [(1000 + i, [500.0, 500.0]) for i in range(50)]
    df = spark.createDataFrame(points, "id INT, features ARRAY<DOUBLE>").repartition(5)
    settled = fit_segments(df, k=6, seed=1, max_iter=300)
    spread = segment_spread(settled, assign_segments(settled, df)).collect()
    members = {}
    for r in assign_segments(settled, df).collect():
        members.setdefault(r["prediction"], []).append(r["features"])
    assert {r["prediction"]: r["count"] for r in spread} == {k: len(v) for k, v in members.items()}
    for r in spread:
        own = members[r["prediction"]]
        mean = [sum(x) / len(own) for x in zip(*own)]
        assert r["within"] == pytest.approx(sum((a - b) ** 2 for v in own for a, b in zip(v, mean)), abs=1e-6)
        assert r["drift"] < 1e-6
    assert sum(r["within"] for r in spread) == pytest.approx(settled.summary.trainingCost, rel=1e-6)

    # Centres fitted on other points are not the means, and drift says by how much.
    other = fit_segments(df.where("id < 100"), k=6, seed=1, max_iter=1)
    assigned = assign_segments(other, df)
    parts = segment_spread(other, assigned).collect()
    centres = other.clusterCenters()
    direct = sum(
        sum((a - b) ** 2 for a, b in zip(r["features"], centres[r["prediction"]])) for r in assigned.collect()
    )
    assert sum(r["within"] + r["count"] * r["drift"] for r in parts) == pytest.approx(direct, rel=1e-9)
    assert max(r["drift"] for r in parts) > 1
    assert segment_spread(other, assigned.where("false")).collect() == []


def test_k_means_keeps_the_points_itself(spark, monkeypatch):
    """Of a persisted table it would decode every row in every iteration."""
    data = [(i, [float(i % 5), float(i % 3)]) for i in range(200)]
    factors = spark.createDataFrame(data, "id INT, features ARRAY<FLOAT>")
    plain, seen = KMeans.fit, []
    monkeypatch.setattr(KMeans, "fit", lambda self, df: (seen.append(df.storageLevel.useMemory), plain(self, df))[1])
    assert len(fit_segments(factors, k=15, seed=1).clusterCenters()) == 15
    assert seen == [False]
