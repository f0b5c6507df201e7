"""Trees as tables: splits against all splits in plain Python, scores against the model's."""

import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.operators import (
    assemble,
    best_splits,
    boosted_score,
    forest_score,
    gbt,
    model_pipeline,
    random_forest,
    root_splits,
    split_gains,
    tree_leaves,
    tree_nodes,
)
from millrace.operators.models import fit


def gini(ys):
    share = sum(ys) / len(ys)
    return 2 * share * (1 - share)


def plain_gains(data, at):
    """(threshold, left rows, left positives) -> gain of every split on column ``at``."""
    known = [(r[at], r[0]) for r in data if r[at] is not None]
    values, out = sorted({v for v, _ in known}), {}
    for low, high in zip(values, values[1:]):
        left, right = [y for v, y in known if v <= low], [y for v, y in known if v > low]
        whole = gini([y for _, y in known])
        gain = whole - (len(left) * gini(left) + len(right) * gini(right)) / len(known)
        out[(low + high) / 2, len(left), sum(left)] = gain
    return out


@pytest.fixture(scope="module")
def data():
    rng = random.Random(4)
    rows = []
    for _ in range(400):
        a, b = rng.randrange(9), rng.randrange(-4, 5)
        rows.append((int(a + rng.random() * 6 > 7), a, b if rng.random() < 0.95 else None, rng.random()))
    return rows


@pytest.fixture(scope="module")
def table(spark, data):
    rows = [(i, *r) for i, r in enumerate(data)]
    return spark.createDataFrame(rows, "id long, y int, a int, b int, c double").repartition(5).cache()


def test_every_split(table, data):
    got = split_gains(table, ["a", "b"], "y", bins=None).collect()
    for at, name in ((1, "a"), (2, "b")):
        found = {(r["threshold"], r["left_rows"], r["left_positives"]): r["gain"] for r in got if r["feature"] == name}
        assert found == pytest.approx(plain_gains(data, at))


def test_bins_bound_the_histogram(table, data):
    gains = split_gains(table, ["a", "c"], "y", bins=16)
    sizes = dict(gains.groupBy("feature").count().collect())
    assert sizes["a"] == 8 and sizes["c"] == 15
    whole = plain_gains(data, 3)
    for r in gains.where("feature = 'c'").collect():
        assert whole[r["threshold"], r["left_rows"], r["left_positives"]] == pytest.approx(r["gain"])
    # The cuts are about even, so the best one is about as good as the best of all.
    best = best_splits(table, ["c"], "y", bins=16).first()
    assert best["gain"] >= 0.3 * max(whole.values())


def test_no_split(spark, table):
    assert split_gains(table.where("id < 0"), ["a"], "y").collect() == []
    assert split_gains(table.withColumn("a", F.lit(1)), ["a"], "y", bins=None).collect() == []
    zeros = spark.createDataFrame([(1, -0.0), (0, 0.0), (1, None)], "y int, x double")
    assert split_gains(zeros, ["x"], "y", bins=None).collect() == []


def test_roots_are_the_best_splits(table):
    rows = assemble(table.fillna(0), ["a", "b"])
    best = best_splits(table.fillna(0), ["a", "b"], "y", bins=None).first()
    for model, factor in ((random_forest("y", max_depth=3, trees=1, bootstrap=False), 1), (gbt("y", max_depth=2, max_iter=1), 2)):
        root = root_splits(tree_nodes(fit(model, rows)), ["a", "b"]).first()
        assert (root["feature"], root["threshold"]) == (best["feature"], best["threshold"])
        assert root["gain"] == pytest.approx(factor * best["gain"])


def test_scores_from_the_table(table):
    rows = assemble(table.fillna(0), ["a", "b", "c"])
    for estimator, score in ((random_forest("y", max_depth=6, trees=5), forest_score), (gbt("y", max_iter=4), boosted_score)):
        model = fit(estimator, rows)
        leaves = tree_leaves(rows, tree_nodes(model), "id")
        both = model.transform(rows).join(score(leaves, "id"), "id")
        gap = F.abs(F.get(vector_to_array("probability"), 1) - F.col("score"))
        assert both.agg(F.count("*"), F.max(gap) < 1e-9).first() == (400, True)


def test_pipelines_and_categories(spark, table):
    model = model_pipeline(["a"], random_forest("y", max_depth=2, trees=2)).fit(table)
    assert tree_nodes(model).agg(F.count_distinct("tree")).first()[0] == 2
    nodes = spark.createDataFrame(
        [(0, 1.0, 0, 1, 2, 0, None, [1.0, 3.0], 0.0, [1.0, 1.0]), (0, 1.0, 1, -1, -1, None, None, None, 0.0, [3.0, 1.0]),
         (0, 1.0, 2, -1, -1, None, None, None, 1.0, [0.0, 2.0])],
        "tree int, weight double, node int, left int, right int, feature int, threshold double, "
        "categories array<double>, prediction double, stats array<double>",
    )
    rows = spark.createDataFrame([(i, [float(i)]) for i in range(4)], "id int, features array<double>")
    leaves = tree_leaves(rows, nodes, "id")
    assert dict(leaves.select("id", "leaf").collect()) == {0: 2, 1: 1, 2: 2, 3: 1}
    assert dict(forest_score(leaves, "id").collect()) == {0: 1.0, 1: 0.25, 2: 1.0, 3: 0.25}
