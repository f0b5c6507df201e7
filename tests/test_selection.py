"""Folds, areas by group, string indices as tables, scaled perceptrons."""

import random

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from millrace.operators import (
    apply_string_index,
    assemble,
    auc,
    auc_by_group,
    cross_validate,
    fit_string_index,
    linear_regression,
    mlp,
    objective_history,
    param_grid,
    standardised,
    with_folds,
)
from tests.helpers import rows


def test_folds_depend_on_the_key_only(spark):
    df = spark.range(3000).withColumn("user", F.col("id") % 200)
    one = rows(with_folds(df.repartition(3), "id", 4), "id", "fold")
    assert one == rows(with_folds(df.repartition(11, "user"), "id", 4), "id", "fold")
    sizes = [sum(f == k for _, f in one) for k in range(4)]
    assert sum(sizes) == 3000 and min(sizes) > 650
    assert one != rows(with_folds(df, "id", 4, seed=7), "id", "fold")
    grouped = with_folds(df, "user", 4).groupBy("user").agg(F.count_distinct("fold").alias("n"))
    assert grouped.where("n > 1").isEmpty()


def test_cross_validation_by_key(spark):
    rng = random.Random(1)
    data = [(i, rng.randrange(20), rng.random(), rng.random() * 9) for i in range(200)]
    df = spark.createDataFrame(data, "id long, user long, x double, y double")
    linear = linear_regression("y")
    found = []
    for parts in (2, 7):
        rows_ = assemble(df.repartition(parts), ["x"])
        _, table = cross_validate(rows_, linear, param_grid(linear, {"regParam": [0.0, 5.0]}),
                                  RegressionEvaluator(labelCol="y"), ["user"], folds=3)
        found.append([(r["params"], round(r["metric"], 9), round(r["spread"], 9), r["best"]) for r in table.collect()])
    assert found[0] == found[1] and sum(r[3] for r in found[0]) == 1


def plain_auc(pairs):
    pos, neg = [s for y, s in pairs if y == 1], [s for y, s in pairs if y == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_by_group(spark):
    rng = random.Random(2)
    data = [("hot", rng.randrange(2), rng.randrange(40) / 8) for _ in range(900)]
    data += [(g, rng.randrange(2), float(rng.randrange(6))) for g in "abc" for _ in range(30)]
    data += [("one", 1, 0.5), ("one", 1, 0.7), (None, 0, 1.0), (None, 1, 1.0), ("zero", 1, -0.0), ("zero", 0, 0.0)]
    odd = [("a", None, 9.0), ("b", 1, None), ("c", 2, 3.0)]
    df = spark.createDataFrame(data + odd, "g string, y int, s double").repartition(7)
    got = {r["g"]: r for r in auc_by_group(df, "y", "s", ["g"]).collect()}
    for g in {g for g, _, _ in data}:
        own = [(y, s) for h, y, s in data if h == g]
        want = plain_auc(own)
        assert got[g]["auc"] == (want if want is None else pytest.approx(want))
        assert (got[g]["positives"], got[g]["negatives"]) == (sum(y for y, _ in own), sum(1 - y for y, _ in own))
    # MLlib takes -0.0 and 0.0 for two scores.
    known = df.where("y < 2 AND s IS NOT NULL AND g <> 'zero'").withColumn("y", F.col("y").cast("double"))
    assert auc_by_group(known, "y", "s").first()["auc"] == pytest.approx(auc(known, "y", "s"))
    assert auc_by_group(df.where("false"), "y", "s", ["g"]).collect() == []


def test_string_index_is_a_ranking(spark):
    rng = random.Random(3)
    values = [f"v{i}" for i in range(700)] + [rng.choice("abcde") for _ in range(300)] + ["", "é", None, None]
    df = spark.createDataFrame(list(enumerate(values)), "id long, s string").repartition(6)
    index = fit_string_index(df, "s")
    counts = {v: values.count(v) for v in set(values) if v is not None}
    want = sorted(counts, key=lambda v: (-counts[v], v.encode()))
    assert rows(index) == sorted([(v, i, counts[v]) for i, v in enumerate(want)], key=repr)
    placed = dict(rows(apply_string_index(df, index, "s"), "id", "s_index"))
    assert placed == {i: float(len(want) if v is None else want.index(v)) for i, v in enumerate(values)}
    new = spark.createDataFrame([(1, "v3", 9), (2, "unseen", 9), (3, None, 9)], "id long, s string, value int")
    for how, unknown in (("keep", float(len(want))), ("null", None)):
        got = dict(rows(apply_string_index(new, index, "s", handle_invalid=how), "id", "s_index"))
        assert got == {1: float(want.index("v3")), 2: unknown, 3: unknown}
    assert rows(apply_string_index(new, index, "s", "at", "skip"), "id", "at", "value") == [(1, float(want.index("v3")), 9)]
    with pytest.raises(ValueError, match="without an index"):
        apply_string_index(new, index, "s", handle_invalid="error")
    none = fit_string_index(df.where("false"), "s")
    assert none.collect() == [] and rows(apply_string_index(new, none, "s"), "s_index") == [(0.0,)] * 3


def test_a_scaled_perceptron_learns(spark):
    rng = random.Random(5)
    data = [(rng.random() * 1e6, rng.random() * 1e-6) for _ in range(400)]
    df = spark.createDataFrame([(a, b, float(a / 1e6 > b * 1e6)) for a, b in data], "a double, b double, y double")
    train = assemble(df, ["a", "b"])
    model = standardised(mlp("y", 2, hidden=(5,), max_iter=40)).fit(train)
    right = model.transform(train).agg(F.avg((F.col("prediction") == F.col("y")).cast("int"))).first()[0]
    losses = [r["objective"] for r in objective_history(model).orderBy("iteration").collect()]
    assert right > 0.95 and all(b <= a + 1e-12 for a, b in zip(losses, losses[1:])) and losses[-1] < losses[0] / 2
