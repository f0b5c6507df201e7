import json

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.operators import (
    assemble,
    auc,
    classification_metrics,
    compare_models,
    cross_validate,
    feature_importance,
    feature_names,
    feature_pipeline,
    fit_gamma,
    fit_tandem,
    gamma_regression,
    gamma_score,
    gbt,
    hard_auc_evaluator,
    index_strings,
    linear_regression,
    mlp,
    model_params,
    model_pipeline,
    one_hot,
    param_grid,
    random_forest,
    regression_metrics,
    tandem_metrics,
)
from millrace.operators.models import fit
from millrace.operators.tuning import FOREST_GRID, GBT_GRID, mlp_grid
from tests.helpers import rows


@pytest.fixture(scope="module")
def points(spark):
    """Two numbers; the label is 1 where the first is above the second, with 10 % noise."""
    noise = F.pmod(F.xxhash64("id"), F.lit(10)) == 0
    a, b = F.pmod(F.xxhash64(F.col("id") * 3), F.lit(1000)), F.pmod(F.xxhash64(F.col("id") * 5), F.lit(1000))
    df = spark.range(600).select("id", a.cast("double").alias("a"), b.cast("double").alias("b"))
    label = ((F.col("a") > F.col("b")) != noise).cast("double")
    return assemble(df.withColumn("y", label), ["a", "b"]).cache()


def test_index_and_one_hot(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), ("a",), (None,)], "s STRING")
    indexed = index_strings(df, ["s"])
    assert dict(rows(indexed.where("s IS NOT NULL").distinct())) == {"a": 0.0, "b": 1.0, "c": 2.0}
    encoded = one_hot(indexed, ["s"]).select("s", vector_to_array("s_vec").alias("v")).distinct()
    assert dict(rows(encoded)) == {
        None: [0.0, 0.0, 0.0], "a": [1.0, 0.0, 0.0], "b": [0.0, 1.0, 0.0], "c": [0.0, 0.0, 1.0]
    }
    kept = one_hot(indexed, ["s"], drop_last=False)
    assert kept.select(F.size(vector_to_array("s_vec"))).first()[0] == 4


def test_feature_pipeline_takes_unseen_values(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "s STRING, x DOUBLE")
    test = spark.createDataFrame([("z", 3.0)], "s STRING, x DOUBLE")
    fitted = feature_pipeline(["s"], ["x"]).fit(train)
    out = fitted.transform(test)
    assert out.select(vector_to_array("features")).first()[0] == [3.0, 0.0, 0.0]
    assert feature_names(out) == ["x", "s_vec_a", "s_vec_b"]


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (5.0, 3.0), (None, 1.0)], "y DOUBLE, p DOUBLE")
    m = regression_metrics(df, "y", "p").first()
    assert (m["rows"], m["mse"], m["mae"]) == (2, 2.5, 1.5)
    assert m["rmse"] == pytest.approx(2.5**0.5)


def test_mse_of_hard_classes_is_the_error_rate(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (0, 0), (1, 1)], "y INT, p INT")
    m, c = regression_metrics(df, "y", "p").first(), classification_metrics(df, "y", "p").first()
    assert m["mse"] == m["mae"] == 1 - c["accuracy"] == 0.25
    assert c["auc_hard"] == 0.75


def test_one_class_has_no_rate(spark):
    df = spark.createDataFrame([(1, 1), (1, 0)], "y INT, p INT")
    c = classification_metrics(df, "y", "p").first()
    assert (c["accuracy"], c["tpr"], c["tnr"], c["auc_hard"]) == (0.5, 0.5, None, None)
    empty = classification_metrics(df.limit(0), "y", "p").first()
    assert empty["rows"] == 0 and empty["accuracy"] is None


def test_hard_auc_equals_the_evaluator(points):
    scored = points.withColumn("prediction", (F.col("a") > 400).cast("double"))
    ours = classification_metrics(scored, "y", "prediction").first()["auc_hard"]
    assert ours == pytest.approx(hard_auc_evaluator("y").evaluate(scored))
    assert auc(scored, "y", "prediction") == pytest.approx(ours)


def test_linear_and_gamma_fit_group_means(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 3.0), ("b", 10.0), ("b", 20.0), ("c", 7.0)], "s STRING, y DOUBLE"
    )
    train = assemble(one_hot(index_strings(df, ["s"], "error"), ["s"]), ["s_vec"])
    for model in (linear_regression("y").fit(train), fit_gamma(train, "y", reg=0.0)):
        got = dict(rows(model.transform(train).groupBy("s").agg(F.avg("prediction"))))
        assert got == pytest.approx({"a": 2.0, "b": 15.0, "c": 7.0}, rel=1e-4)


@pytest.mark.parametrize("bad", [0.0, -1.0, None])
def test_gamma_rejects_labels_that_are_not_positive(spark, bad):
    train = assemble(spark.createDataFrame([(1.0, 2.0), (1.0, bad)], "x DOUBLE, y DOUBLE"), ["x"])
    with pytest.raises(ValueError, match="1 rows have a y that is not positive"):
        fit_gamma(train, "y")


def test_compare_models_and_reports(points):
    train, test = points.where("id % 4 > 0"), points.where("id % 4 = 0")
    estimators = {
        "forest": random_forest("y", max_depth=5),
        "gbt": gbt("y", max_depth=3, max_iter=3),
        "mlp": mlp("y", 2, hidden=(4,), max_iter=10),
    }
    table = {r["model"]: r for r in compare_models(train, test, estimators, "y").collect()}
    assert set(table) == set(estimators)
    assert table["forest"]["accuracy"] > 0.75 and table["gbt"]["auc"] > 0.75
    assert all(r["fit_seconds"] > 0 for r in table.values())

    model = model_pipeline(["a", "b"], random_forest("y", max_depth=3, trees=3)).fit(
        train.drop("features")
    )
    importance = feature_importance(model, ["a", "b"])
    assert importance.agg(F.sum("importance")).first()[0] == pytest.approx(1)
    assert [r["importance"] for r in importance.collect()] == sorted(
        [r["importance"] for r in importance.collect()], reverse=True
    )
    with pytest.raises(ValueError):
        feature_importance(model, ["a"])
    params = dict(rows(model_params(model)))
    assert json.loads(params["maxDepth"]) == 3 and json.loads(params["labelCol"]) == "y"


def test_grid_sizes():
    assert len(param_grid(random_forest("y"), FOREST_GRID)) == 27
    assert len(param_grid(gbt("y"), GBT_GRID)) == 27
    grid = param_grid(mlp("y", 28), mlp_grid(28))
    assert len(grid) == 15
    assert all(value[0] == 28 for point in grid for p, value in point.items() if p.name == "layers")


def test_cross_validation_picks_the_best(points):
    tree = random_forest("y", trees=2)
    grid = param_grid(tree, {"maxDepth": [1, 6]})
    model, table = cross_validate(points, tree, grid, hard_auc_evaluator("y"), "id", folds=2)
    by_depth = {json.loads(r["params"])["maxDepth"]: r for r in table.collect()}
    assert set(by_depth) == {1, 6}
    assert by_depth[6]["best"] and not by_depth[1]["best"]
    assert by_depth[6]["metric"] > by_depth[1]["metric"]
    assert model.bestModel.getMaxDepth() == 6


def test_tandem(spark, points):
    df = points.withColumn("amount", F.when(F.col("y") == 1, F.col("a") + 1).otherwise(0.0))
    model = fit_tandem(
        df, "y", "amount", classifier=gbt("y", max_depth=3, max_iter=3, prediction="_class"),
        regressor=gamma_regression("amount", prediction="_amount"),
    )
    scored = model.transform(df)
    assert scored.columns == [*df.columns, "class_predicted", "amount_predicted"]
    assert scored.where("class_predicted = 0 AND amount_predicted <> 0").isEmpty()
    assert scored.where("amount_predicted < 0").isEmpty()
    table = {r["part"]: r for r in tandem_metrics(scored, "y", "amount").collect()}
    called = scored.where("class_predicted = 1").count()
    assert table["amount of predicted positives"]["rows"] == called < 600
    assert table["amount"]["rows"] == table["class"]["rows"] == 600
    assert table["class"]["mse"] == table["class"]["mae"]
    with pytest.raises(ValueError):
        fit_tandem(df.withColumn("amount", F.lit(0.0)), "y", "amount")


def test_fit_sets_a_checkpoint_folder(spark, points):
    fit(random_forest("y", max_depth=1, trees=1), points)
    assert spark.sparkContext.getCheckpointDir() is not None


def test_gamma_score_tells_a_solution_from_another(spark):
    data = [(float(i % 7), float(i % 3 == 0), 20.0 + 3 * (i % 7) + 5 * (i % 3 == 0) + (i * 37 % 11)) for i in range(300)]
    df = assemble(spark.createDataFrame(data, "a double, b double, y double"), ["a", "b"])
    model = fit_gamma(df, "y", reg=0.1)
    found = {r["position"]: r for r in gamma_score(df, model, "y").collect()}
    assert set(found) == {-1, 0, 1}
    assert all(abs(r["gradient"]) < 1e-6 * r["size"] for r in found.values())
    # On other rows the same coefficients solve nothing, and each number is the plain sum.
    part = df.where("b = 1")
    scored = model.transform(part).select("a", "b", "y", "prediction").collect()
    weight = sum(1 / r["prediction"] ** 2 for r in scored)
    for row in gamma_score(part, model, "y").collect():
        name = {-1: None, 0: "a", 1: "b"}[row["position"]]
        pulls = [(r["y"] - r["prediction"]) / r["prediction"] ** 2 * (r[name] if name else 1) for r in scored]
        penalty = 0.1 * row["coefficient"] if name else 0
        assert row["gradient"] == pytest.approx(sum(pulls) / weight - penalty, rel=1e-9, abs=1e-12)
        assert row["size"] == pytest.approx(sum(map(abs, pulls)) / weight, rel=1e-9)
    assert any(abs(r["gradient"]) > 1e-3 * r["size"] for r in gamma_score(part, model, "y").collect())
    assert gamma_score(df.where("false"), model, "y").count() == 0
