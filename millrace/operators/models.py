"""Estimators with their usual settings, and reports on fitted models."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    GeneralizedLinearRegression,
    GeneralizedLinearRegressionModel,
    LinearRegression,
)
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.features import assembler
from millrace.sources.scratch import ensure_checkpoint_dir


def random_forest(
    label: str,
    features: str = "features",
    max_depth: int = 10,
    trees: int = 10,
    feature_subset: str = "all",
    bootstrap: bool = True,
    seed: int = 42,
) -> RandomForestClassifier:
    """A forest whose trees see rows drawn with replacement, or all rows without ``bootstrap``."""
    return RandomForestClassifier(
        labelCol=label,
        featuresCol=features,
        maxDepth=max_depth,
        numTrees=trees,
        featureSubsetStrategy=feature_subset,
        bootstrap=bootstrap,
        seed=seed,
    )


def gbt(
    label: str,
    features: str = "features",
    max_depth: int = 5,
    max_iter: int = 10,
    max_bins: int = 20,
    step: float = 0.1,
    prediction: str = "prediction",
    seed: int = 42,
) -> GBTClassifier:
    return GBTClassifier(
        labelCol=label,
        featuresCol=features,
        predictionCol=prediction,
        maxDepth=max_depth,
        maxIter=max_iter,
        maxBins=max_bins,
        stepSize=step,
        seed=seed,
    )


def mlp(
    label: str,
    inputs: int,
    hidden: Sequence[int] = (40, 20),
    classes: int = 2,
    features: str = "features",
    max_iter: int = 50,
    seed: int = 42,
) -> MultilayerPerceptronClassifier:
    """A perceptron with ``inputs`` features; solved by L-BFGS, which has no step size."""
    return MultilayerPerceptronClassifier(
        labelCol=label,
        featuresCol=features,
        layers=[inputs, *hidden, classes],
        maxIter=max_iter,
        seed=seed,
    )


def standardised(estimator: Estimator) -> Pipeline:
    """The estimator after a stage that gives each feature mean 0 and deviation 1.

    Mean and deviation are those of the rows that it is fitted on. A perceptron needs it: with features of
    very different size its solver does not find its way.
    """
    features = estimator.getFeaturesCol()
    scaler = StandardScaler(inputCol=features, outputCol=f"{features}_scaled", withMean=True, withStd=True)
    return Pipeline(stages=[scaler, estimator.copy().setFeaturesCol(f"{features}_scaled")])


def linear_regression(
    label: str, features: str = "features", prediction: str = "prediction"
) -> LinearRegression:
    return LinearRegression(labelCol=label, featuresCol=features, predictionCol=prediction)


def gamma_regression(
    label: str,
    features: str = "features",
    max_iter: int = 50,
    reg: float = 0.1,
    prediction: str = "prediction",
) -> GeneralizedLinearRegression:
    """Gamma model with identity link; see :func:`require_positive`."""
    return GeneralizedLinearRegression(
        labelCol=label,
        featuresCol=features,
        predictionCol=prediction,
        family="gamma",
        link="identity",
        maxIter=max_iter,
        regParam=reg,
    )


def require_positive(df: DataFrame, label: str) -> DataFrame:
    """``df`` itself; fails if a label is zero, negative or NULL, as a Gamma model needs."""
    bad = df.agg(F.count_if(F.coalesce(F.col(label) <= 0, F.lit(True)))).first()[0]
    if bad:
        raise ValueError(f"{bad} rows have a {label} that is not positive; Gamma needs labels > 0")
    return df


def fit_gamma(
    train: DataFrame,
    label: str,
    features: str = "features",
    max_iter: int = 50,
    reg: float = 0.1,
    prediction: str = "prediction",
) -> Model:
    """Fit :func:`gamma_regression` after checking the labels."""
    model = gamma_regression(label, features, max_iter, reg, prediction)
    return model.fit(require_positive(train, label))


def gamma_score(train: DataFrame, model: GeneralizedLinearRegressionModel, label: str) -> DataFrame:
    """position (-1 for the intercept), coefficient, gradient, size: whether a Gamma fit solves its equations.

    With identity link a row pulls at its prediction m by (label - m) / m^2. ``gradient`` is the sum of
    pull times feature over the sum of 1 / m^2, less the penalty's share (the intercept has none): 0 at the
    solution. ``size`` is the same sum of absolute pulls, to compare with. Rows that pull up and down are
    two groups of one aggregate over vectors, which is summed up within tasks first, so it takes one
    pass and shuffles two vectors per task. A model without intercept has no position -1; no rows, no result.
    """
    mean = F.col(model.getPredictionCol())
    scored = model.transform(train).withColumn("_weight", 1 / (mean * mean))
    scored = scored.withColumn("_pull", (F.col(label) - mean) * F.col("_weight"))
    pull = F.abs("_pull")
    sums = Summarizer.metrics("sum").summary(F.col(model.getFeaturesCol()), pull).getField("sum")
    up_and_down = scored.groupBy((F.col("_pull") < 0).alias("down")).agg(
        F.concat(F.array(F.sum(pull)), vector_to_array(sums)).alias("pulls"), F.sum("_weight").alias("weight")
    )
    signed = F.when(F.col("down"), -F.col("pull")).otherwise(F.col("pull"))
    sides = up_and_down.select("down", "weight", F.posexplode("pulls").alias("place", "pull"))
    totals = sides.groupBy((F.col("place") - 1).alias("position")).agg(
        F.sum(signed).alias("signed"), F.sum("pull").alias("absolute"), F.sum("weight").alias("weight")
    )
    fitted = [(i, float(c)) for i, c in enumerate(model.coefficients.toArray())]
    if model.getFitIntercept():
        fitted.append((-1, float(model.intercept)))
    coefficients = train.sparkSession.createDataFrame(fitted, "position INT, coefficient DOUBLE")
    penalty = F.when(F.col("position") < 0, 0.0).otherwise(F.col("coefficient") * model.getRegParam())
    return totals.join(coefficients, "position").select(
        "position", "coefficient",
        (F.col("signed") / F.col("weight") - penalty).alias("gradient"),
        (F.col("absolute") / F.col("weight")).alias("size"),
    )


def model_pipeline(features: Sequence[str], estimator: Estimator, out: str = "features") -> Pipeline:
    """Assemble the feature columns, then the estimator."""
    return Pipeline(stages=[assembler(features, out), estimator])


def fit(estimator: Estimator, train: DataFrame) -> Model:
    """``estimator.fit`` with a checkpoint folder, so that boosted trees can cut their lineage."""
    ensure_checkpoint_dir(train.sparkSession)
    return estimator.fit(train)


def _last_stage(model: Model) -> Model:
    return model.stages[-1] if isinstance(model, PipelineModel) else model


def objective_history(model: Model) -> DataFrame:
    """iteration (from 0), objective: the training loss of the (last) model after each step of its solver."""
    summary = _last_stage(model).summary
    losses = (summary() if callable(summary) else summary).objectiveHistory
    rows = [(i, float(loss)) for i, loss in enumerate(losses)]
    return SparkSession.active().createDataFrame(rows, "iteration INT, objective DOUBLE")


def feature_importance(model: Model, names: Sequence[str], k: int | None = 3) -> DataFrame:
    """The ``k`` most important features of a tree model: feature, importance; all if None."""
    weights = _last_stage(model).featureImportances.toArray().tolist()
    if len(weights) != len(names):
        raise ValueError(f"{len(names)} names for {len(weights)} features")
    ranked = sorted(zip(names, weights), key=lambda pair: (-pair[1], pair[0]))
    spark = SparkSession.active()
    return spark.createDataFrame(ranked[:k], "feature STRING, importance DOUBLE")


def model_params(model: Model) -> DataFrame:
    """Every parameter of the (last) model, values as JSON: param, value."""
    params = _last_stage(model).extractParamMap()
    rows = sorted((p.name, json.dumps(value, default=str)) for p, value in params.items())
    return SparkSession.active().createDataFrame(rows, "param STRING, value STRING")
