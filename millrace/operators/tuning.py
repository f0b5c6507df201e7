"""Parameter grids and cross-validated model selection."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.ml import Estimator
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import hash_bucket
from millrace.sources.scratch import ensure_checkpoint_dir, persisted

# The searched settings of the three classifiers.
FOREST_GRID = {
    "maxDepth": [1, 5, 10],
    "numTrees": [1, 5, 10],
    "featureSubsetStrategy": ["all", "sqrt", "log2"],
}
GBT_GRID = {"maxDepth": [1, 5, 10], "maxIter": [3, 5, 10], "maxBins": [5, 10, 20]}
MLP_HIDDEN = [[20, 5], [40, 10], [40, 20], [80, 20], [80, 40, 20]]
MLP_ITERATIONS = [20, 50, 100]


def mlp_grid(inputs: int, classes: int = 2) -> dict[str, list]:
    """Layer sizes by iterations; step size is left out, as L-BFGS does not use it."""
    layers = [[inputs, *hidden, classes] for hidden in MLP_HIDDEN]
    return {"layers": layers, "maxIter": MLP_ITERATIONS}


def param_grid(
    estimator: Estimator, values: Mapping[str, Sequence[Any]]
) -> list[dict[Param, Any]]:
    """Every combination of the given values of the estimator's parameters."""
    builder = ParamGridBuilder()
    for name, options in values.items():
        builder = builder.addGrid(estimator.getParam(name), list(options))
    return builder.build()


def with_folds(
    df: DataFrame, key: str | Sequence[str], folds: int, seed: int = 42, out: str = "fold"
) -> DataFrame:
    """Add the fold (0 to ``folds - 1``) of each row, by a hash of its ``key``.

    It depends on the key and the seed only, so it is the same after a lost executor and in any
    partitioning. Rows with equal keys share a fold: with the id of a user or a household as key, no
    group has rows on both sides.
    """
    return df.withColumn(out, F.floor(hash_bucket(key, seed) * folds).cast("int"))


def cross_validate(
    train: DataFrame,
    estimator: Estimator,
    grid: Sequence[dict[Param, Any]],
    evaluator: Evaluator,
    key: str | Sequence[str],
    folds: int = 5,
    seed: int = 42,
    parallelism: int = 4,
) -> tuple[CrossValidatorModel, DataFrame]:
    """The best model refitted on all of ``train``, and the table params, metric, spread, best.

    The metric is the mean over the folds of :func:`with_folds` and the spread their standard deviation.
    ``train`` should hold the features assembled already. It is persisted for the
    search, and the fits of one fold run ``parallelism`` at a time.
    """
    train = with_folds(train, key, folds, seed, out="_fold")
    ensure_checkpoint_dir(train.sparkSession)
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=list(grid),
        evaluator=evaluator,
        numFolds=folds,
        foldCol="_fold",
        parallelism=parallelism,
        collectSubModels=False,
    )
    with persisted(train) as train:
        model = search.fit(train)
    pick = max if evaluator.isLargerBetter() else min
    best = model.avgMetrics.index(pick(model.avgMetrics))
    rows = [
        (json.dumps({p.name: v for p, v in point.items()}), float(metric), float(spread), i == best)
        for i, (point, metric, spread) in enumerate(zip(grid, model.avgMetrics, model.stdMetrics))
    ]
    schema = "params STRING, metric DOUBLE, spread DOUBLE, best BOOLEAN"
    table = train.sparkSession.createDataFrame(rows, schema)
    return model, table
