"""Classification queries on delimited number records."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from millrace.operators import (
    assemble,
    auc_by_group,
    best_splits,
    boosted_score,
    cast_by_type,
    classification_metrics,
    compare_models,
    cross_validate,
    feature_importance,
    forest_score,
    gbt,
    hard_auc_evaluator,
    hash_split,
    mlp,
    model_params,
    objective_history,
    param_grid,
    random_forest,
    root_splits,
    split_columns,
    standardised,
    tree_leaves,
    tree_nodes,
)
from millrace.operators.evaluate import auc
from millrace.operators.models import fit
from millrace.operators.tuning import FOREST_GRID, GBT_GRID, mlp_grid
from millrace.plans.inputs import bucket_sql, higgs_lines, table
from millrace.plans.registry import query
from millrace.sources.schemas import HIGGS_COLUMNS, HIGGS_FEATURES, HIGGS_LABEL

_TEST_ROWS = f"(SELECT count(*) FROM embeddings WHERE {bucket_sql(42, 'vec_id')} >= 0.7)"
_FIELD_SQL = ", ".join(
    f'CAST(CAST(embedding[{i}] AS VARCHAR) AS DOUBLE) AS "{name}"'
    for i, name in enumerate(HIGGS_FEATURES, 1)
)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parsed records: vec_id, labels and 28 numbers."""
    return cast_by_type(
        split_columns(higgs_lines(spark, sf_dir), HIGGS_COLUMNS), StringType(), "double"
    )


def assembled_split(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """70/30 train and test with vec_id, labels and features."""
    rows = assemble(records(spark, sf_dir), HIGGS_FEATURES)
    return hash_split(rows.select("vec_id", HIGGS_LABEL, "features"), "vec_id", [0.7, 0.3], seed=42)


@query(
    "parse_delimited",
    f"""SELECT vec_id, CASE WHEN label >= 5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS labels,
    {_FIELD_SQL} FROM embeddings""",
)
def parse_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir)


@query(
    "classification_metrics",
    """WITH r AS (
      SELECT count(*) AS rows, avg(CASE WHEN quality = 1 - toxic THEN 1.0 ELSE 0.0 END) AS accuracy,
             avg(CASE WHEN quality = 1 THEN (1 - toxic)::DOUBLE END) AS tpr,
             avg(CASE WHEN quality = 0 THEN toxic::DOUBLE END) AS tnr
      FROM labels)
    SELECT rows, round(accuracy, 9) AS accuracy, round(tpr, 9) AS tpr, round(tnr, 9) AS tnr,
           round((tpr + tnr) / 2, 9) AS auc_hard FROM r""",
)
def classification_metrics_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = table(spark, sf_dir, "labels").withColumn("guess", 1 - F.col("toxic"))
    metrics = classification_metrics(scored, "quality", "guess")
    return metrics.select(
        "rows", *[F.round(m, 9).alias(m) for m in ("accuracy", "tpr", "tnr", "auc_hard")]
    )


@query(
    "auc_of_score",
    """WITH s AS (SELECT CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS y,
                         round(value) AS score FROM events),
    ties AS (SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY score),
    cum AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM ties)
    SELECT round(CAST(sum(pos * (below + neg / 2.0)) AS DOUBLE) / (sum(pos) * sum(neg)), 6) AS auc
    FROM cum""",
)
def auc_of_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = table(spark, sf_dir, "events").select(
        (F.col("event_type") == "purchase").cast("double").alias("y"), F.round("value").alias("score")
    )
    return spark.createDataFrame([(round(auc(scored, "y", "score"), 6),)], "auc DOUBLE")


@query(
    "auc_by_hour",
    """WITH s AS (SELECT CAST(hour(ts) AS INTEGER) AS hour, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS y,
                         round(value) AS score FROM events),
    ties AS (SELECT hour, score, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY hour, score),
    cum AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY hour ORDER BY score
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM ties)
    SELECT hour, CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives,
           round(CAST(sum(pos * (2 * below + neg)) AS DOUBLE) / nullif(2 * sum(pos) * sum(neg), 0), 9) AS auc
    FROM cum GROUP BY hour""",
)
def auc_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = table(spark, sf_dir, "events").select(
        F.hour("ts").alias("hour"), (F.col("event_type") == "purchase").cast("int").alias("y"),
        F.round("value").alias("score"),
    )
    areas = auc_by_group(scored, "y", "score", by=["hour"])
    return areas.select("hour", "positives", "negatives", F.round("auc", 9).alias("auc"))


_LEVELS = [f"level_{i}" for i in range(len(HIGGS_FEATURES))]
_SPLITS_SQL = f"""train AS (
      SELECT CASE WHEN label >= 5 THEN 1 ELSE 0 END AS y, embedding FROM embeddings
      WHERE {bucket_sql(42, 'vec_id')} < 0.7),
    x AS (SELECT y, unnest(range({len(HIGGS_FEATURES)})) AS f, unnest(list_transform(embedding[1:{len(HIGGS_FEATURES)}],
            lambda e: CAST(round(10 * CAST(CAST(e AS VARCHAR) AS DOUBLE)) AS INTEGER))) AS v FROM train),
    cells AS (SELECT f, v, count(*) AS n, sum(y) AS p FROM x GROUP BY f, v),
    cum AS (SELECT f, (v + lead(v) OVER w) / 2.0 AS threshold, sum(n) OVER w AS l, sum(p) OVER w AS lp,
                   sum(n) OVER (PARTITION BY f) AS n, sum(p) OVER (PARTITION BY f) AS p
            FROM cells WINDOW w AS (PARTITION BY f ORDER BY v)),
    gains AS (SELECT 'level_' || f AS feature, CAST(threshold AS DOUBLE) AS threshold, CAST(l AS BIGINT) AS left_rows,
                     2 * (p / n) * (1 - p / n) - l / n * 2 * (lp / l) * (1 - lp / l)
                     - (n - l) / n * 2 * ((p - lp) / (n - l)) * (1 - (p - lp) / (n - l)) AS gain
              FROM cum WHERE threshold IS NOT NULL)"""


def _levels_split(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """70/30 train and test of the records with each number rounded to tenths: few values per feature."""
    rounded = [F.round(F.col(f) * 10).cast("int").alias(n) for f, n in zip(HIGGS_FEATURES, _LEVELS)]
    rows = records(spark, sf_dir).select("vec_id", HIGGS_LABEL, *rounded)
    return hash_split(rows, "vec_id", [0.7, 0.3], seed=42)


@query(
    "split_search",
    f"""WITH {_SPLITS_SQL}
    SELECT feature, threshold, left_rows, round(gain, 9) AS gain FROM gains
    ORDER BY gains.gain DESC, feature, threshold LIMIT 10""",
)
def split_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best first splits by histograms of all features."""
    train, _ = _levels_split(spark, sf_dir)
    best = best_splits(train, _LEVELS, HIGGS_LABEL, k=10, bins=None)
    return best.select("feature", "threshold", "left_rows", F.round("gain", 9).alias("gain"))


@query(
    "tree_root_splits",
    f"""WITH {_SPLITS_SQL}, best AS (SELECT * FROM gains ORDER BY gain DESC, feature, threshold LIMIT 1)
    SELECT 'forest' AS model, feature, threshold, round(gain, 6) AS gain FROM best
    UNION ALL SELECT 'gbt', feature, threshold, round(2 * gain, 6) FROM best""",
)
def tree_root_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first split of a fitted tree, and of the first boosted one, whose impurity is twice the Gini one."""
    train, _ = _levels_split(spark, sf_dir)
    train = assemble(train, _LEVELS).select("features", HIGGS_LABEL)
    models = {
        "forest": random_forest(HIGGS_LABEL, max_depth=5, trees=1, bootstrap=False),
        "gbt": gbt(HIGGS_LABEL, max_depth=2, max_iter=2, max_bins=32),
    }
    parts = []
    for name, estimator in models.items():
        roots = root_splits(tree_nodes(fit(estimator, train)), _LEVELS).where("tree = 0")
        parts.append(roots.select(F.lit(name).alias("model"), "feature", "threshold", F.round("gain", 6).alias("gain")))
    return reduce(DataFrame.unionByName, parts)


def _score_checks(scored: DataFrame, *more: Column) -> DataFrame:
    """rows, and whether every row has a class and probabilities that agree with it."""
    p = vector_to_array("probability")
    return scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.every(F.col("prediction").isin(0.0, 1.0)).alias("classes_ok"),
        F.every(F.abs(F.get(p, 0) + F.get(p, 1) - 1) < 1e-6).alias("probabilities_ok"),
        F.every(F.get(p, F.col("prediction").cast("int")) >= 0.5 - 1e-9).alias("class_is_likeliest"),
        *more,
    )


def _tree_checks(model, test: DataFrame, score) -> DataFrame:
    """The same, and whether the table of the model's nodes gives every row the model's score."""
    told = score(tree_leaves(test, tree_nodes(model), "vec_id"), "vec_id")
    scored = model.transform(test).join(told, "vec_id", "left")
    gap = F.abs(F.get(vector_to_array("probability"), 1) - F.col("score"))
    return _score_checks(scored, F.every(F.coalesce(gap < 1e-9, F.lit(False))).alias("same_from_nodes"))


_SCORE_SQL = f"""SELECT {_TEST_ROWS} AS rows, TRUE AS classes_ok, TRUE AS probabilities_ok,
    TRUE AS class_is_likeliest"""
_TREE_SQL = f"{_SCORE_SQL}, TRUE AS same_from_nodes"


@query("forest_scores", _TREE_SQL)
def forest_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = assembled_split(spark, sf_dir)
    return _tree_checks(fit(random_forest(HIGGS_LABEL), train), test, forest_score)


@query("gbt_scores", _TREE_SQL)
def gbt_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = assembled_split(spark, sf_dir)
    return _tree_checks(fit(gbt(HIGGS_LABEL), train), test, boosted_score)


@query("mlp_scores", f"{_SCORE_SQL}, TRUE AS objective_never_rises")
def mlp_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = assembled_split(spark, sf_dir)
    model = fit(standardised(mlp(HIGGS_LABEL, len(HIGGS_FEATURES))), train)
    before = F.lag("objective").over(Window.orderBy("iteration"))
    steps = objective_history(model).withColumn("rises", F.col("objective") > before + 1e-12)
    falls = not steps.where("rises").count() and steps.count() > 1
    return _score_checks(model.transform(test), F.lit(falls).alias("objective_never_rises"))


@query(
    "forest_importance",
    "SELECT CAST(28 AS BIGINT) AS features, 1.0::DOUBLE AS total, TRUE AS none_negative",
)
def forest_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = assembled_split(spark, sf_dir)
    model = fit(random_forest(HIGGS_LABEL, max_depth=5), train)
    return feature_importance(model, HIGGS_FEATURES, k=None).agg(
        F.count_distinct("feature").alias("features"),
        F.round(F.sum("importance"), 6).alias("total"),
        F.every(F.col("importance") >= 0).alias("none_negative"),
    )


@query(
    "model_params",
    """SELECT param, value FROM (VALUES ('featuresCol', '"features"'), ('labelCol', '"labels"'),
      ('lossType', '"logistic"'), ('maxBins', '20'), ('maxDepth', '3'), ('maxIter', '2'),
      ('seed', '42'), ('stepSize', '0.1'), ('subsamplingRate', '1.0')) AS p(param, value)""",
)
def model_params_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The settings of a fitted model; those that depend on the Spark version are left out."""
    train, _ = assembled_split(spark, sf_dir)
    params = model_params(fit(gbt(HIGGS_LABEL, max_depth=3, max_iter=2), train))
    return params.where(
        F.col("param").isin(
            "featuresCol", "labelCol", "lossType", "maxBins", "maxDepth", "maxIter", "seed",
            "stepSize", "subsamplingRate",
        )
    )


@query(
    "param_grid_sizes",
    """SELECT 'forest' AS model, CAST(27 AS BIGINT) AS points, CAST(count(*) AS BIGINT) AS records
       FROM embeddings
    UNION ALL SELECT 'gbt', 27, count(*) FROM embeddings
    UNION ALL SELECT 'mlp', 15, count(*) FROM embeddings""",
)
def param_grid_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full grids of the three classifiers over the parsed records."""
    rows = records(spark, sf_dir)
    inputs = len(HIGGS_FEATURES)
    grids = {
        "forest": param_grid(random_forest(HIGGS_LABEL), FOREST_GRID),
        "gbt": param_grid(gbt(HIGGS_LABEL), GBT_GRID),
        "mlp": param_grid(mlp(HIGGS_LABEL, inputs), mlp_grid(inputs)),
    }
    parts = [
        rows.groupBy(F.lit(name).alias("model"), F.lit(len(grid)).cast("bigint").alias("points"))
        .agg(F.count(F.lit(1)).alias("records"))
        for name, grid in grids.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "cv_table",
    """SELECT CAST(4 AS BIGINT) AS points, CAST(1 AS BIGINT) AS best, TRUE AS best_is_max,
    TRUE AS bounded""",
)
def cv_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = assembled_split(spark, sf_dir)
    forest = random_forest(HIGGS_LABEL, trees=5)
    grid = param_grid(forest, {"maxDepth": [2, 5], "featureSubsetStrategy": ["all", "sqrt"]})
    _, scores = cross_validate(train, forest, grid, hard_auc_evaluator(HIGGS_LABEL), "vec_id", folds=3)
    return scores.agg(
        F.count_distinct("params").alias("points"),
        F.count_if("best").alias("best"),
        (F.max("metric") == F.max(F.when(F.col("best"), F.col("metric")))).alias("best_is_max"),
        F.every(F.col("metric").between(0, 1)).alias("bounded"),
    )


@query(
    "model_comparison",
    """SELECT model, TRUE AS timed, TRUE AS bounded
    FROM (VALUES ('forest'), ('gbt'), ('mlp')) AS m(model)""",
)
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = assembled_split(spark, sf_dir)
    estimators = {
        "forest": random_forest(HIGGS_LABEL),
        "gbt": gbt(HIGGS_LABEL),
        "mlp": standardised(mlp(HIGGS_LABEL, len(HIGGS_FEATURES))),
    }
    table_ = compare_models(train, test, estimators, HIGGS_LABEL)
    bounded = reduce(
        lambda a, b: a & b, [F.col(m).between(0, 1) for m in ("accuracy", "auc_hard", "auc")]
    )
    return table_.select("model", (F.col("fit_seconds") > 0).alias("timed"), bounded.alias("bounded"))
