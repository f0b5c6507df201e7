"""Claim queries: cleaning, features, regression, tandem model."""

from __future__ import annotations

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import (
    apply_string_index,
    binary_target,
    column_modes,
    cross_validate,
    feature_pipeline,
    fit_gamma,
    fit_string_index,
    fit_tandem,
    gamma_regression,
    gamma_score,
    gbt,
    hash_sample_by,
    hash_split,
    impute_mode,
    index_strings,
    linear_regression,
    lookup_join,
    model_pipeline,
    null_sentinel,
    one_hot,
    param_grid,
    regression_metrics,
    tandem_metrics,
)
from millrace.operators.features import assemble
from millrace.operators.tandem import AMOUNT, CLASS, TandemModel
from millrace.plans.inputs import CLAIMS_SQL, bucket_sql, claims, table
from millrace.plans.registry import query
from millrace.sources import materialise

_MODE_SQL = """(SELECT CAST({c} AS VARCHAR) FROM claims WHERE CAST({c} AS VARCHAR) <> '?'
   GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"""
_MODE_COLS = ["Blind_Make", "OrdCat", "Var1", "Var2"]


@query(
    "column_modes",
    f"WITH {CLAIMS_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {_MODE_SQL.format(c=c)} AS value""" for c in _MODE_COLS
    ),
)
def column_modes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_modes(claims(spark, sf_dir), _MODE_COLS)


@query(
    "impute_mode",
    f"""WITH {CLAIMS_SQL}
    SELECT CASE WHEN Blind_Make = '?' THEN {_MODE_SQL.format(c="Blind_Make")} ELSE Blind_Make END
             AS Blind_Make,
           count(*) AS rows, round(sum(Claim_Amount), 2) AS amount
    FROM claims GROUP BY 1""",
)
def impute_mode_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = impute_mode(claims(spark, sf_dir), ["Blind_Make", "Var1", "Var2"])
    return filled.groupBy("Blind_Make").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("Claim_Amount"), 2).alias("amount")
    )


@query(
    "sentinel_to_null",
    f"""WITH {CLAIMS_SQL}
    SELECT nullif(Blind_Make, '?') AS Blind_Make, count(*) AS rows FROM claims GROUP BY 1""",
)
def sentinel_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = null_sentinel(claims(spark, sf_dir), "?")
    return cleaned.groupBy("Blind_Make").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "binary_target_counts",
    f"""WITH {CLAIMS_SQL}
    SELECT CASE WHEN Claim_Amount = 0 THEN 0 ELSE 1 END AS claimed, count(*) AS rows,
           round(sum(Claim_Amount), 2) AS amount
    FROM claims GROUP BY 1""",
)
def binary_target_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = binary_target(claims(spark, sf_dir), "Claim_Amount", "claimed")
    return marked.groupBy("claimed").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("Claim_Amount"), 2).alias("amount")
    )


@query(
    "stratified_sample",
    f"""WITH {CLAIMS_SQL}
    SELECT Row_ID, CASE WHEN Claim_Amount = 0 THEN 0 ELSE 1 END AS claimed FROM claims
    WHERE {bucket_sql(42, "Row_ID")} < CASE WHEN Claim_Amount = 0 THEN 0.14 ELSE 1.0 END""",
)
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = binary_target(claims(spark, sf_dir), "Claim_Amount", "claimed")
    sample = hash_sample_by(marked, "Row_ID", "claimed", {0: 0.14, 1: 1.0}, seed=42)
    return sample.select("Row_ID", "claimed")


@query(
    "string_index",
    f"""WITH {CLAIMS_SQL}
    SELECT 'Blind_Make' AS "column", Blind_Make AS value, count(*) AS rows,
           CAST(row_number() OVER (ORDER BY count(*) DESC, Blind_Make) - 1 AS DOUBLE) AS "index"
    FROM claims GROUP BY Blind_Make
    UNION ALL
    SELECT 'OrdCat', OrdCat, count(*),
           CAST(row_number() OVER (ORDER BY count(*) DESC, OrdCat) - 1 AS DOUBLE)
    FROM claims GROUP BY OrdCat""",
)
def string_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["Blind_Make", "OrdCat"]
    indexed = index_strings(claims(spark, sf_dir), cols)
    cells = F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("value"), F.col(f"{c}_index").alias("index"))
        for c in cols
    ]))
    return indexed.select(cells).groupBy("column", "value", "index").agg(
        F.count(F.lit(1)).alias("rows")
    )


@query(
    "string_index_wide",
    """WITH v AS (
      SELECT c_name AS value, count(*) AS rows FROM customer GROUP BY c_name),
    i AS (SELECT *, CAST(row_number() OVER (ORDER BY rows DESC, value) - 1 AS DOUBLE) AS "index" FROM v)
    SELECT c_custkey, "index", rows FROM customer JOIN i ON c_name = value""",
)
def string_index_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index of about as many values as rows, fitted and looked up as a table."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    index = fit_string_index(rows, "c_name")
    placed = apply_string_index(rows, index, "c_name", out="index", handle_invalid="error")
    sizes = index.select(F.col("index").cast("double").alias("index"), "rows")
    return placed.join(sizes, "index").select("c_custkey", "index", "rows")


@query(
    "one_hot",
    """WITH i AS (
      SELECT p_type, row_number() OVER (ORDER BY count(*) DESC, p_type) AS pos,
             count(*) OVER () AS types
      FROM part GROUP BY p_type)
    SELECT p_partkey, CAST(types - 1 AS INTEGER) AS width,
           CASE WHEN pos < types THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS ones,
           CAST(CASE WHEN pos < types THEN pos ELSE 0 END AS BIGINT) AS position
    FROM part JOIN i USING (p_type)""",
)
def one_hot_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    encoded = one_hot(index_strings(parts, ["p_type"], handle_invalid="error"), ["p_type"])
    cells = vector_to_array("p_type_vec")
    return encoded.select(
        "p_partkey",
        F.size(cells).alias("width"),
        F.aggregate(cells, F.lit(0.0), lambda total, x: total + x).alias("ones"),
        F.array_position(cells, 1.0).alias("position"),
    )


@query(
    "assemble_features",
    f"""WITH {CLAIMS_SQL},
    makes AS (
      SELECT Blind_Make, row_number() OVER (ORDER BY count(*) DESC, Blind_Make) AS pos
      FROM claims GROUP BY Blind_Make)
    SELECT CAST(0 AS INTEGER) AS pos, CAST(sum(Var1) AS DOUBLE) AS total FROM claims
    UNION ALL SELECT 1, CAST(sum(Var2) AS DOUBLE) FROM claims
    UNION ALL SELECT CAST(pos + 1 AS INTEGER), CAST(count(*) AS DOUBLE)
      FROM claims JOIN makes USING (Blind_Make) GROUP BY pos""",
)
def assemble_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column sums of the assembled vectors; the level for unseen makes is the dropped one."""
    rows = claims(spark, sf_dir).select("Blind_Make", "Var1", "Var2")
    fitted = feature_pipeline(["Blind_Make"], ["Var1", "Var2"]).fit(rows)
    vectors = fitted.transform(rows).select(F.posexplode(vector_to_array("features")))
    return vectors.groupBy("pos").agg(F.sum("col").alias("total"))


@query(
    "regression_metrics",
    f"""WITH {CLAIMS_SQL},
    means AS (SELECT Blind_Make, avg(Claim_Amount) AS pred FROM claims GROUP BY Blind_Make),
    e AS (SELECT Claim_Amount - pred AS err FROM claims JOIN means USING (Blind_Make))
    SELECT count(*) AS rows, round(sqrt(avg(err * err)), 6) AS rmse,
           round(avg(err * err), 6) AS mse, round(avg(abs(err)), 6) AS mae FROM e""",
)
def regression_metrics_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = claims(spark, sf_dir)
    means = rows.groupBy("Blind_Make").agg(F.avg("Claim_Amount").alias("pred"), F.count("*").alias("n"))
    scored = lookup_join(rows, means, ["Blind_Make"], rows_per_key="n")
    metrics = regression_metrics(scored, "Claim_Amount", "pred")
    return metrics.select("rows", *[F.round(m, 6).alias(m) for m in ("rmse", "mse", "mae")])


_GROUP_FIT_SQL = f"""WITH {CLAIMS_SQL}
    SELECT Blind_Make, count(*) AS rows, round(sum(Claim_Amount), 2) AS fitted_total,
           TRUE AS one_prediction
    FROM claims WHERE Claim_Amount > 0 GROUP BY Blind_Make"""


def _positive_by_make(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positive claims with the make as the only feature, so a fit gives the group means."""
    rows = claims(spark, sf_dir).where("Claim_Amount > 0").select("Blind_Make", "Claim_Amount")
    return one_hot(index_strings(rows, ["Blind_Make"], handle_invalid="error"), ["Blind_Make"])


def _predicted_by_make(scored: DataFrame) -> DataFrame:
    """A make's rows share one prediction, and their sum is the sum of the amounts, in cents."""
    spread = F.max("prediction") - F.min("prediction")
    return scored.groupBy("Blind_Make").agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.sum("prediction"), 2).alias("fitted_total"),
        (spread < 1e-6).alias("one_prediction"),
    )


@query("linear_group_fit", _GROUP_FIT_SQL)
def linear_group_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _positive_by_make(spark, sf_dir)
    model = model_pipeline(["Blind_Make_vec"], linear_regression("Claim_Amount")).fit(rows)
    return _predicted_by_make(model.transform(rows))


@query(
    "cv_group_means",
    f"""WITH {CLAIMS_SQL},
    p AS (SELECT Blind_Make, Claim_Amount, CAST(floor({bucket_sql(42, "Row_ID")} * 5) AS INTEGER) AS fold
          FROM claims WHERE Claim_Amount > 0),
    s AS (SELECT Blind_Make, fold, sum(Claim_Amount) AS total, count(*) AS n FROM p GROUP BY ALL),
    m AS (SELECT a.Blind_Make, f.fold, sum(a.total) / sum(a.n) AS pred
          FROM s a, (SELECT DISTINCT fold FROM s) f WHERE a.fold <> f.fold GROUP BY ALL),
    e AS (SELECT fold, sqrt(avg((Claim_Amount - pred) * (Claim_Amount - pred))) AS rmse
          FROM p JOIN m USING (Blind_Make, fold) GROUP BY fold)
    SELECT '{{}}' AS params, round(avg(rmse), 5) AS metric, round(stddev_pop(rmse), 5) AS spread, TRUE AS best
    FROM e""",
)
def cv_group_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-validation of a regression on groups, whose fits are the groups' means in the other folds."""
    rows = claims(spark, sf_dir).where("Claim_Amount > 0").select("Row_ID", "Blind_Make", "Claim_Amount")
    rows = one_hot(index_strings(rows, ["Blind_Make"], handle_invalid="error"), ["Blind_Make"])
    linear = linear_regression("Claim_Amount")
    evaluator = RegressionEvaluator(labelCol="Claim_Amount", metricName="rmse")
    train = assemble(rows, ["Blind_Make_vec"])
    _, scores = cross_validate(train, linear, param_grid(linear, {}), evaluator, "Row_ID", folds=5, seed=42)
    return scores.select("params", *[F.round(c, 5).alias(c) for c in ("metric", "spread")], "best")


@query("gamma_group_fit", _GROUP_FIT_SQL)
def gamma_group_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = assemble(_positive_by_make(spark, sf_dir), ["Blind_Make_vec"])
    return _predicted_by_make(fit_gamma(rows, "Claim_Amount", reg=0.0).transform(rows))


def _tandem(spark: SparkSession, sf_dir: str) -> tuple[TandemModel, DataFrame, DataFrame]:
    """A fitted model, its training rows and the test rows, features assembled."""
    rows = binary_target(claims(spark, sf_dir), "Claim_Amount", "claimed")
    train, test = hash_split(rows, "Row_ID", [0.7, 0.3], seed=42)
    # Another seed: with the split's own the sample would not be independent of it.
    train = hash_sample_by(train, "Row_ID", "claimed", {0: 0.25, 1: 1.0}, seed=43)
    train = materialise(train.select("Blind_Make", "Var1", "Var2", "claimed", "Claim_Amount"))
    features = feature_pipeline(["Blind_Make"], ["Var1", "Var2"]).fit(train)
    model = fit_tandem(
        features.transform(train),
        "claimed",
        "Claim_Amount",
        classifier=gbt("claimed", prediction="_class"),
        regressor=gamma_regression("Claim_Amount", prediction="_amount"),
    )
    return model, features.transform(train), features.transform(test)


@query(
    "tandem_claims",
    f"""WITH {CLAIMS_SQL}
    SELECT count(*) AS rows, TRUE AS zero_where_class_0, TRUE AS none_negative,
           (SELECT count(DISTINCT Blind_Make) + 3 FROM claims WHERE {bucket_sql(42, "Row_ID")} < 0.7
              AND {bucket_sql(43, "Row_ID")} < CASE WHEN Claim_Amount = 0 THEN 0.25 ELSE 1.0 END) AS solved
    FROM claims WHERE {bucket_sql(42, "Row_ID")} >= 0.7""",
)
def tandem_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the parts of a scored test set fit together, and how many of the regressor's equations are solved."""
    model, train, test = _tandem(spark, sf_dir)
    score = gamma_score(train.where("claimed = 1"), model.regressor, "Claim_Amount")
    # A level of the features that no row has neither pulls nor is pulled.
    solved = score.where(F.abs("gradient") <= 1e-4 * F.col("size") + 1e-12).count()
    return model.transform(test).agg(
        F.count(F.lit(1)).alias("rows"),
        F.every((F.col(CLASS) == 1) | (F.col(AMOUNT) == 0)).alias("zero_where_class_0"),
        F.every(F.col(AMOUNT) >= 0).alias("none_negative"),
        F.lit(solved).cast("long").alias("solved"),
    )


@query(
    "tandem_metrics",
    f"""WITH {CLAIMS_SQL}
    SELECT count(*) AS amount_rows, count(*) AS class_rows, TRUE AS called_within,
           TRUE AS class_mse_is_mae, TRUE AS mse_is_rmse_squared
    FROM claims WHERE {bucket_sql(42, "Row_ID")} >= 0.7""",
)
def tandem_metrics_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the metrics of the parts of a scored test set must hang together."""
    model, _, test = _tandem(spark, sf_dir)
    metrics = tandem_metrics(model.transform(test), "claimed", "Claim_Amount")

    def of(part: str, value: str):
        return F.max(F.when(F.col("part") == part, F.col(value)))

    square = F.col("rmse") * F.col("rmse")
    return metrics.agg(
        of("amount", "rows").alias("amount_rows"),
        of("class", "rows").alias("class_rows"),
        (of("amount of predicted positives", "rows") < of("amount", "rows")).alias("called_within"),
        (F.abs(of("class", "mse") - of("class", "mae")) < 1e-9).alias("class_mse_is_mae"),
        F.every(F.abs(F.col("mse") - square) <= 1e-9 * square).alias("mse_is_rmse_squared"),
    )
