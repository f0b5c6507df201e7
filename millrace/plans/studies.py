"""The four whole programs, each from raw input to a set of result tables."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from millrace.operators import (
    assemble,
    assign_segments,
    binary_target,
    cast_by_type,
    cast_columns,
    count_by_suffix,
    cross_validate,
    feature_importance,
    feature_pipeline,
    fill_modes,
    fit_als,
    fit_and_score,
    fit_cells,
    fit_modes,
    fit_segments,
    fit_tandem,
    gbt,
    hard_auc_evaluator,
    hash_sample,
    hash_sample_by,
    hash_split,
    largest_segments,
    linear_regression,
    log_time_parts,
    members_of_largest,
    mlp,
    model_params,
    param_grid,
    parse_access_log,
    random_forest,
    regression_metrics,
    segment_genres,
    split_columns,
    tandem_metrics,
    time_splits,
    top_domain_activity,
    top_domains,
    topk_with_others,
    user_factors,
    with_region,
)
from millrace.operators.recommend import ALS_SETTINGS, TRAIN_FRACTIONS
from millrace.operators.tuning import FOREST_GRID, GBT_GRID, mlp_grid
from millrace.operators.weblog import REGIONS
from millrace.sources import materialise
from millrace.sources.schemas import (
    CLAIM_AMOUNT,
    CLAIM_CATEGORICAL,
    CLAIM_IDS,
    CLAIM_NUMERIC,
    CLAIM_UNUSED,
    HIGGS_COLUMNS,
    HIGGS_FEATURES,
    HIGGS_LABEL,
)

Tables = dict[str, DataFrame]


def _stacked(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def access_log_study(
    lines: DataFrame, regions: Mapping[str, tuple[str, int]] = REGIONS, k: int = 9
) -> Tables:
    """Requests per region, top domains, their shares, and the busiest domains' activity.

    The lines are parsed once into a table; each result reads the columns it needs.
    """
    parsed = materialise(log_time_parts(parse_access_log(lines)))
    regional = with_region(parsed.select("host"), regions)
    suffixes = {label: suffix for label, (suffix, _) in regions.items()}
    return {
        "requests": count_by_suffix(parsed, "host", suffixes),
        "top_domains": top_domains(parsed, regions, k),
        "domain_shares": topk_with_others(regional, "domain", k, by=["region"]),
        "activity": top_domain_activity(parsed, regions),
    }


def rating_study(
    ratings: DataFrame,
    movies: DataFrame,
    fractions: Sequence[float] = TRAIN_FRACTIONS,
    settings: Mapping[str, Mapping] = ALS_SETTINGS,
    segments: int = 20,
    ts: str = "timestamp",
    seed: int = 42,
) -> Tables:
    """Errors of every setting and split; the largest user segments and what they like.

    Segments come from the factors of the first setting, fitted on each side of a split
    by itself, and are matched with the ratings of that side.
    """
    # Landed once: every split, fit and lookup below reads this table.
    splits = time_splits(materialise(ratings), ts, fractions)
    models, metrics = fit_cells(splits, settings, seed)
    first = next(iter(settings))
    largest, genres = [], []
    for split, (train, test) in splits.items():
        sides = {
            "train": (train, models[split, first]),
            "test": (test, fit_als(test, seed=seed, **settings[first])),
        }
        for side, (rows, model) in sides.items():
            name = [F.lit(split).alias("split"), F.lit(side).alias("side")]
            factors = user_factors(model)
            assigned = assign_segments(fit_segments(factors, segments, seed), factors)
            largest.append(largest_segments(assigned).select(*name, "*"))
            members = members_of_largest(assigned, "prediction")
            genres.append(segment_genres(members, rows, movies).select(*name, "*"))
    return {"metrics": metrics, "segments": _stacked(largest), "genres": _stacked(genres)}


def collision_study(
    lines: DataFrame,
    sample: float = 0.01,
    folds: int = 5,
    grids: Mapping[str, Mapping] | None = None,
    seed: int = 42,
) -> Tables:
    """Search settings on a sample, then fit the best ones on all records and compare.

    ``grids`` replaces the searched values per model (``forest``, ``gbt``, ``mlp``). The
    records are identified by a hash of their line, so copies stay on one side.
    """
    inputs = len(HIGGS_FEATURES)
    estimators = {
        "forest": random_forest(HIGGS_LABEL, seed=seed),
        "gbt": gbt(HIGGS_LABEL, seed=seed),
        "mlp": mlp(HIGGS_LABEL, inputs, seed=seed),
    }
    grids = grids or {"forest": FOREST_GRID, "gbt": GBT_GRID, "mlp": mlp_grid(inputs)}
    keyed = lines.select("value", F.xxhash64("value").alias("line_id"))
    records = cast_by_type(split_columns(keyed, HIGGS_COLUMNS), StringType(), "double")
    # Parsed once: every search and fit below reads the vectors from this table.
    records = materialise(assemble(records, HIGGS_FEATURES).select("line_id", HIGGS_LABEL, "features"))
    train, test = hash_split(records, "line_id", [0.7, 0.3], seed)
    small_train = hash_sample(train, "line_id", sample, seed + 1)

    searches, best = [], {}
    for name, values in grids.items():
        grid = param_grid(estimators[name], values)
        evaluator = hard_auc_evaluator(HIGGS_LABEL)
        model, table = cross_validate(small_train, estimators[name], grid, evaluator, "line_id", folds, seed)
        best[name] = estimators[name].copy(grid[model.avgMetrics.index(max(model.avgMetrics))])
        searches.append(table.select(F.lit(name).alias("model"), "*"))
    models, comparison = fit_and_score(train, test, best, HIGGS_LABEL)
    return {
        "search": _stacked(searches),
        "comparison": comparison,
        "importance": _stacked([
            feature_importance(m, HIGGS_FEATURES, k=None).select(F.lit(name).alias("model"), "*")
            for name, m in models.items()
            if hasattr(m, "featureImportances")
        ]),
        "params": _stacked([
            model_params(m).select(F.lit(name).alias("model"), "*") for name, m in models.items()
        ]),
    }


def clean_claims(claims: DataFrame) -> DataFrame:
    """Drop the unused columns, cast the numeric ones, keep ``Row_ID`` as the record's key."""
    numeric = {c: "double" for c in [*CLAIM_NUMERIC, CLAIM_AMOUNT] if c in claims.columns}
    unused = [*(c for c in CLAIM_IDS if c != "Row_ID"), *CLAIM_UNUSED]
    return cast_columns(claims.drop(*unused), numeric)


def claim_study(
    claims: DataFrame,
    keep_unclaimed: float = 0.14,
    max_depth: int = 10,
    max_iter: int = 50,
    count_missing: bool = False,
    seed: int = 42,
) -> Tables:
    """Linear regression against a classifier and Gamma regressor in tandem.

    Modes, categories and models are fitted on the training rows only, in which the rows
    without a claim are thinned to ``keep_unclaimed``; the test rows keep their balance.
    """
    rows = binary_target(clean_claims(claims), CLAIM_AMOUNT, "claimed")
    categorical = [c for c in CLAIM_CATEGORICAL if c in rows.columns]
    numeric = [c for c in CLAIM_NUMERIC if c in rows.columns]
    train, test = hash_split(rows, "Row_ID", [0.7, 0.3], seed)
    # Another seed: with the split's own the sample would not be independent of it.
    train = hash_sample_by(train, "Row_ID", "claimed", {0: keep_unclaimed, 1: 1.0}, seed + 1)
    modes = fit_modes(train, [*categorical, *numeric], count_missing)
    train, test = fill_modes(train, modes), fill_modes(test, modes)
    features = feature_pipeline(categorical, numeric).fit(train)
    columns = ["features", "claimed", CLAIM_AMOUNT]
    train = materialise(features.transform(train).select(*columns))
    test = materialise(features.transform(test).select(*columns))

    start = time.perf_counter()
    linear = linear_regression(CLAIM_AMOUNT).fit(train)
    linear_seconds = time.perf_counter() - start
    start = time.perf_counter()
    classifier = gbt("claimed", max_depth=max_depth, max_iter=max_iter, prediction="_class", seed=seed)
    tandem = fit_tandem(train, "claimed", CLAIM_AMOUNT, classifier)
    tandem_seconds = time.perf_counter() - start

    linear_metrics = regression_metrics(linear.transform(test), CLAIM_AMOUNT, "prediction")
    parts = tandem_metrics(tandem.transform(test), "claimed", CLAIM_AMOUNT)
    seconds = [("linear", linear_seconds), ("tandem", tandem_seconds)]
    return {
        "metrics": _stacked([
            linear_metrics.select(F.lit("linear").alias("model"), F.lit("amount").alias("part"), "*"),
            parts.select(F.lit("tandem").alias("model"), "*"),
        ]),
        "fit_seconds": claims.sparkSession.createDataFrame(seconds, "model STRING, seconds DOUBLE"),
    }
