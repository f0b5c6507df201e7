"""The operators: functions from DataFrames (and settings) to DataFrames or fitted models."""

from millrace.operators.cleaning import (
    column_modes,
    fill_modes,
    fit_modes,
    impute_mode,
    null_sentinel,
)
from millrace.operators.columns import (
    binary_target,
    cast_by_type,
    cast_columns,
    filter_suffix,
    split_columns,
)
from millrace.operators.counts import concat_group, count_by_suffix, top_k, topk_with_others
from millrace.operators.evaluate import (
    auc,
    auc_by_group,
    classification_metrics,
    compare_models,
    fit_and_score,
    hard_auc_evaluator,
    regression_metrics,
)
from millrace.operators.features import (
    apply_string_index,
    assemble,
    feature_names,
    feature_pipeline,
    fit_string_index,
    index_strings,
    one_hot,
)
from millrace.operators.grids import activity_grid
from millrace.operators.joins import heavy_groups, lookup_join
from millrace.operators.ledger import Ledger, fingerprint
from millrace.operators.models import (
    feature_importance,
    fit_gamma,
    gamma_regression,
    gamma_score,
    gbt,
    linear_regression,
    mlp,
    model_params,
    model_pipeline,
    objective_history,
    random_forest,
    standardised,
)
from millrace.operators.ranking import percent_rank_by, running_start
from millrace.operators.recommend import (
    als_experiment,
    fit_als,
    fit_cells,
    normal_equations,
    normal_residuals,
    solve_factors,
    user_factors,
)
from millrace.operators.segments import (
    assign_segments,
    fit_segments,
    largest_segments,
    members_of_largest,
    segment_genres,
    segment_ratings,
    segment_spread,
)
from millrace.operators.splits import (
    hash_sample,
    hash_sample_by,
    hash_split,
    time_split,
    time_splits,
    time_thresholds,
)
from millrace.operators.tandem import TandemModel, fit_tandem, tandem_metrics
from millrace.operators.trees import (
    best_splits,
    boosted_score,
    forest_score,
    root_splits,
    split_gains,
    tree_leaves,
    tree_nodes,
)
from millrace.operators.tuning import cross_validate, param_grid, with_folds
from millrace.operators.weblog import (
    log_time_parts,
    parse_access_log,
    top_domain_activity,
    top_domains,
    with_region,
)

__all__ = [name for name in dir() if not name.startswith("_")]
