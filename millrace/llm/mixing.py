"""Mixing sources to target weights by iterative proportional fitting. DataFrame functions only.

Tokens are summed into cells of (source, language, topic). A cell's weight is its tokens times one
factor per dimension, and the factors are raked: one dimension after the other is scaled
to its target shares until all shares hold. Cells and factors are tables. Up to :data:`ONE_TASK` cells are raked in one task,
some rounds per job, by sums over windows of the cells; beyond that a step joins the factors of the other
dimensions to the cells, sums by the dimension and writes its new factors. Both give the same factors.

The weights give each cell a sampling rate. Rates are scaled so that the expected sample has
``budget`` of all tokens, with probabilities of at most 1; what a cell would need beyond that
is its ``mix_repeat``.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import hash_bucket
from millrace.llm.common import WORD, text_or_empty
from millrace.operators import lookup_join
from millrace.sources import materialise

DIMENSIONS = ("source", "lang", "topic")
#: Target share of a level: its share of the tokens to this power, scaled to sum to 1.
TEMPERATURE = 0.7
#: Part of all tokens that the sample is to have.
BUDGET = 0.7
#: Level of rows that have none.
NO_LEVEL = "(none)"
#: Cells (a few numbers each) that one task rakes, and rounds of it between two looks at the changes.
ONE_TASK, ROUNDS = 100_000, 5

Targets = Mapping[str, Mapping[str, float]]


def form_topic(text: Column, tokens: Column) -> Column:
    """The default topic, by form: what the text consists of, or else its length."""
    bars = F.length(text) - F.length(F.replace(text, F.lit("|"), F.lit("")))
    symbols = F.regexp_count(text, F.lit("[#*$%&<>]"))
    return (
        F.when(tokens == 0, "empty")
        .when(bars * 10 >= tokens, "table")
        .when(symbols * 10 >= tokens, "symbols")
        .when(tokens < 100, "short")
        .when(tokens < 1000, "article")
        .otherwise("long")
    )


def add_mix_columns(docs: DataFrame, topic: Column | None = None, seed: int = 11) -> DataFrame:
    """Add mix_source, mix_lang, mix_topic, mix_tokens (words) and mix_draw (in [0, 1)).

    ``topic`` is any expression; by default :func:`form_topic`. A column ``topic`` of ``docs`` only counts if
    it is given as that expression. Levels of any type become strings, null ones ``(none)``. The draw depends on the
    id only; rows without an id draw by their text. Null and empty texts have no tokens, long ones are counted whole;
    repeated rows draw alike; an empty table stays empty; columns of the names added are replaced.
    """
    text = text_or_empty()
    rows = docs.withColumn("mix_tokens", F.regexp_count(text, F.lit(WORD)).cast("long"))
    if topic is None:
        topic = form_topic(text, F.col("mix_tokens"))
    rows = rows.withColumn("mix_topic", topic)
    for name in ("source", "lang"):
        rows = rows.withColumn(f"mix_{name}", F.col(name))
    for name in DIMENSIONS:
        rows = rows.withColumn(f"mix_{name}", F.coalesce(F.col(f"mix_{name}").cast("string"), F.lit(NO_LEVEL)))
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5(text))
    return rows.withColumn("mix_draw", key).withColumn("mix_draw", hash_bucket("mix_draw", seed))


def _target_shares(cells: DataFrame, dimension: str, targets: Targets, temperature: float) -> DataFrame:
    """level, target: shares that sum to 1 over the levels that have tokens.

    A level that ``targets`` does not name keeps its own share of the tokens.
    """
    levels = cells.groupBy(F.col(dimension).alias("level")).agg(F.sum("tokens").alias("tokens"))
    share = F.col("tokens") / (cells.agg(F.sum("tokens")).first()[0] or 1)
    if dimension in targets:
        spark = cells.sparkSession
        given = spark.createDataFrame(
            [(str(k), float(v)) for k, v in targets[dimension].items()], "level string, given double"
        )
        wanted = levels.join(given, "level", "left").withColumn("target", F.coalesce("given", share))
    else:
        wanted = levels.withColumn("target", F.pow(share, F.lit(temperature)))
    wanted = materialise(wanted.select("level", "target"))
    whole = wanted.agg(F.sum("target")).first()[0] or 1.0
    return wanted.withColumn("target", F.col("target") / whole)


def rake(
    cells: DataFrame, targets: Mapping[str, DataFrame], tolerance: float = 1e-9, rounds: int = 100
) -> dict[str, DataFrame]:
    """Factors (level, factor) of each dimension so that ``tokens`` times factors meet the targets.

    ``cells`` has the dimensions and positive tokens, ``targets`` a table (level, target) per
    dimension. Stops when no factor changes by more than ``tolerance``, or after ``rounds`` rounds: targets
    that no weights can meet (a level that only exists together with another) end there, with a warning that
    tells how much the factors still change.
    """
    few = cells.limit(ONE_TASK + 1).count() <= ONE_TASK
    factors, change = (_rake_in_one_task if few else _rake_by_joins)(cells, targets, tolerance, rounds)
    if change > tolerance:
        warnings.warn(f"targets are not met: factors still change by {change:.2g}", stacklevel=2)
    return factors


def _rake_in_one_task(
    cells: DataFrame, targets: Mapping[str, DataFrame], tolerance: float, rounds: int
) -> tuple[dict[str, DataFrame], float]:
    """The factors and their last relative change; all sums are windows of one sorted partition, without a shuffle."""
    state = cells
    for d, target in targets.items():
        named = target.select(F.col("level").alias(d), F.col("target").alias(f"_t_{d}"))
        state = state.join(named, d).withColumn(f"_f_{d}", F.lit(1.0))
    change, done = 0.0, 0
    while done < rounds:
        state = state.coalesce(1)
        for _ in range(min(ROUNDS, rounds - done)):
            state = state.withColumns({f"_b_{d}": F.col(f"_f_{d}") for d in targets})
            for d in targets:
                weight = reduce(Column.__mul__, [F.col(f"_f_{o}") for o in targets if o != d], F.col("tokens").cast("double"))
                total = F.sum(weight).over(Window.partitionBy(d))
                state = state.withColumn(f"_f_{d}", F.col(f"_t_{d}") / total)
            done += 1
        state = materialise(state)
        moved = F.greatest(*[F.abs(F.col(f"_f_{d}") / F.col(f"_b_{d}") - 1) for d in targets], F.lit(0.0))
        change = state.agg(F.max(moved)).first()[0] or 0.0
        if change <= tolerance:
            break
    return {
        d: materialise(state.groupBy(F.col(d).alias("level")).agg(F.min(f"_f_{d}").alias("factor"))) for d in targets
    }, change


def _rake_by_joins(
    cells: DataFrame, targets: Mapping[str, DataFrame], tolerance: float, rounds: int
) -> tuple[dict[str, DataFrame], float]:
    """As :func:`_rake_in_one_task`, for any number of cells: a join and a sum per dimension and round."""
    most = 0.0
    factors = {d: materialise(t.select("level", F.lit(1.0).alias("factor"))) for d, t in targets.items()}
    for _ in range(rounds):
        changes = []
        for dimension, target in targets.items():
            weighted = cells.withColumn("weight", F.col("tokens").cast("double"))
            for other, factor in factors.items():
                if other != dimension:
                    named = factor.withColumnRenamed("level", other)
                    scaled = F.col("weight") * F.col("factor")
                    weighted = weighted.join(named, other).withColumn("weight", scaled).drop("factor")
            sums = weighted.groupBy(F.col(dimension).alias("level")).agg(F.sum("weight").alias("weight"))
            new = sums.join(target, "level").select("level", (F.col("target") / F.col("weight")).alias("factor"))
            new = materialise(new)
            change = F.abs(F.col("factor") / F.col("before") - 1)
            old = factors[dimension].withColumnRenamed("factor", "before")
            changes.append(new.join(old, "level").select(change.alias("change")))
            factors[dimension] = new
        most = reduce(DataFrame.unionAll, changes).agg(F.max("change")).first()[0] or 0.0
        if most <= tolerance:
            break
    return factors, most


def mixing_rates(
    rows: DataFrame,
    targets: Targets | None = None,
    temperature: float = TEMPERATURE,
    budget: float = BUDGET,
) -> DataFrame:
    """mix_source, mix_lang, mix_topic, mix_probability, mix_repeat: one row per cell, written.

    ``rows`` comes from :func:`add_mix_columns`. Cells without tokens get probability 1: their
    rows weigh nothing.
    """
    names = [f"mix_{d}" for d in DIMENSIONS]
    cells = rows.groupBy(*names).agg(F.sum("mix_tokens").alias("tokens"))
    cells = materialise(cells.toDF(*DIMENSIONS, "tokens"))
    full = cells.where("tokens > 0")
    shares = {d: _target_shares(full, d, targets or {}, temperature) for d in DIMENSIONS}
    rated = full.withColumn("rate", F.lit(1.0))
    for dimension, factor in rake(full, shares).items():
        named = factor.withColumnRenamed("level", dimension)
        rated = rated.join(named, dimension).withColumn("rate", F.col("rate") * F.col("factor")).drop("factor")
    rated = materialise(rated.select(*DIMENSIONS, "tokens", "rate"))
    scale = _scale(rated, budget)
    exact = F.col("rate") * scale
    rated = rated.withColumn("mix_probability", F.round(F.least(exact, F.lit(1.0)), 9)).withColumn(
        "mix_repeat", F.round(F.greatest(exact, F.lit(1.0)), 9)
    )
    none = cells.where("tokens = 0").withColumns({"mix_probability": F.lit(1.0), "mix_repeat": F.lit(1.0)})
    out = rated.select(*DIMENSIONS, "mix_probability", "mix_repeat").unionByName(
        none.select(*DIMENSIONS, "mix_probability", "mix_repeat")
    )
    return materialise(out.toDF(*names, "mix_probability", "mix_repeat"))


def _scale(rated: DataFrame, budget: float) -> float:
    """The scale at which probabilities min(1, scale * rate) keep ``budget`` of the tokens."""
    total = rated.agg(F.sum("tokens")).first()[0] or 0
    scale = budget * total
    while True:
        capped = F.col("rate") * scale >= 1
        kept, open_share = rated.agg(
            F.sum(F.when(capped, F.col("tokens")).otherwise(0)),
            F.sum(F.when(capped, 0.0).otherwise(F.col("tokens") * F.col("rate"))),
        ).first()
        if not open_share:
            return scale
        new = (budget * total - kept) / open_share
        if new <= scale * (1 + 1e-12):
            return scale
        scale = new


def sample_mix(
    rows: DataFrame, targets: Targets | None = None, temperature: float = TEMPERATURE, budget: float = BUDGET
) -> DataFrame:
    """Add mix_probability, mix_repeat and mix_kept to rows of :func:`add_mix_columns`.

    A row is kept if its draw is below its cell's probability, so the choice survives lost
    tasks and other partitionings. Null levels count as ``(none)``; an empty table stays empty;
    rows with one id share their fate. Columns of the names added are replaced. Empty and very long
    texts only weigh by their tokens.
    """
    names = [f"mix_{d}" for d in DIMENSIONS]
    rows = rows.drop("mix_probability", "mix_repeat", "mix_kept")
    rated = lookup_join(rows, mixing_rates(rows, targets, temperature, budget), names)
    return rated.withColumn("mix_kept", F.col("mix_draw") < F.col("mix_probability"))
