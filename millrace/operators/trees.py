"""Fitted trees as a relation, scoring by it, and a split search by histograms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Model, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType
from pyspark.sql.window import Window

from millrace.sources.scratch import scratch_path

#: Spark's trees are no deeper.
MAX_DEPTH = 30


def tree_nodes(model: Model) -> DataFrame:
    """One row per node of a fitted forest or of boosted trees (the last stage, if it is a pipeline).

    tree, weight, node (from 0, the root), left, right (-1 in a leaf), feature, threshold (values up to it
    go left), categories (those that go left, where a split has no threshold), prediction, stats (class
    weights in a forest), rows, gain. The model is saved in the shared folder and read from there.
    """
    model = model.stages[-1] if isinstance(model, PipelineModel) else model
    spark = SparkSession.active()
    path = scratch_path(spark, "trees")
    model.write().save(path)
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "_", "weight").drop("_")
    nodes = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    inner, is_number = F.col("leftChild") >= 0, F.col("split.numCategories") == -1
    cut = F.col("split.leftCategoriesOrThreshold")
    told = nodes.select(
        "tree", F.col("id").alias("node"), F.col("leftChild").alias("left"), F.col("rightChild").alias("right"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner & is_number, F.get(cut, 0)).alias("threshold"),
        F.when(inner & ~is_number, cut).alias("categories"),
        "prediction", F.col("impurityStats").alias("stats"), F.col("rawCount").alias("rows"),
        F.when(inner, F.col("gain")).alias("gain"),
    )
    return told.join(F.broadcast(weights), "tree")  # a row per tree


def tree_leaves(df: DataFrame, nodes: DataFrame, key: str, features: str = "features") -> DataFrame:
    """key, tree, weight, leaf, prediction, stats: where each row ends in each tree of :func:`tree_nodes`.

    A tree is one row with its nodes in order, so going down is an expression and the rows of ``df`` are not
    shuffled: they meet the trees, which the model's own driver holds as well, in a broadcast join.
    """
    node = F.struct("node", "left", "right", "feature", "threshold", "categories", "prediction", "stats")
    packed = nodes.groupBy("tree", "weight").agg(F.sort_array(F.collect_list(node)).alias("_nodes"))
    trees = packed.count()
    is_array = isinstance(df.schema[features].dataType, ArrayType)
    x = F.col(features) if is_array else vector_to_array(features)
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
    met = df.select(F.col(key), x.alias("_x")).select("*", tree).join(F.broadcast(packed), "tree")

    def below(at: Column, _: Column) -> Column:
        n = F.get("_nodes", at)
        value = F.get("_x", n["feature"])
        goes_left = F.coalesce(value <= n["threshold"], F.array_contains(n["categories"], value))
        return F.when(n["left"] < 0, at).when(goes_left, n["left"]).otherwise(n["right"])

    leaf = F.aggregate(F.sequence(F.lit(1), F.lit(MAX_DEPTH)), F.lit(0), below)
    found = met.withColumn("leaf", leaf).withColumn("_leaf", F.get("_nodes", F.col("leaf")))
    return found.select(key, "tree", "weight", "leaf", "_leaf.prediction", "_leaf.stats")


def forest_score(leaves: DataFrame, key: str) -> DataFrame:
    """key, score: the mean share of class 1 in the leaves of a forest."""
    total = F.aggregate("stats", F.lit(0.0), lambda a, b: a + b)
    return leaves.groupBy(key).agg(F.avg(F.get("stats", 1) / total).alias("score"))


def boosted_score(leaves: DataFrame, key: str) -> DataFrame:
    """key, score: the probability of class 1 by boosted trees with logistic loss."""
    margin = F.sum(F.col("weight") * F.col("prediction"))
    return leaves.groupBy(key).agg((1 / (1 + F.exp(-2 * margin))).alias("score"))


def _cells(df: DataFrame, features: Sequence[str], label: str, bins: int | None) -> DataFrame:
    """feature, bin, low, high, n, pos: the histogram of each feature; ``bin`` orders its cells."""
    columns = [F.col(f).cast("double") for f in features]
    pairs = F.posexplode(F.array(*columns)).alias("feature", "value")
    long = df.select(F.col(label).cast("double").alias("y"), pairs).where("value IS NOT NULL AND y IS NOT NULL")
    place = F.col("value") + F.lit(0.0)  # -0.0 and 0.0 are one value
    if bins is not None:
        # One pass: at most bins - 1 cuts of each feature.
        shares = [i / bins for i in range(1, bins)]
        cuts = df.agg(*[F.percentile_approx(c, shares, 10_000).alias(str(i)) for i, c in enumerate(columns)]).first()
        known = F.array(*[F.array(*map(F.lit, sorted(set(c or [])))) .cast("array<double>") for c in cuts])
        place = F.size(F.filter(F.get(known, F.col("feature")), lambda t: t < F.col("value"))).cast("double")
    return long.groupBy("feature", place.alias("bin")).agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.count("*").alias("n"), F.sum("y").alias("pos")
    )


def _gini(n: Column, pos: Column) -> Column:
    share = pos / n
    return 2 * share * (1 - share)


def split_gains(
    df: DataFrame, features: Sequence[str], label: str, bins: int | None = 256
) -> DataFrame:
    """Every binary split of every feature: feature (name), threshold, left_rows, left_positives, gain.

    ``label`` is 0 or 1; the gain is that of the Gini impurity. All features are counted in one pass, by (feature,
    bin), and the splits follow from running sums over the bins, of which there are at most ``bins`` per feature;
    with None each value is a bin, for features with few values. Rows without the value or the label do not count
    for a feature. Thresholds lie midway between neighbouring values.
    """
    cells = _cells(df, features, label, bins)
    ordered = Window.partitionBy("feature").orderBy("bin")
    upto, whole = ordered.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("feature")
    n, pos, left, left_pos = F.col("_n"), F.col("_pos"), F.col("left_rows"), F.col("left_positives")
    summed = cells.select(
        "feature", "high", F.lead("low").over(ordered).alias("_next"),
        F.sum("n").over(upto).alias("left_rows"), F.sum("pos").over(upto).alias("left_positives"),
        F.sum("n").over(whole).alias("_n"), F.sum("pos").over(whole).alias("_pos"),
    ).where("_next IS NOT NULL")
    gain = _gini(n, pos) - left / n * _gini(left, left_pos) - (n - left) / n * _gini(n - left, pos - left_pos)
    names = F.array(*[F.lit(f) for f in features])
    return summed.select(
        F.get(names, F.col("feature")).alias("feature"), ((F.col("high") + F.col("_next")) / 2).alias("threshold"),
        "left_rows", "left_positives", gain.alias("gain"),
    )


def best_splits(
    df: DataFrame, features: Sequence[str], label: str, k: int = 1, bins: int | None = 256
) -> DataFrame:
    """The ``k`` splits of :func:`split_gains` with the highest gain; ties by feature name and threshold."""
    gains = split_gains(df, features, label, bins)
    return gains.orderBy(F.desc("gain"), "feature", "threshold").limit(k)


def root_splits(nodes: DataFrame, names: Sequence[str] | Mapping[int, str]) -> DataFrame:
    """tree, feature (name), threshold, gain: the first split of every tree that has one."""
    named = F.array(*[F.lit(names[i]) for i in range(len(names))])
    roots = nodes.where("node = 0 AND left >= 0")
    return roots.select("tree", F.get(named, F.col("feature")).alias("feature"), "threshold", "gain")
