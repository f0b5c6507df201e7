"""Counting and ranking of groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.operators.ranking import running_start

SLICES = 64


def count_by_suffix(df: DataFrame, col: str, suffixes: Mapping[str, str]) -> DataFrame:
    """Rows whose ``col`` ends with each suffix, in one pass: label, count."""
    counts = df.agg(*[
        F.count_if(F.col(col).endswith(suffix)).alias(f"_{i}")
        for i, suffix in enumerate(suffixes.values())
    ])
    rows = [
        F.struct(F.lit(label).alias("label"), F.col(f"_{i}").alias("count"))
        for i, label in enumerate(suffixes)
    ]
    return counts.select(F.inline(F.array(*rows)))


def top_k(
    counts: DataFrame, key: str, k: int, by: Sequence[str] = (), count: str = "count"
) -> DataFrame:
    """The ``k`` rows with the highest ``count`` (of each ``by`` group) and their ``rank``.

    Ties go to the smaller key. A group is cut down to ``k`` rows per hash slice first,
    so the final ranking of a group sees at most ``SLICES * k`` rows however many keys it has.
    """
    order = [F.desc(count), F.asc(key)]
    if not by:
        few = counts.orderBy(*order).limit(k)
        return few.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    slice_of_key = F.pmod(F.xxhash64(F.col(key)), F.lit(SLICES))
    in_slice = Window.partitionBy(*by, slice_of_key).orderBy(*order)
    in_group = Window.partitionBy(*by).orderBy(*order)
    few = counts.withColumn("_r", F.row_number().over(in_slice)).where(F.col("_r") <= k).drop("_r")
    return few.withColumn("rank", F.row_number().over(in_group)).where(F.col("rank") <= k)


def topk_with_others(
    df: DataFrame, key: str, k: int = 9, by: Sequence[str] = (), others: str = "Others"
) -> DataFrame:
    """The ``k`` most frequent keys and the remainder: [by], rank, key, count, share_pct.

    The remainder has rank ``k + 1`` and exists only if there are more than ``k`` keys.
    A key that is itself called ``Others`` keeps its own row. Keys come back as text.
    """
    counts = df.groupBy(*by, key).count()
    top = top_k(counts, key, k, by).select(
        *by, "rank", F.col(key).cast("string").alias(key), "count",
        F.lit(None).cast("bigint").alias("_groups"),
    )
    totals = counts.groupBy(*by).agg(
        F.sum("count").alias("count"), F.count(F.lit(1)).alias("_groups")
    )
    whole = totals.select(*by, F.lit(k + 1).alias("rank"), F.lit(others).alias(key), "count", "_groups")
    # A group holds at most k + 1 rows from here on.
    group = Window.partitionBy(*by)
    is_whole = F.col("_groups").isNotNull()
    pieces = (
        top.unionByName(whole)
        .withColumn("_total", F.max(F.when(is_whole, F.col("count"))).over(group))
        .withColumn("_kept", F.sum(F.when(~is_whole, F.col("count"))).over(group))
        .where(~is_whole | (F.col("_groups") > k))
        .withColumn(
            "count",
            F.when(is_whole, F.col("count") - F.col("_kept")).otherwise(F.col("count")),
        )
    )
    share = F.lit(100.0) * F.col("count") / F.col("_total")
    return pieces.select(*by, "rank", key, "count", share.alias("share_pct"))


def concat_group(
    df: DataFrame, key: str, col: str, sep: str = "|", max_items: int = 100_000
) -> DataFrame:
    """All values of ``col`` per key joined in sorted order: key, part, text.

    Copies are counted before the shuffle. A key with more than ``max_items`` values is
    continued on further rows (``part`` 0, 1, ...), so no row or task holds an unbounded
    group. NULL values are skipped; a key with nothing else gives one empty text.
    """
    counts = df.groupBy(key, col).agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_n", F.when(F.col(col).isNull(), 0).otherwise(F.col("_n"))
    )
    placed = running_start(counts, col, "_n", by=[key], out="_start")
    first = F.col("_start")
    last = F.col("_start") + F.greatest(F.col("_n"), F.lit(1)) - 1
    part = F.floor(first / max_items).cast("bigint")
    pieces = placed.withColumn(
        "part", F.explode(F.sequence(part, F.floor(last / max_items).cast("bigint")))
    )
    low = F.greatest(F.col("_start"), F.col("part") * max_items)
    high = F.least(F.col("_start") + F.col("_n"), (F.col("part") + 1) * max_items)
    repeated = F.array_repeat(F.col(col), (high - low).cast("int"))
    return (
        pieces.withColumn("_values", F.when(F.col(col).isNotNull(), repeated))
        .groupBy(key, "part")
        .agg(F.array_sort(F.flatten(F.collect_list("_values"))).alias("_values"))
        .select(key, "part", F.concat_ws(sep, "_values").alias("text"))
    )
