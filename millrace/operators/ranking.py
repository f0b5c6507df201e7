"""Global order statistics without sending all rows to one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.operators.joins import EASY_ROWS, SLOTS, heavy_groups, lookup_join, split_heavy
from millrace.sources.files import materialise


def running_start(
    groups: DataFrame, order_col: str, weight: str, by: Sequence[str] = (), out: str = "start"
) -> DataFrame:
    """Add to each row the summed ``weight`` of the smaller rows of its ``by`` group.

    The ``order_col`` is unique within a group; NULL comes first. The rows are cut into
    ranges of (by, order_col), so a large group spans many tasks: each range is summed by
    itself and shifted by the total of the ranges before it. Also adds ``<out>_total``,
    the weight of the whole group. The ranges are written to the shared folder, because
    they must stay the same for both uses, and the result reads them from there.
    """
    by = list(by)
    ranged = materialise(
        groups.repartitionByRange(*by, order_col).withColumn("_range", F.spark_partition_id())
    )
    totals = ranged.groupBy(*by, "_range").agg(F.sum(weight).alias("_sum"))
    # A group has no more rows here than there are ranges.
    whole = Window.partitionBy(*by)
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # The end of a range cuts through one group at most, so fewer than two rows per range
    # belong to groups that go on in another range. Only those are broadcast.
    shifts = (
        totals.withColumn("_ranges", F.count(F.lit(1)).over(whole))
        .withColumn("_shift", F.sum("_sum").over(before))
        .withColumn("_group", F.sum("_sum").over(whole))
        .where(F.col("_ranges") > 1)
        .select(*by, "_range", "_shift", "_group")
    )
    within = Window.partitionBy("_range", *by)
    smaller = within.orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_local", F.sum(weight).over(smaller)).withColumn(
        "_local_total", F.sum(weight).over(within)
    )
    same = reduce(
        and_, [F.col(f"l.{b}").eqNullSafe(F.col(f"s.{b}")) for b in by],
        F.col("l._range") == F.col("s._range"),
    )
    zero = F.lit(0)
    return local.alias("l").join(F.broadcast(shifts).alias("s"), same, "left").select(
        *[F.col(f"l.{c}") for c in groups.columns],
        (F.coalesce("_local", zero) + F.coalesce("_shift", zero)).alias(out),
        F.coalesce("_group", "_local_total").alias(f"{out}_total"),
    )


def percent_rank_by(
    df: DataFrame,
    order_col: str,
    partition_cols: Sequence[str] = (),
    out: str = "percent_rank",
    slots: int = SLOTS,
    easy_rows: int = EASY_ROWS,
) -> DataFrame:
    """Add ``(rank - 1) / (rows - 1)`` within the partition, 0 if it has one row.

    Ties share a rank and NULL ranks lowest. A window sorts each partition in one task,
    so only partitions below the heavy limit of :func:`heavy_groups` take one; the others,
    and a whole table of ``easy_rows`` rows or more, are ranked by ranges.
    """
    if not partition_cols:
        if df.count() < easy_rows:
            return df.withColumn(out, F.percent_rank().over(Window.orderBy(order_col)))
        return _ranked_by_ranges(df, order_col, [], out, slots, easy_rows)
    heavy = heavy_groups(df.groupBy(*partition_cols).count(), "count", slots, easy_rows)
    window = Window.partitionBy(*partition_cols).orderBy(order_col)
    if heavy.isEmpty():
        return df.withColumn(out, F.percent_rank().over(window))
    hot, cold = split_heavy(df, heavy, partition_cols)
    return _ranked_by_ranges(hot, order_col, partition_cols, out, slots, easy_rows).unionByName(
        cold.withColumn(out, F.percent_rank().over(window))
    )


def _ranked_by_ranges(
    df: DataFrame,
    order_col: str,
    partition_cols: Sequence[str],
    out: str,
    slots: int,
    easy_rows: int,
) -> DataFrame:
    """Rank the distinct order values by ranges, then let each row look its rank up."""
    keys = [*partition_cols, order_col]
    ties = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_ties"))
    ranked = running_start(ties, order_col, "_ties", by=partition_cols, out="_below")
    size = F.col("_below_total")
    share = F.when(size == 1, F.lit(0.0)).otherwise(F.col("_below") / (size - 1))
    ranks = ranked.select(*keys, share.alias(out), "_ties")
    return lookup_join(df, ranks, keys, "_ties", slots, easy_rows)
