"""Dense day by hour grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def activity_grid(
    df: DataFrame, day: str, hour: str, by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Row counts per day and hour from the first to the last day, zeros included.

    With ``weight`` the rows are counts already, and that column is summed.

    Days and hours are compared as numbers. The empty cells are made from the two day
    bounds of each group and added to the counts, so no join is needed.
    """
    days, hours = F.col(day).try_cast("int"), F.col(hour).try_cast("int")
    ones = F.col(weight) if weight else F.lit(1).cast("bigint")
    counts = (
        df.select(*by, days.alias("day"), hours.alias("hour"), ones.alias("_ones"))
        .groupBy(*by, "day", "hour")
        .agg(F.sum("_ones").alias("count"))
        .where(F.when(F.col("day").isNotNull() & F.col("hour").isNotNull(), F.col("count")) > 0)
    )
    bounds = counts.groupBy(*by).agg(F.min("day").alias("_lo"), F.max("day").alias("_hi"))
    cells = (
        bounds.where(F.col("_lo").isNotNull())
        .select(*by, F.explode(F.sequence("_lo", "_hi")).alias("day"))
        .select(*by, "day", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
        .withColumn("count", F.lit(0).cast("bigint"))
    )
    return counts.unionByName(cells).groupBy(*by, "day", "hour").agg(F.sum("count").alias("count"))
