"""Missing values: sentinels, column modes, imputation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def null_sentinel(df: DataFrame, sentinel: str = "?", cols: Sequence[str] | None = None) -> DataFrame:
    """NULL for the sentinel text, in string columns only."""
    text = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, StringType) and (cols is None or f.name in cols)
    ]
    return df.withColumns({c: F.nullif(F.col(f"`{c}`"), F.lit(sentinel)) for c in text})


def _modes_by_type(
    df: DataFrame, cols: Sequence[str], count_missing: bool, sentinel: str
) -> list[DataFrame]:
    """One frame (column, value) per data type, so that ties compare in their own type."""
    frames = []
    by_type: dict[str, list[str]] = {}
    for c in cols:
        by_type.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    for kind, names in by_type.items():
        cells = df.select(*[f"`{c}`" for c in names]).unpivot(
            [], [F.col(f"`{c}`") for c in names], "column", "value"
        )
        counts = cells.groupBy("column", "value").count()
        if not count_missing:
            if kind == "string":
                counts = counts.withColumn("value", F.nullif(F.col("value"), F.lit(sentinel)))
            present = F.col("value").isNotNull()
            counts = counts.withColumn("count", F.when(present, F.col("count")).otherwise(0))
        best = F.min(F.struct((-F.col("count")).alias("n"), F.col("value").alias("value")))
        frames.append(
            counts.groupBy("column").agg(best.alias("b")).select("column", F.col("b.value").alias("value"))
        )
    return frames


def column_modes(
    df: DataFrame, cols: Sequence[str], count_missing: bool = False, sentinel: str = "?"
) -> DataFrame:
    """The most frequent value of each column: column, value (as text); ties to the smallest.

    NULL and the sentinel do not compete unless ``count_missing``; a column with nothing
    else has the mode NULL. All columns of a type are counted in one job, with a
    partial count before the shuffle, so a column may have any number of values.
    """
    frames = _modes_by_type(df, cols, count_missing, sentinel)
    return reduce(
        DataFrame.unionByName,
        [f.withColumn("value", F.col("value").cast("string")) for f in frames],
    )


def fit_modes(
    df: DataFrame, cols: Sequence[str], count_missing: bool = False, sentinel: str = "?"
) -> dict[str, Any]:
    """The column modes as Python values: one value per column."""
    return {
        row["column"]: row["value"]
        for frame in _modes_by_type(df, cols, count_missing, sentinel)
        for row in frame.collect()
    }


def fill_modes(df: DataFrame, modes: Mapping[str, Any], sentinel: str = "?") -> DataFrame:
    """Replace NULL and the sentinel by the given modes; every column keeps its type."""
    filled = null_sentinel(df, sentinel, list(modes))
    return filled.withColumns({
        c: F.coalesce(F.col(f"`{c}`"), F.lit(value).cast(df.schema[c].dataType))
        for c, value in modes.items()
        if value is not None
    })


def impute_mode(
    df: DataFrame, cols: Sequence[str], count_missing: bool = False, sentinel: str = "?"
) -> DataFrame:
    """Fill the missing values of ``cols`` with the mode of each column.

    To treat test rows like training rows, use :func:`fit_modes` on the training rows
    and :func:`fill_modes` on both.
    """
    return fill_modes(df, fit_modes(df, cols, count_missing, sentinel), sentinel)
