"""Column reshaping: split a line, cast tolerantly, derive a binary target."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def split_columns(
    df: DataFrame, names: Sequence[str], sep: str = ",", col: str = "value"
) -> DataFrame:
    """Replace the delimited text column ``col`` by one string column per name.

    A line with too few fields gives NULLs at the end.
    """
    parts = F.split(F.col(col), re.escape(sep))
    kept = [F.col(f"`{c}`") for c in df.columns if c != col]
    return df.select(*kept, *[F.get(parts, i).alias(name) for i, name in enumerate(names)])


def cast_columns(df: DataFrame, types: Mapping[str, str | DataType]) -> DataFrame:
    """Cast the named columns; text that does not parse becomes NULL."""
    return df.withColumns({name: F.col(f"`{name}`").try_cast(t) for name, t in types.items()})


def cast_by_type(df: DataFrame, from_type: DataType, to: str | DataType) -> DataFrame:
    """Cast every column that has the type ``from_type``."""
    return cast_columns(df, {f.name: to for f in df.schema.fields if f.dataType == from_type})


def binary_target(df: DataFrame, col: str, out: str) -> DataFrame:
    """Add ``out``: 0 where ``col`` is zero, 1 for any other value, NULL where it is NULL."""
    return df.withColumn(out, (F.col(col) != 0).cast("int"))


def filter_suffix(df: DataFrame, col: str, suffix: str) -> DataFrame:
    """Rows whose ``col`` ends with ``suffix`` (case-sensitive)."""
    return df.where(F.col(col).endswith(suffix))
