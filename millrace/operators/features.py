"""Feature columns: string index, one-hot, vector assembly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import lookup_join
from millrace.operators.ranking import running_start
from millrace.sources.files import materialise


def string_indexer(cols: Sequence[str], handle_invalid: str = "keep") -> StringIndexer:
    """``<col>_index`` by descending frequency, ties by value.

    ``keep`` gives unseen and NULL values one further index instead of failing.
    """
    return StringIndexer(
        inputCols=list(cols),
        outputCols=[f"{c}_index" for c in cols],
        handleInvalid=handle_invalid,
        stringOrderType="frequencyDesc",
    )


def one_hot_encoder(cols: Sequence[str], drop_last: bool = True) -> OneHotEncoder:
    """``<col>_vec`` from ``<col>_index``."""
    return OneHotEncoder(
        inputCols=[f"{c}_index" for c in cols],
        outputCols=[f"{c}_vec" for c in cols],
        dropLast=drop_last,
    )


def assembler(cols: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol=out)


def fit_string_index(df: DataFrame, col: str) -> DataFrame:
    """value, index, rows: the values of ``col`` by descending frequency, ties by value, from 0.

    The table is built by ranges of (count, value), so there may be as many values as rows; none of them
    passes the driver. NULL has no index.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("string").alias("value")).count()
    order = F.struct((-F.col("count")).alias("n"), F.col("value").alias("value"))
    placed = running_start(counts.select("value", "count", order.alias("_order"), F.lit(1).alias("_one")), "_order", "_one")
    return materialise(placed.select("value", F.col("start").alias("index"), F.col("count").alias("rows")))


def apply_string_index(
    df: DataFrame, index: DataFrame, col: str, out: str | None = None, handle_invalid: str = "keep"
) -> DataFrame:
    """Add the index of ``col`` (``<col>_index``) from :func:`fit_string_index`, as a double.

    Values that the index does not know, and NULL, get one further index (``keep``), NULL (``null``), lose
    their row (``skip``) or raise (``error``). Values are looked up once each and joined back so that a
    very frequent one is spread over many tasks.
    """
    out = out or f"{col}_index"
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("_rows"))
    met = counts.join(index.select("value", "index"), F.col(col).cast("string") == F.col("value"), "left")
    if handle_invalid == "keep":
        place = F.coalesce("index", F.lit(index.count()))
    else:
        place = F.col("index")
    known = materialise(met.select(col, place.cast("double").alias(out), "_rows"))
    if handle_invalid == "error":
        bad = known.where(F.col(out).isNull()).limit(1).collect()
        if bad:
            raise ValueError(f"{col} has a value without an index: {bad[0][col]}")
    if handle_invalid == "skip":
        known = known.where(F.col(out).isNotNull())
    return lookup_join(df, known, [col], rows_per_key="_rows")


def index_strings(df: DataFrame, cols: Sequence[str], handle_invalid: str = "keep") -> DataFrame:
    """Add ``<col>_index`` for each column, fitted on ``df`` itself.

    The labels are kept in the columns' metadata, as :func:`one_hot` needs them, so they pass the driver: use
    :func:`fit_string_index` and :func:`apply_string_index` for columns with very many values.
    """
    return string_indexer(cols, handle_invalid).fit(df.select(*cols)).transform(df)


def one_hot(df: DataFrame, cols: Sequence[str], drop_last: bool = True) -> DataFrame:
    """Add ``<col>_vec`` for columns that have a ``<col>_index``."""
    return one_hot_encoder(cols, drop_last).fit(df).transform(df)


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Add one vector column made of the given number and vector columns."""
    return assembler(cols, out).transform(df)


def feature_pipeline(
    categorical: Sequence[str],
    numeric: Sequence[str],
    out: str = "features",
    handle_invalid: str = "keep",
    drop_last: bool = True,
) -> Pipeline:
    """Index, encode and assemble; fit it on training rows only."""
    return Pipeline(
        stages=[
            string_indexer(categorical, handle_invalid),
            one_hot_encoder(categorical, drop_last),
            assembler([*numeric, *[f"{c}_vec" for c in categorical]], out),
        ]
    )


def feature_names(df: DataFrame, features: str = "features") -> list[str]:
    """The name of each position of an assembled vector column, from its metadata."""
    groups = df.schema[features].metadata["ml_attr"]["attrs"].values()
    attributes = sorted((a for g in groups for a in g), key=lambda a: a["idx"])
    return [a["name"] for a in attributes]
