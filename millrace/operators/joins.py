"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A group is heavy if it holds this share of all rows or more, which at most SLOTS groups
# can, unless it is smaller than what any task takes with ease.
SLOTS = 10_000
EASY_ROWS = 1_000_000


def heavy_groups(
    counts: DataFrame, rows: str = "count", slots: int = SLOTS, easy_rows: int = EASY_ROWS
) -> DataFrame:
    """The groups with ``1/slots`` of all rows and ``easy_rows`` rows or more.

    There are at most ``slots`` of them, so they are fetched and come back as a local
    table: small enough to broadcast, and not computed again by each use.
    """
    total = counts.agg(F.sum(rows)).scalar()
    heavy = counts.where((F.col(rows) >= easy_rows) & (F.col(rows) * slots >= total))
    return counts.sparkSession.createDataFrame(heavy.collect(), counts.schema)


def same_keys(keys: Sequence[str], left: str = "l", right: str = "r") -> Column:
    """Condition for equal keys of two aliased frames; NULL equals NULL."""
    pairs = [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    return reduce(and_, pairs)


def split_heavy(
    rows: DataFrame, heavy: DataFrame, keys: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """The rows with and without one of the keys that :func:`heavy_groups` found."""
    known = F.broadcast(heavy.select(*keys)).alias("r")
    left, same = rows.alias("l"), same_keys(keys)
    return left.join(known, same, "left_semi"), left.join(known, same, "left_anti")


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    rows_per_key: str | None = None,
    slots: int = SLOTS,
    easy_rows: int = EASY_ROWS,
) -> DataFrame:
    """Inner join of ``rows`` with a table that has one row per key (NULL equals NULL).

    A lookup of at most ``slots`` rows is broadcast. With a larger one the rows of a heavy
    key would all meet in one task of a shuffle join, so they are joined by broadcasting
    the lookup rows of the heavy keys, of which there are at most ``slots``. All other keys
    go through an ordinary join. ``rows_per_key`` names the column of ``lookup`` that holds
    the number of rows of each key, if there is one; it is left out of the result. Else the
    keys are counted. A lookup that has several rows per key gives the right rows too, but
    if the heavy keys have more than ``slots`` of them, it is joined in the ordinary way.
    """
    keys = list(keys)
    added = [c for c in lookup.columns if c not in [*keys, rows_per_key]]

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        pairs = left.alias("l").join(right.alias("r"), same_keys(keys))
        return pairs.select("l.*", *[F.col(f"r.{c}") for c in added])

    if rows_per_key is None:
        if lookup.limit(slots + 1).count() <= slots:
            return joined(rows, F.broadcast(lookup))
        heavy = heavy_groups(rows.groupBy(*keys).count(), "count", slots, easy_rows)
    else:
        heavy = heavy_groups(lookup.select(*keys, rows_per_key), rows_per_key, slots, easy_rows)
    if heavy.isEmpty():
        return joined(rows, lookup)
    hot_rows, cold_rows = split_heavy(rows, heavy, keys)
    hot_lookup, _ = split_heavy(lookup, heavy, keys)
    if hot_lookup.limit(slots + 1).count() > slots:
        return joined(rows, lookup)
    return joined(hot_rows, F.broadcast(hot_lookup)).unionByName(joined(cold_rows, lookup))
