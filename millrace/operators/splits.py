"""Splits and samples whose rows depend on the data, never on its partitioning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from millrace.functions import hash_bucket
from millrace.sources.scratch import persisted

BINS = 1 << 18
ACCURACY = 10_000


def _as_number(df: DataFrame, col: str) -> Column:
    """``col`` as a bigint in the same order; dates and times do not pass a time zone."""
    kind, value = df.schema[col].dataType, F.col(col)
    if isinstance(kind, T.IntegralType):
        return value.cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, T.TimestampNTZType):
        seconds = F.hour(value) * 3600 + F.minute(value) * 60
        micros = F.extract(F.lit("SECOND"), value) * 1_000_000
        return (
            F.unix_date(value.cast("date")).cast("bigint") * 86_400_000_000
            + seconds.cast("bigint") * 1_000_000
            + micros.cast("bigint")
        )
    raise TypeError(f"{col}: a time split needs an integer, date or timestamp, not {kind}")


def _as_value(df: DataFrame, col: str, number: int) -> Column:
    """The constant of ``col``'s type behind ``number``: a plain literal can be pushed down."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(F.lit(number))
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(F.lit(number))
    if isinstance(kind, T.TimestampNTZType):
        at = datetime(1970, 1, 1) + timedelta(microseconds=number)
        return F.lit(at.isoformat(sep=" ", timespec="microseconds")).cast("timestamp_ntz")
    return F.lit(number).cast(kind)


def _last_position(fraction: float, rows: int) -> int:
    """The largest i with i / (rows - 1) <= fraction, in the arithmetic of percent_rank."""
    if rows <= 1:
        return 0
    i = int(fraction * (rows - 1))
    while i + 1 < rows and (i + 1) / (rows - 1) <= fraction:
        i += 1
    while i > 0 and i / (rows - 1) > fraction:
        i -= 1
    return i


def _select_positions(cells: DataFrame, low: int, high: int, positions: set[int]) -> dict[int, int]:
    """The value at each position (from 0) of the sorted values; ``cells`` has t and count.

    Up to ``BINS`` distinct values are summed up in order. More are never sorted: each
    round counts the rows in up to ``BINS`` equal bins of the open range and goes on
    inside the bin that holds the wanted position.
    """
    if cells.count() <= BINS:
        upto = cells.withColumn("upto", F.sum("count").over(Window.orderBy("t")))
        holds = [(F.col("upto") - F.col("count") <= p) & (F.col("upto") > p) for p in positions]
        found = upto.where(reduce(or_, holds)).collect()
        return {
            p: row["t"] for p in positions for row in found if 0 <= row["upto"] - p - 1 < row["count"]
        }
    # Per wanted position: the open range and the position among the rows in it.
    state = {p: (low, high, p) for p in positions}
    while any(lo < hi for lo, hi, _ in state.values()):
        ranges = sorted({(lo, hi) for lo, hi, _ in state.values() if lo < hi})
        widths = [-(-(hi - lo + 1) // BINS) for lo, hi in ranges]
        bins = [
            F.when(
                F.col("t").between(lo, hi),
                F.struct(F.lit(i).alias("range"), F.expr(f"(t - {lo}L) div {widths[i]}L").alias("bin")),
            )
            for i, (lo, hi) in enumerate(ranges)
        ]
        # At most BINS rows per range.
        histogram = (
            cells.select("count", F.inline(F.array_compact(F.array(*bins))))
            .groupBy("range", "bin")
            .agg(F.sum("count").alias("n"))
            .withColumn("upto", F.sum("n").over(Window.partitionBy("range").orderBy("bin")))
        )
        holds = [
            (F.col("range") == ranges.index((lo, hi)))
            & (F.col("upto") - F.col("n") <= at)
            & (F.col("upto") > at)
            for lo, hi, at in state.values()
            if lo < hi
        ]
        found = histogram.where(reduce(or_, holds)).collect()
        for p, (lo, hi, at) in state.items():
            for row in found:
                before = row["upto"] - row["n"]
                if lo < hi and ranges[row["range"]] == (lo, hi) and before <= at < row["upto"]:
                    start = lo + row["bin"] * widths[row["range"]]
                    end = min(hi, start + widths[row["range"]] - 1)
                    state[p] = (start, end, at - before)
    return {p: lo for p, (lo, _, _) in state.items()}


def time_thresholds(
    df: DataFrame, col: str, fractions: Sequence[float]
) -> dict[float, int | None]:
    """For each fraction p the largest value (as a number) with ``percent_rank <= p``.

    NULL ranks lowest; the result is None where only NULLs pass. ``df`` is scanned twice
    for all fractions together (once more if it has NULLs) and never sorted. The first
    scan sketches the quantiles. The second counts the values close to a wanted quantile
    one by one and all others together, and the exact position is looked up in those counts.
    """
    for p in fractions:
        if not 0 <= p <= 1:
            raise ValueError(f"fraction {p} is not between 0 and 1")
    numbers = df.select(_as_number(df, col).alias("t"))

    def sketch(shares: Sequence[float]) -> Column:
        """Quantiles a little below and above each share of the rows that have a time."""
        probes = [min(1.0, max(0.0, s + side * 3 / ACCURACY)) for s in shares for side in (-1, 1)]
        return F.percentile_approx("t", probes, ACCURACY)

    rows, filled, low, high, quantiles = numbers.agg(
        F.count(F.lit(1)), F.count("t"), F.min("t"), F.max("t"), sketch(fractions)
    ).first()
    positions = {p: _last_position(p, rows) - (rows - filled) for p in fractions}
    wanted = {at for at in positions.values() if at >= 0 and filled}
    if not wanted:
        return dict.fromkeys(fractions)
    if filled < rows:  # the shares were meant of all rows, so sketch again without the NULLs
        shares = [at / max(1, filled - 1) for at in sorted(wanted)]
        quantiles = numbers.agg(sketch(shares)).first()[0]
    near = sorted(zip(quantiles[::2], quantiles[1::2]))
    values = _near_positions(numbers, low, high, near, wanted)
    if values is None:  # the sketch missed: count every value
        values = _near_positions(numbers, low, high, [(low, high)], wanted)
    return {p: values[at] if at in values else None for p, at in positions.items()}


def _near_positions(
    numbers: DataFrame, low: int, high: int, near: list[tuple[int, int]], wanted: set[int]
) -> dict[int, int] | None:
    """The values at the wanted positions, or None if one lies outside the near ranges.

    A value outside of them counts as the first number above the range below it.
    """
    merged: list[tuple[int, int]] = []
    for lo, hi in near:
        if merged and lo <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
        else:
            merged.append((lo, hi))
    stand_in = F.lit(low)
    for lo, hi in merged:
        top = F.lit(hi if hi == high else hi + 1)
        stand_in = F.when(F.col("t") >= lo, F.least("t", top)).otherwise(stand_in)
    cells = numbers.where("t IS NOT NULL").select(stand_in.alias("t")).groupBy("t").count()
    with persisted(cells) as cells:
        values = _select_positions(cells, low, high, wanted)
    if all(any(lo <= v <= hi for lo, hi in merged) for v in values.values()):
        return values
    return None


def time_splits(
    df: DataFrame, ts: str, fractions: Sequence[float]
) -> dict[float, tuple[DataFrame, DataFrame]]:
    """(train, test) per fraction: train holds the rows with ``percent_rank <= fraction``.

    Rows with equal time stay on one side; rows without a time rank lowest.
    """
    splits = {}
    for p, number in time_thresholds(df, ts, fractions).items():
        early = F.col(ts).isNull()
        late = F.col(ts).isNotNull()
        if number is not None:
            early = early | (F.col(ts) <= _as_value(df, ts, number))
            late = F.col(ts) > _as_value(df, ts, number)
        splits[p] = (df.where(early), df.where(late))
    return splits


def time_split(df: DataFrame, ts: str, fraction: float) -> tuple[DataFrame, DataFrame]:
    """The first ``fraction`` of the rows by time, and the rest; see :func:`time_splits`."""
    return time_splits(df, ts, [fraction])[fraction]


def hash_split(
    df: DataFrame, key: str | Sequence[str], weights: Sequence[float], seed: int
) -> list[DataFrame]:
    """Random disjoint parts with sizes near ``weights``; rows with equal keys stay together."""
    if not weights or min(weights) < 0 or sum(weights) <= 0:
        raise ValueError("weights must be non-negative with a positive sum")
    bucket, total, parts, low = hash_bucket(key, seed), sum(weights), [], 0.0
    for i, weight in enumerate(weights):
        last = i == len(weights) - 1
        high = 1.0 if last else low + weight / total
        parts.append(df.where((bucket >= low) & (bucket < high)))
        low = high
    return parts


def hash_sample(
    df: DataFrame, key: str | Sequence[str], fraction: float, seed: int
) -> DataFrame:
    """A random sample of keys, each kept with probability ``fraction``."""
    return df.where(hash_bucket(key, seed) < fraction)


def hash_sample_by(
    df: DataFrame,
    key: str | Sequence[str],
    stratum: str,
    fractions: Mapping[Any, float],
    seed: int,
) -> DataFrame:
    """A random sample with one fraction per stratum; a stratum not listed is left out."""
    keep = F.lit(0.0)
    for value, fraction in fractions.items():
        keep = F.when(F.col(stratum) == value, F.lit(float(fraction))).otherwise(keep)
    return df.where(hash_bucket(key, seed) < keep)
