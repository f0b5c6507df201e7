"""Access-log mining: parse lines, assign hosts to regions, rank domains, map activity."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import host_domain, item, item_from_end
from millrace.operators.counts import top_k
from millrace.operators.grids import activity_grid

# The three field patterns of a log line.
HOST_PATTERN = r"^(.*) - -.*"
TIME_PATTERN = r".* - - \[(.*)\].*"
REQUEST_PATTERN = r'.*"(.*)".*'

MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

# Region label -> (host suffix, number of labels that name the organisation).
REGIONS: dict[str, tuple[str, int]] = {
    "Japan": (".ac.jp", 3),
    "UK": (".ac.uk", 3),
    "US": (".edu", 2),
}


def _wall_clock(text: Column) -> Column:
    """``01/Jul/1995:00:00:01 -0400`` as the zone-free time printed in the log."""
    months = F.create_map(*[F.lit(x) for n, m in enumerate(MONTHS, 1) for x in (m, f"{n:02d}")])
    date = item(text, ":", 0)
    iso_date = F.concat(
        item(date, "/", 2), F.lit("-"), F.try_element_at(months, item(date, "/", 1)), F.lit("-"),
        item(date, "/", 0),
    )
    clock = F.regexp_extract(text, r":(\d{2}:\d{2}:\d{2})", 1)
    return F.concat(iso_date, F.lit(" "), clock).try_cast("timestamp_ntz")


def parse_access_log(lines: DataFrame, col: str = "value") -> DataFrame:
    """Split log lines into host, timestamp, request, status, bytes and ``ts``.

    Every line gives one row: a text field that does not match is ``''``, a number that
    does not parse is NULL. ``ts`` is the wall clock as printed, without its offset.
    """
    line = F.col(col)
    fields = lines.select(
        F.regexp_extract(line, HOST_PATTERN, 1).alias("host"),
        F.regexp_extract(line, TIME_PATTERN, 1).alias("timestamp"),
        F.regexp_extract(line, REQUEST_PATTERN, 1).alias("request"),
        item_from_end(line, " ", 2).try_cast("int").alias("status"),
        item_from_end(line, " ", 1).try_cast("int").alias("bytes"),
    )
    return fields.withColumn("ts", _wall_clock(F.col("timestamp")))


def log_time_parts(df: DataFrame, col: str = "timestamp") -> DataFrame:
    """Add ``hour`` and ``day`` (of the month) as the zero padded text of the log."""
    local = item(F.col(col), "-", 0)
    return df.withColumns(
        {"hour": item(local, ":", 1), "day": item(item(local, ":", 0), "/", 0)}
    )


def with_region(
    df: DataFrame, regions: Mapping[str, tuple[str, int]] = REGIONS, host: str = "host"
) -> DataFrame:
    """Keep the rows of the given regions and add ``region`` and ``domain``.

    One pass for all regions; a host that ends with two of the suffixes appears in both.
    """
    matches = [
        F.when(
            F.col(host).endswith(suffix),
            F.struct(F.lit(label).alias("region"), host_domain(host, n).alias("domain")),
        )
        for label, (suffix, n) in regions.items()
    ]
    return df.select("*", F.inline(F.array_compact(F.array(*matches))))


def top_domains(
    df: DataFrame, regions: Mapping[str, tuple[str, int]] = REGIONS, k: int = 9
) -> DataFrame:
    """The ``k`` domains with the most requests in each region: region, rank, domain, count."""
    counts = with_region(df.select("host"), regions).groupBy("region", "domain").count()
    return top_k(counts, "domain", k, by=["region"]).select("region", "rank", "domain", "count")


def top_domain_activity(
    df: DataFrame, regions: Mapping[str, tuple[str, int]] = REGIONS
) -> DataFrame:
    """Day by hour request counts of each region's busiest domain, empty hours included.

    ``df`` needs ``host``, ``day`` and ``hour``. A row whose time is no day 1-31 or no
    hour 0-23 (an unparsed line) has no place in the grid.
    """
    # One pass over the log: both the ranking and the grid read these counts. A filter on
    # day and hour alone would be pushed below the counting and parse each line twice over.
    counts = (
        with_region(df.select("host", "day", "hour"), regions)
        .groupBy("region", "domain", "day", "hour")
        .count()
    )
    totals = counts.groupBy("region", "domain").agg(F.sum("count").alias("count"))
    # One row per region, so the broadcast side never exceeds len(regions) rows.
    busiest = top_k(totals, "domain", 1, by=["region"]).select("region", "domain")
    hours = (
        counts.join(F.broadcast(busiest), ["region", "domain"])
        .withColumns({"day": F.col("day").try_cast("int"), "hour": F.col("hour").try_cast("int")})
        .where(F.when(F.col("day").between(1, 31) & F.col("hour").between(0, 23), F.col("count")) > 0)
    )
    return activity_grid(hours, "day", "hour", by=["region", "domain"], weight="count")
