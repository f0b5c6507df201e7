"""Access-log queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import (
    count_by_suffix,
    filter_suffix,
    log_time_parts,
    parse_access_log,
    top_domain_activity,
    top_domains,
    topk_with_others,
    with_region,
)
from millrace.plans.inputs import ACCESS_LOG_SQL, access_log
from millrace.plans.registry import query

SUFFIXES = {"Japan": ".ac.jp", "UK": ".ac.uk", "US": ".edu"}


@query(
    "log_parse_summary",
    f"""WITH {ACCESS_LOG_SQL}
    SELECT host, request, status, count(*) AS requests, CAST(sum(bytes) AS BIGINT) AS sum_bytes,
           count(*) - count(bytes) AS no_bytes,
           min("timestamp") AS first_text,
           CAST(max(strptime(substr("timestamp", 1, 20), '%d/%b/%Y:%H:%M:%S')) AS VARCHAR) AS last_ts
    FROM parsed GROUP BY host, request, status""",
)
def log_parse_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_access_log(access_log(spark, sf_dir))
    return parsed.groupBy("host", "request", "status").agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum("bytes").alias("sum_bytes"),
        F.count_if(F.col("bytes").isNull()).alias("no_bytes"),
        F.min("timestamp").alias("first_text"),
        F.max("ts").cast("string").alias("last_ts"),
    )


@query(
    "requests_by_suffix",
    f"""WITH {ACCESS_LOG_SQL}
    SELECT 'Japan' AS label, count(*) FILTER (host LIKE '%.ac.jp') AS "count" FROM parsed
    UNION ALL SELECT 'UK', count(*) FILTER (host LIKE '%.ac.uk') FROM parsed
    UNION ALL SELECT 'US', count(*) FILTER (host LIKE '%.edu') FROM parsed""",
)
def requests_by_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by_suffix(parse_access_log(access_log(spark, sf_dir)), "host", SUFFIXES)


@query(
    "suffix_hosts",
    f"""WITH {ACCESS_LOG_SQL}
    SELECT host, count(*) AS "count" FROM parsed WHERE host LIKE '%.edu' GROUP BY host""",
)
def suffix_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_access_log(access_log(spark, sf_dir))
    return filter_suffix(parsed, "host", ".edu").groupBy("host").count()


@query(
    "requests_by_day_hour",
    f"""WITH {ACCESS_LOG_SQL}
    SELECT day, hour, count(*) AS "count" FROM timed GROUP BY day, hour""",
)
def requests_by_day_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = log_time_parts(parse_access_log(access_log(spark, sf_dir)))
    return timed.groupBy("day", "hour").count()


@query(
    "log_day_bounds",
    f"""WITH {ACCESS_LOG_SQL}
    SELECT region, min(CAST(day AS INTEGER)) AS first_day, max(CAST(day AS INTEGER)) AS last_day
    FROM regional WHERE domain IN ('tohoku.ac.jp', 'tamu.edu') GROUP BY region""",
)
def log_day_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = log_time_parts(parse_access_log(access_log(spark, sf_dir)))
    day = F.col("day").try_cast("int")
    return (
        with_region(timed)
        .where(F.col("domain").isin("tohoku.ac.jp", "tamu.edu"))
        .groupBy("region")
        .agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    )


@query(
    "top_domains",
    f"""WITH {ACCESS_LOG_SQL}
    SELECT region, CAST(rank AS INTEGER) AS rank, domain, "count" FROM domain_counts
    WHERE rank <= 9""",
)
def top_domains_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_domains(parse_access_log(access_log(spark, sf_dir)), k=9)


@query(
    "domain_share_with_others",
    f"""WITH {ACCESS_LOG_SQL},
    labelled AS (
      SELECT region, CAST(least(rank, 2) AS INTEGER) AS rank,
             CASE WHEN rank <= 1 THEN domain ELSE 'Others' END AS domain, "count"
      FROM domain_counts)
    SELECT region, rank, domain, CAST(sum("count") AS BIGINT) AS "count",
           round(100.0 * sum("count") / sum(sum("count")) OVER (PARTITION BY region), 6)
             AS share_pct
    FROM labelled GROUP BY region, rank, domain""",
)
def domain_share_with_others(spark: SparkSession, sf_dir: str) -> DataFrame:
    regional = with_region(parse_access_log(access_log(spark, sf_dir)))
    shares = topk_with_others(regional, "domain", k=1, by=["region"])
    return shares.withColumn("share_pct", F.round("share_pct", 6))


@query(
    "host_share_with_others",
    f"""WITH {ACCESS_LOG_SQL},
    hosts AS (
      SELECT host, count(*) AS "count", row_number() OVER (ORDER BY count(*) DESC, host) AS rank
      FROM parsed GROUP BY host)
    SELECT CAST(least(rank, 10) AS INTEGER) AS rank,
           CASE WHEN rank <= 9 THEN host ELSE 'Others' END AS host,
           CAST(sum("count") AS BIGINT) AS "count",
           round(100.0 * sum("count") / (SELECT count(*) FROM parsed), 6) AS share_pct
    FROM hosts GROUP BY 1, 2""",
)
def host_share_with_others(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_access_log(access_log(spark, sf_dir))
    return topk_with_others(parsed, "host", k=9).withColumn("share_pct", F.round("share_pct", 6))


@query(
    "domain_hour_grid",
    f"""WITH {ACCESS_LOG_SQL},
    busiest AS (
      SELECT r.region, r.domain, CAST(day AS INTEGER) AS day, CAST(hour AS INTEGER) AS hour
      FROM regional r JOIN domain_counts c
        ON r.region = c.region AND r.domain = c.domain AND c.rank = 1),
    bounds AS (
      SELECT region, domain, min(day) AS lo, max(day) AS hi FROM busiest GROUP BY region, domain),
    cells AS (
      SELECT region, domain, CAST(d.day AS INTEGER) AS day, CAST(h.hour AS INTEGER) AS hour
      FROM bounds, generate_series(1, 31) AS d(day), generate_series(0, 23) AS h(hour)
      WHERE d.day BETWEEN lo AND hi)
    SELECT c.region, c.domain, c.day, c.hour, count(b.day) AS "count"
    FROM cells c LEFT JOIN busiest b
      ON b.region = c.region AND b.domain = c.domain AND b.day = c.day AND b.hour = c.hour
    GROUP BY c.region, c.domain, c.day, c.hour""",
)
def domain_hour_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_domain_activity(log_time_parts(parse_access_log(access_log(spark, sf_dir))))
