"""The operators' inputs, derived from the driver's tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources import read_parquet
from millrace.sources.schemas import HIGGS_FEATURES

DOMAINS = [
    "tohoku.ac.jp",
    "keio.ac.jp",
    "rl.ac.uk",
    "ucl.ac.uk",
    "mit.edu",
    "tamu.edu",
    "aol.com",
]
RATING_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log line per event: value."""
    events = table(spark, sf_dir, "events")
    domain = F.get(F.array(*map(F.lit, DOMAINS)), (F.col("user_id") % len(DOMAINS)).cast("int"))
    size = F.when(F.col("event_type") == "error", "-").otherwise(
        F.floor("value").cast("string")
    )
    return events.select(
        F.concat(
            F.lit("h"), "user_id", F.lit("."), domain, F.lit(" - - ["),
            F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(' -0400] "GET /'), "event_type",
            F.lit(' HTTP/1.0" 200 '), size,
        ).alias("value")
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating per order line: the line's key, userId, movieId, rating, ts."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select(*RATING_KEY, "l_quantity")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        *RATING_KEY,
        F.col("o_custkey").cast("int").alias("userId"),
        F.col("l_partkey").cast("int").alias("movieId"),
        (1 + F.floor(F.col("l_quantity") / 12.5)).cast("float").alias("rating"),
        F.col("o_orderdate").alias("ts"),
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One movie per part: movieId, title, genres."""
    genres = F.concat_ws("|", F.replace("p_name", F.lit(" "), F.lit("|")), "p_type")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("movieId"),
        F.col("p_name").alias("title"),
        genres.alias("genres"),
    )


def higgs_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One comma separated record per vector: vec_id, value."""
    fields = [F.get("embedding", i).cast("string") for i in range(len(HIGGS_FEATURES))]
    label = F.when(F.col("label") >= 5, "1").otherwise("0")
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.concat_ws(",", label, *fields).alias("value")
    )


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One claim record per event."""
    make = F.when(F.col("user_id") % 10 == 0, "?").otherwise(
        F.concat(F.lit("M"), F.col("user_id") % 7)
    )
    amount = F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(0.0)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("Row_ID"),
        F.col("user_id").alias("Household_ID"),
        make.alias("Blind_Make"),
        F.col("event_type").alias("OrdCat"),
        F.hour("ts").alias("Var1"),
        F.get_json_object("props", "$.k").try_cast("int").alias("Var2"),
        amount.alias("Claim_Amount"),
    )


_DOMAIN_LIST = ", ".join(f"'{d}'" for d in DOMAINS)

ACCESS_LOG_SQL = f"""
access_log AS (
  SELECT 'h' || user_id || '.' || ([{_DOMAIN_LIST}])[user_id % 7 + 1] || ' - - ['
      || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' -0400] "GET /' || event_type
      || ' HTTP/1.0" 200 '
      || CASE WHEN event_type = 'error' THEN '-'
              ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS value
  FROM events),
parsed AS (
  SELECT regexp_extract(value, '^(.*) - -.*', 1) AS host,
         regexp_extract(value, '.* - - \\[(.*)\\].*', 1) AS "timestamp",
         regexp_extract(value, '.*"(.*)".*', 1) AS request,
         TRY_CAST(string_split(value, ' ')[-2] AS INTEGER) AS status,
         TRY_CAST(string_split(value, ' ')[-1] AS INTEGER) AS bytes
  FROM access_log),
timed AS (
  SELECT *, string_split("timestamp", ':')[2] AS hour, string_split("timestamp", '/')[1] AS day
  FROM parsed),
regional AS (
  SELECT *,
    CASE WHEN host LIKE '%.ac.jp' THEN 'Japan' WHEN host LIKE '%.ac.uk' THEN 'UK' ELSE 'US' END
      AS region,
    array_to_string(
      list_slice(string_split(host, '.'), CASE WHEN host LIKE '%.edu' THEN -2 ELSE -3 END, -1),
      '.') AS domain
  FROM timed
  WHERE host LIKE '%.ac.jp' OR host LIKE '%.ac.uk' OR host LIKE '%.edu'),
domain_counts AS (
  SELECT region, domain, count(*) AS "count",
         row_number() OVER (PARTITION BY region ORDER BY count(*) DESC, domain) AS rank
  FROM regional GROUP BY region, domain)
"""

RATINGS_SQL = """
ratings AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CAST(o_custkey AS INTEGER) AS userId, CAST(l_partkey AS INTEGER) AS movieId,
         CAST(1 + floor(l_quantity / 12.5) AS FLOAT) AS rating, o_orderdate AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
movies AS (
  SELECT CAST(p_partkey AS INTEGER) AS movieId, p_name AS title,
         replace(p_name, ' ', '|') || '|' || p_type AS genres
  FROM part),
ranked AS (
  SELECT *, percent_rank() OVER (ORDER BY ts NULLS FIRST) AS pr FROM ratings)
"""

CLAIMS_SQL = """
claims AS (
  SELECT event_id AS Row_ID, user_id AS Household_ID,
         CASE WHEN user_id % 10 = 0 THEN '?' ELSE 'M' || (user_id % 7) END AS Blind_Make,
         event_type AS OrdCat, CAST(hour(ts) AS INTEGER) AS Var1,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS Var2,
         CASE WHEN event_type = 'purchase' THEN value ELSE 0.0 END AS Claim_Amount
  FROM events)
"""


def bucket_sql(seed: int, *keys: str) -> str:
    """The hash bucket of the given key columns."""
    text = " || ':' || ".join([f"'{seed}'", *keys])
    return f"(CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT) / 4294967296.0)"
