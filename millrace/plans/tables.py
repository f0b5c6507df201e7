"""Round trips through every source and sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import cast_columns, split_columns
from millrace.plans.inputs import table
from millrace.plans.registry import query
from millrace.sources import materialise, read_csv, read_lines, read_parquet, scratch_path, write_parquet

_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"""
_COLUMNS = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderpriority": "string",
}


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(*_COLUMNS)


@query("text_roundtrip", _SQL)
def text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited lines in gzip files, spread right after the scan, split and cast."""
    path = scratch_path(spark, "orders-text")
    lines = _orders(spark, sf_dir).select(F.concat_ws("|", *_COLUMNS).alias("value"))
    lines.write.option("compression", "gzip").text(path)
    partitions = spark.sparkContext.defaultParallelism
    fields = split_columns(read_lines(spark, path, partitions), list(_COLUMNS), sep="|")
    return cast_columns(fields, _COLUMNS)


@query("csv_roundtrip", _SQL)
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders-csv")
    _orders(spark, sf_dir).write.option("header", True).csv(path)
    schema = ", ".join(f"{name} {kind}" for name, kind in _COLUMNS.items())
    return read_csv(spark, path, schema)


@query("csv_inferred_types", _SQL)
def csv_inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above with inferred types; small whole numbers are inferred as int."""
    path = scratch_path(spark, "orders-csv")
    _orders(spark, sf_dir).write.option("header", True).csv(path)
    return cast_columns(read_csv(spark, path), {"o_orderkey": "bigint", "o_custkey": "bigint"})


@query("parquet_roundtrip", _SQL)
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders-parquet")
    write_parquet(_orders(spark, sf_dir), path)
    return read_parquet(spark, path)


@query("materialised_split", """SELECT side, count(*) AS rows, round(sum(o_totalprice), 2) AS total
    FROM (SELECT CASE WHEN o_orderkey % 10 < 7 THEN 'train' ELSE 'test' END AS side, o_totalprice
          FROM orders) GROUP BY side""")
def materialised_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = F.when(F.col("o_orderkey") % 10 < 7, "train").otherwise("test")
    frozen = materialise(_orders(spark, sf_dir).select(side.alias("side"), "o_totalprice"))
    return frozen.groupBy("side").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )
