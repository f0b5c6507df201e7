"""Text, CSV and parquet scans and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from millrace.sources.scratch import scratch_path


def read_lines(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Text lines as one ``value`` column; compressed files are read as they are.

    One ``.gz`` file is read by one task. Give ``partitions`` to spread its lines over
    the cluster right after the scan, and land them once as parquet with
    :func:`materialise` when they are read more than once.
    """
    lines = spark.read.text(path)
    return lines if partitions is None else lines.repartition(partitions)


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    """CSV with a header; without a ``schema`` the types are inferred in an extra pass."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def materialise(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back: cuts the lineage and freezes the rows."""
    spark = df.sparkSession
    path = path or scratch_path(spark, "table")
    write_parquet(df, path)
    return read_parquet(spark, path)
