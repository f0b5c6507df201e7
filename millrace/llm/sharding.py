"""Contiguous shards of nearly equal bytes, from global prefix sums."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from millrace.llm.common import text_or_empty, wide_join
from millrace.sources import materialise

#: Bytes that a row costs besides its text.
ROW_BYTES = 8


def text_bytes(text: str = "text") -> Column:
    """UTF-8 bytes of a text (none for null) plus :data:`ROW_BYTES`."""
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + ROW_BYTES


def prefix_sums(rows: DataFrame, order: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """Add, for each ``name: column`` of ``sums``, the column's sum over all earlier rows.

    ``rows`` should be narrow. They are cut into ranges of the ``order`` columns (nulls first), and each task
    sums its sorted range as a stream. The ranges are written, then shifted by the totals of
    the ranges before them: one number per range, whatever the number of rows. Rows that
    agree in all order columns stay in one range, in any order.
    """
    names = list(sums)
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    added = [StructField(f"_{n}", LongType()) for n in names] + [StructField("_range", IntegerType())]
    schema = StructType([*rows.schema.fields, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = dict.fromkeys(names, 0)
        for batch in batches:
            columns = {c: batch.column(c) for c in batch.schema.names}
            place = columns.pop("_range")
            for name, column in sums.items():
                values = columns[column].to_numpy(zero_copy_only=False).astype(np.int64)
                ends = carried[name] + np.cumsum(values)
                columns[f"_{name}"] = pa.array(ends - values)
                carried[name] = int(ends[-1]) if len(ends) else carried[name]
            yield pa.RecordBatch.from_pydict(columns | {"_range": place})

    local = materialise(ranged.withColumn("_range", F.spark_partition_id()).mapInArrow(run, schema))
    totals = local.groupBy("_range").agg(*[F.sum(c).alias(f"_total_{n}") for n, c in sums.items()])
    found = sorted(tuple(r) for r in totals.collect())
    shifts = [accumulate([0, *[r[k + 1] for r in found]]) for k in range(len(names))]
    before = [(r[0], *s) for r, *s in zip(found, *shifts)]
    shift_schema = "_range int, " + ", ".join(f"_shift_{n} long" for n in names)
    shifted = rows.sparkSession.createDataFrame(before, shift_schema)
    out = local.join(F.broadcast(shifted), "_range")
    return out.select(
        *rows.columns, *[(F.col(f"_{n}") + F.col(f"_shift_{n}")).alias(n) for n in names]
    )


def assign_shards(rows: DataFrame, size: str, order: Sequence[str], shards: int) -> DataFrame:
    """Add shard (0 to ``shards`` - 1) and slot (from 0 within the shard) to narrow rows.

    In the order given, the row whose middle byte lies in the k-th of ``shards`` equal parts of all bytes
    goes to shard k. So shards are contiguous, and a shard's bytes differ from the target by
    at most one row's at either end. Sizes must be positive; an empty table stays empty.
    """
    numbered = rows.withColumn("_one", F.lit(1).cast("long"))
    placed = prefix_sums(numbered, order, {"_before": size, "_number": "_one"})
    total = rows.agg(F.sum(size)).first()[0] or 1
    middle = (2 * F.col("_before") + F.col(size)) * shards
    placed = placed.withColumn("shard", F.floor(middle / F.lit(2 * total)).cast("int"))
    # One row per shard.
    starts = placed.groupBy("shard").agg(F.min("_number").alias("_first"))
    out = placed.join(F.broadcast(starts), "shard")
    return out.select(*rows.columns, "shard", (F.col("_number") - F.col("_first")).alias("slot"))


def shard_documents(docs: DataFrame, shards: int, keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, size, text_crc32, the columns ``keep``, shard and slot for all rows.

    Documents are in the order of doc_id, then of checksum and size; a null id comes first. A null
    text has size :data:`ROW_BYTES` and the checksum of the empty text. Repeated rows each
    get a slot of their own. Very long texts are measured whole and an empty table stays empty. Names in ``keep`` that
    the result has anyway mean the result's own columns, not those of ``docs``. The texts are read once: the narrow rows are written.
    """
    own = ("doc_id", "size", "text_crc32", "shard", "slot")
    narrow = docs.select(
        "doc_id", text_bytes().alias("size"), F.crc32(text_or_empty()).alias("text_crc32"),
        *[c for c in keep if c not in own],
    )
    return assign_shards(materialise(narrow), "size", ["doc_id", "text_crc32", "size"], shards)


def write_shards(docs: DataFrame, placed: DataFrame, path: str) -> None:
    """Write whole documents into one folder per shard, rows in slot order within each file.

    ``placed`` comes from :func:`shard_documents`; ids must be unique and not null. Columns
    shard and slot of ``docs`` are replaced.
    """
    places = materialise(placed.select("doc_id", "shard", "slot"))
    rows = wide_join(docs.drop("shard", "slot"), places, ["doc_id"], "inner")
    spread = rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    spread.write.mode("overwrite").partitionBy("shard").parquet(path)
