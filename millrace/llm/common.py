"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.joins import same_keys
from millrace.sources import read_parquet

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a narrow table that is broadcast to long texts rather than shuffled with them.
FEW = 1_000


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def wide_join(
    rows: DataFrame, slim: DataFrame, keys: Sequence[str], how: str, few: int = FEW
) -> DataFrame:
    """Join rows that carry long texts with a narrow, already written table (NULL equals NULL).

    The narrow side is broadcast if it has at most ``few`` rows. Else both sides are
    shuffled and the narrow one is hashed, so that the texts are never sorted. Returns the
    columns of ``rows`` and, unless ``how`` is a semi or anti join, the further ones of ``slim``.
    """
    small = slim.limit(few + 1).count() <= few
    right = F.broadcast(slim) if small else slim.hint("shuffle_hash")
    joined = rows.alias("l").join(right.alias("r"), same_keys(keys), how)
    if how in ("left_semi", "left_anti"):
        return joined
    added = [F.col(f"r.{c}") for c in slim.columns if c not in keys]
    return joined.select("l.*", *added)


def in_held_out(doc_id: int | None, folds: int = 5) -> bool:
    """Whether a document belongs to the fold that no model may learn from."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == 0


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """:func:`in_held_out` as a column; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))
