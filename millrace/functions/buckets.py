"""Hash buckets: a number in [0, 1) that depends on a row's key and a seed only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_bucket(key: str | Sequence[str], seed: int) -> Column:
    """First 32 bits of ``md5('seed:key')`` as a fraction.

    Equal keys always share a bucket, however the rows are partitioned and however
    often a task is run again. Use another seed for each further draw from the same
    rows, or the draws are not independent.
    """
    keys = [key] if isinstance(key, str) else list(key)
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    bits = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return bits / F.lit(4294967296.0)
