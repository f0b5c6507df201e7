"""Joins of texts with narrow tables both ways, and the held-out fold."""

import zlib

import pytest
from pyspark.sql import functions as F

from millrace.llm.common import held_out, in_held_out, wide_join
from tests.helpers import rows


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_both_join_strategies_agree(spark, how):
    texts = spark.createDataFrame(
        [(1, "a"), (1, "a"), (2, "b"), (None, "none"), (None, "other"), (9, None)], "doc_id long, text string"
    )
    narrow = spark.createDataFrame(
        [(1, 10), (1, 11), (None, 12), (3, 13)], "doc_id long, salt int"
    )
    if how in ("left_semi", "left_anti"):
        narrow = narrow.select("doc_id")
    shuffled = wide_join(texts, narrow, ["doc_id"], how, few=0)
    broadcast = wide_join(texts, narrow, ["doc_id"], how)
    plan = shuffled._jdf.queryExecution().toString()
    assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" not in plan
    assert rows(shuffled) == rows(broadcast)
    size = {"inner": 6, "left": 8, "left_semi": 4, "left_anti": 2}[how]
    assert shuffled.count() == size
    assert wide_join(texts.where("false"), narrow, ["doc_id"], how, few=0).count() == 0


def test_held_out_fold(spark):
    ids = spark.createDataFrame([(i,) for i in [*range(200), None]], "doc_id long")
    for r in ids.select("doc_id", held_out(F.col("doc_id")).alias("out")).collect():
        assert r["out"] == in_held_out(r["doc_id"])
        assert r["doc_id"] is None or r["out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
