"""Every query of the subpackage runs on whole tables; where SQL states the result, it must agree."""

import os

import pytest

from millrace.llm.queries import ORACLES, QUERIES
from tests.oracle import canonical, duck_rows

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    result = QUERIES[name](spark, SF_DIR)
    columns, _, expected = duck_rows(SF_DIR, ORACLES[name])
    assert canonical(result.columns, [tuple(r) for r in result.collect()]) == canonical(columns, expected)


def test_names():
    import __spark_entry__ as entry

    numbers = {n.split("_")[0] for n in QUERIES}
    assert numbers == {f"op{i}" for i in range(1, 14)}
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


def test_shards_follow_the_prefix_sums(spark):
    rows = QUERIES["op5_byte_shards"](spark, SF_DIR).collect()
    total = sum(r["size"] for r in rows)
    before, slots = 0, {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["text_crc32"], r["size"])):
        shard = (2 * before + r["size"]) * 24 // (2 * total)
        slots[shard] = slots.get(shard, -1) + 1
        assert (r["shard"], r["slot"]) == (shard, slots[shard])
        before += r["size"]
