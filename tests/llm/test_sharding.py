"""Shards against plain prefix sums, files read back, and edge rows."""

import random
import zlib

from millrace.llm.sharding import prefix_sums, shard_documents, write_shards
from tests.helpers import rows


def test_prefix_sums(spark):
    rng = random.Random(3)
    data = [(rng.randrange(40), i, rng.randrange(100)) for i in range(700)]
    df = spark.createDataFrame(data, "k long, i long, n long").repartition(9)
    found = {r["i"]: r["before"] for r in prefix_sums(df, ["k", "i"], {"before": "n"}).collect()}
    total = 0
    for _, i, n in sorted(data):
        assert found[i] == total
        total += n


def test_contiguous_and_balanced(spark):
    rng = random.Random(8)
    data = [(i, "é" * rng.choice([1, 10, 3000]), i % 3) for i in rng.sample(range(10_000), 600)]
    df = spark.createDataFrame(data, "doc_id long, text string, shard int")
    placed = sorted(shard_documents(df, 7).collect(), key=lambda r: r["doc_id"])
    assert [r["shard"] for r in placed] == sorted(r["shard"] for r in placed)
    sizes = {}
    for r, (_, text, _) in zip(placed, sorted(data)):
        assert r["size"] == len(text.encode()) + 8 and r["text_crc32"] == zlib.crc32(text.encode())
        assert r["slot"] == len(sizes.setdefault(r["shard"], []))
        sizes[r["shard"]].append(r["size"])
    total = sum(map(sum, sizes.values()))
    assert len(sizes) == 7 and all(abs(sum(s) - total / 7) <= 6008 for s in sizes.values())


def test_files(spark, tmp_path):
    data = [(i, f"text {i}" * (i % 9), -1) for i in range(200)]
    df = spark.createDataFrame(data, "doc_id long, text string, slot int")
    placed = shard_documents(df, 4)
    write_shards(df, placed, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert rows(back, "doc_id", "shard", "slot") == rows(placed, "doc_id", "shard", "slot")
    assert rows(back, "doc_id", "text") == rows(df, "doc_id", "text")


def test_edge_rows(spark):
    long = "x" * 400_000
    df = spark.createDataFrame(
        [(None, None), (None, "a"), (3, "same"), (3, "same"), (3, long), (4, "")], "doc_id long, text string"
    )
    got = rows(shard_documents(df, 3), "doc_id", "size", "shard", "slot")
    assert {(d, s) for d, s, _, _ in got} == {(None, 8), (None, 9), (3, 12), (3, 400_008), (4, 8)} and len(got) == 6
    for shard in {r[2] for r in got}:
        slots = sorted(r[3] for r in got if r[2] == shard)
        assert slots == list(range(len(slots)))
    assert shard_documents(df.where("false"), 3).collect() == []


def test_kept_columns_with_names_of_the_result(spark):
    df = spark.createDataFrame([(1, "abc", 99, 98, "a"), (2, None, 97, 96, "b")], "doc_id long, text string, size int, slot int, source string")
    got = shard_documents(df, 2, keep=["size", "source", "slot", "doc_id"])
    assert sorted(got.columns) == ["doc_id", "shard", "size", "slot", "source", "text_crc32"]
    assert {(r["doc_id"], r["size"], r["source"], r["slot"]) for r in got.collect()} == {(1, 11, "a", 0), (2, 8, "b", 0)}
