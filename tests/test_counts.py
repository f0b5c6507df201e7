import pytest

from millrace.operators import activity_grid, concat_group, top_k, topk_with_others
from tests.helpers import rows


def keys(spark, text):
    return spark.createDataFrame([(c if c != "_" else None,) for c in text], "k STRING")


def test_topk_with_others(spark):
    out = topk_with_others(keys(spark, "aaabbcd"), "k", k=2)
    assert [(r, k, n) for r, k, n, _ in rows(out)] == [(1, "a", 3), (2, "b", 2), (3, "Others", 2)]
    assert sum(r["share_pct"] for r in out.collect()) == pytest.approx(100)


def test_topk_with_few_groups_has_no_remainder(spark):
    assert [r[:3] for r in rows(topk_with_others(keys(spark, "aab"), "k", k=2))] == [
        (1, "a", 2), (2, "b", 1)
    ]
    assert rows(topk_with_others(keys(spark, ""), "k", k=2)) == []


def test_topk_ties_go_to_the_smaller_key_and_null_is_a_group(spark):
    assert [r[:3] for r in rows(topk_with_others(keys(spark, "cba__"), "k", k=2))] == [
        (1, None, 2), (2, "a", 1), (3, "Others", 2)
    ]


def test_a_group_called_others_keeps_its_row(spark):
    df = spark.createDataFrame([("Others",)] * 3 + [("a",), ("b",)], "k STRING")
    assert [r[:3] for r in rows(topk_with_others(df, "k", k=1))] == [
        (1, "Others", 3), (2, "Others", 2)
    ]


def test_topk_per_group_with_many_keys(spark):
    df = spark.range(3000).selectExpr("id % 2 AS g", "id DIV 2 AS k", "1000 + id DIV 2 AS count")
    assert rows(top_k(df, "k", 3, by=["g"]), "g", "rank", "k") == [
        (g, r, 1500 - r) for g in (0, 1) for r in (1, 2, 3)
    ]
    shares = topk_with_others(df.select("g", "k"), "k", k=1, by=["g"])
    assert rows(shares, "g", "rank", "count") == [(0, 1, 1), (0, 2, 1499), (1, 1, 1), (1, 2, 1499)]


def test_grid_is_dense_and_numeric(spark):
    df = spark.createDataFrame([("09", "1"), ("11", "1"), ("11", "1"), (None, "2"), ("x", "3")], "d STRING, h STRING")
    grid = activity_grid(df, "d", "h")
    assert grid.count() == 3 * 24
    assert rows(grid.where("count > 0")) == [(11, 1, 2), (9, 1, 1)]
    assert activity_grid(df.limit(0), "d", "h").count() == 0


def test_concat_group_sorts_and_keeps_copies(spark):
    df = spark.createDataFrame(
        [(1, "b"), (1, "a"), (1, "b"), (2, None), (3, ""), (None, "z"), (1, None)], "k INT, v STRING"
    )
    assert rows(concat_group(df, "k", "v")) == [
        (1, 0, "a|b|b"), (2, 0, ""), (3, 0, ""), (None, 0, "z")
    ]


@pytest.mark.parametrize("size", [1, 3, 100])
def test_concat_group_continues_long_groups(spark, size):
    values = ["a"] * 5 + ["b"] + ["c"] * 7 + [None]
    df = spark.createDataFrame([(1, v) for v in values], "k INT, v STRING")
    parts = [r["text"] for r in concat_group(df, "k", "v", max_items=size).orderBy("part").collect()]
    assert "|".join(parts) == "|".join(v for v in values if v)
    assert all(len(p.split("|")) == size for p in parts[:-1])
