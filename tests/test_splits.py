from datetime import date, datetime, timedelta
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.operators import (
    hash_sample,
    hash_sample_by,
    hash_split,
    heavy_groups,
    lookup_join,
    percent_rank_by,
    running_start,
    time_split,
    time_splits,
    time_thresholds,
)
from millrace.operators import splits
from tests.helpers import rows

FRACTIONS = [0.0, 0.25, 0.5, 0.65, 0.8, 1.0]


def times(spark, values, kind="int"):
    return spark.createDataFrame(list(enumerate(values)), f"id INT, ts {kind}")


def expected_train(df, p):
    ranked = df.withColumn("pr", F.percent_rank().over(Window.orderBy("ts")))
    return sorted(r["id"] for r in ranked.where(F.col("pr") <= p).collect())


CASES = {
    "equal": [5] * 9,
    "one": [3],
    "two": [9, 3],
    "ties across the cut": [1, 2, 2, 2, 2, 2, 3, 4, 5, 6, 7],
    "hot": [7] * 200 + list(range(100)),
    "nulls": [None, None, 4, None, 1, 2, 3],
    "only nulls": [None, None],
    "wide": [-(2**31), 2**31 - 1, 0, 1, -1, 2**20, 2**30, 5, 5],
    "spread": [(i * 7919) % 100003 for i in range(500)],
    "exact positions": list(range(21)),
}


def threshold(values, p):
    """By the definition: the largest value whose percent rank is at most p."""
    ordered = sorted(values, key=lambda v: (v is not None, v))
    n = len(ordered)
    ranks = {v: ordered.index(v) / (n - 1) if n > 1 else 0.0 for v in ordered}
    passing = [v for v in ordered if ranks[v] <= p and v is not None]
    return max(passing) if passing else None


THRESHOLDS = {case: {p: threshold(v, p) for p in FRACTIONS} for case, v in CASES.items()}


@pytest.mark.parametrize("case", CASES)
def test_time_splits_follow_the_definition(spark, case):
    df = times(spark, CASES[case])
    sides = [
        side.select(F.lit(p).alias("p"), F.lit(name).alias("side"), "id")
        for p, pair in time_splits(df, "ts", FRACTIONS).items()
        for name, side in zip(("train", "test"), pair)
    ]
    got = rows(reduce(DataFrame.unionByName, sides))
    want = []
    for p in FRACTIONS:
        top = THRESHOLDS[case][p]
        for i, v in enumerate(CASES[case]):
            early = v is None or (top is not None and v <= top)
            want.append((p, "train" if early else "test", i))
    assert got == sorted(want, key=repr)


def test_time_split_equals_percent_rank(spark):
    df = times(spark, CASES["nulls"] + CASES["hot"])
    for p, (train, _) in time_splits(df, "ts", [0.25, 0.65]).items():
        assert sorted(r["id"] for r in train.collect()) == expected_train(df, p)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "bigint"])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_time_split_of_each_type(spark, kind, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        start = datetime(1995, 4, 1, 20, 0, 0, 123457)
        values = [start + timedelta(minutes=17 * i, microseconds=i * i) for i in range(60)]
        if kind == "date":
            values = [date(1969, 12, 1) + timedelta(days=i % 40) for i in range(60)]
        if kind == "bigint":
            values = [(i - 30) * 10**15 for i in range(60)]
        df = times(spark, values, kind)
        train, _ = time_split(df, "ts", 0.65)
        assert sorted(r["id"] for r in train.collect()) == expected_train(df, 0.65)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_time_split_of_nothing_and_of_bad_input(spark):
    train, test = time_split(times(spark, []), "ts", 0.5)
    assert train.count() == test.count() == 0
    with pytest.raises(TypeError):
        time_split(times(spark, ["a"], "string"), "ts", 0.5)
    with pytest.raises(ValueError):
        time_split(times(spark, [1]), "ts", 1.5)


def test_time_split_filter_is_pushed_down(spark, tmp_path):
    times(spark, list(range(100))).write.parquet(str(tmp_path / "t"))
    train, test = time_split(spark.read.parquet(str(tmp_path / "t")), "ts", 0.5)
    for side in (train, test):
        plan = side._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [" in plan and "Than" in plan.split("PushedFilters: [")[1]


@pytest.mark.parametrize("case", ["hot", "wide", "spread"])
def test_time_splits_by_rounds_of_bins(spark, monkeypatch, case):
    monkeypatch.setattr(splits, "BINS", 64)
    df = times(spark, CASES[case])
    assert time_thresholds(df, "ts", FRACTIONS) == pytest.approx(THRESHOLDS[case])


def test_time_split_when_the_sketch_misses(spark, monkeypatch):
    """Probes that do not enclose the quantile: the search goes over the whole range."""
    df = times(spark, [(i * 7919) % 100003 for i in range(500)])
    want = time_thresholds(df, "ts", [0.5])
    monkeypatch.setattr(
        splits.F, "percentile_approx", lambda *_: F.array(F.lit(3), F.lit(9))
    )
    assert time_thresholds(df, "ts", [0.5]) == want


@pytest.mark.parametrize("case", ["one", "hot", "nulls", "spread"])
def test_global_percent_rank(spark, case):
    df = times(spark, CASES[case])
    native = df.withColumn("pr", F.percent_rank().over(Window.orderBy("ts")))
    ours = percent_rank_by(df, "ts", out="pr", easy_rows=1)
    assert rows(ours, "id", "pr") == rows(native, "id", "pr")


def test_percent_rank_of_hot_and_null_partitions(spark):
    data = [(i, i % 7 if i % 3 else 0, (i * 37) % 50 if i % 5 else None) for i in range(2000)]
    data += [(5000 + i, None, i) for i in range(10)]
    df = spark.createDataFrame(data, "id INT, p INT, ts INT")
    native = df.withColumn("pr", F.percent_rank().over(Window.partitionBy("p").orderBy("ts")))
    for limits in ({}, {"slots": 5, "easy_rows": 100}, {"slots": 1000, "easy_rows": 1}):
        ours = percent_rank_by(df, "ts", ["p"], out="pr", **limits)
        assert ours.columns == ["id", "p", "ts", "pr"]
        assert rows(ours) == rows(native)


def test_running_start_over_many_ranges(spark):
    df = spark.range(5000).selectExpr("id % 3 DIV 2 AS g", "id AS o", "id % 4 AS w")
    window = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("g", "o", F.coalesce(F.sum("w").over(window), F.lit(0)).alias("start"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ours = running_start(df, "o", "w", by=["g"])
        assert rows(ours, "g", "o", "start") == rows(want)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    totals = ours.select("g", "start_total").distinct()
    assert rows(totals) == rows(df.groupBy("g").agg(F.sum("w")))


@pytest.mark.parametrize("slots, heavy", [(1, 0), (3, 1), (1000, 4)])
def test_lookup_join_with_a_hot_key(spark, slots, heavy):
    left = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 0), (None, 1), (9, 9)], "k INT, v INT")
    right = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n"), (3, "c")], "k INT, name STRING")
    want = sorted([(1, i, "a") for i in range(50)] + [(2, 0, "b"), (None, 1, "n")], key=repr)
    assert rows(lookup_join(left, right, ["k"], slots=slots, easy_rows=1)) == want
    counts = left.groupBy("k").count()
    counted = right.join(counts, right.k.eqNullSafe(counts.k), "left").select(right.k, "name", "count")
    assert rows(lookup_join(left, counted, ["k"], "count", slots=slots, easy_rows=1)) == want
    assert heavy_groups(counts, slots=slots, easy_rows=1).count() == heavy
    assert heavy_groups(counts, slots=slots, easy_rows=51).isEmpty()


def test_lookup_join_with_several_rows_per_key(spark):
    left = spark.createDataFrame([(1, i) for i in range(20)] + [(2, 0)], "k INT, v INT")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d")], "k INT, name STRING")
    want = sorted([(1, i, n) for i in range(20) for n in "ab"] + [(2, 0, "c")], key=repr)
    for slots in (1, 2, 3, 10):
        assert rows(lookup_join(left, right, ["k"], slots=slots, easy_rows=1)) == want


def test_hash_split_ignores_partitioning(spark):
    df = spark.range(5000)
    first = [rows(part) for part in hash_split(df.repartition(3), "id", [0.7, 0.3], seed=42)]
    again = [rows(part) for part in hash_split(df.repartition(11), "id", [7, 3], seed=42)]
    assert first == again
    assert abs(len(first[0]) - 3500) < 150
    assert sorted(first[0] + first[1], key=repr) == rows(df)
    other = rows(hash_split(df, "id", [0.7, 0.3], seed=43)[0])
    assert other != first[0]
    assert abs(len(set(other) & set(first[0])) - 2450) < 150


def test_hash_split_keeps_copies_together_and_checks_weights(spark):
    df = spark.createDataFrame([(i % 50, None) for i in range(500)], "a INT, b STRING")
    a, b = hash_split(df, ["a", "b"], [1, 1], seed=1)
    assert {r[0] for r in a.collect()} & {r[0] for r in b.collect()} == set()
    with pytest.raises(ValueError):
        hash_split(df, "a", [], seed=1)


def test_samples(spark):
    df = spark.range(4000).withColumn("s", (F.col("id") % 3).cast("int"))
    assert abs(hash_sample(df, "id", 0.25, seed=1).count() - 1000) < 120
    assert hash_sample(df, "id", 0.0, seed=1).count() == 0
    assert hash_sample(df, "id", 1.0, seed=1).count() == 4000
    by = dict(rows(hash_sample_by(df, "id", "s", {0: 0.0, 1: 1.0}, seed=1).groupBy("s").count()))
    assert by == {1: 1333}  # stratum 0 has fraction 0, stratum 2 is not listed
