"""Raking against numpy, marginals and budget of the sample, and edge rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import mixing
from millrace.llm.mixing import DIMENSIONS, add_mix_columns, mixing_rates, rake, sample_mix
from tests.helpers import rows


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(6)
    data = [
        (i, "word " * rng.choice([3, 40, 300]), rng.choice(["en", "en", "en", "de", None]),
         "hot" if rng.random() < 0.5 else f"s{rng.randrange(4)}", rng.choice(["news", "code", "chat"]))
        for i in range(1500)
    ]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, topic string")


def raked(table, targets, rounds=500):
    weights = table.astype(float)
    for _ in range(rounds):
        for axis, target in enumerate(targets):
            others = tuple(a for a in range(weights.ndim) if a != axis)
            shape = [-1 if a == axis else 1 for a in range(weights.ndim)]
            weights = weights * (target / weights.sum(axis=others)).reshape(shape)
    return weights


@pytest.mark.parametrize("one_task", [100_000, 0])
def test_rake(spark, monkeypatch, one_task):
    monkeypatch.setattr(mixing, "ONE_TASK", one_task)
    rng = np.random.default_rng(4)
    table = rng.integers(1, 1000, size=(4, 3, 2))
    targets = [rng.dirichlet(np.ones(n)) for n in table.shape]
    cells = spark.createDataFrame(
        [(f"{a}", f"{b}", f"{c}", int(table[a, b, c])) for a, b, c in np.ndindex(*table.shape)],
        "source string, lang string, topic string, tokens long",
    )
    frames = {
        d: spark.createDataFrame([(f"{i}", float(x)) for i, x in enumerate(t)], "level string, target double")
        for d, t in zip(DIMENSIONS, targets)
    }
    found = {d: {r["level"]: r["factor"] for r in f.collect()} for d, f in rake(cells, frames).items()}
    want = raked(table, targets)
    for a, b, c in np.ndindex(*table.shape):
        weight = table[a, b, c] * found["source"][f"{a}"] * found["lang"][f"{b}"] * found["topic"][f"{c}"]
        assert weight == pytest.approx(want[a, b, c], rel=1e-6)


@pytest.mark.parametrize("one_task", [100_000, 0])
def test_targets_that_cannot_be_met_are_told(spark, monkeypatch, one_task):
    monkeypatch.setattr(mixing, "ONE_TASK", one_task)
    # Every text of source a is English and every text of source b German.
    cells = spark.createDataFrame([("a", "en", "x", 5), ("b", "de", "x", 5)], "source string, lang string, topic string, tokens long")
    shares = {"source": [("a", 0.5), ("b", 0.5)], "lang": [("en", 0.9), ("de", 0.1)], "topic": [("x", 1.0)]}
    frames = {d: spark.createDataFrame(s, "level string, target double") for d, s in shares.items()}
    with pytest.warns(UserWarning, match="not met"):
        rake(cells, frames, rounds=7)


def test_sample_meets_targets_and_budget(docs):
    targets = {"lang": {"en": 0.5, "de": 0.3, "(none)": 0.2}}
    mixed = sample_mix(add_mix_columns(docs, F.col("topic")), targets, budget=0.4).collect()
    assert len(mixed) == 1500
    total = sum(r["mix_tokens"] for r in mixed)
    expected = sum(r["mix_tokens"] * r["mix_probability"] for r in mixed)
    assert expected == pytest.approx(0.4 * total, rel=1e-6)
    weight = {}
    for r in mixed:
        weight[r["mix_lang"]] = weight.get(r["mix_lang"], 0) + r["mix_tokens"] * r["mix_probability"] * r["mix_repeat"]
    assert {k: v / sum(weight.values()) for k, v in weight.items()} == pytest.approx(targets["lang"], rel=1e-5)
    kept = sum(r["mix_tokens"] for r in mixed if r["mix_kept"])
    assert kept == pytest.approx(expected, rel=0.1)
    assert all(r["mix_kept"] == (r["mix_draw"] < r["mix_probability"]) for r in mixed)


def test_choice_does_not_depend_on_partitions(docs):
    first = rows(sample_mix(add_mix_columns(docs, F.col("topic"))), "doc_id", "mix_probability", "mix_kept")
    again = rows(sample_mix(add_mix_columns(docs.repartition(7), F.col("topic"))), "doc_id", "mix_probability", "mix_kept")
    assert first == again


def test_edge_rows(spark):
    df = spark.createDataFrame(
        [(1, None, None, None, 1), (1, None, None, None, 1), (None, "a b", "en", "s", 2), (None, "c | d", "en", "s", 3),
         (5, "x " * 60_000, "en", "s", 4), (6, "", "de", None, 5)],
        "doc_id long, text string, lang string, source string, mix_kept int",
    )
    mixed = sample_mix(add_mix_columns(df))
    assert mixed.columns.count("mix_kept") == 1
    got = {(r["doc_id"], r["mix_topic"], r["mix_tokens"]) for r in mixed.collect()}
    assert got == {(1, "empty", 0), (None, "short", 2), (None, "table", 3), (5, "long", 60_000), (6, "empty", 0)}
    assert all(r["mix_kept"] for r in mixed.collect() if not r["mix_tokens"])
    assert sample_mix(add_mix_columns(df.where("false"))).collect() == []
    assert mixing_rates(add_mix_columns(df.where("text IS NULL"))).count() == 1


def test_levels_of_other_types_and_clashing_columns(spark):
    df = spark.createDataFrame(
        [(1, "a b c", 7, None, 5, 1.0), (2, "d e", None, 2, 6, 2.0), (3, None, 7, 2, None, 3.0)],
        "doc_id long, text string, source int, lang int, topic int, mix_draw double",
    )
    got = {(r["doc_id"], r["mix_source"], r["mix_lang"], r["mix_topic"], r["topic"]) for r in sample_mix(add_mix_columns(df)).collect()}
    assert got == {(1, "7", "(none)", "short", 5), (2, "(none)", "2", "short", 6), (3, "7", "2", "empty", None)}
    assert {r["mix_topic"] for r in add_mix_columns(df, F.col("topic")).collect()} == {"5", "6", "(none)"}
