"""Maximal segments against brute force, held-out accuracy, and edge rows."""

import random

import numpy as np
import pytest

from millrace.llm.common import in_held_out
from millrace.llm.toxicity import (
    ToxicityModel, _evidence, drop_toxic, fit_toxicity, maximal_segments, score_toxicity,
)

BAD = ["vilewort", "grudgeon", "snarlack"]


def brute_segments(scores):
    """All maximal scoring segments: take the best (shortest, leftmost) one, go on at both sides of it."""
    best = None
    for a in range(len(scores)):
        for b in range(a + 1, len(scores) + 1):
            key = (round(float(np.sum(scores[a:b])), 9), a - b, -a)
            if best is None or key > best[0]:
                best = (key, a, b)
    if best is None or best[0][0] <= 0:
        return []
    (score, *_), a, b = best
    right = [(x + b, y + b, s) for x, y, s in brute_segments(scores[b:])]
    return brute_segments(scores[:a]) + [(a, b, score)] + right


def test_segments():
    rng = np.random.default_rng(1)
    for _ in range(150):
        scores = rng.choice([-4, -3, -1, 1.5, 2, 5], size=rng.integers(0, 16))
        got = [(a, b, round(s, 9)) for a, b, s in maximal_segments(scores.astype(float))]
        assert got == brute_segments(scores)


@pytest.mark.parametrize("each, count", [(-2.0, 40), (-2.0, 100), (-3.6, 150), (1.0, 3), (-9.0, 5)])
def test_evidence_of_the_best_number_of_passages(each, count):
    sums = [r * each + sum(np.log(np.arange(1, r + 1))) for r in range(1, count + 1)]
    assert _evidence([(i, i + 1, each) for i in range(count)]) == pytest.approx(max(sums))


def test_scattered_passages_of_a_long_text(spark):
    """Weak by themselves, as ln n is above their score; a few of them are still nothing."""
    model = ToxicityModel(scores={"vilewort": 8.0}, slope=1.0, intercept=0.0)
    many, few = ("calm " * 40 + "vilewort ") * 1000, "calm " * 20_000 + ("calm " * 40 + "vilewort ") * 5 + "calm " * 20_000
    df = spark.createDataFrame([(1, many), (2, few), (3, "calm " * 41_000)], "doc_id long, text string")
    judged = {r["doc_id"]: r for r in score_toxicity(df, model).collect()}
    assert all(not r["passages"] for r in judged.values())
    assert {i: r["score"] >= 0.5 for i, r in judged.items()} == {1: True, 2: False, 3: False}
    assert {r["doc_id"] for r in drop_toxic(df, model).collect()} == {2, 3}


def corpus(n, seed=0):
    rng = random.Random(seed)
    plain = ["".join(rng.choice("aeioulmnrst") for _ in range(6)) for _ in range(400)]
    rows = []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randrange(20, 150))]
        toxic = i % 5 == 1
        if toxic:
            at = rng.randrange(len(words))
            words[at:at] = [rng.choice(BAD) + rng.choice(["", "s", "ing"]) for _ in range(4)]
        rows.append((i, " ".join(words), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def labelled(spark):
    data = corpus(1200)
    docs = spark.createDataFrame([(i, t, "y") for i, t, _ in data], "doc_id long, text string, score string")
    return docs, spark.createDataFrame([(i, y) for i, _, y in data], "doc_id long, toxic int")


def test_held_out_rows(spark, labelled):
    docs, labels = labelled
    model = fit_toxicity(docs, labels)
    assert any(f.startswith("vile") for f in model.scores)
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    judged = score_toxicity(docs, model).collect()
    held = [r for r in judged if in_held_out(r["doc_id"])]
    assert len(held) > 150
    assert all((r["score"] >= 0.5) == (truth[r["doc_id"]] == 1) for r in held)
    assert all(0 <= r["score"] <= 1 for r in judged)
    for r in judged:
        if truth[r["doc_id"]] and in_held_out(r["doc_id"]):
            passage = " ".join(r["text"][p["start"] : p["end"]] for p in r["passages"])
            assert sum(passage.count(b) for b in BAD) == sum(r["text"].count(b) for b in BAD)


def test_nothing_is_learnt_from_the_held_out_fold(spark, labelled):
    docs, labels = labelled
    rows = [(r["doc_id"], 1 - r["toxic"] if in_held_out(r["doc_id"]) else r["toxic"]) for r in labels.collect()]
    other = fit_toxicity(docs, spark.createDataFrame(rows, "doc_id long, toxic int"))
    assert other == fit_toxicity(docs, labels)


def test_edge_rows(spark, labelled):
    docs, labels = labelled
    model = fit_toxicity(docs, labels.unionByName(spark.createDataFrame([(None, 1), (3, None), (1, 0)], "doc_id long, toxic int")))
    long = "calm " * 50_000 + "vilewort grudgeon snarlack vileworts " + "calm " * 50_000
    df = spark.createDataFrame(
        [(1, None), (2, ""), (3, "İ vilewort grudgeon snarlacks"), (None, long), (4, "calm"), (4, "calm")], "doc_id long, text string"
    )
    got = [(r["doc_id"], r["score"] >= 0.5, len(r["passages"])) for r in score_toxicity(df, model).collect()]
    assert sorted(got, key=repr) == sorted(
        [(1, False, 0), (2, False, 0), (3, True, 1), (None, True, 1), (4, False, 0), (4, False, 0)], key=repr
    )
    assert {r["doc_id"] for r in drop_toxic(df, model).collect()} == {1, 2, 4}
    assert drop_toxic(df, model).columns == df.columns
    empty = fit_toxicity(docs.where("false"), labels)
    assert empty == ToxicityModel() == fit_toxicity(docs, labels.where("toxic = 0"))
    assert drop_toxic(df, empty).count() == 6
    assert score_toxicity(df.where("false"), model).collect() == []
