"""Toxic passages: maximum-scoring segments over token log-odds, calibrated by extreme values.

Training (:func:`fit_toxicity`) counts features in labelled toxic and clean documents: each word
and its beginnings of 4, 5 and 6 letters, so that an inflected form counts as its stem. A
feature's log-odds ratio uses an informative Dirichlet prior in proportion to the feature's overall share.
Only features that are surely toxic (signed root of the likelihood ratio) get a positive score, their
log-odds less one standard deviation. Any other token has a small negative score.

Scoring finds all maximal scoring segments of the token scores in linear time. Under clean text
the best segment of n tokens follows a Gumbel law with the rate that solves
``E[exp(rate * score)] = 1``; a passage's evidence is ``rate * score - ln n`` and it is significant
if this is above ``-ln(significance)``. A document's evidence, that of its r best passages together,
becomes a probability by a logistic curve, fitted on labelled rows that gave no counts.

Copies of one labelled text would pass its words off as common, so a document counts by the
inverse number of labelled documents that agree with it in MinHash values.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import held_out, text_or_empty
from millrace.llm.near_dups import WordHashes, shingle_set, signature
from millrace.sources import materialise

#: Labelled rows of each class that a fit uses, drawn by hash; a quarter of them calibrates.
TOXIC_ROWS, CLEAN_ROWS = 6_000, 9_000
#: Features that a model holds at most, the surest first.
MAX_FEATURES = 50_000

#: Evidence of a text without any toxic token.
NOTHING = -10.0

_WORDS = re.compile(r"[^\W\d_]+")
_STEMS = (4, 5, 6)


@dataclass
class ToxicityModel:
    """Positive feature scores and the calibration; small enough to go to every worker."""

    scores: dict[str, float] = field(default_factory=dict)
    background: float = -0.25
    rate: float = 1.0
    slope: float = 0.0
    intercept: float = -20.0
    significance: float = 0.01


def _features(word: str) -> list[str]:
    return [word, *[f"{word[:n]}*" for n in _STEMS if len(word) > n]]


class _WordScores(dict):
    """Scores of words, remembered for a bounded number of them."""

    def __init__(self, model: ToxicityModel):
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) >= 400_000:
            self.clear()
        known = [self.model.scores[f] for f in _features(word) if f in self.model.scores]
        value = self[word] = max(known, default=self.model.background)
        return value


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (start, end exclusive, score), in one pass.

    Each positive score starts a candidate. It absorbs the nearest earlier one that begins
    lower and ends lower, and is looked at again as the joined candidate.
    """
    total = np.cumsum(scores)
    kept: list[tuple[int, int, float, float, int]] = []  # start, end, before, after, lower one
    for i in np.flatnonzero(scores > 0).tolist():
        start, before, after = i, float(total[i] - scores[i]), float(total[i])
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= before:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= after:
                kept.append((start, i + 1, before, after, j))
                break
            start, before = kept[j][0], kept[j][2]
            del kept[j:]
    return [(a, b, after - before) for a, b, before, after, _ in kept]


def _passages(text: str, words: list[str], known: _WordScores) -> list[tuple[int, int, float]]:
    """(start, end, evidence) of each maximal segment, in token positions."""
    scores = np.fromiter(map(known.__getitem__, words), float, len(words))
    if not len(scores) or scores.max() <= 0:
        return []
    model = known.model
    bar = math.log(len(scores) + 1)
    return [(a, b, model.rate * s - bar) for a, b, s in maximal_segments(scores)]


def _evidence(passages: list[tuple[int, int, float]]) -> float:
    """Evidence of all passages together, by the law for the sum of the r best of them.

    The r best add up, and ``ln r!`` counts the orders in which they could have come; r is the best choice.
    A sum can fall and rise again, as evidence falls with r and ``ln r`` grows, so every r is tried.
    """
    total, most = 0.0, -math.inf
    for r, e in enumerate(sorted((e for *_, e in passages), reverse=True), 1):
        total += e + math.log(r)
        most = max(most, total)
    return max(most, NOTHING)


def toxicity_column(model: ToxicityModel, text: str = "text") -> Column:
    """struct of evidence, score (0 to 1) and the significant passages (code points) of a text."""
    kind = "evidence double, score double, passages array<struct<start: int, end: int, evidence: double>>"

    @F.pandas_udf(kind)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known, bar = _WordScores(model), -math.log(model.significance)
        for texts in batches:
            rows = []
            for text in texts:
                lower = (text or "").lower()
                words = _WORDS.findall(lower)
                found = _passages(lower, words, known)
                x = _evidence(found)
                score = 1 / (1 + math.exp(-max(-700.0, min(700.0, model.slope * x + model.intercept))))
                spans = []
                if any(e > bar for *_, e in found):
                    # Lower-casing can change a text's length; its own words are in the same order.
                    at = [m.span() for m in _WORDS.finditer(text if len(text) == len(lower) else lower)]
                    spans = [
                        {"start": at[a][0], "end": at[b - 1][1], "evidence": e}
                        for a, b, e in found if e > bar
                    ]
                rows.append((x, score, spans))
            yield pd.DataFrame(rows, columns=["evidence", "score", "passages"])

    return judge(F.col(text))


def _weighted(rows: DataFrame) -> DataFrame:
    """Add ``mark``, alike for most copies, and ``weight`` (in thousandths) to labelled texts.

    Each of four pairs of MinHash values is shared by two texts with a chance of their similarity
    squared; the weight is the mean inverse number of rows that share a pair.
    """
    marks = [f"m{k}" for k in range(4)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            signs = [signature(shingle_set(t.as_py(), words, 3))[:2].view("<i4") for t in batch.column(1)]
            columns = np.array(signs, np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], names=["key", *marks])

    keyed = rows.withColumn("key", F.xxhash64("text"))
    narrow = keyed.select("key", F.col("text").cast("binary")).mapInArrow(
        run, "key long, " + ", ".join(f"{m} long" for m in marks)
    )
    shares = [1 / F.count(F.lit(1)).over(Window.partitionBy(m)) for m in marks]
    weights = narrow.select("key", F.col("m0").alias("mark"), F.round(sum(shares[1:], shares[0]) * 250).alias("weight"))
    # As many rows as the bounded sample has at most.
    weights = materialise(weights.groupBy("key").agg(F.min("mark").alias("mark"), F.min("weight").cast("long").alias("weight")))
    return keyed.join(F.broadcast(weights), "key").drop("key")


def _counts(rows: DataFrame) -> DataFrame:
    """feature, toxic, clean: weights of documents that have the feature; the empty feature has the totals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            names = list(counts[0].keys() | counts[1].keys())
            values = [[c[n] for n in names] for c in reversed(counts)]
            for c in counts:
                c.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *[pa.array(v, pa.int64()) for v in values]],
                names=["feature", "toxic", "clean"],
            )

        for batch in batches:
            for text, toxic, weight in zip(*[c.to_pylist() for c in batch.columns]):
                words = set(_WORDS.findall((text or "").lower()))
                features = {f for w in words for f in _features(w)}
                for feature in features:
                    counts[toxic][feature] += weight
                counts[toxic][""] += weight * len(features)
                if len(counts[0]) + len(counts[1]) > 300_000:
                    yield flush()
        yield flush()

    parts = rows.select("text", F.col("toxic").cast("int"), "weight").mapInArrow(
        run, "feature string, toxic long, clean long"
    )
    return parts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _rate(scores: np.ndarray, shares: np.ndarray, background: float) -> float:
    """The positive root of E[exp(rate * score)] = 1 under clean text."""
    shares = shares * min(1.0, 0.02 / max(shares.sum(), 1e-12))  # keeps the mean score negative
    low, high = 1e-3, 20.0
    for _ in range(80):
        mid = (low + high) / 2
        value = (shares * np.exp(np.minimum(mid * scores, 600))).sum()
        value += (1 - shares.sum()) * math.exp(mid * background)
        low, high = (mid, high) if value < 1 else (low, mid)
    return low


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept, with a weak pull to (1, 0)."""
    design, beta = np.stack([x, np.ones_like(x)], axis=1), np.array([0.1, 0.0])
    pull = np.array([0.1, 0.01])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (p - y) + pull * (beta - np.array([1.0, 0.0]))
        hessian = (design * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ design + np.diag(pull)
        step = np.linalg.solve(hessian, gradient)
        beta = beta - step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    return max(float(beta[0]), 0.0), float(beta[1])


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    toxic_rows: int = TOXIC_ROWS,
    clean_rows: int = CLEAN_ROWS,
    prior: float = 0.02,
    least_z: float = 4.5,
) -> ToxicityModel:
    """Learn from ``labels`` (doc_id, toxic) of documents outside the held-out fold.

    A bounded sample is enough for the few features that matter: about ``toxic_rows`` and
    ``clean_rows`` documents at most, drawn by the hash of their ids. Rows without an id or
    label are not used; an id labelled both ways is toxic. Without toxic examples the model calls
    nothing toxic. ``prior`` is the weight of the Dirichlet prior as a part of all counts.
    """
    usable = (
        labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    sizes = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}
    parts = {k: min(1.0, n / sizes.get(k, 1)) for k, n in ((1, toxic_rows), (0, clean_rows))}
    part = F.when(F.col("toxic") == 1, parts[1]).otherwise(parts[0])
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < part * 1_000_000
    # About toxic_rows + clean_rows narrow rows at most, so it can be broadcast.
    chosen = materialise(usable.where(drawn))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = _weighted(materialise(rows.select(text_or_empty().alias("text"), "toxic")))
    # Copies are on one side.
    rows = materialise(rows.withColumn("calibrates", F.pmod("mark", F.lit(4)) == 0).drop("mark"))
    counts = materialise(_counts(rows.where("NOT calibrates")))
    totals = counts.where("feature = ''").first()
    if totals is None or not totals["toxic"]:
        return ToxicityModel()
    n1, n0 = totals["toxic"] / 1000, totals["clean"] / 1000
    n, weight = n1 + n0, prior * (n1 + n0)
    toxic, clean = F.col("toxic") / 1000, F.col("clean") / 1000
    both = toxic + clean
    y1, y0 = toxic + both * prior, clean + both * prior
    odds = F.log(y1 / (n1 + weight - y1)) - F.log(y0 / (n0 + weight - y0))

    def part(y: Column, total: float) -> Column:
        return F.when(y > 0, y * F.log(y * n / (both * total))).otherwise(0.0)

    z = F.sqrt(2 * F.greatest(part(toxic, n1) + part(clean, n0), F.lit(0.0)))
    lower = odds - F.sqrt(1 / y1 + 1 / y0)
    scored = (
        counts.where(F.col("feature") != "")
        .select("feature", lower.alias("score"), z.alias("z"), (y0 / (n0 + weight)).alias("share"))
        .where((F.col("score") > 0) & (F.col("z") >= least_z))
        .orderBy(F.desc("z"), "feature")
        .limit(MAX_FEATURES)
        .toPandas()
    )
    if scored.empty:
        return ToxicityModel()
    model = ToxicityModel(scores=dict(zip(scored.feature, scored.score.tolist())))
    model.rate = _rate(scored.score.to_numpy(), scored.share.to_numpy(), model.background)
    checks = rows.where("calibrates").select("toxic", toxicity_column(model)["evidence"].alias("x"))
    checks = checks.toPandas()
    if checks.empty or checks.toxic.nunique() < 2:
        model.slope, model.intercept = 1.0, 0.0
    else:
        model.slope, model.intercept = _logistic(checks.x.to_numpy(), checks.toxic.to_numpy().astype(float))
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Add evidence, score and passages (start, end, evidence; code points) to every row.

    A null or empty text has no passage and gets a low score. Columns of these names that
    ``docs`` has already are replaced. Equal texts get equal scores.
    """
    judged = docs.withColumn("_toxicity", toxicity_column(model))
    for name in ("evidence", "score", "passages"):
        judged = judged.withColumn(name, F.col(f"_toxicity.{name}"))
    return judged.drop("_toxicity")


def drop_toxic(docs: DataFrame, model: ToxicityModel, least_score: float = 0.5) -> DataFrame:
    """The rows of ``docs``, columns unchanged, that score below ``least_score``."""
    score = toxicity_column(model)["score"]
    return docs.where(score < least_score)
