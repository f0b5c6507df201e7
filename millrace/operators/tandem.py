"""A classifier and a regressor in tandem: is there an amount, and if so how large."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.evaluate import regression_metrics
from millrace.operators.models import fit, gamma_regression, gbt, require_positive
from millrace.sources.scratch import persisted

CLASS = "class_predicted"
AMOUNT = "amount_predicted"


@dataclass(frozen=True)
class TandemModel:
    """The two fitted models; both read the same feature column."""

    classifier: Model
    regressor: Model

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``class_predicted`` (0 or 1) and ``amount_predicted``.

        The amount is 0 where the class is 0. Elsewhere it is the regressor's, but not
        negative, which the identity link would allow.
        """
        scored = self.regressor.transform(self.classifier.transform(df))
        amount = F.greatest(F.col(self.regressor.getPredictionCol()), F.lit(0.0))
        is_positive = F.col(self.classifier.getPredictionCol()) == 1
        return scored.select(
            *[F.col(f"`{c}`") for c in df.columns],
            is_positive.cast("int").alias(CLASS),
            F.when(is_positive, amount).otherwise(0.0).alias(AMOUNT),
        )


def fit_tandem(
    train: DataFrame,
    target: str,
    amount: str,
    classifier: Estimator | None = None,
    regressor: Estimator | None = None,
) -> TandemModel:
    """Fit the classifier on all rows and the regressor on the rows whose target is 1.

    ``train`` has its ``features`` assembled; it is persisted for the two fits. The
    defaults are boosted trees of depth 10 in 50 rounds and a Gamma regression.
    """
    classifier = classifier or gbt(target, max_depth=10, max_iter=50, prediction="_class")
    regressor = regressor or gamma_regression(amount, prediction="_amount")
    with persisted(train.select("features", target, amount)) as train:
        positive = require_positive(train.where(F.col(target) == 1), amount)
        return TandemModel(fit(classifier, train), fit(regressor, positive))


def tandem_metrics(scored: DataFrame, target: str, amount: str) -> DataFrame:
    """part, rows, rmse, mse, mae in one pass.

    ``class`` scores the 0/1 prediction (mse = mae = error rate), ``amount of predicted
    positives`` the regressor where the classifier called it, ``amount`` the whole set.
    """

    def part(name: str, label: str, pred: str):
        return F.struct(
            F.lit(name).alias("part"),
            F.col(label).cast("double").alias("label"),
            F.col(pred).cast("double").alias("pred"),
        )

    parts = F.array(
        part("class", target, CLASS),
        part("amount", amount, AMOUNT),
        F.when(F.col(CLASS) == 1, part("amount of predicted positives", amount, AMOUNT)),
    )
    return regression_metrics(
        scored.select(F.inline(F.array_compact(parts))), "label", "pred", by=["part"]
    )
