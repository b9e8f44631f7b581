"""Matured performance as counts that months are added to.

What a metric needs of a batch is how many positives, negatives and hits each score has.
Those counts add up, so a month stores only what it changes: all labelled rows of its own
batches, and, for the batches before, the rows of customers whose label is new or has turned
from 0 to 1 (a customer's label is the worst one known). The label state has one row per
customer. Sums over the months up to a date are the counts as known on it, and Gini and
recall follow from them without the labels or the history of the scores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lendmart import constants as K
from lendmart.operators import metrics
from lendmart.operators.ranks import cut_points

BATCH = ("inference_date", "model_label", "model_version")
LABELS = f"{K.CUSTOMER} string, label int"


def advance_labels(known: DataFrame, labels: DataFrame) -> DataFrame:
    """(customer, label, was) after a month's labels, which have a row per loan; ``was`` is
    the label before. ``known`` has (customer, label)."""
    new = labels.groupBy(K.CUSTOMER).agg(F.max("label").alias("__new"))
    before = known.select(K.CUSTOMER, F.col("label").alias("was"))
    return before.join(new, K.CUSTOMER, "full_outer").select(
        K.CUSTOMER, F.greatest("was", "__new").alias("label"), "was")


def _counts(rows: DataFrame, pos, neg, by: Sequence[str]) -> DataFrame:
    hit = F.col("prediction") == 1
    sums = rows.groupBy(*by, "score").agg(
        F.sum(pos).alias("pos"), F.sum(neg).alias("neg"),
        F.sum(F.when(hit, pos).otherwise(0)).alias("tp"))
    return sums.filter("pos <> 0 OR neg <> 0 OR tp <> 0")


def new_counts(scored: DataFrame, labels: DataFrame, by: Sequence[str] = BATCH) -> DataFrame:
    """(by..., score, pos, neg, tp) of new batches under all labels known."""
    rows = scored.join(labels.select(K.CUSTOMER, "label"), K.CUSTOMER)
    one = F.col("label") == 1
    return _counts(rows, F.when(one, 1).otherwise(0), F.when(one, 0).otherwise(1), by)


def changed_counts(scored: DataFrame, labels: DataFrame, by: Sequence[str] = BATCH) -> DataFrame:
    """What the month's labels change in earlier batches: rows of customers whose label is
    new count for the first time, those of customers that turned move over."""
    turned = F.col("was").isNotNull()
    changed = labels.filter(F.col("was").isNull() | (F.col("was") < F.col("label")))
    rows = scored.join(changed, K.CUSTOMER)
    pos = F.when(F.col("label") == 1, 1).otherwise(0)
    return _counts(rows, pos, F.when(turned, -1).when(F.col("label") == 1, 0).otherwise(1), by)


def performance(counts: DataFrame, by: Sequence[str] = BATCH,
                points: Sequence[float] | None = None) -> DataFrame:
    """Gini and recall of every matured batch and model, from the sums of stored counts."""
    summed = counts.groupBy(*by, "score").agg(*[F.sum(c).alias(c) for c in ("pos", "neg", "tp")])
    if points is None:
        points = cut_points(counts, ["score"])["score"]
    return metrics.rank_metrics_of_counts(summed, by=by, points=points).filter(
        F.col("gini").isNotNull()).drop("positives")
