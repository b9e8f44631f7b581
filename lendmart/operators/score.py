"""Batch scoring with every model selected for a month."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from lendmart import constants as K
from lendmart.operators import model as M
from lendmart.operators.matrix import MatrixState, feature_matrix, scale


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()


def score(features: DataFrame, model: PipelineModel, state: MatrixState, threshold: float,
          version: str, label: str, inference_date, top: Sequence[str] = ()) -> DataFrame:
    """Scores, hard predictions and stamps of one model, with the model's top features
    that the batch has, scaled as the model saw them. The matrix carries them along,
    so nothing is joined."""
    shown = [c for c in dict.fromkeys(top) if c in features.columns]
    fitted = {c: at for c, at in state.scales.items() if c in shown}
    held = scale(features.withColumns({f"__top_{c}": F.col(c) for c in shown}),
                 {f"__top_{c}": at for c, at in fitted.items()}) if shown else features
    matrix = feature_matrix(held, state, keep=[K.CUSTOMER, *[f"__top_{c}" for c in shown]])
    scored = M.predict(model, matrix, [K.CUSTOMER, *[f"__top_{c}" for c in shown]])
    return scored.select(
        K.CUSTOMER, "score", (F.col("score") >= threshold).cast("int").alias("prediction"),
        F.lit(float(threshold)).alias("threshold"), F.lit(version).alias("model_version"),
        F.lit(label).alias("model_label"),
        F.lit(str(inference_date)).cast("date").alias("inference_date"),
        *[F.col(f"__top_{c}").alias(c) for c in shown])


def score_all(batches: Sequence[DataFrame]) -> DataFrame:
    """All models' scores of a month; a feature only some models report is null for
    the others."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)
