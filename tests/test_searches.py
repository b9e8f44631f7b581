"""The registered queries of fitted models search all default draws."""

from types import SimpleNamespace

import pytest

from pyspark.sql import functions as F

from lendmart.operators import model
from lendmart.plans import queries
from lendmart.sources import snapshots


class Ended(Exception):
    pass


@pytest.mark.parametrize("name, kinds", [("model_evaluation", ["lr", "gbt"]),
                                         ("model_importances", ["gbt"]), ("score_batch", ["lr"])])
def test_registered_searches_are_whole(spark, monkeypatch, name, kinds):
    asked = []

    def train(matrix, features, kind, candidates=None, *_, **__):
        asked.append((kind, candidates or model.draws(kind)))

    def end(*_, **__):
        raise Ended

    monkeypatch.setattr(model, "train", train)
    monkeypatch.setattr(model, "evaluate", end)
    monkeypatch.setattr(model, "importances", end)
    monkeypatch.setattr(queries.snapshots, "stage", lambda df: df)
    monkeypatch.setattr(queries, "gold_with_ema", lambda *_: None)
    monkeypatch.setattr(queries, "training_matrix", lambda *_: (None, SimpleNamespace(names=[])))
    with pytest.raises(Ended):
        queries.QUERIES[name](spark, None)
    assert asked == [(kind, model.draws(kind)) for kind in kinds]


@pytest.mark.parametrize("cores, parts, fits, wanted", [
    (8, 1, 30, 8), (8, 2, 30, 8), (8, 4, 30, 4), (8, 8, 30, 2), (8, 200, 30, 2), (64, 2, 30, 30),
    (8, 1, 6, 6), (1, 1, 30, 2), (8, 0, 30, 8)])
def test_fits_at_a_time(cores, parts, fits, wanted):
    assert model.at_a_time(cores, parts, fits) == wanted


def test_small_searches_fill_the_cores(spark, monkeypatch):
    """Few partitions: more fits at a time, with the same results as two at a time."""
    rows = spark.range(0, 240, 1, 2).select(
        F.col("id").cast("string").alias("Customer_ID"), (F.col("id") % 3 == 0).cast("int").alias("label"),
        ((F.col("id") * 37) % 101).cast("double").alias("a"),
        ((F.col("id") * 53) % 17 + F.col("id") % 3).cast("double").alias("b"))
    train = snapshots.stage(model.class_weights(rows, "gbt"))
    grid = {**model.GBT_GRID, "maxIter": [2, 3], "maxDepth": [2]}
    candidates, asked, scores = model.draws("gbt", grid, 5), [], []

    class Recorded(model.CrossValidator):
        def fit(self, *args):
            asked.append(self.getParallelism())
            found = super().fit(*args)
            scores.append(found.avgMetrics)
            return found

    monkeypatch.setattr(model, "CrossValidator", Recorded)
    found = [model.search(train, ["a", "b"], "gbt", candidates, parallelism=n) for n in (2, None)]
    assert asked == [2, 5]
    assert scores[0] == pytest.approx(scores[1], abs=1e-12) and len(scores[0]) == 5
    (_, two, params), (_, many, same) = found
    trees = [m.toDebugString.split("\n")[1:] for m in (two, many)]  # without the model's id
    assert params == same and trees[0] == trees[1]
