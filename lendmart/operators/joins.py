"""Joins between the monthly tables.

All are equi-joins left to the optimizer: a side is broadcast only when its
measured size is below the session's limit, otherwise both are shuffled on the
key and adaptive execution splits a partition that one hot key makes too large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lendmart import constants as K
from lendmart.operators.asof import asof_join
from lendmart.operators.ledger import one_label_per_customer
from lendmart.sources.snapshots import stage


def customer_snapshot(attributes: DataFrame, financials: DataFrame) -> DataFrame:
    """Attributes with the month's financials, attributes' columns first."""
    keys = [K.CUSTOMER, K.SNAPSHOT]
    rest = [c for c in financials.columns if c not in keys]
    return attributes.join(financials, keys, "left").select(*attributes.columns, *rest)


def with_ema(features: DataFrame, ema: DataFrame) -> DataFrame:
    """Features with the customer's EMAs and a flag for customers that have any."""
    first = next(c for c in ema.columns if c != K.CUSTOMER)
    return (features.join(ema, K.CUSTOMER, "left")
            .withColumn("has_clickstream", F.col(first).isNotNull().cast("int")))


def training_set(labelled: DataFrame, features: DataFrame) -> DataFrame:
    """Labelled customers with their features; the label's date becomes label_date."""
    return (labelled.withColumnRenamed(K.SNAPSHOT, "label_date")
            .join(features, K.CUSTOMER, "left"))


def training_set_asof(labelled: DataFrame, features: DataFrame) -> DataFrame:
    """Labelled customers, one row each, with their newest feature slice up to the label's
    date, which becomes label_date: features dated after the label are never used, and no
    further slices multiply the rows. ``features`` has a row per customer and slice."""
    return asof_join(labelled.withColumnRenamed(K.SNAPSHOT, "label_date"), features,
                     K.CUSTOMER, "label_date", K.SNAPSHOT)


def matured(scored: DataFrame, labelled: DataFrame, as_of=None) -> DataFrame:
    """Scored rows whose customer has a label, as known on ``as_of``.

    ``labelled`` has a row per loan. Labels and batches dated later are left out first;
    only then is a customer reduced to one label, so a later label never hides an earlier
    one. The reduced labels are staged, which lets both sides of the join be exchanged
    and a hot customer's rows be split.
    """
    if as_of is not None:
        date = F.lit(str(as_of)).cast("date")
        labelled = labelled.filter(F.col(K.SNAPSHOT) <= date)
        scored = scored.filter(F.col("inference_date") <= date)
    known = stage(one_label_per_customer(labelled).select(
        K.CUSTOMER, "label", F.col(K.SNAPSHOT).alias("label_date")))
    return scored.join(known, K.CUSTOMER, "inner")


def models_for(registry: DataFrame, batches: DataFrame) -> DataFrame:
    """Models to score each batch with: production, and the model trained the month
    before.

    ``registry``: (model_label, model_version, trained) with ``trained`` the training
    month; ``batches``: (inference_date). Production serves every batch after its
    own training month.
    """
    stamped = batches.withColumn("trained", F.add_months("inference_date", -1))
    recent = (stamped.join(registry.filter(F.col("model_label") != "production"), "trained")
              .select("inference_date", "model_label", "model_version"))
    # scalar subqueries: a second production row is an error, not a choice
    production = registry.filter(F.col("model_label") == "production")
    served = F.col("inference_date") > production.select("trained").scalar()
    serving = batches.filter(served).select(
        "inference_date", F.lit("production").alias("model_label"),
        production.select("model_version").scalar().alias("model_version"))
    return serving.unionByName(recent.filter(served))
