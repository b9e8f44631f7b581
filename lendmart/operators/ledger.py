"""Loan ledger: month on book, days past due, default labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lendmart import constants as K
from lendmart.operators.cleansing import fill_numeric


def with_dpd(ledger: DataFrame) -> DataFrame:
    """Adds mob, installments_missed, first_missed_date and dpd.

    Narrow: no shuffle. Amounts stay FLOAT and divide as double, because the
    ceiling depends on it. Missing numbers become 0 before the dates are derived;
    an overdue loan whose due amount is 0 has no first missed date and a null dpd.
    """
    missed = F.ceil(F.try_divide(F.col("overdue_amt").cast("double"),
                                 F.col("due_amt").cast("double"))).cast("int")
    counted = fill_numeric(ledger.withColumns({
        "mob": F.col("installment_num").cast("int"),
        "installments_missed": missed,
    }))
    dated = counted.withColumn(
        "first_missed_date",
        F.when(F.col("installments_missed") > 0,
               F.add_months(F.col("snapshot_date"), -F.col("installments_missed"))))
    return dated.withColumn(
        "dpd",
        F.when(F.col("overdue_amt") > 0,
               F.datediff(F.col("snapshot_date"), F.col("first_missed_date")))
        .otherwise(0).cast("int"))


def labels(ledger: DataFrame, dpd: int = K.DEFAULT_DPD, mob: int = K.DEFAULT_MOB) -> DataFrame:
    """Loans that reach month ``mob``, labelled 1 when at least ``dpd`` days past due."""
    return ledger.filter(F.col("mob") == mob).select(
        "loan_id", "Customer_ID",
        F.when(F.col("dpd") >= dpd, 1).otherwise(0).alias("label"),
        F.lit(f"{dpd}dpd_{mob}mob").alias("label_def"),
        "snapshot_date")


def default_rate(labelled: DataFrame, by=("snapshot_date",)) -> DataFrame:
    """Loans, defaults and default rate per cohort."""
    return labelled.groupBy(*by).agg(
        F.count(F.lit(1)).alias("loans"),
        F.count_if(F.col("label") == 1).alias("defaults"),
    ).withColumn("default_rate", F.col("defaults") / F.col("loans"))


def one_label_per_customer(labelled: DataFrame) -> DataFrame:
    """Reduce to one loan per customer (the worst label, its latest date).

    Partially aggregated before the shuffle, so a customer with very many loans
    reaches its reducer as one row per map task.
    """
    return labelled.groupBy("Customer_ID").agg(
        F.max("label").alias("label"),
        F.max("snapshot_date").alias("snapshot_date"))
