"""Cleansing of the raw customer tables and the one-pass audit of what it changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType, StructType

from lendmart import constants as K
from lendmart.functions import clean as C


def attribute_rules() -> dict[str, Column]:
    return {
        "Age": C.clean_number(F.col("Age"), strip="_", lo=K.AGE_RANGE[0], hi=K.AGE_RANGE[1]),
        "SSN": C.conform(F.col("SSN"), K.SSN_PATTERN),
        "Occupation": C.conform(F.col("Occupation"), K.SYMBOLS_ONLY_PATTERN,
                                invert=True, fill_null=False),
    }


def financial_rules() -> dict[str, Column]:
    c = F.col
    money = dict(dp=2, to="double")
    return {
        "Annual_Income": C.clean_number(c("Annual_Income"), strip="_", **money),
        "Monthly_Inhand_Salary": C.clean_number(c("Monthly_Inhand_Salary"), **money),
        "Num_Bank_Accounts": C.clean_number(c("Num_Bank_Accounts"), hi=K.MAX_BANK_ACCOUNTS),
        "Num_Credit_Card": C.clean_number(c("Num_Credit_Card"), hi=K.MAX_CREDIT_CARDS),
        "Interest_Rate": C.clean_number(c("Interest_Rate"), hi=K.MAX_INTEREST_RATE),
        "Num_of_Loan": C.list_size(c("Type_of_Loan")),
        "Type_of_Loan": C.fill_sentinel(c("Type_of_Loan"), ()),
        "Delay_from_due_date": C.clean_number(c("Delay_from_due_date"),
                                              lo=K.DELAY_DAYS_RANGE[0], hi=K.DELAY_DAYS_RANGE[1]),
        "Num_of_Delayed_Payment": C.clean_number(
            c("Num_of_Delayed_Payment"), strip="_",
            lo=K.DELAYED_PAYMENTS_RANGE[0], hi=K.DELAYED_PAYMENTS_RANGE[1]),
        "Changed_Credit_Limit": C.clean_number(c("Changed_Credit_Limit"), strip="_", to="double"),
        "Num_Credit_Inquiries": C.clean_number(c("Num_Credit_Inquiries"), hi=K.MAX_INQUIRIES),
        "Credit_Mix": C.fill_sentinel(c("Credit_Mix"), (K.CREDIT_MIX_SENTINEL,)),
        "Outstanding_Debt": C.clean_number(c("Outstanding_Debt"), strip="_", **money),
        "Credit_Utilization_Ratio": C.clean_number(c("Credit_Utilization_Ratio"), **money),
        "Credit_History_Age_Months": C.duration_months(c("Credit_History_Age")),
        "Total_EMI_per_month": C.clean_number(c("Total_EMI_per_month"), hi=K.MAX_EMI, **money),
        "Amount_Invested_Monthly": C.clean_number(
            c("Amount_Invested_Monthly"), null_tokens=(K.INVESTED_SENTINEL,), **money),
        "Spent_Level": C.split_code(_behaviour(), K.SPENT_PATTERN),
        "Value_Payments": C.split_code(_behaviour(), K.VALUE_PATTERN),
        "Monthly_Balance": C.clean_number(
            c("Monthly_Balance"), null_tokens=(K.BALANCE_SENTINEL,), **money),
    }


def _behaviour() -> Column:
    code = F.col("Payment_Behaviour")
    return (F.when(code == K.BEHAVIOUR_SENTINEL,
                   F.lit(f"{K.UNKNOWN}_spent_{K.UNKNOWN}_value_payments"))
            .otherwise(code))


def clean_attributes(raw: DataFrame) -> DataFrame:
    """Typed, guarded attributes without the name column."""
    return raw.drop("Name").withColumns(attribute_rules())


def clean_financials(raw: DataFrame) -> DataFrame:
    """Typed, guarded financials: the raw columns but the behaviour code, then what the rules
    and the two consistency flags derive from them."""
    typed = raw.withColumns(financial_rules())
    flagged = typed.withColumns({
        "Income_Inconsistent": C.income_flag(F.col("Monthly_Inhand_Salary"),
                                             F.col("Annual_Income")),
        "Delay_Inconsistent": C.delay_flag(F.col("Delay_from_due_date"),
                                           F.col("Num_of_Delayed_Payment")),
    })
    return flagged.drop("Payment_Behaviour")


def project(df: DataFrame, schema: StructType) -> DataFrame:
    """Lenient cast to a schema: its columns, its order, bad values to null."""
    def typed(field):
        kind = field.dataType.simpleString()
        source = F.col(field.name)
        if kind == "int" and dict(df.dtypes)[field.name] == "string":
            return C.try_int(source).alias(field.name)
        return source.try_cast(field.dataType).alias(field.name)
    return df.select([typed(f) for f in schema])


def fill_numeric(df: DataFrame, value=0) -> DataFrame:
    """Fill nulls in every numeric column of the frame."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, NumericType)]
    return df.fillna(value, subset=numeric) if numeric else df


def audit(raw: DataFrame, rules: dict[str, Column], fill: str = K.UNKNOWN) -> DataFrame:
    """What the rules did, one row per column: total rows, values turned to null,
    values replaced by ``fill``. One scan and one shuffle for all columns."""
    columns = [c for c in rules if c in raw.columns]
    pairs = raw.select(
        *[F.col(c).isNull().alias(f"{c}__was_null") for c in columns],
        *[(F.col(c) == fill).alias(f"{c}__was_fill") for c in columns],
        *[rules[c].alias(c) for c in columns])
    counts = []
    for c in columns:
        after = F.col(c)
        counts.append(F.count_if(after.isNull() & ~F.col(f"{c}__was_null"))
                      .alias(f"{c}__nulled"))
        counts.append(F.count_if((after.cast("string") == fill)
                                 & ~F.coalesce(F.col(f"{c}__was_fill"), F.lit(False)))
                      .alias(f"{c}__replaced"))
    totals = pairs.agg(F.count(F.lit(1)).alias("total"), *counts)
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col("total"),
                 F.col(f"{c}__nulled").alias("nulled"),
                 F.col(f"{c}__replaced").alias("replaced")) for c in columns]))
    return totals.select(rows.alias("r")).select("r.*")
