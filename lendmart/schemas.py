"""Explicit schemas. Columns that arrive dirty are declared STRING on read, so a
clean month and a dirty month have the same schema; nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import (DateType, FloatType, IntegerType, StringType,
                               StructField, StructType)

from lendmart.constants import PANEL_COLUMNS


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind(), True) for name, kind in fields.items()])


def as_text(schema: StructType, keep=("snapshot_date",)) -> StructType:
    """The same columns as raw text, as they lie in a landed CSV."""
    return StructType([f if f.name in keep else StructField(f.name, StringType(), True)
                       for f in schema])


ATTRIBUTES_RAW = _struct(
    Customer_ID=StringType, Name=StringType, Age=StringType, SSN=StringType,
    Occupation=StringType, snapshot_date=DateType)

FINANCIALS_RAW = _struct(
    Customer_ID=StringType, Annual_Income=StringType, Monthly_Inhand_Salary=StringType,
    Num_Bank_Accounts=StringType, Num_Credit_Card=StringType, Interest_Rate=StringType,
    Num_of_Loan=StringType, Type_of_Loan=StringType, Delay_from_due_date=StringType,
    Num_of_Delayed_Payment=StringType, Changed_Credit_Limit=StringType,
    Num_Credit_Inquiries=StringType, Credit_Mix=StringType, Outstanding_Debt=StringType,
    Credit_Utilization_Ratio=StringType, Credit_History_Age=StringType,
    Payment_of_Min_Amount=StringType, Total_EMI_per_month=StringType,
    Amount_Invested_Monthly=StringType, Payment_Behaviour=StringType,
    Monthly_Balance=StringType, snapshot_date=DateType)

LEDGER = _struct(
    loan_id=StringType, Customer_ID=StringType, loan_start_date=DateType,
    tenure=IntegerType, installment_num=IntegerType, loan_amt=FloatType,
    due_amt=FloatType, paid_amt=FloatType, overdue_amt=FloatType, balance=FloatType,
    snapshot_date=DateType)

LEDGER_RAW = as_text(LEDGER)

PANEL_RAW = StructType(
    [StructField(c, StringType(), True) for c in PANEL_COLUMNS]
    + [StructField("Customer_ID", StringType(), True),
       StructField("snapshot_date", DateType(), True)])
