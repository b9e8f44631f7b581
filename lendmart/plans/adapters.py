"""The domain's tables, derived from the given star-schema and event tables.

Each adapter is one projection (or aggregation) whose expressions are plain SQL
that Spark and the checking engine read alike, so both sides start from the same
rows. The given tables are clean; the adapters put in the dirt the cleansing rules
are for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
PANEL_COLUMNS = [f"fe_{i}" for i in range(1, len(EVENT_TYPES) + 1)]
EMA_COLUMNS = [f"ema_{c}" for c in PANEL_COLUMNS]
BASELINE_END = "1998-01-01"


def _cents(expr: str) -> str:
    return f"CAST(({expr}) * 0.01 AS DECIMAL(12,2))"


def _text(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


_SALARY = "CAST(CAST(c_acctbal AS DECIMAL(12,2)) + 1000 AS DECIMAL(12,2))"

ATTRIBUTES = {
    "Customer_ID": "'CUS_0x' || lower(hex(c_custkey))",
    "Name": "c_name",
    "Age": "CASE WHEN c_custkey % 101 = 0 THEN '-500'"
           " WHEN c_custkey % 19 = 0 THEN CAST(18 + c_custkey % 60 AS STRING) || '_'"
           " ELSE CAST(18 + c_custkey % 60 AS STRING) END",
    "SSN": "CASE WHEN c_custkey % 211 = 0 THEN NULL WHEN c_custkey % 17 = 0 THEN '#bad-token#'"
           " ELSE lpad(CAST(c_custkey % 1000 AS STRING), 3, '0') || '-'"
           " || lpad(CAST(c_custkey % 100 AS STRING), 2, '0') || '-'"
           " || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0') END",
    "Occupation": "CASE WHEN c_custkey % 223 = 0 THEN NULL"
                  " WHEN c_custkey % 14 = 0 THEN '_______' ELSE c_mktsegment END",
    "snapshot_date": "make_date(2023, CAST(1 + c_custkey % 12 AS INT), 1)",
}

FINANCIALS = {
    "Customer_ID": "'CUS_0x' || lower(hex(c_custkey))",
    "Annual_Income":
        f"CAST(CAST({_SALARY} * 12 + (c_custkey % 3 - 1) * 100 AS DECIMAL(14,2)) AS STRING)"
        " || CASE WHEN c_custkey % 13 = 0 THEN '_' ELSE '' END",
    "Monthly_Inhand_Salary":
        f"CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE {_text(_SALARY)} END",
    "Num_Bank_Accounts":
        "CASE WHEN c_custkey % 37 = 0 THEN '1798' ELSE CAST(c_custkey % 14 - 1 AS STRING) END",
    "Num_Credit_Card":
        "CASE WHEN c_custkey % 39 = 0 THEN '3.7' ELSE CAST(c_custkey % 13 AS STRING) END",
    "Interest_Rate": "CAST(1 + c_custkey % 40 AS STRING)",
    "Num_of_Loan": "'3_'",
    "Type_of_Loan":
        "CASE c_custkey % 8 WHEN 1 THEN 'Auto Loan' WHEN 2 THEN 'Auto Loan, and Student Loan'"
        " WHEN 3 THEN 'Credit-Builder Loan, Personal Loan, and Payday Loan'"
        " WHEN 4 THEN 'Not Specified' WHEN 5 THEN 'Payday Loan, and Not Specified'"
        " WHEN 6 THEN 'Student Loan, Mortgage Loan, Auto Loan, and Home Equity Loan'"
        " WHEN 7 THEN 'Debt Consolidation Loan' ELSE NULL END",
    "Delay_from_due_date": "CAST(c_custkey % 70 - 5 AS STRING)",
    "Num_of_Delayed_Payment":
        "CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE CAST(c_custkey % 33 - 2 AS STRING) END"
        " || CASE WHEN c_custkey % 11 = 0 THEN '_' ELSE '' END",
    "Changed_Credit_Limit":
        f"CASE WHEN c_custkey % 31 = 0 THEN '_' ELSE {_text(_cents('c_custkey % 2500'))} END",
    "Num_Credit_Inquiries":
        "CASE WHEN c_custkey % 43 = 0 THEN NULL ELSE CAST(c_custkey % 21 AS STRING) END",
    "Credit_Mix":
        "CASE WHEN c_custkey % 47 = 0 THEN NULL WHEN c_custkey % 4 = 0 THEN 'Bad'"
        " WHEN c_custkey % 4 = 1 THEN 'Standard' WHEN c_custkey % 4 = 2 THEN 'Good' ELSE '_' END",
    "Outstanding_Debt":
        f"{_text(_cents('(c_custkey * 3701) % 500000'))}"
        " || CASE WHEN c_custkey % 23 = 0 THEN '_' ELSE '' END",
    "Credit_Utilization_Ratio": _text(_cents("2000 + c_custkey % 2000")),
    "Credit_History_Age":
        "CASE WHEN c_custkey % 53 = 0 THEN NULL WHEN c_custkey % 59 = 0 THEN 'NA'"
        " WHEN c_custkey % 61 = 0 THEN CAST(c_custkey % 33 AS STRING) || ' Years'"
        " ELSE CAST(c_custkey % 33 AS STRING) || ' Years and '"
        " || CAST(c_custkey % 12 AS STRING) || ' Months' END",
    "Payment_of_Min_Amount":
        "CASE c_custkey % 5 WHEN 0 THEN 'NM' WHEN 1 THEN 'No' WHEN 2 THEN 'No' ELSE 'Yes' END",
    "Total_EMI_per_month": _text(_cents("(c_custkey * 7919) % 100000")),
    "Amount_Invested_Monthly":
        "CASE WHEN c_custkey % 27 = 0 THEN '__10000__'"
        f" ELSE {_text(_cents('(c_custkey * 6287) % 60000'))} END",
    "Payment_Behaviour":
        "CASE WHEN c_custkey % 67 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN '!@9#%8'"
        " WHEN c_custkey % 71 = 0 THEN 'garbled'"
        " ELSE CASE WHEN c_custkey % 7 < 4 THEN 'Low' ELSE 'High' END || '_spent_'"
        " || CASE WHEN c_custkey % 6 < 3 THEN 'Small' WHEN c_custkey % 6 < 5 THEN 'Medium'"
        " ELSE 'Large' END || '_value_payments' END",
    "Monthly_Balance":
        "CASE WHEN c_custkey % 97 = 0 THEN '__-333333333333333333333333333__'"
        f" ELSE {_text(_cents('(c_custkey * 5303) % 90000'))} END",
    # some financials arrive for another month than the customer's attributes
    "snapshot_date": "make_date(CASE WHEN c_custkey % 9 = 4 THEN 2024 ELSE 2023 END,"
                     " CAST(1 + c_custkey % 12 AS INT), 1)",
}

def _mills(expr: str) -> str:
    return f"CAST(({expr}) * 0.001 AS DECIMAL(14,3))"


#: Amounts with three digits, many of them halfway between two cents.
MONEY_TEXT = {
    "Customer_ID": "'CUS_0x' || lower(hex(c_custkey))",
    "Annual_Income": f"{_text(_mills('c_custkey * 7919005 % 90000000'))}"
                     " || CASE WHEN c_custkey % 13 = 0 THEN '_' ELSE '' END",
    "Monthly_Inhand_Salary": "CASE WHEN c_custkey % 29 = 0 THEN NULL"
                             f" ELSE {_text(_mills('c_custkey * 5 % 7000000'))} END",
    "Outstanding_Debt": f"{_text(_mills('(c_custkey * 3701 + 5) % 5000000'))}"
                        " || CASE WHEN c_custkey % 23 = 0 THEN '_' ELSE '' END",
    "Credit_Utilization_Ratio": _text(_mills("20000 + c_custkey * 3 % 20000")),
}

_DUE = "CASE WHEN l_orderkey % 97 = 0 THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END"
_OVERDUE = ("CASE WHEN l_returnflag = 'R' AND l_discount >= 0.01 THEN"
            " CAST(CAST(l_extendedprice AS DECIMAL(12,2))"
            " * (CAST(l_discount * 100 AS DECIMAL(4,1)) - 0.5) AS DECIMAL(14,2)) ELSE 0 END")

LEDGER_RAW = {
    "loan_id": _text("l_orderkey"),
    "Customer_ID": "'CUS_0x' || lower(hex(o_custkey))",
    "loan_start_date": _text("CAST(o_orderdate AS DATE)"),
    "tenure": "'10'",
    "installment_num": _text("l_linenumber"),
    "loan_amt": _text("CAST(o_totalprice AS DECIMAL(14,2))"),
    "due_amt": _text(f"CAST({_DUE} AS DECIMAL(14,2))"),
    "paid_amt": "CASE WHEN l_orderkey % 89 = 0 THEN 'n/a' ELSE "
                + _text("CAST(l_tax * 1000 AS DECIMAL(12,2))") + " END",
    "overdue_amt": _text(f"CAST({_OVERDUE} AS DECIMAL(14,2))"),
    "balance": "CASE WHEN l_orderkey % 83 = 0 THEN '' ELSE "
               + _text("CAST(l_quantity * 10 AS DECIMAL(12,2))") + " END",
    "snapshot_date": "CAST(date_trunc('month', CAST(l_shipdate AS DATE)) AS DATE)",
}

SCORED = {
    "Customer_ID": "'CUS_0x' || lower(hex(o_custkey))",
    "loan_id": _text("o_orderkey"),
    "score": "least(o_totalprice / 500000, CAST(1 AS DOUBLE))",
    "prediction": "CAST(CASE WHEN o_totalprice / 500000 >= 0.5 THEN 1 ELSE 0 END AS INT)",
    "label": "CAST(CASE WHEN (o_orderkey * 7919) % 1000 < o_totalprice / 500 THEN 1 ELSE 0 END"
             " AS INT)",
    "model_label": "CASE WHEN o_orderkey % 3 = 0 THEN 'autoML1' ELSE 'production' END",
    "o_totalprice": "o_totalprice",
    "o_orderpriority": "o_orderpriority",
    "weekday": "CAST(o_custkey % 7 AS INT)",
    "floor_value": "CASE WHEN o_orderkey % 20 < 7 THEN 1000.0 ELSE o_totalprice END",
    "inference_date": "CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE)",
}
DRIFT_FEATURES = ["o_totalprice", "floor_value", "o_orderpriority", "weekday"]


def _events_sum(kind: str, otherwise: str) -> str:
    return (f"CAST(sum(CASE WHEN event_type = '{kind}' THEN CAST(value AS DECIMAL(12,2))"
            f" ELSE {otherwise} END) AS DOUBLE)")


#: What a customer had ordered by month, one slice per month.
ORDER_SLICES = {
    "Customer_ID": "'CUS_0x' || lower(hex(o_custkey))",
    "snapshot_date": "CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE)",
    "n_orders": "count(*)",
    "spend": "CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE)",
}

PANEL = {c: _events_sum(kind, "0") for c, kind in zip(PANEL_COLUMNS, EVENT_TYPES)}
PANEL_SPARSE = {c: _events_sum(kind, "NULL") for c, kind in zip(PANEL_COLUMNS, EVENT_TYPES)}


def select_list(columns: dict[str, str]) -> list[str]:
    return [f"{e} AS {n}" for n, e in columns.items()]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*select_list(ATTRIBUTES))


def financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*select_list(FINANCIALS))


def ledger_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger lines as text; the join brings the customer of the loan."""
    lines, loans = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return (lines.join(loans, lines["l_orderkey"] == loans["o_orderkey"])
            .selectExpr(*select_list(LEDGER_RAW)))


def panel(spark: SparkSession, sf_dir: str, sparse: bool = False) -> DataFrame:
    """One row per customer and day; partially aggregated before the shuffle."""
    return (table(spark, sf_dir, "events")
            .selectExpr("'CUS_0x' || lower(hex(user_id)) AS Customer_ID",
                        "CAST(ts AS DATE) AS snapshot_date", "event_type", "value")
            .groupBy("Customer_ID", "snapshot_date")
            .agg(*[F.expr(e).alias(n) for n, e in (PANEL_SPARSE if sparse else PANEL).items()]))


def money_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*select_list(MONEY_TEXT))


def order_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["Customer_ID", "snapshot_date"]
    rows = table(spark, sf_dir, "orders").selectExpr(
        *[f"{ORDER_SLICES[k]} AS {k}" for k in keys], "o_totalprice")
    return rows.groupBy(*keys).agg(
        *[F.expr(e).alias(n) for n, e in ORDER_SLICES.items() if n not in keys])


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*select_list(SCORED))


def _cte(columns: dict[str, str], source: str) -> str:
    body = ",\n  ".join(select_list(columns))
    return f"SELECT {body}\nFROM {source}"


def _panel_cte(columns: dict[str, str]) -> str:
    return ("SELECT 'CUS_0x' || lower(hex(user_id)) AS Customer_ID,"
            " CAST(ts AS DATE) AS snapshot_date, "
            + ", ".join(select_list(columns)) + " FROM events GROUP BY 1, 2")


ADAPTER_SQL = {
    "ad_attributes": _cte(ATTRIBUTES, "customer"),
    "ad_financials": _cte(FINANCIALS, "customer"),
    "ad_ledger_raw": _cte(LEDGER_RAW, "lineitem JOIN orders ON l_orderkey = o_orderkey"),
    "ad_panel": _panel_cte(PANEL),
    "ad_panel_sparse": _panel_cte(PANEL_SPARSE),
    "ad_scored": _cte(SCORED, "orders"),
    "ad_money_text": _cte(MONEY_TEXT, "customer"),
    "ad_order_slices": _cte(ORDER_SLICES, "orders GROUP BY 1, 2"),
}
