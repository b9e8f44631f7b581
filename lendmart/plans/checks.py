"""Named SQL building blocks of the checking queries.

``oracle(body)`` puts the blocks a query refers to, and the blocks these refer to,
in front of it.
"""

from __future__ import annotations

import re

from lendmart import constants as K
from lendmart.functions.encode import safe_name
from lendmart.plans import adapters as A


def _int(c: str) -> str:
    return f"CAST(trunc(try_cast({c} AS DOUBLE)) AS INTEGER)"


def _guard(value: str, lo=None, hi=None) -> str:
    tests = [f"{value} >= {lo}"] * (lo is not None) + [f"{value} <= {hi}"] * (hi is not None)
    return f"CASE WHEN {' AND '.join(tests)} THEN {value} END"


def _strip(c: str) -> str:
    return f"replace({c}, '_', '')"


def _num(c: str) -> str:
    return f"try_cast({c} AS DOUBLE)"


def quoted(name: str) -> str:
    return f'"{name}"'


BEHAVIOUR = (f"CASE WHEN Payment_Behaviour = '{K.BEHAVIOUR_SENTINEL}'"
             " THEN 'Unknown_spent_Unknown_value_payments' ELSE Payment_Behaviour END")

ATTRIBUTE_SQL = {
    "Age": _guard(_int(_strip("Age")), *K.AGE_RANGE),
    "SSN": f"CASE WHEN regexp_matches(SSN, '{K.SSN_PATTERN}') THEN SSN ELSE 'Unknown' END",
    "Occupation": f"CASE WHEN regexp_matches(Occupation, '{K.SYMBOLS_ONLY_PATTERN}')"
                  " THEN 'Unknown' ELSE Occupation END",
}
FINANCIAL_SQL = {
    "Annual_Income": _num(_strip("Annual_Income")),
    "Monthly_Inhand_Salary": _num("Monthly_Inhand_Salary"),
    "Num_Bank_Accounts": _guard(_int("Num_Bank_Accounts"), None, K.MAX_BANK_ACCOUNTS),
    "Num_Credit_Card": _guard(_int("Num_Credit_Card"), None, K.MAX_CREDIT_CARDS),
    "Interest_Rate": _guard(_int("Interest_Rate"), None, K.MAX_INTEREST_RATE),
    "Num_of_Loan": "CAST(coalesce(length(Type_of_Loan) - length(replace(Type_of_Loan, ',', ''))"
                   " + 1, 0) AS INTEGER)",
    "Type_of_Loan": "coalesce(Type_of_Loan, 'Unknown')",
    "Delay_from_due_date": _guard(_int("Delay_from_due_date"), *K.DELAY_DAYS_RANGE),
    "Num_of_Delayed_Payment": _guard(_int(_strip("Num_of_Delayed_Payment")),
                                     *K.DELAYED_PAYMENTS_RANGE),
    "Changed_Credit_Limit": _num(_strip("Changed_Credit_Limit")),
    "Num_Credit_Inquiries": _guard(_int("Num_Credit_Inquiries"), None, K.MAX_INQUIRIES),
    "Credit_Mix": "CASE WHEN Credit_Mix IS NULL OR Credit_Mix = '_' THEN 'Unknown'"
                  " ELSE Credit_Mix END",
    "Outstanding_Debt": _num(_strip("Outstanding_Debt")),
    "Credit_Utilization_Ratio": _num("Credit_Utilization_Ratio"),
    "Credit_History_Age_Months":
        "CASE WHEN Credit_History_Age IS NOT NULL THEN CAST("
        f"coalesce(try_cast(regexp_extract(Credit_History_Age, '{K.YEARS_PATTERN}', 1)"
        " AS INTEGER), 0) * 12 +"
        f" coalesce(try_cast(regexp_extract(Credit_History_Age, '{K.MONTHS_PATTERN}', 1)"
        " AS INTEGER), 0) AS INTEGER) END",
    "Total_EMI_per_month": _guard(_num("Total_EMI_per_month"), None, K.MAX_EMI),
    "Amount_Invested_Monthly":
        _num(f"nullif(Amount_Invested_Monthly, '{K.INVESTED_SENTINEL}')"),
    "Spent_Level": f"regexp_extract({BEHAVIOUR}, '{K.SPENT_PATTERN}', 1)",
    "Value_Payments": f"regexp_extract({BEHAVIOUR}, '{K.VALUE_PATTERN}', 1)",
    "Monthly_Balance": _num(f"nullif(Monthly_Balance, '{K.BALANCE_SENTINEL}')"),
}


def _replaced(columns: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in columns.items())


_FIN_NEW = "Credit_History_Age_Months", "Spent_Level", "Value_Payments"


def _fin_clean() -> str:
    old = {k: v for k, v in FINANCIAL_SQL.items() if k not in _FIN_NEW}
    new = {k: v for k, v in FINANCIAL_SQL.items() if k in _FIN_NEW}
    return f"SELECT * REPLACE ({_replaced(old)}), {_replaced(new)} FROM ad_financials"


# Spark sorts category names by code point, as Python and DuckDB's binary collation do
LOAN_TYPES = ["Auto Loan", "Credit-Builder Loan", "Debt Consolidation Loan",
              "Home Equity Loan", "Mortgage Loan", "Not Specified", "Payday Loan",
              "Personal Loan", "Student Loan"]
OCCUPATIONS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "Unknown"]
MIN_PAYMENTS = ["NM", "No", "Yes"]


def bin_sql(c: str) -> str:
    limits, labels = K.BINS[c]
    tests = " ".join(f"WHEN {c} < {x} THEN '{label}'" for x, label in zip(limits, labels))
    return f"CASE {tests} ELSE '{labels[-1]}' END"


def codes_sql(c: str, codes: dict[str, int]) -> str:
    tests = " ".join(f"WHEN {c} = '{v}' THEN {code}" for v, code in codes.items())
    return f"CAST(CASE {tests} END AS INTEGER)"


def flag_sql(test: str) -> str:
    return f"CAST(CASE WHEN {test} THEN 1 ELSE 0 END AS INTEGER)"


def one_hot_sql() -> dict[str, str]:
    out = {}
    for v in OCCUPATIONS:
        out[f"Occupation_{v}"] = flag_sql(f"Occupation = '{v}'")
    for v in MIN_PAYMENTS:
        out[f"Payment_of_Min_Amount_{v}"] = flag_sql(f"Payment_of_Min_Amount = '{v}'")
    return out


def multi_hot_sql() -> dict[str, str]:
    return {"Loan_" + v.replace(" ", "_").replace("-", "_"):
            flag_sql(f"contains(Type_of_Loan, '{v}')") for v in LOAN_TYPES}


def median_sql(c: str, source: str = "sv_customer") -> str:
    return f"(SELECT quantile_disc({c}, 0.5) FROM {source})"


def uniform_sql(key: str, seed: str) -> str:
    return (f"CAST(('0x' || substr(md5({key} || '|{seed}'), 1, 8)) AS UBIGINT)"
            " / CAST(4294967296 AS DOUBLE)")


def _imputed(c: str, source: str, fitted_on: str | None = None) -> str:
    """Customer_ID and the column with Unknown replaced by a proportional draw."""
    return f"""
SELECT t.Customer_ID, CASE WHEN t.{c} IN ('Unknown', '') THEN s.value ELSE t.{c} END AS {c}
FROM (SELECT Customer_ID, {c}, {uniform_sql('Customer_ID', f'{K.SPLIT_SEED}|{c}')} AS u
      FROM {source}) t
JOIN (SELECT value,
             CAST(coalesce(sum(n) OVER (ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING
                           AND 1 PRECEDING), 0) AS DOUBLE)
               / CAST(sum(n) OVER () AS DOUBLE) AS lo,
             CAST(sum(n) OVER (ORDER BY value) AS DOUBLE)
               / CAST(sum(n) OVER () AS DOUBLE) AS hi
      FROM (SELECT {c} AS value, count(*) AS n FROM {fitted_on or source}
            WHERE {c} NOT IN ('Unknown', '') GROUP BY 1)) s
  ON t.u >= s.lo AND t.u < s.hi"""


KEPT_BINS = list(K.BINS)
GOLD_NUMERIC = [
    "Age", "Monthly_Inhand_Salary", "Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate",
    "Num_of_Loan", "Delay_from_due_date", "Num_of_Delayed_Payment", "Delay_Inconsistent",
    "Changed_Credit_Limit", "Num_Credit_Inquiries", "Credit_Mix", "Outstanding_Debt",
    "Credit_Utilization_Ratio", "Credit_History_Age_Months", "Total_EMI_per_month",
    "Amount_Invested_Monthly", "Spent_Level", "Value_Payments",
]


def _gold_fitted(fitted_on: str = "sv_customer", spent: str = "gf_spent",
                 value: str = "gf_value") -> str:
    """Customers with medians and draws filled in."""
    filled = {c: f"coalesce({c}, {median_sql(c, fitted_on)})" for c in K.MEDIAN_COLUMNS}
    return f"""
SELECT c.* REPLACE ({_replaced(filled)}, s.Spent_Level AS Spent_Level,
                    v.Value_Payments AS Value_Payments)
FROM sv_customer c
LEFT JOIN {spent} s ON s.Customer_ID = c.Customer_ID
LEFT JOIN {value} v ON v.Customer_ID = c.Customer_ID"""


def _gold(source: str = "gf_customer") -> str:
    columns = {c: c for c in ["Customer_ID", "snapshot_date"] + GOLD_NUMERIC}
    mix = codes_sql("Credit_Mix", K.CREDIT_MIX_CODES)
    columns["Credit_Mix"] = mix
    columns["Spent_Level"] = codes_sql("Spent_Level", K.SPENT_LEVEL_CODES)
    columns["Value_Payments"] = codes_sql("Value_Payments", K.VALUE_PAYMENTS_CODES)
    columns["Delay_Inconsistent"] = "CAST(Delay_Inconsistent AS INTEGER)"
    columns["Credit_Mix_Known"] = (
        f"CAST(CASE WHEN {mix} = {K.CREDIT_MIX_CODES['Unknown']} THEN 0 ELSE 1 END AS INTEGER)")
    columns.update(one_hot_sql())
    columns.update(multi_hot_sql())
    for c in K.BINS:
        columns[f"{c}_binned"] = bin_sql(c)
    return ("SELECT " + ", ".join(f"{e} AS {quoted(n)}" for n, e in columns.items())
            + f" FROM {source}")


GOLD_COLUMNS = (["Customer_ID", "snapshot_date"] + GOLD_NUMERIC + ["Credit_Mix_Known"]
                + list(one_hot_sql()) + list(multi_hot_sql()) + [f"{c}_binned" for c in K.BINS])


def _ema_columns(fold: str) -> str:
    return ", ".join(fold.format(c=c) for c in A.PANEL_COLUMNS)


def _ema_running() -> str:
    step = ", ".join(
        f"CAST({1.0 - K.EMA_ALPHA} AS DOUBLE) * r.ema_{c} + CAST({K.EMA_ALPHA} AS DOUBLE) * p.{c}"
        for c in A.PANEL_COLUMNS)
    return f"""
SELECT Customer_ID, snapshot_date, i, {', '.join(f'{c} AS ema_{c}' for c in A.PANEL_COLUMNS)}
FROM em_rows WHERE i = 1
UNION ALL
SELECT p.Customer_ID, p.snapshot_date, p.i, {step}
FROM em_running r JOIN em_rows p ON p.Customer_ID = r.Customer_ID AND p.i = r.i + 1"""


def _ema_sparse() -> str:
    keep, new = f"CAST({1.0 - K.EMA_ALPHA} AS DOUBLE)", f"CAST({K.EMA_ALPHA} AS DOUBLE)"
    ys, ws = [], []
    for c in A.PANEL_COLUMNS:
        ys.append(f"CASE WHEN p.{c} IS NULL THEN r.y_{c} WHEN r.y_{c} IS NULL THEN p.{c}"
                  f" ELSE ((r.w_{c} * {keep}) * r.y_{c} + {new} * p.{c})"
                  f" / (r.w_{c} * {keep} + {new}) END")
        ws.append(f"CASE WHEN p.{c} IS NULL AND r.y_{c} IS NOT NULL THEN r.w_{c} * {keep}"
                  " ELSE CAST(1 AS DOUBLE) END")
    start = ", ".join(f"{c} AS y_{c}, CAST(1 AS DOUBLE) AS w_{c}" for c in A.PANEL_COLUMNS)
    step = ", ".join(f"{y}, {w}" for y, w in zip(ys, ws))
    return f"""
SELECT Customer_ID, i, {start} FROM em_sparse_rows WHERE i = 1
UNION ALL
SELECT p.Customer_ID, p.i, {step}
FROM em_sparse r JOIN em_sparse_rows p ON p.Customer_ID = r.Customer_ID AND p.i = r.i + 1"""


_HASH = f"CAST(('0x' || substr(md5(Customer_ID || '|{K.SPLIT_SEED}'), 1, 8)) AS UBIGINT)"

BLOCKS = {
    **A.ADAPTER_SQL,
    "sv_attributes": f"SELECT * EXCLUDE (Name) REPLACE ({_replaced(ATTRIBUTE_SQL)})"
                     " FROM ad_attributes",
    "sv_fin_typed": _fin_clean(),
    "sv_financials": """
SELECT * EXCLUDE (Payment_Behaviour),
       Monthly_Inhand_Salary * 12 > Annual_Income AS Income_Inconsistent,
       coalesce((Delay_from_due_date > 0 AND Num_of_Delayed_Payment = 0)
                OR (Delay_from_due_date = 0 AND Num_of_Delayed_Payment > 0), false)
         AS Delay_Inconsistent
FROM sv_fin_typed""",
    "sv_customer": """
SELECT a.*, f.* EXCLUDE (Customer_ID, snapshot_date)
FROM sv_attributes a LEFT JOIN sv_financials f
  ON f.Customer_ID = a.Customer_ID AND f.snapshot_date = a.snapshot_date""",
    "lg_typed": """
SELECT loan_id, Customer_ID, try_cast(loan_start_date AS DATE) AS loan_start_date,
       try_cast(tenure AS INTEGER) AS tenure,
       try_cast(installment_num AS INTEGER) AS installment_num,
       try_cast(loan_amt AS FLOAT) AS loan_amt, try_cast(due_amt AS FLOAT) AS due_amt,
       try_cast(paid_amt AS FLOAT) AS paid_amt, try_cast(overdue_amt AS FLOAT) AS overdue_amt,
       try_cast(balance AS FLOAT) AS balance, snapshot_date
FROM ad_ledger_raw""",
    "lg_missed": """
SELECT *, installment_num AS mob,
       CAST(coalesce(ceil(CAST(overdue_amt AS DOUBLE) / nullif(CAST(due_amt AS DOUBLE), 0)), 0)
            AS INTEGER) AS installments_missed
FROM lg_typed""",
    "lg_dated": """
SELECT *, CASE WHEN installments_missed > 0
               THEN CAST(snapshot_date - to_months(installments_missed) AS DATE) END
            AS first_missed_date
FROM lg_missed""",
    "lg_dpd": """
SELECT *, CAST(CASE WHEN overdue_amt > 0 THEN date_diff('day', first_missed_date, snapshot_date)
                    ELSE 0 END AS INTEGER) AS dpd
FROM lg_dated""",
    "lb_labels": f"""
SELECT loan_id, Customer_ID,
       CAST(CASE WHEN dpd >= {K.DEFAULT_DPD} THEN 1 ELSE 0 END AS INTEGER) AS label,
       '{K.DEFAULT_DPD}dpd_{K.DEFAULT_MOB}mob' AS label_def, snapshot_date
FROM lg_dpd WHERE mob = {K.DEFAULT_MOB}""",
    "lb_customer": """
SELECT Customer_ID, max(label) AS label, max(snapshot_date) AS snapshot_date
FROM lb_labels GROUP BY Customer_ID""",
    "gf_spent": _imputed("Spent_Level", "sv_customer"),
    "gf_value": _imputed("Value_Payments", "sv_customer"),
    "gf_customer": _gold_fitted(),
    "gf_gold": _gold(),
    "tr_customer": """
SELECT c.* FROM sv_customer c
WHERE c.Customer_ID IN (SELECT Customer_ID FROM tr_split WHERE split = 'train')""",
    "gf_spent_train": _imputed("Spent_Level", "sv_customer", "tr_customer"),
    "gf_value_train": _imputed("Value_Payments", "sv_customer", "tr_customer"),
    "gf_customer_train": _gold_fitted("tr_customer", "gf_spent_train", "gf_value_train"),
    "gf_gold_train": _gold("gf_customer_train"),
    "em_rows": "SELECT *, row_number() OVER (PARTITION BY Customer_ID ORDER BY snapshot_date)"
               " AS i FROM ad_panel",
    "em_running": _ema_running(),
    "em_latest": f"""
SELECT Customer_ID, {', '.join(f'arg_max(ema_{c}, i) AS ema_{c}' for c in A.PANEL_COLUMNS)}
FROM em_running GROUP BY Customer_ID""",
    "em_sparse_rows":
        "SELECT *, row_number() OVER (PARTITION BY Customer_ID ORDER BY snapshot_date) AS i"
        " FROM ad_panel_sparse",
    "em_sparse": _ema_sparse(),
    "gf_with_ema": f"""
SELECT g.*, {', '.join(f'e.{c}' for c in A.EMA_COLUMNS)},
       {flag_sql('e.Customer_ID IS NOT NULL')} AS has_clickstream
FROM gf_gold g LEFT JOIN em_latest e ON e.Customer_ID = g.Customer_ID""",
    "tr_oot": f"""
SELECT *, snapshot_date IN (SELECT DISTINCT snapshot_date FROM lb_customer
                            ORDER BY snapshot_date DESC LIMIT {K.OOT_MONTHS}) AS is_oot
FROM lb_customer""",
    "tr_ranked": f"""
SELECT *, row_number() OVER (PARTITION BY label, is_oot ORDER BY {_HASH}, Customer_ID) AS rk,
       count(*) OVER (PARTITION BY label, is_oot) AS n
FROM tr_oot""",
    "tr_split": """
SELECT Customer_ID, label, snapshot_date,
       CASE WHEN is_oot THEN 'oot' WHEN rk <= n * 80 // 100 THEN 'train'
            WHEN rk <= n * 80 // 100 + n * 10 // 100 THEN 'val' ELSE 'test' END AS split
FROM tr_ranked""",
    "tr_set": f"""
SELECT l.Customer_ID, l.label, l.split, l.snapshot_date AS label_date,
       f.* EXCLUDE (Customer_ID)
FROM tr_split l LEFT JOIN gf_with_ema f ON f.Customer_ID = l.Customer_ID""",
    "tr_scaler": "SELECT " + ", ".join(
        f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in A.EMA_COLUMNS)
        + " FROM tr_set WHERE split = 'train'",
    "sc_baseline": f"SELECT * FROM ad_scored WHERE inference_date < DATE '{A.BASELINE_END}'",
    "sc_batches": f"SELECT * FROM ad_scored WHERE inference_date >= DATE '{A.BASELINE_END}'",
    "sc_psi_expected": """
SELECT count(*) FILTER (prediction = 0) / CAST(count(*) AS DOUBLE) AS e0,
       count(*) FILTER (prediction = 1) / CAST(count(*) AS DOUBLE) AS e1
FROM sc_baseline WHERE model_label = 'production'""",
    "sc_psi": """
SELECT b.inference_date,
       round((a0 - e0) * ln(a0 / e0) + (a1 - e1) * ln(a1 / e1), 4) AS psi
FROM (SELECT inference_date,
             coalesce(nullif(count(*) FILTER (prediction = 0) / CAST(count(*) AS DOUBLE), 0), 1e-6)
               AS a0,
             coalesce(nullif(count(*) FILTER (prediction = 1) / CAST(count(*) AS DOUBLE), 0), 1e-6)
               AS a1
      FROM sc_batches WHERE model_label = 'production' GROUP BY 1) b, sc_psi_expected""",
    "sc_matured": """
SELECT s.* EXCLUDE (label), l.label, l.snapshot_date AS label_date
FROM ad_scored s JOIN (
    SELECT Customer_ID, max(label) AS label, max(snapshot_date) AS snapshot_date
    FROM lb_labels WHERE snapshot_date <= DATE '2001-01-01' GROUP BY Customer_ID
) l ON l.Customer_ID = s.Customer_ID
WHERE s.inference_date <= DATE '2001-01-01'""",
    "rg_trained": """
SELECT DISTINCT 'credit_model_' || strftime(inference_date, '%Y_%m_%d') AS model_version,
       inference_date AS trained
FROM ad_scored""",
    "rg_registry": """
SELECT model_version, trained,
       CASE WHEN n = 1 THEN 'production' ELSE 'autoML' || CAST(n - 1 AS VARCHAR) END AS model_label
FROM (SELECT *, row_number() OVER (ORDER BY trained) AS n FROM rg_trained)""",
}
RECURSIVE = {"em_running", "em_sparse"}


def metrics_sql(source: str, by: str, pred: str | None = None, dp: int = 4) -> str:
    """Rank-sum Gini and recall per group."""
    tp = f"count(*) FILTER (label = 1 AND {pred} = 1)" if pred else "CAST(NULL AS BIGINT)"
    return f"""
SELECT {by}, CAST(sum(pos) + sum(neg) AS BIGINT) AS n, CAST(sum(pos) AS BIGINT) AS positives,
       CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN
         round(CAST(sum(CAST(pos AS HUGEINT) * (2 * below + neg)) AS DOUBLE)
               / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) - 1, {dp}) END AS gini,
       CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN
         round(CAST(sum(tp) AS DOUBLE) / CAST(sum(pos) AS DOUBLE), {dp}) END AS recall
FROM (SELECT *, sum(neg) OVER (PARTITION BY {by} ORDER BY score) - neg AS below
      FROM (SELECT {by}, score, count(*) FILTER (label = 1) AS pos,
                   count(*) FILTER (label = 0) AS neg, {tp} AS tp
            FROM {source} GROUP BY {by}, score))
GROUP BY {by}"""


def csi_sql(features: dict[str, str], source: str = "sc_batches",
            base: str = "sc_baseline") -> str:
    """CSI per month; ``features``: name -> 'continuous' or 'discrete'."""
    parts = []
    for c, kind in features.items():
        if kind == "continuous":
            edges = (f"(SELECT list_sort(list_distinct(quantile_cont({c},"
                     f" [{', '.join(str(i / 10) for i in range(11))}]))) FROM {base})")
            value = (f"CAST(len(list_filter({edges}[2:-2], lambda x: x <= {c})) AS VARCHAR)")
            bins = f"SELECT CAST(unnest(range(0, len({edges}) - 1)) AS VARCHAR) AS bin"
        else:
            value = f"CAST({c} AS VARCHAR)"
            bins = (f"SELECT DISTINCT CAST({c} AS VARCHAR) AS bin FROM"
                    f" (SELECT {c} FROM {base} UNION ALL SELECT {c} FROM {source})")
        parts.append(f"""
SELECT m.inference_date, '{c}' AS feature,
       round(sum((m.a - m.e) * ln(m.a / m.e)), 4) AS csi
FROM (SELECT d.inference_date, g.bin,
             coalesce(nullif(coalesce(x.n, 0) / CAST(t.n AS DOUBLE), 0), 1e-6) AS a,
             coalesce(nullif(coalesce(y.n, 0) / CAST(u.n AS DOUBLE), 0), 1e-6) AS e
      FROM (SELECT DISTINCT inference_date FROM {source}) d
      CROSS JOIN ({bins}) g
      JOIN (SELECT inference_date, count({c}) AS n FROM {source} GROUP BY 1) t
        ON t.inference_date = d.inference_date
      CROSS JOIN (SELECT count({c}) AS n FROM {base}) u
      LEFT JOIN (SELECT inference_date, {value} AS bin, count(*) AS n FROM {source}
                 GROUP BY ALL) x ON x.inference_date = d.inference_date AND x.bin = g.bin
      LEFT JOIN (SELECT {value} AS bin, count(*) AS n FROM {base} GROUP BY ALL) y
        ON y.bin = g.bin) m
GROUP BY 1""")
    return " UNION ALL ".join(parts)


def matrix_sql(source: str) -> str:
    """The feature matrix of the training set, columns in any order."""
    numeric = ([c for c in GOLD_COLUMNS if c not in ("Customer_ID", "snapshot_date")
                and not c.endswith("_binned")] + ["has_clickstream"])
    columns = {safe_name(c): f"coalesce(CAST({quoted(c)} AS DOUBLE), 0)" for c in numeric}
    for c in A.EMA_COLUMNS:
        columns[c] = f"round(coalesce(({c} - m_{c}) / s_{c}, 0), 6)"
    for c, (_, labels) in K.BINS.items():
        for v in labels:
            columns[safe_name(f"{c}_binned_{v}")] = (
                f"CASE WHEN {c}_binned = '{v}' THEN CAST(1 AS DOUBLE) ELSE 0 END")
    return ("SELECT Customer_ID, label, split, "
            + ", ".join(f"CAST({e} AS DOUBLE) AS {quoted(n)}" for n, e in columns.items())
            + f" FROM {source}, tr_scaler")


def oracle(body: str) -> str:
    needed: list[str] = []

    def visit(text: str):
        for name in re.findall(r"\b(?:ad|sv|lg|lb|gf|em|tr|sc|rg)_[a-z_]+\b", text):
            if name in BLOCKS and name not in needed:
                if name in RECURSIVE:
                    visit(re.sub(rf"\b{name}\b", "", BLOCKS[name]))
                else:
                    visit(BLOCKS[name])
                if name not in needed:
                    needed.append(name)
    visit(body)
    if not needed:
        return body
    recursive = "RECURSIVE " if RECURSIVE & set(needed) else ""
    ctes = ",\n".join(f"{n} AS ({BLOCKS[n]})" for n in needed)
    return f"WITH {recursive}{ctes}\n{body.strip()}"
