"""Every operator as a query over the given tables, with the SQL it must agree with.

A query is a function (spark, sf_dir) -> DataFrame. Its SQL is None where the
result is a fitted model's.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lendmart import constants as K
from lendmart.functions import clean as C, encode as E
from lendmart.operators import (cleansing, drift, ema_state, features, joins, ledger, matrix,
                                maturity, metrics, model, monitor, panel, ranks, score, split, stats)
from lendmart.plans import adapters as A
from lendmart.plans.checks import (GOLD_COLUMNS, LOAN_TYPES, OCCUPATIONS, bin_sql, codes_sql,
                                   csi_sql, flag_sql, matrix_sql, median_sql, metrics_sql,
                                   multi_hot_sql, one_hot_sql, oracle, quoted)
from lendmart.schemas import LEDGER
from lendmart.session import tune
from lendmart.sources import published, snapshots

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = functools.wraps(fn)(lambda spark, d: fn(tune(spark), d))
        if sql is not None:
            ORACLES[fn.__name__] = oracle(sql)
        return fn
    return add


# --- shared inputs -----------------------------------------------------------

def clean_customers(spark, d) -> DataFrame:
    return joins.customer_snapshot(cleansing.clean_attributes(A.attributes(spark, d)),
                                   cleansing.clean_financials(A.financials(spark, d)))


def typed(spark, d) -> DataFrame:
    return cleansing.project(A.ledger_raw(spark, d), LEDGER)


def dpd_ledger(spark, d) -> DataFrame:
    return ledger.with_dpd(typed(spark, d))


def loan_labels(spark, d) -> DataFrame:
    return ledger.labels(dpd_ledger(spark, d))


def customer_labels(spark, d) -> DataFrame:
    return ledger.one_label_per_customer(loan_labels(spark, d))


def staged_customers(spark, d) -> DataFrame:
    """Cleansed customers, evaluated once for the passes of fit and transform."""
    return snapshots.stage(clean_customers(spark, d))


def gold(spark, d) -> DataFrame:
    customers = staged_customers(spark, d)
    return features.apply_features(customers, features.fit_features(customers))


def gold_with_ema(spark, d) -> DataFrame:
    ema = panel.ema_latest(A.panel(spark, d), A.PANEL_COLUMNS)
    return joins.with_ema(gold(spark, d), ema)


def split_labels(spark, d) -> DataFrame:
    """Customers' labels with their split, made before the wide join."""
    return split.split_sets(snapshots.stage(customer_labels(spark, d)), date=K.SNAPSHOT)


def baseline_and_batches(spark, d) -> tuple[DataFrame, DataFrame]:
    rows = A.scored(spark, d)
    cut = F.lit(A.BASELINE_END).cast("date")
    return (rows.filter(F.col("inference_date") < cut),
            rows.filter(F.col("inference_date") >= cut))


def month_cut(column: str, start: str, months: int = 1):
    """A month as a range on the raw column, so that the scan can use it."""
    first = F.lit(start).cast("date")
    return (F.col(column) >= first) & (F.col(column) < F.add_months(first, months))


_ROUND_EMA = ", ".join(f"round({c}, 6) AS {c}" for c in A.EMA_COLUMNS)


def rounded(df: DataFrame, columns=tuple(A.EMA_COLUMNS), dp: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), dp) for c in columns})


# --- sources -------------------------------------------------------------------

@query("""SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate
          FROM orders WHERE o_orderdate >= DATE '1998-03-01' AND o_orderdate < DATE '1998-04-01'""")
def snapshot_extract(spark, d):
    """One month of a table; the date range reaches the parquet scan."""
    return (A.table(spark, d, "orders").filter(month_cut("o_orderdate", "1998-03-01"))
            .select("o_orderkey", "o_custkey", "o_totalprice",
                    F.col("o_orderdate").cast("date").alias("o_orderdate")))


@query("""
SELECT loan_id, Customer_ID, label, label_def, CAST(NULL AS INTEGER) AS dpd, snapshot_date
FROM lb_labels WHERE snapshot_date <> DATE '1999-01-01'
UNION ALL
SELECT loan_id, Customer_ID, CAST(CASE WHEN dpd >= 60 THEN 1 ELSE 0 END AS INTEGER),
       '60dpd_6mob', dpd, snapshot_date
FROM lg_dpd WHERE mob = 6 AND snapshot_date = DATE '1999-01-01'""")
def slice_upsert(spark, d):
    """Replace one month of the label store by rows with one more column."""
    rows = dpd_ledger(spark, d)
    month = snapshots.snapshot_of(rows, "1999-01-01")
    new = month.filter(F.col("mob") == K.DEFAULT_MOB).select(
        "loan_id", "Customer_ID", F.when(F.col("dpd") >= 60, 1).otherwise(0).alias("label"),
        F.lit("60dpd_6mob").alias("label_def"), "dpd", "snapshot_date")
    return snapshots.upsert_slice(ledger.labels(rows), new, "1999-01-01")


@query("SELECT DISTINCT inference_date, model_label FROM ad_scored")
def list_batches(spark, d):
    """Batch discovery: the distinct batches and models of the scored table."""
    return snapshots.list_slices(A.scored(spark, d), "inference_date", "model_label")


@query("SELECT CAST(snapshot_date AS VARCHAR) AS slice, count(*) AS rows FROM ad_order_slices"
       " GROUP BY 1")
def slice_manifest(spark, d):
    """The months of a published table and their sizes, read from its manifest. The last
    month is published twice, at first with every row; readers see the second version."""
    path = f"{snapshots.checkpoint_folder(spark)}/published-{uuid.uuid4().hex}"
    rows = snapshots.stage(A.order_slices(spark, d))
    last = rows.agg(F.max("snapshot_date")).first()[0]
    if last is not None:
        published.publish(rows, path, last)
        published.publish_slices(rows, path, "snapshot_date")
    return published.slices(spark, path).select("slice", "rows")


# --- cleansing -------------------------------------------------------------------

def _clean(spark, d, *columns, source=None):
    raw = source(spark, d)
    rules = {**cleansing.attribute_rules(), **cleansing.financial_rules()}
    return raw.select(K.CUSTOMER, *[rules[c].alias(c) for c in columns])


@query("SELECT Customer_ID, Age FROM sv_attributes")
def clean_numeric(spark, d):
    """Junk characters out, lenient cast, two-sided guard."""
    return _clean(spark, d, "Age", source=A.attributes)


@query("""SELECT Customer_ID, Num_Bank_Accounts, Num_Credit_Card, Interest_Rate,
                 Delay_from_due_date, Num_of_Delayed_Payment, Num_Credit_Inquiries,
                 Total_EMI_per_month FROM sv_financials""")
def range_guard(spark, d):
    return _clean(spark, d, "Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate",
                  "Delay_from_due_date", "Num_of_Delayed_Payment", "Num_Credit_Inquiries",
                  "Total_EMI_per_month", source=A.financials)


@query("SELECT Customer_ID, SSN, Occupation FROM sv_attributes")
def regex_conform(spark, d):
    return _clean(spark, d, "SSN", "Occupation", source=A.attributes)


@query("""SELECT Customer_ID, Type_of_Loan, Changed_Credit_Limit, Credit_Mix,
                 Amount_Invested_Monthly, Monthly_Balance FROM sv_financials""")
def sentinel_clean(spark, d):
    return _clean(spark, d, "Type_of_Loan", "Changed_Credit_Limit", "Credit_Mix",
                  "Amount_Invested_Monthly", "Monthly_Balance", source=A.financials)


def _cents_sql(c: str) -> str:
    return (f"CAST(CAST(CAST(replace({c}, '_', '') AS DECIMAL(18,3)) AS DECIMAL(18,2)) AS DOUBLE)"
            f" AS {c}")


_AMOUNTS = ["Annual_Income", "Monthly_Inhand_Salary", "Outstanding_Debt",
          "Credit_Utilization_Ratio"]


@query(f"SELECT Customer_ID, {', '.join(map(_cents_sql, _AMOUNTS))} FROM ad_money_text")
def money_round(spark, d):
    """Amounts of three digits to cents, half up."""
    return _clean(spark, d, *_AMOUNTS, source=A.money_text)


@query("SELECT Customer_ID, Income_Inconsistent, Delay_Inconsistent FROM sv_financials")
def consistency_flags(spark, d):
    return (cleansing.clean_financials(A.financials(spark, d))
            .select(K.CUSTOMER, "Income_Inconsistent", "Delay_Inconsistent"))


@query("SELECT Customer_ID, Num_of_Loan FROM sv_financials")
def list_count(spark, d):
    return _clean(spark, d, "Num_of_Loan", source=A.financials)


@query("SELECT Customer_ID, Credit_History_Age_Months FROM sv_financials")
def duration_months(spark, d):
    return _clean(spark, d, "Credit_History_Age_Months", source=A.financials)


@query("SELECT Customer_ID, Spent_Level, Value_Payments FROM sv_financials")
def code_split(spark, d):
    return _clean(spark, d, "Spent_Level", "Value_Payments", source=A.financials)


_AUDITED = ["Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate", "Delay_from_due_date",
            "Num_of_Delayed_Payment", "Changed_Credit_Limit", "Num_Credit_Inquiries",
            "Credit_Mix", "Type_of_Loan", "Total_EMI_per_month", "Amount_Invested_Monthly",
            "Monthly_Balance"]


def _audit_sql(columns, raw, clean) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS total,"
        f" count(*) FILTER (c.{c} IS NULL AND r.{c} IS NOT NULL) AS nulled,"
        f" count(*) FILTER (CAST(c.{c} AS VARCHAR) = 'Unknown'"
        f" AND r.{c} IS DISTINCT FROM 'Unknown') AS replaced"
        f" FROM {raw} r JOIN {clean} c ON c.Customer_ID = r.Customer_ID"
        for c in columns)


@query(_audit_sql(_AUDITED, "ad_financials", "sv_financials") + " UNION ALL "
       + _audit_sql(["Age", "SSN", "Occupation"], "ad_attributes", "sv_attributes"))
def clean_audit(spark, d):
    """Counts of nulled and replaced values, one pass per table."""
    rules = {c: r for c, r in cleansing.financial_rules().items() if c in _AUDITED}
    return cleansing.audit(A.financials(spark, d), rules).unionByName(
        cleansing.audit(A.attributes(spark, d), cleansing.attribute_rules()))


# --- ledger and labels -------------------------------------------------------------

_MONEY = ["loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance"]
_MONEY_SQL = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _MONEY)


def _as_double(df):
    return df.withColumns({c: F.col(c).cast("double") for c in _MONEY})


@query(f"SELECT * REPLACE ({_MONEY_SQL}) FROM lg_typed")
def typed_ledger(spark, d):
    return _as_double(typed(spark, d))


_FILLED_SQL = ", ".join(f"CAST(coalesce({c}, 0) AS DOUBLE) AS {c}" for c in _MONEY)


@query(f"SELECT * REPLACE ({_FILLED_SQL}) FROM lg_dpd")
def ledger_dpd(spark, d):
    return _as_double(dpd_ledger(spark, d))


@query("SELECT * FROM lb_labels")
def default_label(spark, d):
    return loan_labels(spark, d)


@query("""SELECT snapshot_date, count(*) AS loans, count(*) FILTER (label = 1) AS defaults,
                 count(*) FILTER (label = 1) / CAST(count(*) AS DOUBLE) AS default_rate
          FROM lb_labels GROUP BY 1""")
def default_rate_by_month(spark, d):
    """Flagship: default rate of every monthly cohort."""
    return ledger.default_rate(loan_labels(spark, d))


@query("SELECT Customer_ID, label, snapshot_date FROM lb_customer")
def customer_label(spark, d):
    return customer_labels(spark, d)


# --- joins ------------------------------------------------------------------------

@query("SELECT * FROM sv_customer")
def customer_snapshot(spark, d):
    return clean_customers(spark, d)


@query(f"""SELECT Customer_ID, snapshot_date, Age, Credit_Mix, {_ROUND_EMA}, has_clickstream
           FROM gf_with_ema""")
def features_with_ema(spark, d):
    return rounded(gold_with_ema(spark, d)).select(
        "Customer_ID", "snapshot_date", "Age", "Credit_Mix", *A.EMA_COLUMNS, "has_clickstream")


@query(f"SELECT * REPLACE ({_ROUND_EMA}) FROM tr_set")
def training_set(spark, d):
    """Split labels with all features."""
    return rounded(joins.training_set(split_labels(spark, d), gold_with_ema(spark, d)))


@query("""
SELECT l.Customer_ID, l.label, l.snapshot_date AS label_date, f.snapshot_date, f.n_orders, f.spend
FROM lb_customer l ASOF LEFT JOIN ad_order_slices f
  ON f.Customer_ID = l.Customer_ID AND l.snapshot_date >= f.snapshot_date""")
def training_set_asof(spark, d):
    """Labelled customers with their newest month of orders up to the label, if any."""
    return joins.training_set_asof(customer_labels(spark, d), A.order_slices(spark, d))


@query("""SELECT Customer_ID, loan_id, score, prediction, model_label, inference_date,
                 label, label_date FROM sc_matured""")
def matured_scores(spark, d):
    scored = A.scored(spark, d).select("Customer_ID", "loan_id", "score", "prediction",
                                       "model_label", "inference_date")
    return joins.matured(scored, loan_labels(spark, d), as_of="2001-01-01")


def registry(spark, d) -> DataFrame:
    """A model per scored month; the earliest serves in production."""
    trained = A.scored(spark, d).select(
        F.concat(F.lit("credit_model_"), F.date_format("inference_date", "yyyy_MM_dd"))
        .alias("model_version"), F.col("inference_date").alias("trained")).distinct()
    return monitor.register(trained)


@query("SELECT model_version, trained, model_label FROM rg_registry")
def automl_names(spark, d):
    return registry(spark, d)


@query("""
SELECT b.inference_date, r.model_label, r.model_version
FROM (SELECT DISTINCT inference_date FROM ad_scored) b JOIN rg_registry r
  ON (r.model_label = 'production' AND b.inference_date > r.trained)
  OR (r.model_label <> 'production'
      AND r.trained = CAST(b.inference_date - to_months(1) AS DATE))""")
def model_for_month(spark, d):
    batches = snapshots.list_slices(A.scored(spark, d), "inference_date")
    return joins.models_for(registry(spark, d), batches)


# --- aggregations -------------------------------------------------------------------

@query("SELECT label, count(*) AS n FROM lb_customer GROUP BY 1")
def label_distribution(spark, d):
    return stats.group_counts(customer_labels(spark, d), ["label"])


@query("SELECT DISTINCT Occupation AS value FROM sv_attributes WHERE Occupation IS NOT NULL")
def vocabulary(spark, d):
    return stats.vocabulary(cleansing.clean_attributes(A.attributes(spark, d)), "Occupation")


@query("""
SELECT DISTINCT CASE WHEN starts_with(item, 'and ') THEN substr(item, 5) ELSE item END AS value
FROM (SELECT unnest(string_split(Type_of_Loan, ', ')) AS item FROM sv_financials)
WHERE item NOT IN ('Unknown', 'and Unknown')""")
def list_vocabulary(spark, d):
    return stats.list_vocabulary(cleansing.clean_financials(A.financials(spark, d)),
                                 "Type_of_Loan")


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({median_sql(c)} AS DOUBLE) AS median"
    for c in K.MEDIAN_COLUMNS))
def medians(spark, d):
    """Exact medians of ten columns at once."""
    return ranks.medians(staged_customers(spark, d), K.MEDIAN_COLUMNS)


@query("""
SELECT Spent_Level AS value, count(*) AS n,
       count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share
FROM sv_financials WHERE Spent_Level NOT IN ('Unknown', '') GROUP BY 1""")
def category_shares(spark, d):
    return stats.shares(cleansing.clean_financials(A.financials(spark, d)), "Spent_Level")


@query("SELECT split, count(*) AS n, avg(CAST(label AS DOUBLE)) AS label_rate"
       " FROM tr_split GROUP BY 1")
def split_stats(spark, d):
    return stats.split_stats(split_labels(spark, d))


@query("SELECT inference_date, model_label, count(*) AS n, round(avg(score), 6) AS mean_score"
       " FROM ad_scored GROUP BY ALL")
def score_summary(spark, d):
    return A.scored(spark, d).groupBy("inference_date", "model_label").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 6).alias("mean_score"))


_MIX = """count(*) AS n, count(*) FILTER (prediction = 0) / CAST(count(*) AS DOUBLE) AS share_0,
          count(*) FILTER (prediction = 1) / CAST(count(*) AS DOUBLE) AS share_1"""


@query(f"""SELECT 'expected' AS side, CAST(NULL AS DATE) AS inference_date, {_MIX}
           FROM sc_baseline
           UNION ALL
           SELECT 'actual', inference_date, {_MIX} FROM sc_batches GROUP BY inference_date""")
def label_mix(spark, d):
    """Expected and actual label shares side by side."""
    baseline, batches = baseline_and_batches(spark, d)
    expected = stats.label_mix(baseline, "prediction").withColumns(
        {"side": F.lit("expected"), "inference_date": F.lit(None).cast("date")})
    actual = stats.label_mix(batches, "prediction", ["inference_date"]).withColumn(
        "side", F.lit("actual"))
    return expected.unionByName(actual).select("side", "inference_date", "n", "share_0",
                                               "share_1")


# --- panel -----------------------------------------------------------------------

@query(f"SELECT Customer_ID, {_ROUND_EMA} FROM em_latest")
def ema_latest(spark, d):
    return rounded(panel.ema_latest(A.panel(spark, d), A.PANEL_COLUMNS))


_GRID_DAYS = "1 + date_diff('day', DATE '2024-01-01', DATE '2024-01-30')"


@query(f"""
SELECT Customer_ID, {', '.join(
    f"round(list_reduce(list(x_{c} ORDER BY day),"
    f" lambda y, x: CAST(0.9 AS DOUBLE) * y + CAST(0.1 AS DOUBLE) * x), 6) AS ema_{c}"
    for c in A.PANEL_COLUMNS)}
FROM (SELECT u.Customer_ID, g.day,
             {', '.join(f'coalesce(p.{c}, 0) AS x_{c}' for c in A.PANEL_COLUMNS)}
      FROM (SELECT DISTINCT Customer_ID FROM ad_panel) u
      CROSS JOIN (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30',
                                                     INTERVAL 1 DAY)) AS DATE) AS day) g
      LEFT JOIN ad_panel p ON p.Customer_ID = u.Customer_ID AND p.snapshot_date = g.day)
GROUP BY 1""")
def ema_latest_grid(spark, d):
    """EMA over the zero-filled daily grid, without building the grid."""
    return rounded(panel.ema_latest_on_grid(
        A.panel(spark, d), A.PANEL_COLUMNS, as_of="2024-01-30", start="2024-01-01", unit="DAY"))


@query("SELECT Customer_ID, " + ", ".join(
    f"arg_max(struct_pack(v := y_{c}), i).v AS ema_{c}" for c in A.PANEL_COLUMNS)
    + " FROM em_sparse GROUP BY Customer_ID")
def ema_latest_sparse(spark, d):
    return panel.ema_latest_sparse(A.panel(spark, d, sparse=True), A.PANEL_COLUMNS)


_EMA_START, _EMA_DAYS = "2024-01-01", 6  # slices of the incremental average


@query("SELECT Customer_ID, " + ", ".join(
    f"round(arg_max(struct_pack(v := y_{c}), i).v, 6) AS ema_{c}" for c in A.PANEL_COLUMNS)
    + " FROM em_sparse GROUP BY Customer_ID")
def ema_incremental(spark, d):
    """The averages after slices of the panel that were added one by one, the second one
    late: each slice is read once, the states after the late one are composed again."""
    slice_ = F.floor(F.datediff(K.SNAPSHOT, F.lit(_EMA_START).cast("date")) / _EMA_DAYS)
    path = f"{snapshots.checkpoint_folder(spark)}/panel-{uuid.uuid4().hex}"
    snapshots.write_slices(A.panel(spark, d, sparse=True).withColumn("slice", slice_), path,
                           by=["slice"])
    rows = spark.read.parquet(path)
    order = sorted(r[0] for r in rows.select("slice").distinct().collect())
    maps, states = {}, {}
    for arrived in order[:1] + order[2:] + order[1:2]:
        maps[arrived] = snapshots.stage(ema_state.summarise(
            rows.filter(F.col("slice") == arrived), A.PANEL_COLUMNS))
        for at in [x for x in sorted(maps) if x >= arrived]:
            before = max((x for x in states if x < at), default=None)
            states[at] = maps[at] if before is None else snapshots.stage(
                ema_state.advance(states[before], maps[at]))
    return rounded(ema_state.averages(states[order[-1]]))


@query("SELECT Customer_ID, snapshot_date, " + ", ".join(A.EMA_COLUMNS) + " FROM em_running")
def ema_running(spark, d):
    return panel.ema_running(A.panel(spark, d), A.PANEL_COLUMNS)


@query("""SELECT * EXCLUDE (rn) FROM
          (SELECT *, row_number() OVER (PARTITION BY Customer_ID ORDER BY snapshot_date DESC) AS rn
           FROM ad_panel) WHERE rn = 1""")
def latest_per_key(spark, d):
    return panel.latest_per_key(A.panel(spark, d), K.CUSTOMER, K.SNAPSHOT)


# --- features --------------------------------------------------------------------

@query("SELECT Customer_ID, " + ", ".join(
    f"coalesce({c}, {median_sql(c)}) AS {c}" for c in K.MEDIAN_COLUMNS) + " FROM sv_customer")
def median_impute(spark, d):
    customers = staged_customers(spark, d)
    return (features.impute_medians(customers, features.fit_medians(customers))
            .select(K.CUSTOMER, *K.MEDIAN_COLUMNS))


def _categories(df, single, lists=()):
    return stats.collect_categories(stats.category_counts(df, single, lists))


@query("SELECT Customer_ID, " + ", ".join(f"{e} AS {quoted(n)}" for n, e in one_hot_sql().items())
       + " FROM sv_customer")
def one_hot(spark, d):
    customers = clean_customers(spark, d)
    found = _categories(customers, features.ONE_HOT)
    columns = [e.alias(n) for c in features.ONE_HOT for n, e in E.one_hot(c, found[c]).items()]
    return customers.select(K.CUSTOMER, *columns)


@query("SELECT Customer_ID, " + ", ".join(
    f"{e} AS {quoted(n)}" for n, e in multi_hot_sql().items()) + " FROM sv_financials")
def multi_hot(spark, d):
    rows = cleansing.clean_financials(A.financials(spark, d))
    found = _categories(rows, [], [features.MULTI_HOT])[features.MULTI_HOT]
    flags = E.multi_hot(features.MULTI_HOT, [v for v in found if v != K.UNKNOWN])
    return rows.select(K.CUSTOMER, *[e.alias(n) for n, e in flags.items()])


@query("SELECT Customer_ID, " + ", ".join(f"{bin_sql(c)} AS {c}_binned" for c in K.BINS)
       + " FROM sv_customer")
def fixed_bins(spark, d):
    return clean_customers(spark, d).select(
        K.CUSTOMER, *[E.bin_label(F.col(c), limits, labels).alias(f"{c}_binned")
                      for c, (limits, labels) in K.BINS.items()])


_MIX_CODE = codes_sql("Credit_Mix", K.CREDIT_MIX_CODES)


@query(f"""SELECT Customer_ID, {_MIX_CODE} AS Credit_Mix,
                  CAST(CASE WHEN {_MIX_CODE} = 1 THEN 0 ELSE 1 END AS INTEGER) AS Credit_Mix_Known,
                  {codes_sql('Spent_Level', K.SPENT_LEVEL_CODES)} AS Spent_Level,
                  {codes_sql('Value_Payments', K.VALUE_PAYMENTS_CODES)} AS Value_Payments
           FROM sv_customer""")
def ordinal_encode(spark, d):
    mix = E.ordinal(F.col("Credit_Mix"), K.CREDIT_MIX_CODES)
    return clean_customers(spark, d).select(
        K.CUSTOMER, mix.alias("Credit_Mix"), E.known_flag(mix).alias("Credit_Mix_Known"),
        E.ordinal(F.col("Spent_Level"), K.SPENT_LEVEL_CODES).alias("Spent_Level"),
        E.ordinal(F.col("Value_Payments"), K.VALUE_PAYMENTS_CODES).alias("Value_Payments"))


@query("SELECT Customer_ID, s.Spent_Level, v.Value_Payments FROM sv_customer"
       " JOIN gf_spent s USING (Customer_ID) JOIN gf_value v USING (Customer_ID)")
def proportional_impute(spark, d):
    customers = clean_customers(spark, d)
    state = features.FeatureState(categories=_categories(customers, features.IMPUTED))
    return (features.impute_shares(customers, state)
            .select(K.CUSTOMER, "Spent_Level", "Value_Payments"))


@query("SELECT " + ", ".join(quoted(c) for c in GOLD_COLUMNS) + " FROM gf_gold")
def gold_features_wide(spark, d):
    """All feature engineering of the customer table."""
    return gold(spark, d)


@query("SELECT " + ", ".join(quoted(c) for c in GOLD_COLUMNS) + " FROM gf_gold_train")
def features_fitted_on_train(spark, d):
    """All customers transformed by statistics that only the train split has seen."""
    customers = staged_customers(spark, d)
    train = split_labels(spark, d).filter(F.col("split") == "train").select(K.CUSTOMER)
    state = features.fit_features(customers.join(train, K.CUSTOMER, "left_semi"))
    return features.apply_features(customers, state)


# --- datasets --------------------------------------------------------------------

@query("SELECT * FROM tr_oot")
def oot_split(spark, d):
    return split.oot_split(customer_labels(spark, d), K.SNAPSHOT)


_ORDER_HASH = "CAST(('0x' || substr(md5(CAST(loan_id AS VARCHAR) || '|42'), 1, 8)) AS UBIGINT)"


@query(f"""
SELECT loan_id, label, CASE WHEN rk <= n * 80 // 100 THEN 'train'
                            WHEN rk <= n * 80 // 100 + n * 10 // 100 THEN 'val'
                            ELSE 'test' END AS split
FROM (SELECT loan_id, label,
             row_number() OVER (PARTITION BY label ORDER BY {_ORDER_HASH}, loan_id) AS rk,
             count(*) OVER (PARTITION BY label) AS n
      FROM ad_scored)""")
def stratified_split(spark, d):
    """80/10/10 within each label with exact quotas."""
    rows = A.scored(spark, d).select("loan_id", "label")
    return split.stratified_split(rows, "loan_id", "label")


@query("SELECT Customer_ID, label, snapshot_date, split FROM tr_split")
def train_test_oot(spark, d):
    return split_labels(spark, d)


def _train_labels(spark, d) -> DataFrame:
    return split_labels(spark, d).filter(F.col("split") == "train")


_FOLD_HASH = (f"CAST(('0x' || substr(md5(Customer_ID || '|{K.SPLIT_SEED + 1}'), 1, 8)) AS UBIGINT)")


@query(f"""
SELECT Customer_ID, label, CAST((rk > n * 1 // 3)::INTEGER + (rk > n * 2 // 3)::INTEGER AS INTEGER)
       AS fold
FROM (SELECT Customer_ID, label, count(*) OVER (PARTITION BY label) AS n,
             row_number() OVER (PARTITION BY label ORDER BY {_FOLD_HASH}, Customer_ID) AS rk
      FROM tr_split WHERE split = 'train')""")
def cv_folds(spark, d):
    """The folds that a model search compares its draws on."""
    return split.cv_folds(_train_labels(spark, d)).select(K.CUSTOMER, "label", "fold")


@query("""
SELECT kind, label, count(*) AS n, max(CASE WHEN kind = 'lr' AND label = 1 THEN (pos + neg) / (2.0 * pos)
  WHEN kind = 'lr' THEN (pos + neg) / (2.0 * neg) WHEN label = 1 THEN neg / CAST(pos AS DOUBLE)
  ELSE CAST(1 AS DOUBLE) END) AS weight
FROM (SELECT label, count(*) FILTER (label = 1) OVER () AS pos,
             count(*) FILTER (label = 0) OVER () AS neg FROM tr_split WHERE split = 'train'),
     (SELECT unnest(['lr', 'gbt']) AS kind)
GROUP BY 1, 2""")
def class_weights(spark, d):
    """How much a row of each class weighs when a model of each kind is fitted."""
    rows = snapshots.stage(_train_labels(spark, d))
    lr, gbt = (model.class_weights(rows, kind).withColumn("kind", F.lit(kind))
               for kind in model.KINDS)
    return lr.unionByName(gbt).groupBy("kind", "label").agg(
        F.count(F.lit(1)).alias("n"), F.max("weight").alias("weight"))


@query("""
SELECT Customer_ID, label, CASE WHEN label = 1 THEN (pos + 1) / CAST(pos + 2 AS DOUBLE)
                                ELSE 1 / CAST(neg + 2 AS DOUBLE) END AS target
FROM (SELECT *, count(*) FILTER (label = 1) OVER () AS pos,
             count(*) FILTER (label = 0) OVER () AS neg FROM tr_split WHERE split = 'val')""")
def platt_targets(spark, d):
    """The targets that a calibration on the validation split is fitted to."""
    val = split_labels(spark, d).filter(F.col("split") == "val")
    return model.platt_targets(val).select(K.CUSTOMER, "label", "target")


_SCALED = ", ".join(f"round((t.{c} - m_{c}) / s_{c}, 6) AS {c}" for c in A.EMA_COLUMNS)


@query(f"SELECT t.Customer_ID, t.split, {_SCALED} FROM tr_set t, tr_scaler")
def standard_scale(spark, d):
    """EMAs scaled by the train split's mean and population deviation."""
    ema = panel.ema_latest(A.panel(spark, d), A.PANEL_COLUMNS)
    rows = snapshots.stage(split_labels(spark, d).join(ema, K.CUSTOMER, "left"))
    scaler = matrix.fit_scaler(rows.filter(F.col("split") == "train"), A.EMA_COLUMNS)
    return rounded(matrix.scale(rows, scaler)).select(K.CUSTOMER, "split", *A.EMA_COLUMNS)


def training_matrix(spark, d, feature_table=None) -> tuple[DataFrame, matrix.MatrixState]:
    rows = snapshots.stage(joins.training_set(
        split_labels(spark, d),
        feature_table if feature_table is not None else gold_with_ema(spark, d)))
    state = matrix.fit_matrix(rows, fit_on=rows.filter(F.col("split") == "train"))
    return matrix.feature_matrix(rows, state, keep=[K.CUSTOMER, "label", "split"]), state


@query(matrix_sql("tr_set"))
def feature_matrix(spark, d):
    return rounded(training_matrix(spark, d)[0])


# --- metrics ---------------------------------------------------------------------

_GINI = metrics_sql("ad_scored", "inference_date, model_label")


@query(f"SELECT inference_date, model_label, n, positives, gini FROM ({_GINI})")
def gini(spark, d):
    return metrics.gini(A.scored(spark, d), by=["inference_date", "model_label"])


@query("""SELECT model_label, count(*) AS n, count(*) FILTER (label = 1) AS positives,
                 round(count(*) FILTER (label = 1 AND prediction = 1)
                       / CAST(count(*) FILTER (label = 1) AS DOUBLE), 4) AS recall
          FROM ad_scored GROUP BY 1""")
def recall_at_threshold(spark, d):
    return metrics.recall(A.scored(spark, d), by=["model_label"])


_GRID_SQL = f"""
SELECT model_label, t.threshold, count(*) FILTER (score >= t.threshold AND label = 1) AS tp,
       count(*) FILTER (score >= t.threshold AND label = 0) AS fp,
       count(*) FILTER (label = 1) AS positives
FROM ad_scored, (SELECT unnest([{', '.join(f'CAST({t} AS DOUBLE)' for t in K.THRESHOLD_GRID)}])
                 AS threshold) t
GROUP BY ALL"""
_POINTS_SQL = f"""
SELECT *, coalesce(tp / CAST(nullif(tp + fp, 0) AS DOUBLE), 0) AS "precision",
       coalesce(tp / CAST(nullif(positives, 0) AS DOUBLE), 0) AS recall
FROM ({_GRID_SQL})"""


@query(_POINTS_SQL)
def threshold_table(spark, d):
    return metrics.threshold_table(A.scored(spark, d), by=["model_label"])


@query(f"""
SELECT DISTINCT ON (model_label) model_label, threshold, recall
FROM ({_POINTS_SQL}) WHERE "precision" >= 0.5 ORDER BY model_label, recall DESC, threshold""")
def threshold_search(spark, d):
    return metrics.threshold(A.scored(spark, d), by=["model_label"])


def candidate_metrics(spark, d) -> DataFrame:
    """Gini and recall of the two scorers on each split."""
    rows = A.scored(spark, d).select("loan_id", "score", "prediction", "label", "inference_date",
                                     F.col("model_label").alias("candidate"))
    sets = split.split_sets(rows, "loan_id", "label", "inference_date")
    return metrics.rank_metrics(sets, pred="prediction", by=["candidate", "split"])


_EVAL_SETS = f"""
(SELECT model_label AS candidate, score, prediction, label,
        CASE WHEN is_oot THEN 'oot' WHEN rk <= n * 80 // 100 THEN 'train'
             WHEN rk <= n * 80 // 100 + n * 10 // 100 THEN 'val' ELSE 'test' END AS split
 FROM (SELECT *, row_number() OVER (PARTITION BY label, is_oot
                                    ORDER BY {_ORDER_HASH}, loan_id) AS rk,
              count(*) OVER (PARTITION BY label, is_oot) AS n
       FROM (SELECT *, inference_date IN (SELECT DISTINCT inference_date FROM ad_scored
                                          ORDER BY 1 DESC LIMIT 2) AS is_oot FROM ad_scored)))"""
_EVAL = metrics_sql(_EVAL_SETS, "candidate, split", pred="prediction")


@query(_EVAL)
def eval_by_split(spark, d):
    return candidate_metrics(spark, d)


@query(f"SELECT * FROM ({_EVAL}) WHERE split = 'oot' ORDER BY gini DESC, candidate LIMIT 1")
def champion(spark, d):
    """The scorer with the larger Gini on the last two months."""
    return monitor.champion(candidate_metrics(spark, d))


_IMPORTANCE = {
    "o_totalprice": "o_totalprice", "floor_value": "floor_value", "weekday": "weekday",
    "score": "score", "prediction": "prediction", "log_price": "ln(o_totalprice)",
    "root_price": "sqrt(o_totalprice)", "loan_number": "CAST(loan_id AS BIGINT) % 1000",
    "priority": "CAST(substr(o_orderpriority, 1, 1) AS INTEGER)",
    "month": "month(inference_date)", "year": "year(inference_date)",
    "automl": "CASE WHEN model_label = 'production' THEN 0 ELSE 1 END",
}


_IMPORTANCE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(abs(corr(CAST({e} AS DOUBLE), CAST(label AS DOUBLE))), 6)"
    " AS importance FROM ad_scored" for c, e in _IMPORTANCE.items())


@query(f"SELECT * FROM ({_IMPORTANCE_SQL}) ORDER BY importance DESC, feature LIMIT 10")
def top_features(spark, d):
    """The ten strongest of twelve columns by correlation with the label."""
    rows = A.scored(spark, d)
    table = rows.agg(*[F.round(F.abs(F.corr(F.expr(e).cast("double"),
                                            F.col("label").cast("double"))), 6).alias(c)
                       for c, e in _IMPORTANCE.items()])
    return monitor.top_features(
        table.unpivot([], list(_IMPORTANCE), "feature", "importance"))


# --- drift and monitoring ------------------------------------------------------------

def production(df):
    return df.filter(F.col("model_label") == "production")


def psi_table(spark, d):
    baseline, batches = baseline_and_batches(spark, d)
    return drift.psi(drift.label_shares(production(baseline)), production(batches))


@query("SELECT inference_date, psi FROM sc_psi")
def psi_by_batch(spark, d):
    return psi_table(spark, d)


def _csi(spark, d, columns):
    baseline, batches = baseline_and_batches(spark, d)
    return drift.csi(drift.fit_drift_baseline(baseline, columns), batches)


@query(csi_sql({"o_orderpriority": "discrete", "weekday": "discrete"}))
def csi_discrete(spark, d):
    return _csi(spark, d, ["o_orderpriority", "weekday"])


@query(csi_sql({"o_totalprice": "continuous", "floor_value": "continuous",
                "o_orderpriority": "discrete", "weekday": "discrete"}))
def csi_by_batch(spark, d):
    """CSI of all features and batches in one job."""
    return _csi(spark, d, A.DRIFT_FEATURES)


_PERF = metrics_sql("sc_matured", "inference_date, model_label", pred="prediction")


def performance(spark, d):
    scored = A.scored(spark, d).select("Customer_ID", "score", "prediction", "model_label",
                                       "inference_date")
    points = ranks.cut_points(scored, ["score"])["score"]
    rows = joins.matured(scored, loan_labels(spark, d), as_of="2001-01-01")
    return metrics.performance(rows, ["inference_date", "model_label"], points)


@query(f"SELECT inference_date, model_label, n, gini, recall FROM ({_PERF})"
       " WHERE gini IS NOT NULL")
def performance_by_batch(spark, d):
    """Matured Gini and recall of every batch and model."""
    return performance(spark, d)


@query(f"SELECT inference_date, model_label, n, gini, recall FROM ({_PERF})"
       " WHERE gini IS NOT NULL")
def performance_incremental(spark, d):
    """The same from stored counts to which each year adds its batches and its labels."""
    cut, by = F.lit("2001-01-01").cast("date"), ["inference_date", "model_label"]
    scored = snapshots.stage(A.scored(spark, d).filter(F.col("inference_date") <= cut).select(
        K.CUSTOMER, "score", "prediction", *by, F.year("inference_date").alias("at")))
    labels = snapshots.stage(loan_labels(spark, d).filter(F.col(K.SNAPSHOT) <= cut).select(
        K.CUSTOMER, "label", F.year(K.SNAPSHOT).alias("at")))
    known = snapshots.small_table(spark, [], maturity.LABELS)
    years = scored.select("at").union(labels.select("at")).distinct().sort("at").collect()
    counts = None
    for year in [r["at"] for r in years]:  # as many as the calendar has
        known = snapshots.stage(maturity.advance_labels(known, labels.filter(F.col("at") == year)))
        added = maturity.new_counts(scored.filter(F.col("at") == year), known, by).unionByName(
            maturity.changed_counts(scored.filter(F.col("at") < year), known, by))
        added = snapshots.stage(added)
        counts = added if counts is None else counts.unionByName(added)
    if counts is None:
        counts = maturity.new_counts(scored, known.withColumn("was", F.col("label")), by)
    return maturity.performance(counts, by)


def _status_sql(c: str) -> str:
    green, yellow, higher = K.BANDS[c]
    op = ">=" if higher else "<"
    return (f"CASE WHEN {c} IS NULL THEN NULL WHEN {c} {op} {green} THEN 'green'"
            f" WHEN {c} {op} {yellow} THEN 'yellow' ELSE 'red' END")


@query(f"""
SELECT inference_date, 'psi' AS metric, psi AS value, {_status_sql('psi')} AS status FROM sc_psi
UNION ALL
SELECT inference_date, 'csi_' || feature, csi, {_status_sql('csi')}
FROM ({csi_sql({'o_totalprice': 'continuous', 'floor_value': 'continuous',
                'o_orderpriority': 'discrete', 'weekday': 'discrete'})})
UNION ALL
SELECT inference_date, 'gini_' || model_label, gini, {_status_sql('gini')}
FROM ({_PERF}) WHERE gini IS NOT NULL
UNION ALL
SELECT inference_date, 'recall_' || model_label, recall, {_status_sql('recall')}
FROM ({_PERF}) WHERE gini IS NOT NULL""")
def drift_status(spark, d):
    """Green / yellow / red per batch and metric: label mix, all monitored features, and
    Gini and recall of every model."""
    def banded(df, metric, name):
        out = monitor.with_status(df, metric)
        return out.select("inference_date", name.alias("metric"), F.col(metric).alias("value"),
                          F.col(f"{metric}_status").alias("status"))
    psi_rows = banded(psi_table(spark, d), "psi", F.lit("psi"))
    csi_rows = banded(_csi(spark, d, A.DRIFT_FEATURES), "csi",
                      F.concat(F.lit("csi_"), F.col("feature")))
    measured = snapshots.stage(performance(spark, d))  # a row per batch and model
    rows = [banded(measured, m, F.concat(F.lit(f"{m}_"), F.col("model_label")))
            for m in ("gini", "recall")]
    return psi_rows.unionByName(csi_rows).unionByName(rows[0]).unionByName(rows[1])


@query(f"""
SELECT m.month, p.inference_date, p.model_label, p.gini, p.recall
FROM (SELECT CAST(unnest(generate_series(
             (SELECT min(inference_date) FROM ad_scored)::TIMESTAMP,
             (SELECT max(inference_date) FROM ad_scored)::TIMESTAMP,
             INTERVAL 1 MONTH)) AS DATE) AS month) m
LEFT JOIN (SELECT * FROM ({_PERF}) WHERE gini IS NOT NULL) p
  ON CAST(p.inference_date + to_months(6) AS DATE) = m.month""")
def maturity_timeline(spark, d):
    """Performance placed at the month in which the labels matured."""
    span = A.scored(spark, d).agg(F.min("inference_date").alias("first"),
                                  F.max("inference_date").alias("last")).first()
    return (monitor.maturity_timeline(performance(spark, d), F.lit(span["first"]),
                                      F.lit(span["last"]))
            .select("month", "inference_date", "model_label", "gini", "recall"))


# --- models: fitted, hence without SQL ------------------------------------------------

_LR_DRAWS = model.draws("lr")
_GBT_DRAWS = model.draws("gbt")


@query()
def model_evaluation(spark, d):
    """Both kinds of model searched, calibrated and evaluated on every split."""
    rows, state = training_matrix(spark, d)
    data = snapshots.stage(rows)
    trained = [model.train(data, state.names, "lr", _LR_DRAWS),
               model.train(data, state.names, "gbt", _GBT_DRAWS)]
    first, second = (model.evaluate(t, data) for t in trained)
    return first.unionByName(second)


@query()
def model_importances(spark, d):
    """Top ten features of the tree model."""
    rows, state = training_matrix(spark, d)
    fitted = model.train(snapshots.stage(rows), state.names, "gbt", _GBT_DRAWS)
    return monitor.top_features(model.importances(spark, fitted))


@query()
def score_batch(spark, d):
    """Every customer scored by a logistic regression fitted on the labelled ones."""
    table = snapshots.stage(gold_with_ema(spark, d))
    rows, state = training_matrix(spark, d, table)
    fitted = model.train(snapshots.stage(rows), state.names, "lr", _LR_DRAWS)
    top = monitor.top_features(model.importances(spark, fitted)).collect()
    return score.score(table, fitted.model, state, fitted.threshold, "credit_model_2023_12_01",
                       "production", "2024-01-01", [state.source_of(r["feature"]) for r in top])
