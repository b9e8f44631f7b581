import datetime

import pytest
from pyspark.sql import functions as F

from lendmart import constants as K
from lendmart.functions import clean as C, encode as E
from lendmart.operators import cleansing, ledger
from lendmart.schemas import FINANCIALS_RAW, LEDGER


def apply(spark, values, fn, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["o"] for r in rows.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_lenient_integers(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        got = apply(spark, ["24_", "24", " 7 ", "3.7", "-5", "", "_", "x", "24d", "1e3",
                            "99999999999", None],
                    lambda c: C.clean_number(c, strip="_"))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert got == [24, 24, 7, 3, -5, None, None, None, None, None, None, None]


def test_range_guards_keep_the_ends_and_open_sides(spark):
    both = apply(spark, ["17", "18", "56", "57", "-500", None],
                 lambda c: C.clean_number(c, lo=18, hi=56))
    assert both == [None, 18, 56, None, None, None]
    upper = apply(spark, ["-1", "11", "12"], lambda c: C.clean_number(c, hi=11))
    assert upper == [-1, 11, None]


def test_money_is_rounded_half_up(spark):
    assert apply(spark, ["1.005", "2.344", "19114.12_", "bad", None],
                 lambda c: C.clean_number(c, strip="_", dp=2, to="double")) == [
        1.01, 2.34, 19114.12, None, None]


def test_sentinels(spark):
    assert apply(spark, ["__10000__", "80.415", None],
                 lambda c: C.clean_number(c, null_tokens=(K.INVESTED_SENTINEL,), dp=2,
                                          to="double")) == [None, 80.42, None]
    assert apply(spark, ["_", "Good", None], lambda c: C.fill_sentinel(c, ("_",))) == [
        "Unknown", "Good", "Unknown"]
    assert apply(spark, ["A", None], lambda c: C.fill_sentinel(c, ())) == ["A", "Unknown"]


def test_conform(spark):
    assert apply(spark, ["821-00-0265", "#F%$D@*&8", None],
                 lambda c: C.conform(c, K.SSN_PATTERN)) == ["821-00-0265", "Unknown", "Unknown"]
    assert apply(spark, ["_______", "Doctor", None, ""],
                 lambda c: C.conform(c, K.SYMBOLS_ONLY_PATTERN, invert=True,
                                     fill_null=False)) == ["Unknown", "Doctor", None, ""]


def test_durations_lists_and_codes(spark):
    assert apply(spark, ["22 Years and 1 Months", "3 Years", "5 Months", "NA", None],
                 C.duration_months) == [265, 36, 5, 0, None]
    assert apply(spark, ["A, B, and C", "A", None], C.list_size) == [3, 1, 0]
    code = "High_spent_Small_value_payments"
    assert apply(spark, [code, "garbled", None],
                 lambda c: C.split_code(c, K.SPENT_PATTERN)) == ["High", "", None]
    assert apply(spark, [code], lambda c: C.split_code(c, K.VALUE_PATTERN)) == ["Small"]


def test_flags(spark):
    rows = spark.createDataFrame(
        [(0, 100.0, 1100.0), (1, 100.0, 1200.0), (2, None, 5.0)], "i int, s double, a double")
    assert [r[0] for r in rows.orderBy("i").select(
        C.income_flag(F.col("s"), F.col("a"))).collect()] == [True, False, None]
    rows = spark.createDataFrame(
        [(0, 5, 0), (1, 0, 3), (2, 0, 0), (3, 4, 4), (4, None, 3), (5, 0, None)],
        "i int, d int, n int")
    assert [r[0] for r in rows.orderBy("i").select(
        C.delay_flag(F.col("d"), F.col("n"))).collect()] == [
        True, True, False, False, False, False]


def test_clean_financials_has_the_fixed_columns(spark):
    empty = spark.createDataFrame([], FINANCIALS_RAW)
    raw = [c for c in FINANCIALS_RAW.names if c != "Payment_Behaviour"]
    derived = [c for c in cleansing.financial_rules() if c not in raw]
    assert cleansing.clean_financials(empty).columns == [
        *raw, *derived, "Income_Inconsistent", "Delay_Inconsistent"]


def test_audit_counts_what_changed(spark):
    raw = spark.createDataFrame(
        [("a", "n", "24_", "123-45-6789", "Doctor"), ("b", "n", "-500", "garbage", "____"),
         ("c", "n", None, None, None)],
        "Customer_ID string, Name string, Age string, SSN string, Occupation string")
    got = {r["column"]: (r["total"], r["nulled"], r["replaced"])
           for r in cleansing.audit(raw, cleansing.attribute_rules()).collect()}
    assert got == {"Age": (3, 1, 0), "SSN": (3, 0, 2), "Occupation": (3, 0, 1)}


def _ledger(spark, rows):
    d = datetime.date(2024, 3, 1)
    return spark.createDataFrame(
        [(str(i), "c", d, 10, mob, 1.0, due, 0.0, over, None, d)
         for i, (mob, due, over) in enumerate(rows)], LEDGER)


def test_days_past_due(spark):
    rows = ledger.with_dpd(_ledger(spark, [
        (6, 100.0, 0.0), (6, 100.0, 150.0), (6, 100.0, 100.0), (6, 0.0, 50.0), (None, 100.0, 0.0),
        (6, None, 10.0)]))
    got = [(r["mob"], r["installments_missed"], r["first_missed_date"], r["dpd"], r["balance"])
           for r in rows.orderBy("loan_id").collect()]
    jan, feb = datetime.date(2024, 1, 1), datetime.date(2024, 2, 1)
    assert got == [
        (6, 0, None, 0, 0.0),
        (6, 2, jan, 60, 0.0),       # part of an instalment counts as one
        (6, 1, feb, 29, 0.0),       # a missed February is 29 days
        (6, 0, None, None, 0.0),    # overdue without a due amount
        (0, 0, None, 0, 0.0),       # missing numbers become 0
        (6, 0, None, None, 0.0)]


def test_labels(spark):
    rows = ledger.with_dpd(_ledger(spark, [(6, 100.0, 150.0), (6, 100.0, 100.0), (6, 0.0, 50.0),
                                           (5, 100.0, 500.0)]))
    got = [(r["loan_id"], r["label"], r["label_def"])
           for r in ledger.labels(rows).orderBy("loan_id").collect()]
    assert got == [("0", 1, "30dpd_6mob"), ("1", 0, "30dpd_6mob"), ("2", 0, "30dpd_6mob")]
    rate = ledger.default_rate(ledger.labels(rows)).first()
    assert (rate["loans"], rate["defaults"], round(rate["default_rate"], 6)) == (3, 1, 0.333333)


def test_encodings(spark):
    limits, labels = K.BINS["Outstanding_Debt"]
    assert apply(spark, [1499.99, 1500.0, 2500.0, None],
                 lambda c: E.bin_label(c, limits, labels), "double") == [
        "<1500", "1500-2500", ">2500", ">2500"]
    assert apply(spark, [None], lambda c: E.bin_label(c, limits, labels, "none"), "double") == [
        "none"]
    assert apply(spark, ["Bad", "Unknown", "Standard", "Good", "x", None],
                 lambda c: E.ordinal(c, K.CREDIT_MIX_CODES)) == [0, 1, 2, 3, None, None]
    assert apply(spark, [0, 1, 3, None], E.known_flag, "int") == [1, 0, 1, 1]


def test_draws_are_stable_and_in_proportion(spark):
    keys = spark.range(20000).select(
        E.draw_category(F.col("id"), 1, {"a": 1, "b": 3}).alias("v"),
        E.draw_category(F.col("id"), 1, {"a": 1, "b": 3}).alias("again"))
    assert keys.filter("v <> again").isEmpty()
    share = keys.filter("v = 'a'").count() / 20000
    assert abs(share - 0.25) < 0.01
