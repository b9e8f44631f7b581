"""Five months from raw files to monitor tables."""

import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lendmart import constants as K
from lendmart.operators import features, joins, matrix, maturity, metrics
from lendmart.plans import monthly
from lendmart.sources import published, snapshots

MONTHS = [str(d.date()) for d in pd.date_range("2024-01-01", periods=5, freq="MS")]
PER_MONTH = 120
GRIDS = {
    "lr": [{"C": 1.0, "penalty": "l2"}],
    "gbt": [{"maxIter": 3, "maxDepth": 2, "stepSize": 0.1, "subsamplingRate": 0.8,
             "featureSubsetStrategy": "0.8", "minInstancesPerNode": 5}],
}


def raw_files(folder):
    """Each customer joins in one month, has one loan that reaches month 6 in the month
    after, and a panel row in every month."""
    g = np.random.default_rng(1)
    attributes, financials, ledger, panel = [], [], [], []
    for m, month in enumerate(MONTHS):
        for i in range(PER_MONTH):
            c = f"CUS_{m}_{i}"
            bad = bool(g.random() < 0.35)
            attributes.append((c, 'An "X" Other', f"{20 + i % 50}_", "123-45-6789",
                               "Doctor" if i % 3 else "_______", month))
            financials.append((
                c, 40000 + i, 3000.0 + i * 40, i % 14, i % 9, 30 if bad else 10 + i % 9, 1,
                "Auto Loan, and Home Loan" if i % 2 else None, i % 40, f"{i % 20}_",
                "_" if i % 11 == 0 else i / 10, i % 12, "Bad" if bad else "Good",
                f"{500 + i * 20 + 900 * bad}_", 25.5, f"{i % 20} Years and {i % 12} Months",
                ("Yes", "No", "NM")[i % 3], 40.0 + i, "__10000__" if i % 17 == 0 else 80.0 + i,
                "!@9#%8" if i % 5 == 0 else "High_spent_Small_value_payments", 300.0, month))
            due = 100.0
            next_month = (pd.Timestamp(month) + pd.DateOffset(months=1)).date()
            ledger.append((f"L{m}_{i}", c, month, 10, 6, 1000.0, due, 0.0,
                           250.0 if bad else 0.0, 500.0, month))
            ledger.append((f"L{m}_{i}", c, month, 10, 7, 1000.0, due, 0.0, 0.0, 400.0,
                           next_month))
            panel += [(*g.integers(0, 90, 20), c, t) for t in MONTHS[:4]] if i % 4 else []
    tables = {
        "attributes": (attributes, "Customer_ID Name Age SSN Occupation snapshot_date"),
        "financials": (financials, " ".join(f.name for f in monthly.SOURCES["financials"])),
        "ledger": (ledger, " ".join(f.name for f in monthly.SOURCES["ledger"])),
        "panel": (panel, " ".join(f.name for f in monthly.SOURCES["panel"])),
    }
    out = {}
    for name, (rows, columns) in tables.items():
        out[name] = f"{folder}/{name}.csv"
        pd.DataFrame(rows, columns=columns.split()).to_csv(out[name], index=False)
    return out


@pytest.fixture(scope="module")
def mart(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("mart")
    sources = raw_files(folder)
    out = monthly.Mart(spark, str(folder / "mart"))
    for month in MONTHS:
        monthly.run(out, month, sources, train=month in MONTHS[2:4], grids=GRIDS)
    return out, sources


def test_tables_hold_every_month_once(mart):
    m, _ = mart
    for table in ("silver/customers", "gold/features", "gold/labels"):
        counts = {str(r[K.SNAPSHOT]): r["count"]
                  for r in m.read(table).groupBy(K.SNAPSHOT).count().collect()}
        assert counts == dict.fromkeys(MONTHS, PER_MONTH), table


def test_rerun_changes_nothing(mart):
    m, sources = mart
    before = {t: m.read(t).count() for t in ("gold/features", "gold/labels", "gold/scores")}
    assert not monthly.build_features(m, MONTHS[0])
    assert not monthly.land(m, "attributes", sources["attributes"], MONTHS[0])
    features_before = m.read("gold/features", MONTHS[1]).collect()
    assert monthly.build_features(m, MONTHS[1], mode="replace")
    assert sorted(map(str, features_before)) == sorted(
        map(str, m.read("gold/features", MONTHS[1]).collect()))
    assert monthly.score_month(m, MONTHS[4], mode="replace")
    assert before == {t: m.read(t).count() for t in before}


def test_panel_flag(mart):
    m, _ = mart
    flags = {r["has_clickstream"]: r["count"] for r in
             m.read("gold/features", MONTHS[0]).groupBy("has_clickstream").count().collect()}
    assert flags == {1: 90, 0: 30}


def test_registry_names_and_scores(mart):
    m, _ = mart
    names = {r["model_version"]: r["model_label"] for r in monthly.registry(m).collect()}
    assert names == {"credit_model_2024_03_01": "production", "credit_model_2024_04_01": "autoML1"}
    scored = {(str(r["inference_date"]), r["model_label"]): r["count"] for r in
              m.read("gold/scores").groupBy("inference_date", "model_label").count().collect()}
    assert scored == {(MONTHS[3], "production"): PER_MONTH, (MONTHS[4], "production"): PER_MONTH,
                      (MONTHS[4], "autoML1"): PER_MONTH}
    row = m.read("gold/scores").first()
    assert 0 < row["score"] < 1
    assert m.read("gold/scores").filter(
        (F.col("score") >= F.col("threshold")) != (F.col("prediction") == 1)).isEmpty()


def test_model_separates_what_it_can(mart):
    m, _ = mart
    metrics = {(r["candidate"], r["split"]): r["gini"] for r in m.read("registry/metrics").filter(
        F.col("trained") == MONTHS[2]).collect()}
    assert set(metrics) == {(c, s) for c in ("lr", "gbt") for s in ("train", "val", "test", "oot")
                            if (c, s) in metrics} and ("lr", "oot") in metrics
    assert max(metrics["lr", "oot"], metrics["gbt", "oot"]) > 0.9


def test_monitor_tables(mart):
    m, _ = mart
    psi = m.read("monitor/psi")
    assert sorted(str(r["inference_date"]) for r in psi.collect()) == MONTHS[3:]
    assert psi.filter("psi_status IS NULL").isEmpty()
    csi = m.read("monitor/csi")
    assert csi.select("feature").distinct().count() >= 3
    perf = m.read("monitor/performance").collect()
    assert {(str(r["inference_date"]), r["model_label"]) for r in perf} == {
        (MONTHS[3], "production"), (MONTHS[4], "production"), (MONTHS[4], "autoML1")}
    assert all(r["gini"] > 0.9 and r["gini_status"] == "green" for r in perf)


def test_performance_follows_from_counts(mart):
    """Stored counts give what a look at all scores and labels gives, at every date."""
    m, _ = mart
    scores, labels = m.read("gold/scores"), m.read("gold/labels")
    for date in MONTHS[3:]:
        want = metrics.performance(joins.matured(scores, labels, as_of=date))
        got = maturity.performance(published.read(m.spark, m.path(monthly.COUNTS_TABLE), upto=date))
        assert got.count() > 0 and sorted(map(str, got.select(want.columns).collect())) == sorted(
            map(str, want.collect()))


def test_months_without_data_are_skipped(mart):
    m, _ = mart
    assert not monthly.score_month(m, "2025-01-01")
    assert monthly.train_month(m, "2025-01-01") is None


def test_scoring_columns_equal_training_columns(mart):
    m, _ = mart
    state = matrix.MatrixState.from_frame(m.read("models/credit_model_2024_03_01_matrix"))
    batch = snapshots.snapshot_of(monthly.feature_store(m), MONTHS[4])
    out = matrix.feature_matrix(batch.drop("Age").withColumn("extra", F.lit(1)), state)
    assert out.columns == state.names
    assert out.select(F.max("Age")).first()[0] == 0.0


def test_audit(mart):
    m, _ = mart
    rows = {r["column"]: r for r in monthly.audit_customers(m, MONTHS[0]).collect()}
    assert rows["Occupation"]["replaced"] == 40 and rows["Occupation"]["total"] == PER_MONTH
    assert rows["Amount_Invested_Monthly"]["nulled"] == 8


def test_feature_state_round_trip(spark, mart):
    m, _ = mart
    state = features.fit_features(m.read("silver/customers", MONTHS[0]))
    assert features.FeatureState.from_frame(state.to_frame(spark)) == state
    assert state.categories["Type_of_Loan"].keys() == {"Auto Loan", "Home Loan", "Unknown"}
    assert isinstance(m.read("gold/features").first()[K.SNAPSHOT], datetime.date)
