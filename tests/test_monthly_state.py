"""Averages, fitted statistics, training rows and names of the monthly run, month by month."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lendmart import constants as K
from lendmart.operators import features, ledger, panel
from lendmart.plans import monthly
from lendmart.sources import published, snapshots
from test_monthly import raw_files

MONTHS = [str(d.date()) for d in pd.date_range("2024-01-01", periods=4, freq="MS")]


@pytest.fixture(scope="module")
def sources(tmp_path_factory):
    return raw_files(tmp_path_factory.mktemp("raw"))


@pytest.fixture(scope="module")
def mart(spark, sources, tmp_path_factory):
    """Three months in order; the second month's panel comes after the third's."""
    m = monthly.Mart(spark, str(tmp_path_factory.mktemp("mart")))
    for month in MONTHS[:3]:
        for name in ("attributes", "financials", "ledger"):
            monthly.land(m, name, sources[name], month)
        monthly.build_ledger(m, month)
        monthly.build_labels(m, month)
        monthly.build_customers(m, month)
    for month in (MONTHS[0], MONTHS[2], MONTHS[1]):
        monthly.land(m, "panel", sources["panel"], month)
        monthly.build_panel(m, month)
        monthly.update_averages(m, month)
    for month in MONTHS[:3]:
        monthly.build_features(m, month)
    return m


@pytest.mark.parametrize("upto", MONTHS[:3])
def test_averages_equal_the_whole_fold(mart, upto):
    want = panel.ema_latest_sparse(mart.read("silver/panel"), K.PANEL_COLUMNS, as_of=upto)
    got = monthly.ema_state.averages(mart.read(monthly.AVERAGES_TABLE, upto))
    names = [c for c in want.columns if c != K.CUSTOMER]
    both = got.withColumnsRenamed({c: f"g_{c}" for c in names}).join(want, K.CUSTOMER, "full")
    off = " OR ".join(f"NOT coalesce(abs(g_{c} - {c}) < 1e-9, false)" for c in names)
    assert both.count() == want.count() > 0 and both.filter(off).isEmpty()


def test_a_month_reads_its_own_panel_rows(mart):
    month = mart.read("silver/panel", MONTHS[2])
    plan = monthly.ema_state.summarise(month, K.PANEL_COLUMNS)._jdf.queryExecution()
    filters = [x for x in plan.executedPlan().toString().split("\n") if "PartitionFilters" in x]
    assert len(filters) == 1
    files = {r[0] for r in month.select(F.input_file_name()).collect()}
    assert files and all(f"snapshot_date={MONTHS[2]}" in f for f in files)
    state = mart.read(monthly.AVERAGES_TABLE, MONTHS[2])
    assert all(monthly.AVERAGES_TABLE in f for f in state.inputFiles())
    assert not monthly.update_averages(mart, MONTHS[2])


def test_all_months_use_the_state_of_the_first(spark, mart):
    notes = {r["slice"]: r["note"] for r in
             published.slices(spark, mart.path(monthly.FEATURES_TABLE)).collect()}
    assert notes == dict.fromkeys(MONTHS[:3], MONTHS[0])
    first = features.fit_features(mart.read("silver/customers", MONTHS[0]))
    assert monthly.feature_state(mart, MONTHS[2]) == (MONTHS[0], first)
    rows = mart.read(monthly.FEATURES_TABLE, MONTHS[1]).select(K.CUSTOMER, *K.MEDIAN_COLUMNS)
    want = features.apply_features(mart.read("silver/customers", MONTHS[1]), first)
    assert rows.exceptAll(want.select(rows.columns)).isEmpty()


def test_a_new_state_changes_later_months_only(spark, mart):
    before = mart.read(monthly.FEATURES_TABLE).columns
    wider = features.FeatureState({}, {"Occupation": {"Pilot": 1}})
    mart.publish(wider.to_frame(spark), monthly.STATES_TABLE, MONTHS[2])
    assert monthly.feature_state(mart, MONTHS[1])[0] == MONTHS[0]
    assert monthly.feature_state(mart, MONTHS[2]) == (MONTHS[2], wider)
    old = mart.read(monthly.FEATURES_TABLE, MONTHS[1]).collect()
    assert monthly.build_features(mart, MONTHS[2], mode="replace")
    assert mart.read(monthly.FEATURES_TABLE, MONTHS[1]).drop("Occupation_Pilot").collect() == old
    store = monthly.feature_store(mart)
    assert set(store.columns) - set(before) == {"Occupation_Pilot"}
    assert store.groupBy(K.SNAPSHOT).agg(F.count("Occupation_Pilot").alias("n")).orderBy(
        K.SNAPSHOT).toPandas()["n"].tolist() == [0, 0, 120]


def test_training_rows_are_customers_with_earlier_features(spark, mart):
    labels = mart.read("gold/labels").unionByName(
        mart.read("gold/labels", MONTHS[1]).withColumn("loan_id", F.lit("second")))
    late = mart.read(monthly.FEATURES_TABLE, MONTHS[1]).withColumn(
        K.SNAPSHOT, F.lit("2024-06-01").cast("date"))
    store = monthly.feature_store(mart).unionByName(late, allowMissingColumns=True)
    rows = monthly.joins.training_set_asof(ledger.one_label_per_customer(labels), store)
    assert rows.count() == rows.select(K.CUSTOMER).distinct().count() == 3 * 120
    assert rows.filter(F.col(K.SNAPSHOT) > F.col("label_date")).isEmpty()
    assert rows.filter(F.col(K.SNAPSHOT).isNull()).isEmpty()


def test_an_empty_rerun_leaves_no_old_features(spark, mart):
    customers = mart.read("silver/customers", MONTHS[0])
    snapshots.write_slices(customers.limit(0), mart.path("silver/customers"), value=MONTHS[0])
    assert monthly.build_features(mart, MONTHS[0], mode="replace")
    assert not mart.loaded(monthly.FEATURES_TABLE, MONTHS[0])
    assert monthly.feature_store(mart).filter(F.col(K.SNAPSHOT) == MONTHS[0]).isEmpty()


def test_names_are_given_once(spark, mart):
    def register(month):
        version = monthly.version_of(month)
        name = monthly.model_name(mart, version)
        mart.publish(snapshots.small_table(spark, [(version, name)],
                                           "model_version string, model_label string"),
                     monthly.MODELS_TABLE, month)
        return name

    # a month before the first registered one is backfilled, one is trained again
    assert [register(x) for x in ("2024-03-01", "2024-04-01", "2024-01-01", "2024-03-01",
                                  "2024-05-01")] == [
        "production", "autoML1", "autoML2", "production", "autoML3"]
