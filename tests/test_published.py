"""Published slices, the averages' state, and as-of joins."""

import datetime
import random
from functools import reduce

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lendmart.operators import ema_state, maturity, metrics, panel
from lendmart.operators.asof import asof_join
from lendmart.sources import published as P
from lendmart.sources.snapshots import stage

DAY = datetime.date


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_readers_see_the_newest_whole_slice(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1, "a"), (2, "b")], "v int, w string")
    assert P.entries(spark, path) == [] and not P.is_published(spark, path, "2024-01-01")
    assert P.publish(one, path, "2024-01-01", note="first") == 2
    before = P.read(spark, path)
    P.publish(one.filter("v = 1"), path, "2024-01-01")
    P.publish(one.filter("v = 2"), path, "2024-02-01")
    assert values(before) == [(1, "a"), (2, "b")]  # a reader keeps the slice it began with
    assert values(P.read(spark, path)) == [(1, "a"), (2, "b")]
    assert values(P.read(spark, path, "2024-01-01")) == [(1, "a")]
    assert values(P.read(spark, path, upto="2024-01-31", columns=["w"])) == [("a",)]
    assert values(P.slices(spark, path).select("slice", "rows", "version")) == [
        ("2024-01-01", 1, 2), ("2024-02-01", 1, 3)]
    assert len(P.superseded(spark, path)) == 1


def test_a_failed_write_leaves_the_old_slice(spark, tmp_path):
    path = str(tmp_path / "t")
    P.publish(spark.range(3), path, "2024-01-01")
    bad = spark.range(3).withColumn("id", F.when(F.col("id") == 2, F.raise_error(F.lit("x")))
                                    .otherwise(F.col("id")).cast("long"))
    with pytest.raises(PySparkException):
        P.publish(bad, path, "2024-01-01")
    assert values(P.read(spark, path)) == [(0,), (1,), (2,)]


def test_many_slices_are_published_in_one_pass(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(DAY(2024, 1 + i % 3, 1), i) for i in range(10)],
                               "snapshot_date date, v int")
    P.publish(df.limit(1), path, "2024-02-01")
    assert P.publish_slices(df, path, "snapshot_date") == {
        "2024-01-01": 4, "2024-02-01": 3, "2024-03-01": 3}
    assert P.held(spark, path) == ["2024-01-01", "2024-02-01", "2024-03-01"]
    assert values(P.read(spark, path)) == values(df)
    assert values(P.read(spark, path, "2024-02-01").select("v")) == [(1,), (4,), (7,)]
    with pytest.raises(ValueError):
        P.publish_slices(spark.createDataFrame([(None, 1)], df.schema), path, "snapshot_date")
    assert P.read(spark, path).count() == 10


def test_an_empty_slice_replaces_a_full_one(spark, tmp_path):
    path = str(tmp_path / "t")
    P.publish(spark.range(3), path, "2024-01-01")
    assert P.publish(spark.range(0), path, "2024-01-01") == 0
    assert not P.is_published(spark, path, "2024-01-01")
    assert P.read(spark, path).columns == ["id"] and P.read(spark, path).count() == 0


def test_one_schema_for_all_slices(spark, tmp_path):
    path = str(tmp_path / "t")
    P.publish(spark.createDataFrame([(1, 2)], "a int, b int"), path, "2024-01-01")
    P.publish(spark.createDataFrame([(3, "x")], "a int, c string"), path, "2024-02-01")
    assert P.read(spark, path).columns == ["a", "b", "c"]
    assert values(P.read(spark, path)) == [(1, 2, None), (3, None, "x")]
    assert values(P.read(spark, path, "2024-02-01")) == [(3, None, "x")]
    with pytest.raises(ValueError):
        P.publish(spark.createDataFrame([("3",)], "a string"), path, "2024-03-01")
    # the slice that made the contract may change it
    P.publish(spark.createDataFrame([("x",)], "c string"), path, "2024-01-01")
    assert set(P.read(spark, path).columns) == {"a", "c"}


def test_slices_are_chosen_without_reading_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    for month in ("2024-01-01", "2024-02-01"):
        P.publish(spark.range(2), path, month)
    files = P.read(spark, path, "2024-02-01").inputFiles()
    assert files and all("/data/2024-02-01-" in f for f in files)
    assert all("/manifest/" in f for f in P.slices(spark, path).inputFiles())


# --- averages ----------------------------------------------------------------------

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def history(spark):
    rng = random.Random(2)
    rows = [(f"k{k}", t, *((rng.random() * 100 if rng.random() < p else None)
                           for p in (1, .5, .05))) for k in range(25) for t in range(36)
            if rng.random() < .7]
    return spark.createDataFrame(rows, "Customer_ID string, t int, a double, b double, c double")


def close(got, want):
    got, want = ({r[0]: r[1:] for r in df.collect()} for df in (got, want))
    assert got.keys() == want.keys()
    for k in want:
        for x, y in zip(got[k], want[k]):
            assert (x is None) == (y is None) and (x is None or abs(x - y) < 1e-9)


@pytest.mark.parametrize("length", [1, 5, 36])
def test_state_of_stretches_equals_the_whole_fold(spark, history, length):
    want = panel.ema_latest_sparse(history, COLUMNS, time="t")
    if length == 1:
        rows = history.select("Customer_ID", F.col("t").alias("at"), *[
            ema_state._one(F.col(c)).alias(f"map_{c}") for c in COLUMNS])
    else:
        rows = reduce(lambda a, b: a.union(b), [
            ema_state.summarise(history.filter(f"t div {length} = {i}"), COLUMNS, time="t")
            .withColumn("at", F.lit(i)) for i in range(-(-36 // length))])
    close(ema_state.averages(ema_state.merge(rows, "at")), want)


def test_composition_is_associative(spark, history):
    a, b, c = (ema_state.summarise(history.filter(f"t div 12 = {i}"), COLUMNS, time="t")
               for i in range(3))
    left = ema_state.advance(ema_state.advance(a, b), c)
    right = ema_state.advance(a, ema_state.advance(b, c))
    close(ema_state.averages(left), ema_state.averages(right))
    close(ema_state.averages(left), panel.ema_latest_sparse(history, COLUMNS, time="t"))


def test_running_average_of_a_long_history(spark):
    rows = [("k", t, float(t % 17)) for t in range(1000)] + [("one", 5, 2.0)]
    df = spark.createDataFrame(rows, "Customer_ID string, t int, a double")
    got = {(r[0], r[1]): r[2] for r in panel.ema_running(df, ["a"], time="t").collect()}
    y, want = None, {("one", 5): 2.0}
    for t in range(1000):
        y = float(t % 17) if y is None else 0.9 * y + 0.1 * (t % 17)
        want["k", t] = y
    assert got == want


# --- as-of joins -------------------------------------------------------------------

def test_asof_join_equals_brute_force(spark):
    rng = random.Random(4)
    days = [DAY(2020 + rng.randrange(4), rng.randrange(1, 13), rng.randrange(1, 29))
            for _ in range(400)]
    left = [(rng.choice(["hot", "hot", "a", "b", None]), rng.choice([*days[:150], None]), i)
            for i in range(300)]
    left += left[:20]
    right = {(rng.choice(["hot", "a", "c"]), d): i for i, d in enumerate(days)}
    l_df = spark.createDataFrame(left, "k string, at date, i int")
    r_df = spark.createDataFrame([(k, d, v) for (k, d), v in right.items()],
                                 "k string, day date, v int")
    got = values(asof_join(l_df, r_df, "k", "at", "day"))
    want = []
    for k, at, i in left:
        seen = [d for (key, d) in right if key == k and at is not None and d <= at]
        d = max(seen, default=None)
        want.append((k, at, i, d, right.get((k, d))))
    assert got == sorted(want, key=str)
    for block in ("month", "day"):
        assert values(asof_join(l_df, r_df, "k", "at", "day", block)) == got
    assert values(asof_join(l_df, r_df.limit(0), "k", "at", "day")) == sorted(
        [(*x, None, None) for x in left], key=str)
    with pytest.raises(ValueError):
        asof_join(l_df, r_df.withColumnRenamed("v", "i"), "k", "at", "day")


def test_wide_rows_are_not_sorted_by_the_asof_join(spark):
    left = spark.createDataFrame([("k", DAY(2024, 1, 1), "wide")], "k string, at date, w string")
    right = spark.createDataFrame([("k", DAY(2023, 1, 1), "x")], "k string, day date, f string")
    plan = asof_join(left, right, "k", "at", "day")._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.split("\n") if "Window" in x]
    assert windows and not any("w#" in x or "f#" in x for x in windows)


# --- matured counts ----------------------------------------------------------------

def test_counts_of_months_add_up(spark):
    """Labels that come late, turn from 0 to 1, repeat, or never come."""
    rng = random.Random(5)
    who = [f"c{i}" for i in range(60)] + [None]
    scored = [(rng.choice(who), round(rng.random(), 1), rng.randrange(2), m, "production")
              for m in range(5) for _ in range(80)]
    labels = [(rng.choice(who), rng.randrange(2), m) for m in range(5) for _ in range(25)]
    by = ["inference_date", "model_label"]
    s_df = spark.createDataFrame(scored, "Customer_ID string, score double, prediction int,"
                                         " inference_date int, model_label string")
    l_df = spark.createDataFrame(labels, "Customer_ID string, label int, snapshot_date int")
    known, counts = spark.createDataFrame([], maturity.LABELS), None
    for month in range(5):
        known = stage(maturity.advance_labels(known, l_df.filter(f"snapshot_date = {month}")))
        added = maturity.new_counts(s_df.filter(f"inference_date = {month}"), known, by).union(
            maturity.changed_counts(s_df.filter(f"inference_date < {month}"), known, by))
        counts = stage(added if counts is None else counts.union(added))
    worst = l_df.groupBy("Customer_ID").agg(F.max("label").alias("label"))
    rows = s_df.join(worst, "Customer_ID")
    assert values(maturity.performance(counts, by)) == values(metrics.performance(rows, by))
    some = maturity.performance(counts, by, points=[0.2, 0.5])
    assert values(some) == values(metrics.performance(rows, by, points=[]))
