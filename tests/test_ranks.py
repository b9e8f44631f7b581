"""Exact results on skewed data against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lendmart import constants as K
from lendmart.operators import drift, metrics, monitor, panel, ranks, split
from lendmart.sources.snapshots import stage


def skewed(n=6000, seed=1):
    """A third of the rows at one value, the rest over twelve orders of magnitude."""
    g = np.random.default_rng(seed)
    x = np.exp(g.normal(0, 6, n)).round(3)
    x[: n // 3] = 7.5
    return g.permutation(x)


@pytest.mark.parametrize("n", [1, 2, 5, 6000])
def test_quantiles_equal_numpy(spark, n):
    x = skewed(6000)[:n]
    y = np.round(np.linspace(-3, 3, n), 1)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y, "z": [np.nan] * n})).repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    disc = {(r["column"], r["prob"]): r["value"]
            for r in ranks.quantiles(df, ["x", "y", "z"], probs, "disc").collect()}
    cont = {(r["column"], r["prob"]): r["value"]
            for r in ranks.quantiles(df, ["x", "y"], probs, "cont").collect()}
    assert not [k for k in disc if k[0] == "z"]
    for name, v in (("x", x), ("y", y)):
        for p in probs:
            assert disc[name, p] == np.percentile(v, p * 100, method="inverted_cdf")
            assert cont[name, p] == pytest.approx(np.percentile(v, p * 100), rel=1e-12)


def test_bad_cut_points_do_not_change_results(spark):
    x = skewed(3000)
    y = (np.random.default_rng(2).random(3000) < 0.3).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"score": x, "label": y}))
    results = {metrics.gini(df).first()["gini"]}
    for points in ([], [7.5], [1e9], list(np.linspace(0, 100, 50))):
        results.add(metrics.rank_metrics(df, points=points).first()["gini"])
    assert len(results) == 1


def test_pieces_are_even_on_skewed_values(spark):
    x = skewed(20000)
    df = spark.createDataFrame(pd.DataFrame({"x": x})).repartition(4)
    points = ranks.cut_points(df, ["x"], 32)
    sizes = (ranks.long_form(df, points).select("piece", "value").distinct()
             .groupBy("piece").count())
    biggest = sizes.agg(F.max("count")).first()[0]
    assert biggest <= 20000 / 32 * 4


@pytest.mark.parametrize("kind", ["uniform", "zero-inflated", "log-normal", "whole numbers"])
def test_many_pieces_are_even_on_any_distribution(spark, kind):
    """Far more pieces than the first sketch has points, with heavy values apart."""
    g = np.random.default_rng(3)
    n = 60000
    x = {"uniform": g.random(n) * 1e6,
         "zero-inflated": np.where(g.random(n) < 0.8, 0.0, g.exponential(5, n)),
         "log-normal": np.exp(g.normal(0, 8, n)) * g.choice([-1, 1], n),
         "whole numbers": np.concatenate([np.arange(n - 9000), np.repeat([5, 77, 500], 3000)])}
    df = spark.createDataFrame(pd.DataFrame({"x": x[kind].astype(float)})).repartition(8)
    points = ranks.cut_points(df, ["x"], 400)
    values = pd.Series(np.searchsorted(points["x"], np.unique(x[kind].astype(float)), "right"))
    sizes = values.value_counts()
    assert len(sizes) >= 400
    assert sizes.max() <= 4 * sizes.mean()
    some = ranks.quantiles(df, ["x"], [0.01, 0.5, 0.999], points=points).collect()
    assert {r["prob"]: r["value"] for r in some} == {
        p: np.sort(x[kind])[int(p * n) - 1] for p in (0.01, 0.5, 0.999)}


def brute_gini(score, label):
    pos, neg = score[label == 1], score[label == 0]
    if not len(pos) or not len(neg):
        return None
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return 2 * wins / (len(pos) * len(neg)) - 1


def test_gini_equals_brute_force_and_is_antisymmetric(spark):
    g = np.random.default_rng(3)
    n = 3000
    pdf = pd.DataFrame({
        "by": np.where(np.arange(n) % 3 == 0, "hot", g.choice(["a", "b", "c"], n)),
        "score": np.where(g.random(n) < 0.33, 0.5, g.random(n).round(3)),
        "label": (g.random(n) < 0.4).astype(int)})
    pdf.loc[pdf["by"] == "c", "label"] = 1
    df = spark.createDataFrame(pdf).withColumn("prediction", (F.col("score") > 0.5).cast("int"))
    got = {r["by"]: r for r in metrics.rank_metrics(df, pred="prediction", by=["by"]).collect()}
    flipped = {r["by"]: r["gini"] for r in metrics.gini(
        df.withColumn("score", -F.col("score")), by=["by"]).collect()}
    for by, part in pdf.groupby("by"):
        want = brute_gini(part["score"].to_numpy(), part["label"].to_numpy())
        assert got[by]["n"] == len(part)
        if want is None:
            assert got[by]["gini"] is None and got[by]["recall"] is None
            continue
        assert got[by]["gini"] == pytest.approx(want, abs=5.1e-5)
        assert flipped[by] == -got[by]["gini"]
        hit = ((part["score"] > 0.5) & (part["label"] == 1)).sum() / part["label"].sum()
        assert got[by]["recall"] == pytest.approx(hit, abs=5.1e-5)


def test_threshold_search(spark):
    g = np.random.default_rng(4)
    pdf = pd.DataFrame({"score": g.random(2000).round(3)})
    pdf["label"] = (g.random(2000) < pdf["score"]).astype(int)
    best_t, best_r = 0.5, -1.0
    for t in K.THRESHOLD_GRID:
        pred = pdf["score"] >= t
        tp = (pred & (pdf["label"] == 1)).sum()
        if pred.sum() == 0 or tp / pred.sum() < 0.5:
            continue
        if tp / pdf["label"].sum() > best_r:
            best_t, best_r = t, tp / pdf["label"].sum()
    got = metrics.threshold(spark.createDataFrame(pdf)).first()
    assert (got["threshold"], got["recall"]) == (best_t, best_r)
    hopeless = spark.createDataFrame([(0.9, 0), (0.2, 0), (0.1, 1)], "score double, label int")
    assert metrics.threshold(hopeless).first()["threshold"] == 0.5


def test_stratified_split_has_exact_quotas(spark):
    df = spark.range(5003).select(F.col("id").cast("string").alias("k"),
                                  (F.col("id") % 3 == 0).cast("int").alias("label"))
    got = split.stratified_split(df, "k", "label")
    assert got.count() == 5003 and got.select("k").distinct().count() == 5003
    counts = {(r["label"], r["split"]): r["count"]
              for r in got.groupBy("label", "split").count().collect()}
    for label, n in ((1, 1668), (0, 3335)):
        train, val = n * 80 // 100, n * 10 // 100
        assert [counts[label, s] for s in ("train", "val", "test")] == [
            train, val, n - train - val]
    again = split.stratified_split(df.repartition(7), "k", "label")
    assert got.exceptAll(again).isEmpty()


def test_rows_of_a_hot_key_stay_together(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
        .alias("k"), F.lit(1).alias("label"))
    got = split.stratified_split(df, "k", "label")
    assert got.count() == 3000
    assert got.filter("k = 'hot'").select("split").distinct().count() == 1


def test_tiny_groups_split(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("c", 0)], "k string, label int")
    assert split.stratified_split(df, "k", "label").count() == 3


def test_oot_takes_the_last_months(spark):
    df = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-06-01',"
                   " interval 1 month)) AS label_date, 1 AS x")
    got = split.oot_split(df).filter("is_oot").select("label_date").orderBy("label_date")
    assert [str(r[0]) for r in got.collect()] == ["2024-05-01", "2024-06-01"]


# --- panel -----------------------------------------------------------------

@pytest.fixture(scope="module")
def panel_pdf():
    g = np.random.default_rng(5)
    months = pd.date_range("2023-01-01", periods=18, freq="MS").date
    rows = [(f"c{k}", m, *g.normal(10, 5, 3).round(2)) for k in range(40)
            for m in months if g.random() < 0.9]
    pdf = pd.DataFrame(rows, columns=["Customer_ID", "snapshot_date", "fe_1", "fe_2", "fe_3"])
    return pdf.sample(frac=1, random_state=1)


def pandas_ema(pdf, cols):
    pdf = pdf.sort_values(["Customer_ID", "snapshot_date"]).copy()
    for c in cols:
        pdf["ema_" + c] = pdf.groupby("Customer_ID")[c].transform(
            lambda s: s.ewm(alpha=0.1, adjust=False).mean())
    return pdf


def test_ema_equals_pandas(spark, panel_pdf):
    cols = ["fe_1", "fe_2", "fe_3"]
    df = spark.createDataFrame(panel_pdf)
    want = pandas_ema(panel_pdf, cols)
    last = want.groupby("Customer_ID").tail(1).set_index("Customer_ID")
    for fn in (panel.ema_latest, panel.ema_latest_sparse):
        got = fn(df, cols).toPandas().set_index("Customer_ID").loc[last.index]
        for c in cols:
            np.testing.assert_allclose(got["ema_" + c], last["ema_" + c], rtol=1e-12)
    running = (panel.ema_running(df, cols).toPandas()
               .sort_values(["Customer_ID", "snapshot_date"]))
    for c in cols:
        np.testing.assert_allclose(running["ema_" + c].to_numpy(), want["ema_" + c].to_numpy(),
                                   rtol=1e-12)


def test_ema_with_gaps_equals_pandas(spark, panel_pdf):
    cols = ["fe_1", "fe_2", "fe_3"]
    g = np.random.default_rng(6)
    pdf = panel_pdf.copy()
    for c in cols:
        pdf.loc[g.random(len(pdf)) < 0.3, c] = np.nan
    pdf.loc[pdf["Customer_ID"] == "c7", "fe_2"] = np.nan
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    want = pandas_ema(pdf, cols).groupby("Customer_ID").tail(1).set_index("Customer_ID")
    got = panel.ema_latest_sparse(df, cols).toPandas().set_index("Customer_ID").loc[want.index]
    for c in cols:
        np.testing.assert_allclose(got["ema_" + c].astype(float), want["ema_" + c], rtol=1e-12)


def test_ema_as_of_ignores_later_rows(spark, panel_pdf):
    df = spark.createDataFrame(panel_pdf)
    cut = panel_pdf[panel_pdf["snapshot_date"] <= pd.Timestamp("2023-06-01").date()]
    want = pandas_ema(cut, ["fe_1"]).groupby("Customer_ID").tail(1).set_index("Customer_ID")
    got = panel.ema_latest(df, ["fe_1"], as_of="2023-06-01").toPandas().set_index("Customer_ID")
    np.testing.assert_allclose(got.loc[want.index, "ema_fe_1"], want["ema_fe_1"], rtol=1e-12)


def test_ema_on_a_full_monthly_grid(spark):
    months = pd.date_range("2023-01-01", periods=12, freq="MS").date
    g = np.random.default_rng(7)
    pdf = pd.DataFrame([(f"c{k}", m, float(g.integers(0, 99))) for k in range(9) for m in months],
                       columns=["Customer_ID", "snapshot_date", "fe_1"])
    df = spark.createDataFrame(pdf)
    a = panel.ema_latest(df, ["fe_1"]).toPandas().set_index("Customer_ID").sort_index()
    b = panel.ema_latest_on_grid(df, ["fe_1"], as_of="2023-12-01",
                                 start="2023-01-01").toPandas().set_index("Customer_ID")
    np.testing.assert_allclose(a["ema_fe_1"], b.sort_index()["ema_fe_1"], rtol=1e-12)


def test_latest_per_key_and_argmax(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 2, "z")],
                               "k string, t int, v string")
    assert sorted(map(tuple, panel.latest_per_key(df, "k", "t").collect())) == [
        ("a", 3, "y"), ("b", 2, "z")]
    assert panel.argmax_row(df, "t").first()["v"] == "y"


# --- drift -------------------------------------------------------------------

def numpy_csi(exp, act, bins=10):
    exp, act = pd.Series(exp).dropna(), pd.Series(act).dropna()
    if not len(exp) or not len(act):
        return None
    if exp.dtype == object or exp.nunique() <= bins:
        cats = sorted(set(exp) | set(act), key=str)
        e = np.array([(exp == c).mean() for c in cats])
        a = np.array([(act == c).mean() for c in cats])
    else:
        edges = np.unique(np.percentile(exp, np.linspace(0, 100, bins + 1)))
        inner = edges[1:-1]
        def share(v):
            return np.bincount(np.searchsorted(inner, v, side="right"),
                               minlength=len(inner) + 1) / len(v)
        e, a = share(exp.to_numpy()), share(act.to_numpy())
    e, a = np.where(e == 0, 1e-6, e), np.where(a == 0, 1e-6, a)
    return float(np.sum((a - e) * np.log(a / e)))


def test_csi_equals_numpy(spark):
    g = np.random.default_rng(8)
    n = 4000
    base = pd.DataFrame({
        "smooth": g.normal(0, 1, n), "heavy": np.where(g.random(n) < 0.35, 0.0, g.random(n)),
        "code": g.integers(0, 4, n), "text": g.choice(list("abc"), n)})
    base.loc[:50, "smooth"] = np.nan
    batch = pd.DataFrame({
        "inference_date": np.where(np.arange(n) % 3 == 0, "m1", g.choice(["m2", "m3"], n)),
        "smooth": g.normal(0.5, 1, n), "heavy": np.where(g.random(n) < 0.1, 0.0, g.random(n)),
        "code": g.integers(2, 6, n), "text": g.choice(list("bcd"), n)})
    batch.loc[batch["inference_date"] == "m2", "smooth"] = np.nan
    cols = ["smooth", "heavy", "code", "text"]
    exp_df = spark.createDataFrame(base).replace(float("nan"), None)
    act_df = spark.createDataFrame(batch).replace(float("nan"), None)
    fitted = drift.fit_drift_baseline(exp_df, cols)
    assert set(fitted.edges) == {"smooth", "heavy"} and set(fitted.discrete) == {"code", "text"}
    got = {(r["inference_date"], r["feature"]): r["csi"]
           for r in drift.csi(fitted, act_df).collect()}
    assert len(got) == 12
    for month, part in batch.groupby("inference_date"):
        for c in cols:
            want = numpy_csi(base[c], part[c])
            if want is None:
                assert got[month, c] is None
            else:
                assert got[month, c] == pytest.approx(want, abs=5.1e-5), (month, c)
    same = drift.csi(fitted, exp_df.withColumn("inference_date", F.lit("m")))
    assert {r["csi"] for r in same.collect()} == {0.0}


def test_psi(spark):
    base = spark.createDataFrame([(0,)] * 60 + [(1,)] * 40, "prediction int")
    rows = spark.createDataFrame([("a", 0)] * 6 + [("a", 1)] * 4 + [("b", 0)] * 5,
                                 "inference_date string, prediction int")
    got = {r["inference_date"]: r["psi"]
           for r in drift.psi(drift.label_shares(base), rows).collect()}
    want = (1 - 0.6) * np.log(1 / 0.6) + (1e-6 - 0.4) * np.log(1e-6 / 0.4)
    assert got == {"a": 0.0, "b": pytest.approx(want, abs=5e-5)}


def test_staged_tables_read_back(spark):
    df = spark.range(10).withColumn("d", F.lit("2024-01-01").cast("date"))
    staged = stage(df)
    assert staged.schema.simpleString() == df.schema.simpleString()
    assert staged.exceptAll(df).isEmpty() and staged.count() == 10


def test_wide_csi_has_one_column_per_feature(spark):
    long = spark.createDataFrame([("m1", "a", 0.1), ("m1", "b", 0.2), ("m2", "a", 0.3)],
                                 "inference_date string, feature string, csi double")
    got = {r["inference_date"]: (r["a"], r["b"])
           for r in monitor.wide_csi(long, ["a", "b"]).collect()}
    assert got == {"m1": (0.1, 0.2), "m2": (0.3, None)}


def test_status_bands(spark):
    df = spark.createDataFrame([(0.7, 0.05), (0.62, 0.2), (0.1, 0.25), (None, None)],
                               "gini double, psi double")
    got = monitor.with_status(monitor.with_status(df, "gini"), "psi").collect()
    assert [(r["gini_status"], r["psi_status"]) for r in got] == [
        ("green", "green"), ("yellow", "yellow"), ("red", "red"), (None, None)]
