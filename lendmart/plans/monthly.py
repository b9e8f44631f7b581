"""The monthly run: land, cleanse, build features and labels, train, score, monitor.

Any scheduler may call these with a snapshot date. Every step reads and writes
tables under one root, replaces only its own slice, and can be run again or skipped
when its slice is there. Raw and cleansed tables are partitioned by snapshot; those
that later steps read while others write are published slice by slice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from lendmart import constants as K, schemas
from lendmart.operators import (cleansing, drift, ema_state, features, joins, ledger, matrix,
                                maturity, model as M, monitor, score as S, split)
from lendmart.session import tune
from lendmart.sources import published, snapshots as tables

SOURCES = {
    "attributes": schemas.ATTRIBUTES_RAW,
    "financials": schemas.FINANCIALS_RAW,
    "ledger": schemas.LEDGER_RAW,
    "panel": schemas.PANEL_RAW,
}
PANEL_TABLE = "silver/panel"
MAPS_TABLE, AVERAGES_TABLE = "silver/panel_maps", "gold/averages"
FEATURES_TABLE, STATES_TABLE = "gold/features", "registry/feature_states"
SCORES_TABLE, MODELS_TABLE = "gold/scores", "registry/models"
LABELS_KNOWN_TABLE, COUNTS_TABLE = "monitor/labels_known", "monitor/score_counts"
#: Tables read through their manifest; the others are partitioned by snapshot.
PUBLISHED = {MAPS_TABLE, AVERAGES_TABLE, FEATURES_TABLE, STATES_TABLE, SCORES_TABLE,
             MODELS_TABLE, LABELS_KNOWN_TABLE, COUNTS_TABLE}


@dataclass(frozen=True)
class Mart:
    """Where the tables of one mart lie."""

    spark: SparkSession
    root: str

    def __post_init__(self):
        tune(self.spark)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str, snapshot_date=None) -> DataFrame:
        if table in PUBLISHED:
            return published.read(self.spark, self.path(table), snapshot_date)
        if snapshot_date is None:
            return tables.read_table(self.spark, self.path(table))
        return tables.read_snapshot(self.spark, self.path(table), snapshot_date)

    def exists(self, table: str) -> bool:
        if table in PUBLISHED:
            return bool(published.held(self.spark, self.path(table)))
        return tables.table_exists(self.spark, self.path(table))

    def loaded(self, table: str, value, column: str = K.SNAPSHOT) -> bool:
        if table in PUBLISHED:
            return published.is_published(self.spark, self.path(table), value)
        return tables.is_loaded(self.spark, self.path(table), value, column)

    def write(self, df: DataFrame, table: str, by=(K.SNAPSHOT,), value=None) -> None:
        tables.write_slices(df, self.path(table), by, value=value)

    def publish(self, df: DataFrame, table: str, value, note: str = "") -> None:
        published.publish(df, self.path(table), value, note)

    def newest(self, table: str, upto, before: bool = False) -> str | None:
        """The last published slice up to a date."""
        return published.newest_upto(self.spark, self.path(table), upto, before)


def land(mart: Mart, source: str, csv_path: str, snapshot_date, mode: str = "skip") -> bool:
    """One month of a raw CSV into its landing table, as text."""
    raw = tables.read_csv(mart.spark, csv_path, SOURCES[source])
    return tables.write_slices(tables.snapshot_of(raw, snapshot_date),
                               mart.path(f"bronze/{source}"), mode=mode, value=snapshot_date)


def build_ledger(mart: Mart, snapshot_date, mode: str = "skip") -> bool:
    raw = mart.read("bronze/ledger", snapshot_date)
    rows = ledger.with_dpd(cleansing.project(raw, schemas.LEDGER))
    return tables.write_slices(rows, mart.path("silver/ledger"), mode=mode, value=snapshot_date)


def build_customers(mart: Mart, snapshot_date, mode: str = "skip") -> bool:
    rows = joins.customer_snapshot(
        cleansing.clean_attributes(mart.read("bronze/attributes", snapshot_date)),
        cleansing.clean_financials(mart.read("bronze/financials", snapshot_date)))
    return tables.write_slices(rows, mart.path("silver/customers"), mode=mode,
                               value=snapshot_date)


def audit_customers(mart: Mart, snapshot_date) -> DataFrame:
    """What cleansing changed this month, one row per column."""
    return cleansing.audit(
        mart.read("bronze/attributes", snapshot_date), cleansing.attribute_rules()
    ).unionByName(cleansing.audit(
        mart.read("bronze/financials", snapshot_date), cleansing.financial_rules()))


def build_panel(mart: Mart, snapshot_date, mode: str = "skip") -> bool:
    raw = mart.read("bronze/panel", snapshot_date)
    rows = raw.withColumns({c: F.col(c).try_cast("double") for c in K.PANEL_COLUMNS})
    return tables.write_slices(rows, mart.path(PANEL_TABLE), mode=mode, value=snapshot_date)


def build_labels(mart: Mart, snapshot_date, dpd: int = K.DEFAULT_DPD, mob: int = K.DEFAULT_MOB,
                 mode: str = "skip") -> bool:
    rows = ledger.labels(mart.read("silver/ledger", snapshot_date), dpd, mob)
    return tables.write_slices(rows, mart.path("gold/labels"), mode=mode, value=snapshot_date)


def update_averages(mart: Mart, snapshot_date, mode: str = "skip") -> bool:
    """Add a month to the moving averages. Reads that month of the panel and the newest
    state before it. A month that comes late, or again, is summarised anew; the states after
    it are composed again from the months' summaries, without their panel rows."""
    if mode == "skip" and mart.loaded(MAPS_TABLE, snapshot_date):
        return False
    month = mart.read(PANEL_TABLE, snapshot_date)
    mart.publish(ema_state.summarise(month, K.PANEL_COLUMNS), MAPS_TABLE, snapshot_date)
    dates = [r["slice"] for r in published.entries(mart.spark, mart.path(MAPS_TABLE))]
    for date in [d for d in dates if d >= str(snapshot_date)]:
        state, before = mart.read(MAPS_TABLE, date), mart.newest(AVERAGES_TABLE, date, before=True)
        if before is not None:
            state = ema_state.advance(mart.read(AVERAGES_TABLE, before), state)
        mart.publish(state, AVERAGES_TABLE, date)
    return True


def fit_state(mart: Mart, as_of) -> features.FeatureState:
    """Fit the feature statistics on all customers up to a date and register them for it."""
    known = mart.read("silver/customers").filter(
        F.col(K.SNAPSHOT) <= F.lit(str(as_of)).cast("date"))
    state = features.fit_features(known)
    mart.publish(state.to_frame(mart.spark), STATES_TABLE, as_of)
    return state


def feature_state(mart: Mart, as_of) -> tuple[str, features.FeatureState]:
    """The newest statistics fitted up to a date, and that date; fitted for it if there are
    none. A later state never changes what an earlier month is built with."""
    version = mart.newest(STATES_TABLE, as_of)
    if version is None:
        return str(as_of), fit_state(mart, as_of)
    return version, features.FeatureState.from_frame(mart.read(STATES_TABLE, version))


def build_features(mart: Mart, snapshot_date, mode: str = "skip",
                   state: features.FeatureState | None = None) -> bool:
    """The month's feature slice, published whole. Its statistics are those of the state
    given, or of the newest state fitted up to the month, whose date the manifest notes. All
    slices share one schema: the columns of the states used so far, null where a slice was
    built before a category was known."""
    if mode == "skip" and mart.loaded(FEATURES_TABLE, snapshot_date):
        return False
    version = "given"
    if state is None:
        version, state = feature_state(mart, snapshot_date)
    rows = features.apply_features(mart.read("silver/customers", snapshot_date), state)
    averaged = mart.newest(AVERAGES_TABLE, snapshot_date)
    if averaged is not None:
        rows = joins.with_ema(rows, ema_state.averages(mart.read(AVERAGES_TABLE, averaged)))
    mart.publish(rows, FEATURES_TABLE, snapshot_date, note=version)
    return True


def feature_store(mart: Mart) -> DataFrame:
    """All months under the table's one schema, which comes from the manifest."""
    return mart.read(FEATURES_TABLE)


def version_of(snapshot_date) -> str:
    return "credit_model_" + str(snapshot_date).replace("-", "_")


def training_matrix(mart: Mart, as_of) -> tuple[DataFrame, matrix.MatrixState, DataFrame]:
    """Staged training rows, the fitted matrix and the staged matrix, from the labels
    known as of a date. A customer is one row, with the features known at its label."""
    known = mart.read("gold/labels").filter(
        F.col(K.SNAPSHOT) <= F.lit(str(as_of)).cast("date"))
    labelled = split.split_sets(ledger.one_label_per_customer(known), date=K.SNAPSHOT)
    rows = tables.stage(joins.training_set_asof(labelled, feature_store(mart)))
    state = matrix.fit_matrix(rows, fit_on=rows.filter(F.col("split") == "train"))
    return rows, state, tables.stage(
        matrix.feature_matrix(rows, state, keep=[K.CUSTOMER, "label", "split"]))


def train_month(mart: Mart, snapshot_date, grids: dict[str, list[dict]] | None = None,
                folds: int = 3, parallelism: int | None = None) -> DataFrame | None:
    """Train the candidates, keep the champion by out-of-time Gini, register it, and
    store its drift baseline. Does nothing for a month without features. Returns the
    metrics table."""
    if not mart.loaded(FEATURES_TABLE, snapshot_date):
        return None
    spark, trained_on = mart.spark, F.lit(str(snapshot_date)).cast("date")
    rows, state, data = training_matrix(mart, snapshot_date)
    candidates = {kind: M.train(data, state.names, kind, (grids or {}).get(kind), folds,
                                parallelism=parallelism)
                  for kind in M.KINDS}
    results = None
    for t in candidates.values():
        table = M.evaluate(t, data)
        results = table if results is None else results.unionByName(table)
    results = results.withColumn("trained", trained_on)
    mart.write(results, "registry/metrics", ["trained"])
    results = mart.read("registry/metrics").filter(F.col("trained") == trained_on)

    best = candidates[monitor.champion(results).first()["candidate"]]
    version = version_of(snapshot_date)
    best.model.write().overwrite().save(mart.path(f"models/{version}"))
    state.to_frame(spark).write.mode("overwrite").parquet(mart.path(f"models/{version}_matrix"))
    top = [r["feature"] for r in monitor.top_features(M.importances(spark, best)).collect()]
    mart.publish(tables.small_table(
        spark, [(version, model_name(mart, version), best.kind, float(best.threshold), top,
                 str(best.params))],
        "model_version string, model_label string, kind string, threshold double,"
        " top array<string>, params string").withColumn("trained", trained_on),
        MODELS_TABLE, snapshot_date)
    save_baseline(mart, version, rows, data, state, best, top)
    return results


def save_baseline(mart: Mart, version: str, rows: DataFrame, data: DataFrame,
                  state: matrix.MatrixState, best: M.Trained, top: list[str]) -> None:
    """Expected label mix and feature distributions of the train split, as tables.

    A dummy among the top features is monitored by the binned column it comes from.
    """
    spark, is_train = mart.spark, F.col("split") == "train"
    scored = M.predict(best.model, data.filter(is_train), ["label"]).withColumn(
        "prediction", (F.col("score") >= best.threshold).cast("int"))
    s0, s1 = drift.label_shares(scored)
    tables.small_table(spark, [(s0, s1)], "share_0 double, share_1 double").write.mode(
        "overwrite").parquet(mart.path(f"models/{version}_label_mix"))
    columns = list(dict.fromkeys(state.source_of(f) for f in top))
    base = drift.fit_drift_baseline(
        matrix.scale(rows.filter(is_train), state.scales), columns)
    base.table.write.mode("overwrite").parquet(mart.path(f"models/{version}_shares"))
    tables.small_table(
        spark, [(c, base.edges.get(c), i) for i, c in enumerate(base.features)],
        "feature string, edges array<double>, pos int").write.mode("overwrite").parquet(
            mart.path(f"models/{version}_edges"))


def load_baseline(mart: Mart, version: str):
    """(expected label shares, drift baseline) of a registered model."""
    mix = mart.read(f"models/{version}_label_mix").first()
    edges = sorted(mart.read(f"models/{version}_edges").collect(), key=lambda r: r["pos"])
    return (mix["share_0"], mix["share_1"]), drift.DriftBaseline(
        {r["feature"]: list(r["edges"]) for r in edges if r["edges"] is not None},
        [r["feature"] for r in edges if r["edges"] is None],
        mart.read(f"models/{version}_shares"))


def registry(mart: Mart) -> DataFrame:
    """Registered models with the names they were given."""
    return mart.read(MODELS_TABLE)


def model_name(mart: Mart, version: str) -> str:
    """The name of a model, given once: 'production' to the first one registered, autoML1,
    autoML2, ... to the next, whatever months they are for. A model trained again keeps it,
    so names in stored scores stay true on a backfill."""
    if not mart.exists(MODELS_TABLE):
        return "production"
    names = {r["model_version"]: r["model_label"]
             for r in registry(mart).select("model_version", "model_label").collect()}
    return names.get(version) or f"autoML{len(names)}"


def score_month(mart: Mart, inference_date, mode: str = "skip") -> bool:
    """Score the month with production and last month's model. Does nothing where no
    model was trained before the month or the month has no features."""
    if not mart.exists(MODELS_TABLE):
        return False
    if mode == "skip" and mart.loaded(SCORES_TABLE, inference_date):
        return False
    known = registry(mart)
    batch = mart.spark.range(1).select(
        F.lit(str(inference_date)).cast("date").alias("inference_date"))
    chosen = (joins.models_for(known.select("model_label", "model_version", "trained"), batch)
              .join(known.select("model_version", "threshold", "top"), "model_version")
              .collect())
    if not chosen or not mart.loaded(FEATURES_TABLE, inference_date):
        return False
    rows = mart.read(FEATURES_TABLE, inference_date)
    parts = []
    for m in sorted(chosen, key=lambda r: r["model_label"]):
        version = m["model_version"]
        state = matrix.MatrixState.from_frame(mart.read(f"models/{version}_matrix"))
        model = PipelineModel.load(mart.path(f"models/{version}"))
        shown = [state.source_of(f) for f in m["top"]]
        parts.append(S.score(rows, model, state, m["threshold"], version, m["model_label"],
                             inference_date, shown))
    mart.publish(S.score_all(parts), SCORES_TABLE, inference_date)
    return True


def update_counts(mart: Mart, monitor_date) -> None:
    """Add a month to the matured counts: its batches under the labels known by now, and
    what its labels change in the batches before, of which only customers, scores and
    predictions are read. Months already counted after it are counted again."""
    spark, path = mart.spark, mart.path(SCORES_TABLE)
    done = [r["slice"] for r in published.entries(spark, mart.path(COUNTS_TABLE))]
    for month in [str(monitor_date), *[m for m in done if m > str(monitor_date)]]:
        before = mart.newest(LABELS_KNOWN_TABLE, month, before=True)
        known = (tables.small_table(spark, [], maturity.LABELS) if before is None
                 else mart.read(LABELS_KNOWN_TABLE, before))
        labels = mart.read("gold/labels").filter(F.col(K.SNAPSHOT) <= F.lit(month).cast("date"))
        if before is not None:
            labels = labels.filter(F.col(K.SNAPSHOT) > F.lit(before).cast("date"))
        mart.publish(maturity.advance_labels(known, labels), LABELS_KNOWN_TABLE, month)
        state = mart.read(LABELS_KNOWN_TABLE, month)
        columns = [K.CUSTOMER, "score", "prediction", *maturity.BATCH]
        counts = maturity.new_counts(
            published.read(spark, path, upto=month, after=before, columns=columns), state)
        if before is not None:
            counts = counts.unionByName(maturity.changed_counts(
                published.read(spark, path, upto=before, columns=columns), state))
        mart.publish(counts, COUNTS_TABLE, month)


def monitor_month(mart: Mart, monitor_date) -> dict[str, DataFrame]:
    """PSI and CSI of the production batches that have none yet or are the month's own, and
    matured performance of all batches as known on the date, with status bands.

    The first two follow from a batch alone and are written once; performance follows from
    the stored counts. So the month reads its own batch and its own labels.
    """
    spark, stamp = mart.spark, F.lit(str(monitor_date)).cast("date")
    scored = [d for d in published.held(spark, mart.path(SCORES_TABLE)) if d <= str(monitor_date)]
    if not scored:
        return {}
    production = registry(mart).filter(F.col("model_label") == "production").first()
    expected, base = load_baseline(mart, production["model_version"])
    by = ["inference_date", "model_label"]
    out = {}
    pending = [d for d in scored if d == str(monitor_date)
               or not mart.loaded("monitor/psi", d, "inference_date")]
    if pending:
        served = mart.read(SCORES_TABLE, pending).filter(F.col("model_label") == "production")
        out = {"psi": drift.psi(expected, served, by),
               "csi": drift.csi(base.only(served.columns), served, by)}
    update_counts(mart, monitor_date)
    out = {name: monitor.with_status(df, name) for name, df in out.items()}
    performance = maturity.performance(
        published.read(spark, mart.path(COUNTS_TABLE), upto=monitor_date))
    out["performance"] = monitor.with_status(monitor.with_status(performance, "gini"), "recall")
    for name, df in out.items():
        mart.write(df.withColumn("monitor_date", stamp), f"monitor/{name}", ["inference_date"])
    return {name: mart.read(f"monitor/{name}") for name in ("psi", "csi", "performance")
            if mart.exists(f"monitor/{name}")}


def run(mart: Mart, snapshot_date, sources: dict[str, str], train: bool = True,
        grids: dict[str, list[dict]] | None = None, mode: str = "skip") -> None:
    """One month from raw files to monitor tables. ``sources``: name -> CSV path."""
    for name, path in sources.items():
        land(mart, name, path, snapshot_date, mode)
    if mart.exists("bronze/ledger"):
        build_ledger(mart, snapshot_date, mode)
        build_labels(mart, snapshot_date, mode=mode)
    if mart.exists("bronze/panel"):
        build_panel(mart, snapshot_date, mode)
        update_averages(mart, snapshot_date, mode)
    if mart.loaded("bronze/attributes", snapshot_date):
        build_customers(mart, snapshot_date, mode)
        build_features(mart, snapshot_date, mode)
    score_month(mart, snapshot_date, mode)
    if train:
        train_month(mart, snapshot_date, grids)
    monitor_month(mart, snapshot_date)
