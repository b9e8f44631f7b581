"""Population drift: PSI on hard labels, CSI per feature, against a fitted baseline."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from lendmart import constants as K
from lendmart.operators.ranks import (MAX_QUANTILE_PIECES, default_pieces, place, quantiles,
                                      refine, sketch)
from lendmart.sources.snapshots import small_table


def _floored(share: Column) -> Column:
    return F.when(share == 0, F.lit(K.SHARE_FLOOR)).otherwise(share)


def _term(expected: Column, actual: Column) -> Column:
    return (actual - expected) * F.ln(actual / expected)


@dataclass(frozen=True)
class DriftBaseline:
    """Expected distributions: the inner edges of continuous features and a table
    (feature, bin, share) for all of them."""

    edges: dict[str, list[float]]
    discrete: list[str]
    table: DataFrame

    @property
    def features(self) -> list[str]:
        return list(self.edges) + list(self.discrete)

    def only(self, features: Sequence[str]) -> DriftBaseline:
        return DriftBaseline({c: e for c, e in self.edges.items() if c in features},
                             [c for c in self.discrete if c in features],
                             self.table.filter(F.col("feature").isin(list(features))))


def _few_values(df: DataFrame, points: dict[str, list[float]], limit: int) -> set[str]:
    """Numeric columns with at most ``limit`` distinct values.

    A sketch that shows more distinct values settles it, as all of them occur in the
    data. Only the other columns are counted, exactly; their rows concentrate on few
    values, so little is left to shuffle after the partial distinct.
    """
    unsure = [c for c, found in points.items() if len(set(found)) <= limit]
    if not unsure:
        return set()
    entries = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
        for c in unsure]))
    found = (df.select(entries.alias("e")).select("e.*").filter("value is not null").distinct()
             .groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect())
    counts = {r["feature"]: r["n"] for r in found}
    return {c for c in unsure if counts.get(c, 0) <= limit}


def binned(df: DataFrame, edges: dict[str, list[float]], discrete: Sequence[str],
           keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., feature, bin) for all features; missing values are left out."""
    wide = place(df.select(*keep, *edges, *discrete), edges)
    entries = [F.struct(F.lit(c).alias("feature"),
                        F.col(f"__p_{c}").cast("string").alias("bin"),
                        F.col(c).isNotNull().alias("seen"))
               for c in edges]
    entries += [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("bin"),
                         F.col(c).isNotNull().alias("seen")) for c in discrete]
    return (wide.select(*keep, F.explode(F.array(*entries)).alias("e"))
            .filter("e.seen").select(*keep, "e.feature", "e.bin"))


def _bin_shares(df: DataFrame, edges, discrete, by: Sequence[str] = ()) -> DataFrame:
    """(by..., feature, bin, share): the total rows of a group have one row per group
    and feature even where a feature is missing throughout (null bin)."""
    features = [*edges, *discrete]
    sizes = df.groupBy(*by).agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(features)])
    sizes = sizes.select(*by, F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"n{i}").alias("total"))
        for i, c in enumerate(features)])).alias("e")).select(*by, "e.*")
    counts = (binned(df, edges, discrete, by)
              .groupBy(*by, "feature", "bin").agg(F.count(F.lit(1)).alias("n")))
    return (sizes.join(counts, [*by, "feature"], "left")
            .withColumn("share", F.col("n") / F.col("total")).drop("n", "total"))


def fit_drift_baseline(df: DataFrame, columns: Sequence[str],
                       bins: int = K.DRIFT_BINS) -> DriftBaseline:
    """Expected distributions of the columns.

    Text columns and numeric columns with at most ``bins`` distinct values are
    compared by value; others by decile, with the smallest and largest of the
    distinct percentiles replaced by open ends.
    """
    numeric = [f.name for f in df.schema
               if f.name in columns and isinstance(f.dataType, NumericType)]
    points = sketch(df, numeric) if numeric else {}
    few = _few_values(df, points, bins)
    continuous = [c for c in columns if c in numeric and c not in few]
    discrete = [c for c in columns if c not in continuous]
    edges: dict[str, list[float]] = {}
    if continuous:
        probs = [i / bins for i in range(bins + 1)]
        found: dict[str, set[float]] = {c: set() for c in continuous}
        at, _ = refine(df, continuous, points, min(MAX_QUANTILE_PIECES,
                                                   default_pieces(df.sparkSession)))
        for r in quantiles(df, continuous, probs, "cont", at).collect():
            found[r["column"]].add(r["value"])
        edges = {c: sorted(found[c])[1:-1] for c in continuous}
    table = _bin_shares(df, edges, discrete).filter("bin is not null")
    # a decile bin without training rows still belongs to the expected side
    if edges:
        grid = small_table(
            df.sparkSession, [(c, str(i)) for c, e in edges.items() for i in range(len(e) + 1)],
            "feature string, bin string")
        table = (table.join(F.broadcast(grid), ["feature", "bin"], "full")
                 .withColumn("share", F.coalesce("share", F.lit(0.0))))
    return DriftBaseline(edges, discrete, table)


def csi(baseline: DriftBaseline, scored: DataFrame, by: Sequence[str] = ("inference_date",),
        dp: int = 4) -> DataFrame:
    """(by..., feature, csi) for all groups and features in one job; null where a
    group has no value of the feature.

    The sum runs over the union of expected and actual bins. Bins a group lacks are
    not generated: their terms are the feature's constant (every expected bin against
    the floor) minus the same terms of the bins the group has.
    """
    floor = F.lit(K.SHARE_FLOOR)
    expected = baseline.table.select("feature", "bin", _floored(F.col("share")).alias("e"))
    # one row per monitored feature
    absent = expected.groupBy("feature").agg(F.sum(_term(F.col("e"), floor)).alias("absent"))
    actual = _bin_shares(scored, baseline.edges, baseline.discrete, by)
    pairs = actual.join(expected, ["feature", "bin"], "left")
    e, a = F.coalesce("e", floor), F.col("share")
    part = _term(e, a) - F.when(F.col("e").isNotNull(), _term(F.col("e"), floor)).otherwise(0.0)
    return (pairs.groupBy(*by, "feature").agg(F.sum(part).alias("part"))
            .join(F.broadcast(absent), "feature")
            .select(*by, "feature",
                    F.round(F.col("part") + F.col("absent"), dp).alias("csi")))


def label_shares(df: DataFrame, label: str = "prediction") -> tuple[float | None, float | None]:
    """Shares of label 0 and 1 as driver values."""
    n = F.count(F.lit(1))
    row = df.agg(F.try_divide(F.count_if(F.col(label) == 0), n).alias("s0"),
                 F.try_divide(F.count_if(F.col(label) == 1), n).alias("s1")).first()
    return row["s0"], row["s1"]


def psi(expected: tuple[float, float], scored: DataFrame, by: Sequence[str] = ("inference_date",),
        label: str = "prediction", dp: int = 4) -> DataFrame:
    """(by..., psi) of the hard-label mix of all groups in one partially aggregated pass."""
    n = F.count(F.lit(1))
    parts = []
    for value, share in enumerate(expected):
        parts.append(_term(_floored(F.lit(share)),
                           _floored(F.count_if(F.col(label) == value) / n)))
    return scored.groupBy(*by).agg(F.round(parts[0] + parts[1], dp).alias("psi"))
