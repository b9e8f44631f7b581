"""Exact ranks and quantiles without putting a group into one task.

A rank needs a global order. Instead of one window over all rows, values are cut
into pieces of roughly equal row counts: approximate quantiles serve as cut
points (any cut points give exact results, good ones give even pieces, whatever
the distribution). Equal values are counted together before anything is shuffled,
so a value that holds a third of all rows is one row per map task. Running counts
then come in two levels: inside a piece, and over the piece totals.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window, functions as F

from lendmart.sources.snapshots import small_table

SKETCH_POINTS = 64
MAX_QUANTILE_PIECES = 1024
REFINEMENTS = 4  # passes at most; each makes pieces up to SKETCH_POINTS times finer


def default_pieces(spark: SparkSession) -> int:
    """Twice the session's shuffle partitions, so that the pieces occupy the cluster."""
    return max(16, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))


def sketch(df: DataFrame, columns: Sequence[str],
           grid: int = SKETCH_POINTS) -> dict[str, list[float]]:
    """Approximate quantiles of each column, ascending; every one of them occurs in the
    data, and one that is repeated holds about so many of the grid's shares.

    One column-pruned pass; the sketches are small (``grid`` points at a tenth of
    their spacing), so merging those of very many tasks stays cheap.
    """
    row = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)]).agg(
        *[_grid(f"c{i}", grid).alias(f"c{i}") for i in range(len(columns))]).first()
    return {c: sorted(v for v in (row[i] or []) if math.isfinite(v))
            for i, c in enumerate(columns)}


def _grid(column: str, grid: int) -> Column:
    steps = ", ".join(str(i / grid) for i in range(1, grid))
    return F.expr(f"percentile_approx({column}, array({steps}), {grid * 10})")


def _apart(values: Sequence[float]) -> set[float]:
    """Cut points at the values; a repeated one is in a piece of its own."""
    ends = {math.nextafter(a, math.inf) for a, b in zip(values, values[1:]) if a == b}
    return {x for x in {*values, *ends} if math.isfinite(x)}


def _counts(rows: DataFrame) -> list[Row]:
    """Rows per column and piece, and whether the piece has more than one value."""
    return rows.groupBy("column", "piece").agg(
        F.count(F.lit(1)).alias("n"), (F.min("value") < F.max("value")).alias("mixed")).collect()


def _held(pieces: Sequence[tuple[str, int]]) -> Column:
    found: dict[str, set[int]] = {}
    for column, piece in pieces:
        found.setdefault(column, set()).add(piece)
    out = F.lit(False)
    for column, own in found.items():
        out = out | ((F.col("column") == column) & F.col("piece").isin(sorted(own)))
    return out


def refine(df: DataFrame, columns: Sequence[str], start: dict[str, list[float]],
           pieces: int) -> tuple[dict[str, list[float]], list[Row] | None]:
    """Cut points that are even however many pieces are asked for, from a sketch's, and the
    pieces' row counts where they are known.

    A sketch alone is no finer than its grid, at the ends of the range least of all. So rows
    are counted per piece, and the pieces that hold more than twice their share get sketches
    of their own, all in one pass over their rows. Values that hold a share by themselves
    stand apart in a piece that needs no order inside, and do not count for the shares of
    the others. One counter per piece and a sketch per large piece are all that is shuffled.
    """
    points = {c: sorted(_apart(start[c])) for c in columns}
    if all(len(start[c]) + 1 >= pieces for c in columns):
        return points, None
    for _ in range(REFINEMENTS):
        rows = long_form(df, points)
        counts = _counts(rows)
        share = {c: sum(r["n"] for r in counts if r["column"] == c and r["mixed"]) / pieces
                 for c in columns}
        large = {(r["column"], r["piece"]): r["n"] / share[r["column"]] for r in counts
                 if r["mixed"] and r["n"] > max(1, 2 * share[r["column"]])}
        if not large:
            return points, counts
        finer = rows.filter(_held(list(large))).groupBy("column", "piece").agg(
            _grid("value", SKETCH_POINTS).alias("found")).collect()
        for r in finer:
            found, parts = sorted(r["found"]), math.ceil(large[r["column"], r["piece"]])
            # as many of the grid's values as there are shares, and the repeated ones
            chosen = {found[min(len(found) - 1, SKETCH_POINTS * i // parts)]
                      for i in range(1, min(parts, SKETCH_POINTS))}
            repeated = [x for pair in zip(found, found[1:]) if pair[0] == pair[1] for x in pair]
            points[r["column"]] = sorted({*points[r["column"]], *chosen, *_apart(repeated)})
    return points, None


def cut_points(df: DataFrame, columns: Sequence[str],
               pieces: int | None = None) -> dict[str, list[float]]:
    """Strictly increasing inner cut points per column, for pieces of about equal row
    counts with frequent values apart. Only these doubles reach the driver."""
    pieces = pieces or default_pieces(df.sparkSession)
    return refine(df, columns, sketch(df, columns, min(SKETCH_POINTS, pieces)), pieces)[0]


def place(df: DataFrame, points: dict[str, Sequence[float]], prefix: str = "__p_") -> DataFrame:
    """Adds for every column the number of its cut points <= value, found by binary
    search in the JVM; null stays null."""
    cut = [c for c, p in points.items() if p]
    out = df
    if cut:
        out = out.select("*", *[F.col(c).cast("double").alias(f"__in_{i}")
                                for i, c in enumerate(cut)])
        out = Bucketizer(
            splitsArray=[[-math.inf, *points[c], math.inf] for c in cut],
            inputCols=[f"__in_{i}" for i in range(len(cut))],
            outputCols=[f"__at_{i}" for i in range(len(cut))],
            handleInvalid="keep").transform(out)
    found = {c: F.col(f"__at_{i}").cast("int") for i, c in enumerate(cut)}
    return out.select(*df.columns, *[
        F.when(F.col(c).isNotNull(), found.get(c, F.lit(0))).alias(prefix + c) for c in points])


def long_form(df: DataFrame, points: dict[str, list[float]]) -> DataFrame:
    """(column, piece, value) of numeric columns, without nulls and NaNs."""
    wide = place(df.select(*[F.col(c).cast("double").alias(c) for c in points]), points)
    entries = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"__p_{c}").alias("piece"),
                 F.col(c).alias("value")) for c in points])
    return (wide.select(F.explode(entries).alias("e")).select("e.*")
            .filter(F.col("value").isNotNull() & ~F.isnan("value")))


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
              method: str = "disc", points: dict[str, list[float]] | None = None) -> DataFrame:
    """Exact quantiles of each column: rows (column, prob, value).

    ``disc`` is the smallest value whose cumulative share reaches the probability;
    ``cont`` interpolates linearly between the two neighbouring values. Columns
    without any value are absent.

    Three column-pruned passes: cut points, row counts per piece (all that is shuffled
    is one counter per piece), and the exact order inside the few pieces that hold a
    wanted rank. ``points`` are cut points, where they are known already.
    """
    if method not in ("disc", "cont"):
        raise ValueError(f"unknown method {method!r}")
    counts = None
    if points is None:
        pieces = min(MAX_QUANTILE_PIECES, default_pieces(df.sparkSession))
        points, counts = refine(df, columns, sketch(df, columns, min(SKETCH_POINTS, pieces)),
                                pieces)
    rows = long_form(df, points)
    targets = _wanted_ranks(counts if counts is not None else _counts(rows), probs, method)
    wanted = small_table(
        df.sparkSession, targets, "column string, piece int, prob double, part double, rank long")
    is_held = _held([t[:2] for t in targets])

    inside = Window.partitionBy("column", "piece").orderBy("value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ordered = (rows.filter(is_held)
               .groupBy("column", "piece", "value").agg(F.count(F.lit(1)).alias("n"))
               .withColumn("upto", F.sum("n").over(inside)))
    # at most 2 x columns x probabilities targets, hence the broadcast
    hits = (ordered.join(F.broadcast(wanted), ["column", "piece"])
            .filter((F.col("rank") <= F.col("upto"))
                    & (F.col("rank") > F.col("upto") - F.col("n"))))
    lo, hi = F.min("value"), F.max("value")
    return hits.groupBy("column", "prob").agg(
        (lo + (hi - lo) * F.max("part")).alias("value"))


def _wanted_ranks(counts, probs, method) -> list[tuple]:
    """(column, piece, prob, part, rank inside the piece) of the wanted rows, from the
    piece counts."""
    sizes: dict[str, list[tuple[int, int]]] = {}
    for r in sorted(counts, key=lambda r: (r["column"], r["piece"])):
        sizes.setdefault(r["column"], []).append((r["piece"], r["n"]))
    out = []
    for column, ordered in sizes.items():
        total = sum(n for _, n in ordered)
        for p in map(float, probs):
            at = p * (total - 1)
            ranks = ({max(math.ceil(p * total), 1)} if method == "disc"
                     else {math.floor(at) + 1, math.ceil(at) + 1})
            part = at - math.floor(at) if method == "cont" else 0.0
            before = 0
            for piece, n in ordered:
                out += [(column, piece, p, part, k - before) for k in sorted(ranks)
                        if before < k <= before + n]
                before += n
    return out


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact lower median of each column: rows (column, median)."""
    return (quantiles(df, columns, [0.5], "disc")
            .select("column", F.col("value").alias("median")))
