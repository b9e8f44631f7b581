"""Time-aware and stratified splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, LongType

from lendmart import constants as K
from lendmart.functions.encode import hash32
from lendmart.sources.snapshots import small_table

_PIECE_BITS = 16
MAX_LABELS = 1000


def oot_split(df: DataFrame, date: str = "label_date", k: int = K.OOT_MONTHS) -> DataFrame:
    """Adds ``is_oot``: whether the row lies in the last k months present.

    The k dates are the only rows joined back, hence the broadcast.
    """
    last = (df.select(F.col(date).alias("__month")).filter("__month is not null").distinct()
            .orderBy(F.col("__month").desc()).limit(k))
    return (df.join(F.broadcast(last), df[date] == last["__month"], "left")
            .withColumn("is_oot", F.col("__month").isNotNull()).drop("__month"))


def _percent_ends(percent: dict[str, int] | None):
    """Ends of consecutive quotas, each a rounded-down percentage of the total."""
    def ends(total: Column) -> list[Column]:
        out, running = [], F.lit(0)
        for p in list((percent or K.SPLIT_PERCENT).values())[:-1]:
            running = running + F.floor(total * p / 100)
            out.append(running)
        return out
    return ends


def _even_ends(parts: int):
    """Ends of parts whose sizes differ by one at most."""
    return lambda total: [F.floor(total * i / parts) for i in range(1, parts)]


def quota_cuts(df: DataFrame, key: str = K.CUSTOMER, label: str = "label",
               seed: int = K.SPLIT_SEED, percent: dict[str, int] | None = None,
               quotas=None) -> dict:
    """Where each quota ends: label -> [(hash, key) of the last key of each split but
    the last], None for an empty split. ``quotas`` makes the ends of a total.

    Two narrow passes over (label, key): rows per label and hash piece, then the exact
    order of the keys inside the few pieces in which a quota ends. Neither a label nor
    a key that holds most of the rows is ever collected in one task.
    """
    ids = df.filter(F.col(label).isNotNull()).select(
        F.col(label).alias("l"), F.col(key).alias("k"), hash32(F.col(key), seed).alias("h"))
    placed = ids.withColumn("piece", F.shiftright("h", 32 - _PIECE_BITS))

    # at most 2^16 rows per label
    along = Window.partitionBy("l").orderBy("piece").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    totals = (placed.groupBy("l", "piece").agg(F.count(F.lit(1)).alias("n"))
              .withColumns({"upto": F.sum("n").over(along),
                            "total": F.sum("n").over(Window.partitionBy("l"))}))
    shares = (quotas or _percent_ends(percent))(F.col("total"))
    ends = [F.struct(F.lit(i).alias("cut"), end.alias("end")) for i, end in enumerate(shares)]
    found = (totals.withColumn("e", F.explode(F.array(*ends)))
             .filter((F.col("e.end") > F.col("upto") - F.col("n"))
                     & (F.col("e.end") <= F.col("upto")))
             .select("l", "piece", F.col("e.cut").alias("cut"),
                     (F.col("e.end") - F.col("upto") + F.col("n")).alias("inner_end"))
             .limit(MAX_LABELS * len(shares) + 1).collect())
    if len(found) > MAX_LABELS * len(shares):
        raise ValueError(f"more than {MAX_LABELS} labels")
    # the limit above bounds the targets, hence the broadcast
    targets = F.broadcast(small_table(
        df.sparkSession, found, ids.select("l").schema.add("piece", LongType()).add("cut", IntegerType())
        .add("inner_end", LongType())))

    inside = Window.partitionBy("l", "piece").orderBy("h", "k").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ordered = (placed.filter(F.col("piece").isin(sorted({r["piece"] for r in found})))
               .groupBy("l", "piece", "h", "k").agg(F.count(F.lit(1)).alias("n"))
               .withColumn("upto", F.sum("n").over(inside)))
    hits = (ordered.join(targets, ["l", "piece"])
            .filter((F.col("inner_end") <= F.col("upto"))
                    & (F.col("inner_end") > F.col("upto") - F.col("n"))))
    out = {}
    for r in hits.select("l", "cut", "h", "k").collect():
        out.setdefault(r["l"], [None] * len(shares))[r["cut"]] = (r["h"], r["k"])
    return out


def stratified_split(df: DataFrame, key: str = K.CUSTOMER, label: str = "label",
                     seed: int = K.SPLIT_SEED, percent: dict[str, int] | None = None,
                     out: str = "split") -> DataFrame:
    """Adds ``split`` with exact quotas per label, in a fixed pseudo-random order.

    Keys are ordered by (hash, key). Of n rows of a label the first
    floor(n * percent / 100) go to the first split, and so on; the last split takes
    the rest. The rows themselves are neither ranked nor shuffled nor joined: each
    compares itself with the cuts, which are literals. All rows of one key and label
    land in the same split.
    """
    return _assigned(df, quota_cuts(df, key, label, seed, percent), key, label, seed,
                     list(percent or K.SPLIT_PERCENT), out)


def _assigned(df: DataFrame, cuts: dict, key: str, label: str, seed: int, names: list,
              out: str) -> DataFrame:
    h, k = F.col("__h"), F.col(key)
    choice = F.when(F.lit(False), F.lit(names[-1]))
    for value, ends in sorted(cuts.items()):
        for name, end in zip(names, ends):
            if end is not None:
                upto = (h < end[0]) | ((h == end[0]) & (k <= F.lit(end[1])))
                choice = choice.when((F.col(label) == value) & upto, F.lit(name))
    hashed = df.withColumn("__h", hash32(F.col(key), seed))
    return hashed.withColumn(out, choice.otherwise(F.lit(names[-1]))).drop("__h")


def cv_folds(df: DataFrame, folds: int = 3, key: str = K.CUSTOMER, label: str = "label",
             seed: int = K.SPLIT_SEED + 1, out: str = "fold") -> DataFrame:
    """Adds ``fold``, 0 to folds - 1: within each label the keys in the order of a hash, cut
    into parts whose sizes differ by one at most. Membership depends on the keys alone, not
    on how rows are dealt, so a repeated search compares the same folds; the order is
    another than the split's."""
    cuts = quota_cuts(df, key, label, seed, quotas=_even_ends(folds))
    return _assigned(df, cuts, key, label, seed, list(range(folds)), out)


def split_sets(df: DataFrame, key: str = K.CUSTOMER, label: str = "label",
               date: str = "label_date", seed: int = K.SPLIT_SEED) -> DataFrame:
    """Adds ``split``: the last two months are 'oot', the others are split 80/10/10
    within each label."""
    marked = oot_split(df, date)
    rest = stratified_split(marked.filter(~F.col("is_oot")), key, label, seed)
    oot = marked.filter(F.col("is_oot")).withColumn("split", F.lit("oot"))
    return rest.unionByName(oot).drop("is_oot")
