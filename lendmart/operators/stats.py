"""Counts, shares and vocabularies of categorical columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lendmart import constants as K

MAX_CATEGORIES = 1000


class TooManyCategories(ValueError):
    """A column treated as categorical has more values than can become columns."""


def group_counts(df: DataFrame, by: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def vocabulary(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values of a column: (value)."""
    return df.select(F.col(column).alias("value")).filter("value is not null").distinct()


def list_items(c: Column) -> Column:
    """Items of 'A, B, and C' without the leading 'and '."""
    return F.transform(F.split(c, ", "),
                       lambda item: F.when(item.startswith("and "), F.substring(item, 5, 1 << 30))
                       .otherwise(item))


def list_vocabulary(df: DataFrame, column: str, drop=(K.UNKNOWN,)) -> DataFrame:
    """Distinct list items of a column: (value)."""
    items = df.select(F.explode(list_items(F.col(column))).alias("value")).distinct()
    return items.filter(~F.col("value").isin(list(drop)))


def shares(df: DataFrame, column: str, drop=(K.UNKNOWN, "")) -> DataFrame:
    """Counts and shares of the known categories: (value, n, share).

    The total comes as a scalar subquery over the counts, not from a window that
    would put all categories into one task.
    """
    known = df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(drop)))
    counts = known.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = known.agg(F.count(F.lit(1)).alias("total")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def category_counts(df: DataFrame, single: Sequence[str], lists: Sequence[str] = ()) -> DataFrame:
    """(column, value, n) for several categorical columns in one pass."""
    entries = [F.array(F.struct(F.lit(c).alias("column"), F.col(c).alias("value")))
               for c in single]
    def tagged(c):
        items = F.coalesce(list_items(F.col(c)), F.array().cast("array<string>"))
        return F.transform(items, lambda item: F.struct(F.lit(c).alias("column"),
                                                        item.alias("value")))
    entries += [tagged(c) for c in lists]
    return (df.select(F.explode(F.concat(*entries)).alias("e")).select("e.*")
            .filter("value is not null")
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))


def collect_categories(counts: DataFrame, limit: int = MAX_CATEGORIES) -> dict[str, dict[str, int]]:
    """Category counts as driver values: column -> value -> n.

    Only for columns whose values become columns or codes. More than ``limit``
    values in all is an error, never a cut.
    """
    rows = counts.limit(limit + 1).collect()
    if len(rows) > limit:
        raise TooManyCategories(f"more than {limit} category values")
    out: dict[str, dict[str, int]] = {}
    for r in sorted(rows, key=lambda r: (r["column"], r["value"])):
        out.setdefault(r["column"], {})[r["value"]] = r["n"]
    return out


def label_mix(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Shares of label 0 and 1: (by..., n, share_0, share_1)."""
    n = F.count(F.lit(1))
    return df.groupBy(*by).agg(
        n.alias("n"),
        (F.count_if(F.col(label) == 0) / n).alias("share_0"),
        (F.count_if(F.col(label) == 1) / n).alias("share_1"))


def split_stats(df: DataFrame, split: str = "split", label: str = "label") -> DataFrame:
    """Rows and label rate of each split."""
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col(label).cast("double")).alias("label_rate"))
