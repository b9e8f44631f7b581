"""As-of joins: each row with the last row of another table up to its own time.

Only keys and times are ordered, never the wide rows. Both sides' distinct (key, time)
pairs are put together and sorted within a key and a block of time; the last time of the
right side is carried forward. What a block inherits from earlier ones comes from one row
per key and block. So a key with a third of all rows is dealt out by its blocks, and the
rows themselves meet in two equi-joins, which adaptive execution splits where they are
skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

BLOCK = "year"


def asof_times(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
               block: str = BLOCK) -> DataFrame:
    """(key, left_time, __seen): for each key and time of the left side that has one, the
    last time of the right side up to it."""
    seen = right.select(F.col(key).alias("__key"), F.col(right_time).alias("__time"),
                        F.col(right_time).alias("__seen"), F.lit(False).alias("__asks"))
    asked = left.select(F.col(key).alias("__key"), F.col(left_time).alias("__time"))
    asked = asked.withColumns({"__seen": F.lit(None).cast(seen.schema["__seen"].dataType),
                               "__asks": F.lit(True)})
    both = seen.unionByName(asked).filter("__key IS NOT NULL AND __time IS NOT NULL").distinct() \
        .withColumn("__block", F.date_trunc(block, "__time"))
    inside = Window.partitionBy("__key", "__block").orderBy("__time", "__asks").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("__key").orderBy("__block").rowsBetween(
        Window.unboundedPreceding, -1)
    # one row per key and block, so a key's are as many as the calendar's
    inherited = both.groupBy("__key", "__block").agg(F.max("__seen").alias("__last")).select(
        "__key", "__block", F.max("__last").over(earlier).alias("__before"))
    placed = both.withColumn("__here", F.max("__seen").over(inside)).filter("__asks")
    return placed.join(inherited, ["__key", "__block"]).select(
        F.col("__key").alias(key), F.col("__time").alias(left_time),
        F.coalesce("__here", "__before").alias("__seen")).filter("__seen IS NOT NULL")


def asof_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
              block: str = BLOCK) -> DataFrame:
    """Left rows with the columns of the right side's last row up to their time, null where
    there is none. The right side has one row per key and time. A column of the right side
    that the left one has too, other than the key, is an error."""
    clash = set(left.columns) & set(right.columns) - {key}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    times = asof_times(left, right, key, left_time, right_time, block)
    found = left.join(times, [key, left_time], "left")
    other = right.withColumnsRenamed({key: "__key"})
    return found.join(other, (found[key] == other["__key"])
                      & (found["__seen"] == other[right_time]), "left").select(
        *left.columns, *[c for c in right.columns if c != key])
