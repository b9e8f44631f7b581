"""Moving averages as a state that months are added to.

From its first value on, a stretch of a key's rows turns the average ``y`` that was there
into ``decay * y + offset``: an affine map. Maps of neighbouring stretches compose, so a
stretch is kept as one small struct and never read again::

    n       rows
    lead    rows before the first value; null if no row has a value
    first   the first value
    decay, offset   what the rows after the first value do to the average at it
    trail   rows after the last value

Between two stretches the first value of the later one meets the average of the earlier
one, whose weight has decayed over ``trail + lead + 1`` rows; that step is an affine map of
the average too. Composition is associative, so stretches may be days, months or years, may
be merged in any grouping, and a late month costs its own rows and the structs after it.

A state table has one row per key and a struct per column. The average itself is
``decay * first + offset``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lendmart import constants as K

PREFIX = "map_"
_KIND = "struct<n:bigint,lead:bigint,first:double,decay:double,offset:double,trail:bigint>"


def _map(n, lead, first, decay, offset, trail) -> Column:
    return F.struct(n.alias("n"), lead.alias("lead"), first.alias("first"), decay.alias("decay"),
                    offset.alias("offset"), trail.alias("trail")).cast(_KIND)


def _one(value: Column) -> Column:
    """The map of a single row."""
    known = value.isNotNull()
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    return _map(one, F.when(known, zero), value, F.lit(1.0), F.lit(0.0), F.when(known, zero))


def compose(a: Column, b: Column, alpha: float) -> Column:
    """The map of stretch ``a`` followed by ``b``; a null stretch has no rows."""
    weight = F.pow(F.lit(1.0 - alpha), a["trail"] + b["lead"] + 1)
    keep = weight / (weight + F.lit(alpha))
    gain = F.lit(alpha) * b["first"] / (weight + F.lit(alpha))
    n = a["n"] + b["n"]
    both = _map(n, a["lead"], a["first"], b["decay"] * keep * a["decay"],
                b["decay"] * (keep * a["offset"] + gain) + b["offset"], b["trail"])
    late = _map(n, a["n"] + b["lead"], b["first"], b["decay"], b["offset"], b["trail"])
    quiet = _map(n, a["lead"], a["first"], a["decay"], a["offset"], a["trail"] + b["n"])
    return (F.when(a.isNull(), b).when(b.isNull(), a)
            .when(a["lead"].isNull() & b["lead"].isNotNull(), late)
            .when(b["lead"].isNull(), quiet).otherwise(both))


def _columns(state: DataFrame) -> list[str]:
    return [c for c in state.columns if c.startswith(PREFIX)]


def _folded(rows: Column, take, alpha: float) -> Column:
    """Composition of the maps that ``take`` makes of a sorted array's entries."""
    return F.aggregate(rows, F.lit(None).cast(_KIND),
                       lambda s, r: compose(s, take(r), alpha).cast(_KIND))


def summarise(panel: DataFrame, columns: Sequence[str], key: str = K.CUSTOMER,
              time: str = K.SNAPSHOT, alpha: float = K.EMA_ALPHA) -> DataFrame:
    """The maps of each key's rows: one row per key, whatever stretch of time the panel
    holds. A key has one row per time, so its rows are bounded by the stretch."""
    rows = F.struct(F.col(time).alias("t"),
                    *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    grouped = panel.groupBy(key).agg(F.array_sort(F.collect_list(rows)).alias("__h"))
    return grouped.select(key, *[
        _folded(F.col("__h"), lambda r, i=i: _one(r[f"x{i}"]), alpha).alias(PREFIX + c)
        for i, c in enumerate(columns)])


def advance(state: DataFrame, later: DataFrame, key: str = K.CUSTOMER,
            alpha: float = K.EMA_ALPHA) -> DataFrame:
    """The state after a later stretch. Both sides have one row per key."""
    names = _columns(later)
    old = state.select(key, *[F.col(c).alias(f"__{c}") for c in names])
    return old.join(later, key, "full_outer").select(
        key, *[compose(F.col(f"__{c}"), F.col(c), alpha).alias(c) for c in names])


def merge(stretches: DataFrame, order: str, key: str = K.CUSTOMER,
          alpha: float = K.EMA_ALPHA) -> DataFrame:
    """One state from the summaries of many stretches, in the order of a column: what a
    rebuild costs when no state is left, one struct per key and stretch."""
    names = _columns(stretches)
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("t"), *names)))
    grouped = stretches.groupBy(key).agg(rows.alias("__h"))
    return grouped.select(key, *[
        _folded(F.col("__h"), lambda r, c=c: r[c], alpha).alias(c) for c in names])


def averages(state: DataFrame, key: str = K.CUSTOMER, prefix: str = "ema_") -> DataFrame:
    """Each key's average after its last row; null without a value."""
    def value(c):
        m = F.col(c)
        return (m["decay"] * m["first"] + m["offset"]).alias(prefix + c.removeprefix(PREFIX))

    return state.select(key, *map(value, _columns(state)))
