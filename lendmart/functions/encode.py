"""Feature encodings as Column expressions built from small fitted values."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from lendmart import constants as K


def bin_label(c: Column, limits, labels, null_bin: str | None = None) -> Column:
    """Label of the first bin whose upper limit exceeds the value.

    A missing value falls into the open top bin unless ``null_bin`` names another.
    """
    out = F.when(c.isNull(), F.lit(null_bin)) if null_bin is not None else F
    for limit, label in zip(limits, labels):
        out = out.when(c < F.lit(limit), F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def ordinal(c: Column, codes: dict[str, int]) -> Column:
    out = F
    for value, code in codes.items():
        out = out.when(c == value, F.lit(code))
    return out.otherwise(F.lit(None)).cast("int")


def known_flag(code: Column, unknown_code: int = K.CREDIT_MIX_CODES[K.UNKNOWN]) -> Column:
    """0 only for the code of 'Unknown'; a missing code counts as known."""
    return F.when(code == unknown_code, F.lit(0)).otherwise(F.lit(1))


def one_hot(column: str, values) -> dict[str, Column]:
    return {f"{column}_{v}": F.when(F.col(column) == v, 1).otherwise(0) for v in values}


def multi_hot(column: str, values, prefix: str = "Loan_") -> dict[str, Column]:
    """One flag per list item, by substring test on the raw list."""
    return {prefix + re.sub(r"[ -]", "_", v):
            F.when(F.col(column).contains(v), 1).otherwise(0) for v in values}


def safe_name(name: str) -> str:
    return re.sub(r"[\[\]<>(),]", "_", name)


def hash32(key: Column, seed) -> Column:
    """First 32 bits of md5(key|seed), as a non-negative long."""
    digest = F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def uniform(key: Column, seed) -> Column:
    """A draw in [0, 1) that is the same on every run and every retry."""
    return hash32(key, seed) / F.lit(4294967296.0)


def draw_category(key: Column, seed, counts: dict[str, int]) -> Column:
    """Draw a category in proportion to its count, by inverse cumulative share."""
    if not counts:
        return F.lit(None).cast("string")
    u, total, below, out = uniform(key, seed), sum(counts.values()), 0, F
    names = sorted(counts)
    for name in names[:-1]:
        below += counts[name]
        out = out.when(u < F.lit(below / total), F.lit(name))
    return out.otherwise(F.lit(names[-1])) if len(names) > 1 else F.lit(names[0])
