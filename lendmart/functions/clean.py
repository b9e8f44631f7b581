"""Cleansing rules as Column expressions: all JVM-side, none of them raises on a
bad value whatever the session's ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lendmart import constants as K


def strip_chars(c: Column, chars: str = "_") -> Column:
    return F.translate(c, chars, "")


def try_int(text: Column) -> Column:
    """Integer text; a decimal tail is cut off, anything else is null."""
    whole = F.substring_index(F.trim(text), ".", 1).try_cast("int")
    return F.when(text.try_cast("double").isNotNull(), whole)


def range_guard(c: Column, lo=None, hi=None) -> Column:
    """Keep a value inside [lo, hi]; an open side lets everything pass."""
    keep = c.isNotNull()
    if lo is not None:
        keep = keep & (c >= F.lit(lo))
    if hi is not None:
        keep = keep & (c <= F.lit(hi))
    return F.when(keep, c)


def drop_tokens(c: Column, tokens) -> Column:
    return F.when(c.isin(list(tokens)), F.lit(None)).otherwise(c)


def clean_number(c: Column, strip: str = "", lo=None, hi=None, null_tokens=(),
                 dp: int | None = None, to: str = "int") -> Column:
    """Text to number: sentinel tokens to null, junk characters out, lenient cast,
    range guard, rounding."""
    text = c.cast("string")
    if null_tokens:
        text = drop_tokens(text, null_tokens)
    if strip:
        text = strip_chars(text, strip)
    number = try_int(text) if to == "int" else text.try_cast(to)
    number = range_guard(number, lo, hi)
    return F.round(number, dp) if dp is not None else number


def conform(c: Column, pattern: str, fill: str = K.UNKNOWN, invert: bool = False,
            fill_null: bool = True) -> Column:
    """Replace a value that does not match (``invert``: that does match) by ``fill``."""
    hit = c.rlike(pattern)
    bad = hit if invert else ~hit
    if fill_null:
        bad = bad | c.isNull()
    return F.when(bad, F.lit(fill)).otherwise(c)


def fill_sentinel(c: Column, tokens, fill: str = K.UNKNOWN, fill_null: bool = True) -> Column:
    bad = c.isin(list(tokens)) if tokens else F.lit(False)
    if fill_null:
        bad = c.isNull() | bad
    return F.when(bad, F.lit(fill)).otherwise(c)


def income_flag(monthly_salary: Column, annual_income: Column) -> Column:
    """Twelve salaries above the stated income; null when either is missing."""
    return monthly_salary * F.lit(12) > annual_income


def delay_flag(delay_days: Column, delayed_payments: Column) -> Column:
    """Delay days and delayed payments contradict each other; missing is no contradiction."""
    clash = (((delay_days > 0) & (delayed_payments == 0))
             | ((delay_days == 0) & (delayed_payments > 0)))
    return F.coalesce(clash, F.lit(False))


def list_size(c: Column, sep: str = ",") -> Column:
    return F.when(c.isNull(), F.lit(0)).otherwise(F.size(F.split(c, sep))).cast("int")


def duration_months(c: Column) -> Column:
    """'x Years and y Months' to months; a missing part counts 0, null stays null."""
    def part(pattern):
        return F.coalesce(F.regexp_extract(c, pattern, 1).try_cast("int"), F.lit(0))
    return F.when(c.isNotNull(),
                  part(K.YEARS_PATTERN) * 12 + part(K.MONTHS_PATTERN)).cast("int")


def split_code(c: Column, pattern: str) -> Column:
    """First group of the pattern; empty text when it does not match."""
    return F.regexp_extract(c, pattern, 1)
