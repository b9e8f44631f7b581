"""Helpers shared by the text operators.

An operator never trusts ``doc_id`` to be unique or present: rows meet again on
``(doc_id, hash of the text)``, compared null-safely. Rows that agree on both are the
same document to it and get the same answer.
"""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(column) -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def lower_ascii(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as empty text."""
    return F.crc32(whole(F.col(doc_id).cast("string"))) % divisor


def keyed(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the row's key and text: ``d`` (id), ``t`` (hash of the text), ``text``."""
    return df.select(F.col(doc_id).alias("d"), F.xxhash64(whole(text)).alias("t"),
                     whole(text).alias("text"))


def packed(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The input columns renamed ``c0``, ``c1``... beside ``d``, ``t`` and ``text``, so
    that input columns of any name cannot clash with an operator's own."""
    return df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)],
                     F.col(doc_id).alias("d"), F.xxhash64(whole(text)).alias("t"),
                     whole(text).alias("text"))


def carried(df: DataFrame) -> list[str]:
    """The names that the input's columns have in ``packed``."""
    return [f"c{i}" for i in range(len(df.columns))]


def unpacked(rows: DataFrame, names: list[str], **computed: Column) -> DataFrame:
    """Input columns under their own names again. A computed column replaces an input
    column of its name, in its place; the others follow."""
    kept = [computed[c].alias(c) if c in computed else F.col(f"c{i}").alias(c)
            for i, c in enumerate(names)]
    return rows.select(*kept, *[v.alias(k) for k, v in computed.items() if k not in names])


def same_key(left: DataFrame, right: DataFrame) -> Column:
    return (left["t"] == right["t"]) & left["d"].eqNullSafe(right["d"])


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of frames that are no longer referenced, which
    it does when the driver collects its garbage. Called between an operator's phases."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
