"""Benchmark decontamination by winnowing.

Words are runs of ASCII letters and digits or any character beyond ASCII, ASCII lower
case. A window is ``span`` consecutive words of an item, or the whole item if it is
shorter. The smallest k-gram hash of every ``span - k + 1`` consecutive k-grams is kept
as a fingerprint of a text, so two texts that share ``span`` words share a fingerprint:
no window is missed. Documents that share fingerprints with the benchmark are extended to
the exact windows. Items shorter than ``span`` are compared by all their word sequences of
that length.

Null or wordless texts have no words and are clean; null or wordless items have no
windows. Rows equal in id and text get equal results. Items with a null id are found but
not listed. Input columns pass through; one with the name of a result is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lendmart.llm.common import carried, keyed, lower_ascii, packed, same_key, table, unpacked, whole
from lendmart.sources.snapshots import stage

SPAN, K = 10, 5
#: What separates words (fixed by the word pattern: everything ASCII but 0-9 and a-z).
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(whole(text)), SEPARATOR), "")


def _grams(hashes: str, k: int) -> Column:
    """Hash of every k consecutive elements of a column of word hashes; empty if fewer."""
    h = F.col(hashes)
    every = F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, k)]))
    return F.when(F.size(h) >= k, F.slice(every, F.lit(1), F.greatest(F.size(h) - (k - 1),
                                                                     F.lit(0)))
                  ).otherwise(F.array().cast("array<bigint>"))


def _winnowed(grams: str, window: int) -> Column:
    """Smallest of every ``window`` consecutive k-gram hashes, each once."""
    g = F.col(grams)
    least = F.transform(g, lambda x, i: F.least(x, *[F.get(g, i + j) for j in range(1, window)]))
    return F.when(F.size(g) >= window, F.array_distinct(
        F.slice(least, F.lit(1), F.greatest(F.size(g) - (window - 1), F.lit(0))))
                  ).otherwise(F.array().cast("array<bigint>"))


def _hashed(texts: DataFrame, *keep: str) -> DataFrame:
    """Word hashes ``h`` of the column ``text``."""
    split = texts.select(*keep, words(F.col("text")).alias("w"))
    return split.select(*keep, F.transform("w", lambda w: F.xxhash64(w)).alias("h"))


def fingerprints(texts: DataFrame, *keep: str, span: int = SPAN, k: int = K) -> DataFrame:
    """Winnowing fingerprints ``f`` of the column ``text``, one row for each."""
    grams = _hashed(texts, *keep).select(*keep, _grams("h", k).alias("g"))
    return grams.select(*keep, F.explode(_winnowed("g", span - k + 1)).alias("f"))


def _windows(texts: DataFrame, length: int, *keep: str) -> DataFrame:
    return _hashed(texts, *keep).select(*keep, F.posexplode(_grams("h", length))
                                        .alias("at", "g"))


def _covered(starts: Column) -> Column:
    """Words inside any of the windows {at, len}, sorted by start."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def add(done, w):
        end = F.greatest(done["end"], w["at"] + w["len"])
        return F.struct((done["n"] + end - F.greatest(done["end"], w["at"])).alias("n"),
                        end.alias("end"))

    return F.aggregate(starts, zero, add, lambda done: done["n"].cast("long"))


def occurrences(docs: DataFrame, items: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    """Windows of ``items`` (item, text) found in ``docs`` (d, t, text): one row per
    document and place, with the items that have that window."""
    lengths = items.select(F.size(words(F.col("text"))).alias("n")).distinct()
    short = sorted(r["n"] for r in lengths.filter(F.col("n").between(1, span - 1))
                   .collect())  # at most span - 1 numbers
    out = None
    for length in [span, *short]:
        count = F.size(words(F.col("text")))
        own = items.filter(count >= span if length == span else count == length)
        if length == span:
            marks = fingerprints(own, span=span, k=k).distinct()
            found = fingerprints(docs, "d", "t", span=span, k=k)
        else:
            marks = _windows(own, length).select(F.col("g").alias("f")).distinct()
            found = _hashed(docs, "d", "t").select(
                "d", "t", F.explode(F.array_distinct(_grams("h", length))).alias("f"))
        touched = stage(found.join(marks, "f", "left_semi").select("d", "t").distinct())
        near = docs.join(touched, same_key(docs, touched), "left_semi")
        windows = _windows(own, length, "item").groupBy("g").agg(
            F.collect_set(F.col("item").cast("string")).alias("items"))
        placed = _windows(near, length, "d", "t").join(windows, "g").select(
            "d", "t", "at", F.lit(length).alias("len"), "items")
        out = placed if out is None else out.unionByName(placed)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id",
                  text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  span: int = SPAN, k: int = K) -> DataFrame:
    """The documents with n_words, n_hit, items (sorted ids as text) and contaminated."""
    items = benchmark.select(F.col(item_id).alias("item"), whole(item_text).alias("text"))
    found = occurrences(keyed(docs, doc_id, text), items, span, k)
    hits = stage(found.groupBy("d", "t").agg(
        _covered(F.sort_array(F.collect_set(F.struct("at", "len")))).alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")))
    rows = packed(docs, doc_id, text).withColumn(
        "n_words", F.size(words(F.col("text"))).cast("long"))
    joined = rows.join(hits, same_key(rows, hits), "left").select(
        *carried(docs), "n_words", "n_hit", "items")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return unpacked(joined, docs.columns, n_words=F.col("n_words"), n_hit=n_hit,
                    items=F.coalesce("items", F.array().cast("array<string>")),
                    contaminated=n_hit > 0)


def op9_winnowing(spark, sf_dir: str) -> DataFrame:
    out = decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"),
                        table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit",
                      F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      "contaminated")
