"""Line dedup by a tree of log templates.

A line's path in the tree has a fixed depth: its number of tokens, then its leading
tokens. Tokens with a digit are variable from the start. Within a leaf, a token is
constant at its place if enough documents have it there, and not far fewer than have the
line's solid tokens: as many of its most frequent ones as a template needs. So a field's
values stay fields however often each recurs. Every other field is generalised. What is
left is the line's template. A template that enough documents share, with enough constant
tokens (all of them in lines of up to three tokens), is boilerplate: its first occurrence in
the corpus (smallest id, then place) stays, all others are dropped.

Every step is a grouped count or an equi-join, so it does not depend on the order in which
lines come, and a line, leaf or template that a third of all documents share reaches the
shuffle as one row per task or is split by adaptive execution. Only lines in leaves that
recur go past the first count.

Null texts stay null, empty ones empty; a document that loses every line has an empty text.
Rows equal in id and text count as one document and are treated alike. Other columns pass
through; an input column ``n_dropped`` is replaced.
"""

from __future__ import annotations

import re

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

from lendmart.llm.common import carried, keyed, packed, same_key, table, unpacked
from lendmart.sources.snapshots import stage

MIN_DOCS = 3          # documents that must share a template
LEADING = 3           # leading tokens in a path
MIN_CONSTANT, SHARE = 4, 0.7   # constant tokens of a template: at least, and share
RELATIVE = 10         # constant tokens have one in so many documents of the solid ones
FIELD = "<*>"


_DIGIT = re.compile("[0-9]")


def _leaf(tokens: list[str]) -> int:
    """The path of a line's tokens."""
    path = f"{len(tokens)} {' '.join(tokens[:LEADING])}"
    return xxhash.xxh3_64_intdigest(path.encode("utf-8", "surrogatepass")) >> 1


def _tokens(line: str) -> list[str]:
    """Tokens between white space, those with a digit generalised."""
    tokens = line.split()
    if _DIGIT.search(line):
        return [FIELD if _DIGIT.search(x) else x for x in tokens]
    return tokens


def _leaves(batches):
    """Leaves of each text, once."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            out = []
            for text in batch.column(0).slice(at, 1000).to_pylist():
                found = map(_tokens, text.split("\n"))
                out.extend({_leaf(tokens) for tokens in found if tokens})
            yield pa.record_batch([pa.array(out, pa.int64())], names=["leaf"])


def _masked(batches):
    """(d, t, line, masked, leaf) of every line that can be a template."""
    schema = pa.schema([("d", pa.int64()), ("t", pa.int64()), ("line", pa.int32()),
                        ("masked", pa.string()), ("leaf", pa.int64())])
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            columns = [[] for _ in schema]
            for d, t, text in zip(*(c.to_pylist() for c in batch.slice(at, 1000).columns)):
                for line, raw in enumerate(text.split("\n")):
                    tokens = _tokens(raw)
                    if tokens:
                        for column, value in zip(columns, (d, t, line, " ".join(tokens),
                                                           _leaf(tokens))):
                            column.append(value)
            yield pa.record_batch(columns, schema=schema)


def _lines(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("d").cast("long"), "t", "text").mapInArrow(
        _masked, "d long, t long, line int, masked string, leaf long")


def _path_counts(docs: DataFrame, min_docs: int) -> DataFrame:
    """Leaves that enough documents reach; a document's repeats count once."""
    return docs.select("text").mapInArrow(_leaves, "leaf long").groupBy("leaf").count().filter(
        F.col("count") >= min_docs).select("leaf")


def templates(docs: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """Recurring templates (leaf, form, template, n_docs, first) and all lines with their
    template's hash (d, t, line, leaf, form), of documents ``d``, ``t``, ``text``."""
    leaves = stage(_path_counts(docs, min_docs))
    found = stage(_lines(docs).join(leaves, "leaf").withColumn("own", F.xxhash64("masked")))
    distinct = found.groupBy("leaf", "own").agg(
        F.first("masked").alias("masked"), F.count_distinct(F.struct("d", "t")).alias("n"))
    tokens = stage(distinct.select("leaf", "own", "n", F.posexplode(F.split("masked", " "))
                                   .alias("at", "token")))
    often = stage(tokens.filter(F.col("token") != FIELD).groupBy("leaf", "at", "token").agg(
        F.sum("n").alias("often")).filter(F.col("often") >= min_docs))
    fields = tokens.drop("n").join(often, ["leaf", "at", "token"], "left").select(
        "leaf", "own", "at", "token", F.coalesce("often", F.lit(0)).alias("often"))
    forms = fields.groupBy("leaf", "own").agg(
        F.array_sort(F.collect_list(F.struct("at", "token", "often"))).alias("tokens"))
    n = F.size("tokens")
    needed = F.greatest(F.least(F.lit(MIN_CONSTANT), n), F.ceil(SHARE * n).cast("int"))
    solid = F.element_at(F.sort_array(F.transform("tokens", lambda x: x["often"]), False), needed)
    # lines that share the constants of an absolute count share their solid tokens too, so a
    # relative one only ever joins their templates
    forms = stage(forms.withColumn("solid", solid).filter(F.col("solid") >= min_docs).select(
        "leaf", "own", F.array_join(F.transform("tokens", lambda x: F.when(
            (x["often"] >= min_docs) & (x["often"] * RELATIVE >= F.col("solid")), x["token"])
            .otherwise(FIELD)), " ").alias("template")).withColumn(
                "form", F.xxhash64("template")))
    occurring = stage(found.select("d", "t", "line", "leaf", "own").join(
        forms.select("leaf", "own", "form"), ["leaf", "own"]).drop("own"))
    shared = occurring.groupBy("leaf", "form").agg(
        F.count_distinct(F.struct("d", "t")).alias("n_docs"),
        F.min(F.struct("d", "t", "line")).alias("first")).filter(F.col("n_docs") >= min_docs)
    named = forms.groupBy("leaf", "form").agg(F.first("template").alias("template"))
    return stage(shared.join(named, ["leaf", "form"])), occurring


def _remaining(texts: pd.Series, dropped: pd.Series) -> pd.Series:
    def one(text, lines):
        if text is None or lines is None:
            return text
        gone = set(lines)
        return "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)

    return pd.Series([one(*x) for x in zip(texts, dropped)], dtype=object)


def drop_lines(df: DataFrame, min_docs: int = MIN_DOCS, doc_id: str = "doc_id",
               text: str = "text") -> DataFrame:
    """The rows without their recurring lines, and ``n_dropped``, how many those were."""
    shared, occurring = templates(keyed(df, doc_id, text), min_docs)
    here = F.struct("d", "t", "line")
    gone = occurring.join(shared.select("leaf", "form", "first"), ["leaf", "form"]).filter(
        ~here.eqNullSafe(F.col("first"))).groupBy("d", "t").agg(
            F.collect_list("line").alias("gone"))
    gone = stage(gone)
    rows = packed(df, doc_id, text)
    own = f"c{df.columns.index(text)}"
    joined = rows.join(gone, same_key(rows, gone), "left").select(
        *carried(df), "gone", F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n"))
    n = F.when(F.col("n") > 0, F.col("n")).otherwise(0)
    # a deterministic function would run once more for every later filter on its result
    without = F.pandas_udf(_remaining, StringType()).asNondeterministic()
    return unpacked(joined, df.columns, **{text: without(F.col(own), F.col("gone")),
                                           "n_dropped": n})


def op1_log_templates(spark, sf_dir: str) -> DataFrame:
    return drop_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
