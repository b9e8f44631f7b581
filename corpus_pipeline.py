"""A corpus from raw documents to packed sequences.

Every stage takes what its predecessor kept, as a table of documents, and its decisions
take effect there. All but the last return the columns of documents; the last returns a
row per packed piece.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from lendmart.llm.common import packed, remainder, same_key, table, unpacked
from lendmart.llm.decontaminate import decontaminate
from lendmart.llm.jaccard import join_groups
from lendmart.llm.langid import UNKNOWN, identify
from lendmart.llm.lines import drop_lines
from lendmart.llm.packing import digest, pack, vocabulary_path
from lendmart.sources.snapshots import checkpoint_folder, stage

MIN_SHARE = 0.5  # a document's main language must hold this much of it


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The columns under names that no operator adds to, and these names by the old ones."""
    names = {c: f"column{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), names


def named(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    return rows.select(*[F.col(n).alias(c) for c, n in names.items()])


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language. Those without a letter (null and empty texts, too),
    and those in which no language has at least half, go. Learns as the language query does."""
    known = docs.filter(remainder("doc_id", 5) != 0).select("text", "lang")
    rows, names = numbered(docs)  # each text once in the queue to the Python workers
    found = identify(rows, known, text=names["text"])
    kept = found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MIN_SHARE))
    return named(kept, names)


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without recurring lines; those that had nothing else go. Where lines were
    dropped, ``n_chars``, which the documents must have, counts what is left."""
    rows = drop_lines(docs)
    kept = rows.filter((F.col("n_dropped") == 0) | (F.trim("text") != ""))
    chars = F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(
        F.col("n_chars"))
    return kept.withColumn("n_chars", chars).select(*docs.columns)


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents joined by near-duplicate links, the one with the smallest id. Rows
    without an id stay; rows equal in id and text stay or go together."""
    groups = join_groups(docs)
    gone = stage(groups.filter(F.col("doc_id") != F.col("component_id")).select(
        F.col("doc_id").alias("d"), "t").distinct())
    rows = packed(docs)
    return unpacked(rows.join(gone, same_key(rows, gone), "left_anti"), docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage; a null or empty text has none."""
    rows, names = numbered(docs)
    found = decontaminate(rows, table(spark, sf_dir, "benchmark"), names["doc_id"], names["text"])
    return named(found.filter(~F.col("contaminated")), names)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in a sequence; a null or empty text is one closing id."""
    return digest(pack(docs, vocabulary_path()))


STAGES = [
    ("language_id", keep_identified),
    ("line_dedup", drop_recurring_lines),
    ("jaccard_join", keep_one_of_group),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: Learned models, components and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each result is written to the shared folder and read again."""
    rows = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for name, step in STAGES:
        step(spark, rows, sf_dir).write.parquet(f"{folder}/{name}")
        rows = spark.read.parquet(f"{folder}/{name}")
    return rows
