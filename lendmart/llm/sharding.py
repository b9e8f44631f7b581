"""Sharding by histogram sort.

Rows are ordered by (hash of the text, hash of the id). Exact bytes are counted in the
bins of that key space; a bin too heavy to be placed within the tolerance is counted
again with finer probes, until every boundary can be placed. Only then are the rows
exchanged, once, and numbered inside their part.

Law ``bytes``: shard sizes differ by little more than ``tolerance`` of a shard, or by one
row where a row is larger than that. Equal texts are neighbours in the order, so they
share a shard unless their group is itself heavier than the tolerance allows.

Null text: 0 bytes. Null ids order like any other value. Rows equal in text and id have
one key and cannot be told apart: they stay together and are numbered in any order. An
empty table gives no rows. Other columns pass through; an input column with the name of
a result is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lendmart.llm.common import carried, packed, table, unpacked, whole
from lendmart.sources.snapshots import small_table, stage

OVERHEAD = 8          # bytes a row counts beside its text
FIRST_BITS, MORE_BITS = 16, 12
PART_BYTES = 1 << 30  # rows of a shard are numbered in parts of at most about this


def _digits(high: Column, low: Column) -> list[Column]:
    """The 128-bit key as digits, most significant first."""
    out = [F.shiftrightunsigned(high, 64 - FIRST_BITS)]
    for key, left in ((high, 64 - FIRST_BITS), (low, 64)):
        while left > 0:
            bits = min(MORE_BITS, left)
            left -= bits
            out.append(F.shiftrightunsigned(key, left).bitwiseAND(F.lit((1 << bits) - 1)))
    return [d.cast("int") for d in out]


def _names(depth: int) -> list[str]:
    return [f"b{i}" for i in range(depth)]


def _keys(df: DataFrame) -> DataFrame:
    digits = _digits(F.col("t"), F.xxhash64("d", F.lit(1)))
    return df.select("*", *[c.alias(n) for c, n in zip(digits, _names(len(digits)))])


def probe(sizes: DataFrame, depth: int, shards: int, tolerance: float):
    """Leaves of the key space in order: [(prefix, bytes, rows)].

    Each round counts only inside the bins that are still heavier than the limit. Of
    those there are at most shards / tolerance, whatever the input's size, so what is
    sent to the tasks and back is bounded.
    """
    spark = sizes.sparkSession
    leaves, open_bins, limit = [], None, None
    for level in range(1, depth + 1):
        names = _names(level)
        rows = sizes
        if open_bins is not None:
            kind = ", ".join(f"{n} int" for n in names[:-1])
            rows = sizes.join(F.broadcast(small_table(spark, open_bins, kind)), names[:-1],
                              "left_semi")
        found = rows.groupBy(*names).agg(F.sum("size").alias("bytes"),
                                         F.count(F.lit(1)).alias("n")).collect()
        if limit is None:
            limit = tolerance * sum(r["bytes"] for r in found) / shards
        open_bins = []
        for r in found:
            prefix = tuple(r[n] for n in names)
            if r["bytes"] > limit and r["n"] > 1 and level < depth:
                open_bins.append(prefix)
            else:
                leaves.append((prefix, r["bytes"], r["n"]))
        if not open_bins:
            break
    return sorted(leaves)


def split(leaves, shards: int, part_bytes: int = PART_BYTES):
    """(prefix, shard, part, rows before the part in its shard) of every leaf."""
    total = sum(b for _, b, _ in leaves)
    most = min(part_bytes, total / (8 * shards))
    out, before, part, filled, base, rows, last = [], 0, -1, 0, 0, 0, None
    for prefix, size, n in leaves:
        shard = min(shards - 1, int(shards * (before + size / 2) / total))
        if shard != last:
            rows = 0
        if shard != last or filled >= most:
            part, filled, base = part + 1, 0, rows
        out.append((prefix, shard, part, base))
        before, filled, rows, last = before + size, filled + size, rows + n, shard
    return out


def shard_by_bytes(df: DataFrame, shards: int = 24, tolerance: float = 0.005,
                   doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with ``size``, ``law``, ``shard``, ``slot`` and a null ``grown_shard``."""
    rows = _keys(packed(df, doc_id, text).withColumn(
        "size", F.octet_length("text").cast("long") + OVERHEAD))
    names = [c for c in rows.columns if c.startswith("b")]
    sizes = stage(rows.select(*names, "size"))
    placed = split(probe(sizes, len(names), shards, tolerance), shards)
    found = {k: F.lit(None).cast(v) for k, v in (("shard", "int"), ("part", "int"),
                                                 ("base", "long"))}
    for level in sorted({len(p) for p, *_ in placed}):
        own = _names(level)
        kind = ", ".join(f"{n} int" for n in own)
        here = small_table(rows.sparkSession, [(*p, *x) for p, *x in placed if len(p) == level],
                           f"{kind}, s{level} int, p{level} int, r{level} long")
        rows = rows.join(F.broadcast(here), own, "left")
        found = {"shard": F.coalesce(found["shard"], F.col(f"s{level}")),
                 "part": F.coalesce(found["part"], F.col(f"p{level}")),
                 "base": F.coalesce(found["base"], F.col(f"r{level}"))}
    placed_rows = rows.select(*carried(df), "size", *names, *[v.alias(k) for k, v in found.items()])
    order = Window.partitionBy("part").orderBy(*names)
    numbered = placed_rows.withColumn("slot", F.col("base") + F.row_number().over(order) - 1)
    return unpacked(numbered, df.columns, size=F.col("size"), law=F.lit("bytes"), shard=F.col("shard"),
                    slot=F.col("slot").cast("long"), grown_shard=F.lit(None).cast("int"))


def op10_histogram_sort(spark, sf_dir: str) -> DataFrame:
    out = shard_by_bytes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", F.crc32(whole("text")).alias("text_crc32"), "law",
                      "shard", "slot", "grown_shard")
