"""Audit of how the sources of a language differ, by Gustavson's row accumulation.

The term-major index has one row per kept term: its postings, the sources that have it with
their counts. It is dealt into blocks of terms. In a block, each group (a source of a
language) is a row: it looks up the postings of its own terms and adds what they say about
each peer into one dense array with a place per peer. So a pair of postings is a step of the
accumulation and never a row; a block emits one array per group, and arrays of blocks are
summed.

Most counts are zero and never appear, yet each has a smoothed probability. The
accumulation starts from two zero counts everywhere, ``f(p0, q0)`` for each kept term, then
corrects it: for a group's own terms against peers that lack them, and where postings meet,
for both at once. With ``f`` as the measure, ``p0`` and ``q0`` as the zero probabilities::

    sum f = V f(p0,q0) + sum over own terms f(p,q0) - f(p0,q0)
          + the same of the peer + sum over shared f(p,q) - f(p,q0) - f(p0,q) + f(p0,q0)

Everything is integer arithmetic. Probabilities are parts of ``SCALE``; a quotient is taken
three decimal digits at a time, exact for up to 9e15 tokens of a group.

Tasks count terms before the shuffle, and a block holds about ``BLOCK`` postings, or as many
as its arrays have numbers if that is more, so neither a hot source or language nor a
frequent term reaches one task: a term has at most one posting per source.

Null text, language and source are empty strings. A group without a kept term takes part
with its zero counts; a language that keeps no term has value 0 for all pairs and no terms.
A language's only source has no pairs. Repeated rows count as often as they occur. An empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from lendmart.llm.common import table, whole
from lendmart.sources.snapshots import stage

MIN_DOCS, SCALE, TOP = 10, 1_000_000_000, 10
BLOCK = 200_000      # postings of a block
HELD = 400_000       # terms that a task counts before it passes them on
STEP = 1_000_000     # numbers of one vectorised step
#: Letters and all bytes beyond ASCII stay, lower-cased; everything else separates terms.
TERMS = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256)).lower()


def _counted(batches):
    """(lang, source, term, n, docs), counted in the task as far as it can hold terms."""
    names = ["lang", "source", "term", "n", "docs"]
    kinds = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def emit():
        for (lang, source), (n, docs) in held.items():
            columns = [[lang] * len(n), [source] * len(n), list(n), list(n.values()),
                       [docs[x] for x in n]]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
        held.clear()

    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            lang, source, text = batch.slice(at, 500).columns
            for a, b, body in zip(lang.to_pylist(), source.to_pylist(),
                                  text.cast(pa.binary()).to_pylist()):
                found = body.translate(TERMS).split()
                n, docs = held.setdefault((a, b), (Counter(), Counter()))
                n.update(found)
                docs.update(set(found))
            if sum(len(n) for n, _ in held.values()) > HELD:
                yield from emit()
    yield from emit()


def term_index(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, posts), of terms in enough documents of their language. ``docs`` has
    lang, source and text without nulls."""
    counts = docs.select("lang", "source", "text").mapInArrow(
        _counted, "lang string, source string, term binary, n long, docs long").groupBy(
            "lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return counts.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("posts")
    ).filter(F.col("docs") >= min_docs).select(
        "lang", F.col("term").cast("string").alias("term"), "posts")


def group_totals(docs: DataFrame, index: DataFrame) -> DataFrame:
    """(lang, source, total, v, at): each occurring group, its count of kept terms, how many
    terms its language keeps, and its place among the language's sources."""
    totals = index.select("lang", F.inline("posts")).groupBy("lang", "source").agg(
        F.sum("n").alias("total"))
    kept = index.groupBy("lang").agg(F.count("*").alias("v"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    return docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left") \
        .join(kept, "lang", "left").select("lang", "source", zero("total"), zero("v"),
                                           place.alias("at"))


def probability(n: Column, total: Column, v: Column) -> Column:
    """Smoothed parts of ``SCALE``, exact in decimals."""
    scaled = F.lit(SCALE).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)")
    return 1 + F.call_function("div", scaled, (total + 2 * v).cast("decimal(20,0)"))


def _parts(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * n / total), for n up to total."""
    out, rest = np.zeros_like(n), n
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + digits
    return out + 1


def _measure(p, q):
    return (p - q) ** 2 // (p + q)


def _accumulate(index: pa.Table, peers: pa.Table) -> pa.Table:
    """One block: a dense array over the peers for each group. ``own`` is the part that a
    peer's array lacks as well: the group's terms against zero counts."""
    peers = peers.sort_by("at")
    size, v, block = peers.num_rows, peers["v"][0].as_py(), peers["block"][0].as_py()
    total = peers["total"].to_numpy() + 2 * v
    posts = index["posts"].combine_chunks()
    flat = posts.flatten()
    source = pc.index_in(flat.field("source"), peers["source"].combine_chunks()).to_numpy()
    lengths = np.asarray(pc.list_value_length(posts)).astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    term = np.repeat(np.arange(len(lengths)), lengths)
    zero = _parts(np.full(size, 2), total) if v else np.ones(size, np.int64)
    p = _parts(flat.field("n").to_numpy() + 2, total[source]) if len(source) else \
        np.zeros(0, np.int64)
    by_group = np.argsort(source, kind="stable")
    ends = np.searchsorted(source[by_group], np.arange(size + 1))
    arrays, owns = [], []
    for g in range(size):
        mine = by_group[ends[g]:ends[g + 1]]
        base = _measure(zero[g], zero)
        row = base * v if block == 0 else np.zeros(size, np.int64)
        own = np.zeros(size, np.int64)
        values, times = np.unique(p[mine], return_counts=True)
        for at in range(0, len(values), max(1, STEP // size)):
            part = slice(at, at + max(1, STEP // size))
            own += (times[part, None] * (_measure(values[part, None], zero) - base)).sum(axis=0)
        reach = lengths[term[mine]]
        cuts = np.searchsorted(np.cumsum(reach), np.arange(0, reach.sum(), STEP)) \
            if len(mine) else []
        for a, b in zip(cuts, [*cuts[1:], len(mine)]):
            n = reach[a:b]
            where = np.arange(n.sum()) + np.repeat(starts[term[mine[a:b]]] - np.cumsum(n) + n, n)
            peer, q, here = source[where], p[where], np.repeat(p[mine[a:b]], n)
            np.add.at(row, peer, _measure(here, q) - _measure(here, zero[peer])
                      - _measure(zero[g], q) + base[peer])
        arrays.append(row + own)
        owns.append(own)
    kind = pa.list_(pa.int64())
    return pa.table({"lang": peers["lang"], "at": peers["at"].cast(pa.int32()),
                     "row": pa.array(arrays, kind), "own": pa.array(owns, kind)})


def pair_sums(index: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of all pairs of a language's sources."""
    postings = index.groupBy("lang").agg(F.sum(F.size("posts")).alias("postings"))
    sizes = groups.groupBy("lang").agg(F.count("*").alias("n")).join(postings, "lang", "left")
    per_block = F.greatest(F.lit(BLOCK), F.col("n") * F.col("n"))
    blocks = stage(sizes.select("lang", F.greatest(F.lit(1), F.ceil(
        F.coalesce("postings", F.lit(0)) / per_block)).cast("int").alias("blocks")))
    dealt = index.join(blocks, "lang").select(
        "lang", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"), "posts")
    peers = groups.join(blocks, "lang").select(
        "lang", "source", "total", "v", "at",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    rows = stage(dealt.groupBy("lang", "block").cogroup(peers.groupBy("lang", "block"))
                 .applyInArrow(_accumulate, "lang string, at int, row array<long>, own array<long>"))
    there = rows.select("lang", "at", F.posexplode("row").alias("peer", "value"))
    back = rows.select("lang", F.col("at").alias("peer"), F.posexplode("own").alias("at", "value"))
    sums = there.union(back.select("lang", "at", "peer", "value")).groupBy(
        "lang", "at", "peer").agg(F.sum("value").alias("value")).filter("at <> peer")
    item = groups.select("lang", F.col("at").alias("peer"), F.col("source").alias("item"))
    return sums.join(groups.select("lang", "at", "source"), ["lang", "at"]).join(
        item, ["lang", "peer"]).select("lang", "source", "item", "value")


def term_values(index: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of the terms that a group has more of than its language."""
    languages = groups.groupBy("lang").agg(F.sum("total").alias("all"))
    posts = index.join(languages, "lang").select(
        "lang", "term", "all", F.aggregate("posts", F.lit(0).cast("long"),
                                           lambda x, y: x + y["n"]).alias("everywhere"),
        F.inline("posts")).join(groups.select("lang", "source", "total", "v"),
                                ["lang", "source"])
    found = posts.select("lang", "source", F.col("term").alias("item"),
                         probability(F.col("n"), F.col("total"), F.col("v")).alias("p"),
                         probability(F.col("everywhere"), F.col("all"), F.col("v")).alias("q"))
    p, q = F.col("p"), F.col("q")
    return found.filter(p > q).select(
        "lang", "source", "item", F.expr("(p - q) * (p - q) div (p + q)").alias("value"))


def audit_sources(df: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
                  min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` with every other source of the
    language, part ``term`` with the ``top`` terms that set the group apart most."""
    docs = df.select(whole(lang).alias("lang"), whole(source).alias("source"),
                     whole(text).alias("text"))
    index = stage(term_index(docs, min_docs))
    groups = stage(group_totals(docs, index))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(
        F.desc("value"), "item"))
    pairs = pair_sums(index, groups).withColumn("rank", rank)
    terms = term_values(index, groups).withColumn("rank", rank).filter(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(columns).union(
        terms.withColumn("part", F.lit("term")).select(columns))


def op13_gustavson(spark, sf_dir: str) -> DataFrame:
    return audit_sources(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
often AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(words)) AS term FROM docs)
  GROUP BY lang, term HAVING count(*) >= 10),
vocabulary AS (SELECT lang, count(*) AS v FROM often GROUP BY lang),
counts AS (
  SELECT lang, source, term, count(*) AS n
  FROM (SELECT lang, source, unnest(words) AS term FROM docs) JOIN often USING (lang, term)
  GROUP BY lang, source, term),
groups AS (
  SELECT d.lang, d.source, coalesce(v, 0) AS v, coalesce(total, 0) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) d LEFT JOIN vocabulary USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source)
    USING (lang, source)),
dense AS (
  SELECT g.lang, g.source, o.term, coalesce(c.n, 0) AS n, g.total, g.v
  FROM groups g JOIN often o USING (lang) LEFT JOIN counts c USING (lang, source, term)),
parts AS (
  SELECT lang, source, term, n,
         1 + (1000000000::HUGEINT * (n + 2)) // (total + 2 * v) AS p FROM dense),
everywhere AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 2))
    // (sum(total) + 2 * any_value(v)) AS q FROM dense GROUP BY lang, term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item,
           sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
    FROM parts x JOIN parts y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
    GROUP BY ALL) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT lang, source, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value
  FROM parts JOIN everywhere USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (
    PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', item, value, row_number() OVER (
    PARTITION BY lang, source ORDER BY value DESC, item) FROM terms)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked
WHERE part = 'pair' OR rank <= 10
"""
