"""Audit of how quality filters interact, by relations of failing ids.

Every filter has one stored table with the rows that fail it, and nothing else is joined.
What a filter removes after some earlier filters, in whatever order those ran, are its
failing rows left-anti-joined with each earlier filter's table. One pass per filter extends
all combinations at once: rows of the relation (filter, earlier filters, row) that survive
the next filter's table enter again with it among the earlier ones, so five filters cost
five anti joins however many orders there are. Left-semi joins with the labelled ids mark
label losses before that. Survivors, redundant failures and the shares of all orders then
follow from one grouped count per combination and part, which has no more rows than parts
x filters x combinations.

A row's id is its place in the stored flag table, so repeated or null document ids are
counted as the rows they are. A part is a value of ``source``; null is the empty one. A
null text is empty. A document is good or toxic if any of its label rows says so. A copy is
a row whose text some row with a smaller document id has; a null id is neither smaller nor
larger than another. An empty table has no parts and so no rows. Other columns are not read.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window, functions as F

from lendmart.llm.common import table, whole
from lendmart.sources.snapshots import stage

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_UPPER = 200, 50, 2   # words; percent of words; of characters
SEPARATORS, UPPER, SYMBOLS = r"[\x20\x09-\x0D]+", "[^A-Z]+", "[#$%&*|]"


def conditions(text: Column) -> dict[str, Column]:
    """Failure of the filters that look at one text only."""
    words = F.filter(F.split(text, SEPARATORS), lambda w: w != "")
    return {
        "A": F.size(words) < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT * F.size(words),
        "C": 100 * F.char_length(F.regexp_replace(text, UPPER, "")).cast("long")
        > MAX_UPPER * F.char_length(text),
        "D": text.rlike(SYMBOLS),
    }


def flagged(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
            part: str = "source") -> DataFrame:
    """(id, part, good, toxic, A to E) of every row, stored; ``id`` is the row's own."""
    body = whole(text)
    rows = stage(docs.select(
        F.monotonically_increasing_id().alias("id"), F.col(doc_id).alias("doc"),
        whole(part).alias("part"), F.sha2(body, 256).alias("copy"),
        *[c.alias(f) for f, c in conditions(body).items()]))
    # the table is stored, so ids given to rows while it was written stay as they are
    first = rows.groupBy("copy").agg(F.min("doc").alias("first"), F.max("doc").alias("last")) \
        .filter("first < last").select("copy", "first")
    copies = rows.join(first, "copy").filter(F.col("doc") > F.col("first")).select("id")
    good, toxic = (rows.join(labels.filter(F.col(c) == 1).select(F.col("doc_id").alias("doc")),
                             "doc", "left_semi").select("id") for c in ("quality", "toxic"))
    marks = copies.withColumn("m", F.lit(1)).union(good.withColumn("m", F.lit(2))).union(
        toxic.withColumn("m", F.lit(4))).groupBy("id").agg(F.sum("m").alias("m"))
    m = F.coalesce(F.col("m"), F.lit(0))
    return stage(rows.drop("doc", "copy").join(marks, "id", "left").select(
        "id", "part", m.bitwiseAND(2).cast("boolean").alias("good"),
        m.bitwiseAND(4).cast("boolean").alias("toxic"), "A", "B", "C", "D",
        m.bitwiseAND(1).cast("boolean").alias("E")))


def removals(rows: DataFrame) -> DataFrame:
    """(filter, earlier, part, removed, good, toxic): what each filter removes after the set
    of earlier ones, a string of letters in alphabetical order, in each part. Combinations
    without a removal have no row."""
    failing = {f: stage(rows.filter(f).select("id", "part", "good", "toxic")) for f in FILTERS}
    found = None
    for f, ids in failing.items():
        own = ids.select(F.lit(f).alias("filter"), F.lit("").alias("earlier"), "id", "part",
                         "good", "toxic")
        found = own if found is None else found.union(own)
    for f, ids in failing.items():
        passing = found.filter(F.col("filter") != f).join(ids.select("id"), "id", "left_anti")
        found = stage(found.unionByName(passing.withColumn(
            "earlier", F.concat("earlier", F.lit(f)))))
    return found.groupBy("filter", "earlier", "part").agg(
        F.count("*").alias("removed"), F.count_if("good").alias("good"),
        F.count_if("toxic").alias("toxic"))


def steps(parts: DataFrame) -> DataFrame:
    """The rows of ``parts`` with every filter order, and every step of it: step, filter, and
    the earlier filters in alphabetical order."""
    orders = ",".join(map("".join, permutations(FILTERS)))
    each = parts.withColumn("filter_order", F.explode(F.split(F.lit(orders), ",")))
    letters = F.split("filter_order", "(?<=.)(?=.)")
    return each.select("*", F.posexplode(letters).alias("place", "filter")).select(
        *each.columns, (F.col("place") + 1).alias("step"), "filter",
        F.array_join(F.array_sort(F.slice(letters, 1, F.col("place"))), "").alias("earlier"))


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          part: str = "source") -> DataFrame:
    """A row per part, filter order and step, with the counts of that step."""
    rows = flagged(docs, labels, doc_id, text, part)
    removed = stage(removals(rows))
    totals = rows.groupBy("part").count()
    n = len(FILTERS)
    orders = F.element_at(F.create_map(*[x for k in range(n) for x in (
        F.lit(k), F.lit(factorial(k) * factorial(n - 1 - k)))]), F.length("earlier"))
    alone = F.length("earlier") == n - 1
    of_filter = removed.groupBy("part", "filter").agg(
        F.sum(F.when(F.col("earlier") == "", F.col("removed"))).alias("failing"),
        F.sum(F.when(alone, F.col("removed"))).alias("unique_fails"),
        F.sum(F.col("removed") * orders).alias("shapley"))
    # every part has every step, also those that remove nothing
    grid = steps(totals.select("part", F.col("count").alias("total")))
    wide = grid.join(removed, ["part", "filter", "earlier"], "left").join(
        of_filter, ["part", "filter"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    out = wide.select("part", "filter_order", "step", "total", zero("removed").alias("removed"),
                      zero("failing").alias("failing"), zero("unique_fails").alias("unique_fails"),
                      zero("good").alias("good_lost"), zero("toxic").alias("toxic_lost"),
                      zero("shapley").alias("shapley"))
    so_far = F.sum("removed").over(Window.partitionBy("part", "filter_order").orderBy("step"))
    return out.select("part", "filter_order", "step", (F.col("total") - so_far).alias("kept"),
                      "removed", (F.col("failing") - F.col("removed")).alias("redundant"),
                      "unique_fails", "good_lost", "toxic_lost", "shapley")


def op11_failing_ids(spark, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP11_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part FROM documents),
worded AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM docs),
firsts AS (SELECT text, min(doc_id) AS first FROM docs GROUP BY text),
failed AS (
  SELECT part, len(words) < 200 AS a,
         100 * len(list_distinct(words)) < 50 * len(words) AS b,
         100 * length(regexp_replace(w.text, '[^A-Z]+', '', 'g')) > 2 * length(w.text) AS c,
         regexp_matches(w.text, '[#$%&*|]') AS d,
         coalesce(doc_id > first, false) AS e,
         EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = w.doc_id AND l.quality = 1) AS good,
         EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = w.doc_id AND l.toxic = 1) AS toxic
  FROM worded w JOIN firsts f ON f.text = w.text),
marked AS (
  SELECT part, good, toxic, concat(CASE WHEN a THEN 'A' ELSE '' END,
         CASE WHEN b THEN 'B' ELSE '' END, CASE WHEN c THEN 'C' ELSE '' END,
         CASE WHEN d THEN 'D' ELSE '' END, CASE WHEN e THEN 'E' ELSE '' END) AS fails
  FROM failed),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT concat(a.f, b.f, c.f, d.f, e.f) AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (
  SELECT filter_order, s::INTEGER AS step, filter_order[s] AS f,
         filter_order[1:s - 1] AS earlier
  FROM orders, range(1, 6) r(s)),
counted AS (
  SELECT part, filter_order, step, f,
    count(*) FILTER (fails = '' OR translate(fails, earlier || f, '') = fails) AS kept,
    count(*) FILTER (contains(fails, f) AND translate(fails, earlier, '') = fails) AS removed,
    count(*) FILTER (contains(fails, f) AND translate(fails, earlier, '') <> fails) AS redundant,
    count(*) FILTER (fails = f) AS unique_fails,
    count(*) FILTER (contains(fails, f) AND translate(fails, earlier, '') = fails AND good)
      AS good_lost,
    count(*) FILTER (contains(fails, f) AND translate(fails, earlier, '') = fails AND toxic)
      AS toxic_lost
  FROM marked, steps GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""
