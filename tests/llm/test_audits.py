"""Filter and source audits against plain versions, on awkward rows."""

import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest

from lendmart.llm import audit, divergence, queries
from check import compare, connect

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i}" for i in range(30000))
FULL = " ".join(f"word{i}" for i in range(250))
ROWS = [
    (1, FULL, "s"), (2, FULL, "s"), (2, FULL, "s"), (3, FULL, None), (None, FULL, "s"),
    (4, None, "s"), (5, "", ""), (6, " \t\n", "only"), (7, LONG, "s"), (7, "other $ text", "t"),
    (8, "A " * 300, "t"), (9, "word " * 200 + "Éa #", None), (10, LONG + " X%", "s"),
    (11, " ".join(f"Word{i} {i}" for i in range(120)), "t"), (12, "ab\x0bcd\xa0ef", "s"),
]
LABELS = [(1, 1, 0), (1, 0, 1), (2, 1, 1), (None, 1, 1), (8, 1, 0), (9, 0, 1), (99, 1, 1)]


@pytest.fixture(scope="module")
def awkward(spark):
    """Extra columns bear names that the operators use inside or return."""
    return spark.createDataFrame(ROWS, "doc_id long, text string, source string").selectExpr(
        "*", "1 AS id", "'x' AS part", "2 AS removed", "'c' AS copy", "true AS A", "0 AS kept")


def plain_audit(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    texts = defaultdict(list)
    for d, t, _ in rows:
        if d is not None:
            texts[t or ""].append(d)
    docs = []
    for d, t, s in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                 "D": re.search("[#$%&*|]", t) is not None,
                 "E": d is not None and any(x < d for x in texts[t])}
        docs.append((s or "", {f for f in fails if fails[f]}, d in good, d in toxic))
    out = {}
    for part in {p for p, *_ in docs}:
        mine = [x for x in docs if x[0] == part]
        shapley = Counter()
        steps = {}
        for order in permutations("ABCDE"):
            left = mine
            for i, f in enumerate(order):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                shapley[f] += len(gone)
                failing = sum(f in x[1] for x in mine)
                steps["".join(order), i + 1] = (
                    len(left), len(gone), failing - len(gone), sum(x[1] == {f} for x in mine),
                    sum(x[2] for x in gone), sum(x[3] for x in gone))
        for (order, step), row in steps.items():
            out[part, order, step] = (*row, shapley[order[step - 1]])
    return out


def got_audit(df):
    return {(r["part"], r["filter_order"], r["step"]): (
        r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"],
        r["toxic_lost"], r["shapley"]) for r in df.collect()}


def test_filter_audit_of_awkward_rows(spark, awkward):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = got_audit(audit.audit(awkward, labels))
    assert got == plain_audit(ROWS, LABELS)
    assert len(got) == 4 * 120 * 5


def test_filter_audit_of_an_empty_table(spark, awkward):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(awkward.limit(0), labels).count() == 0
    assert got_audit(audit.audit(awkward, labels)) == plain_audit(ROWS, [])


def test_survivors_come_from_joins_of_id_tables(spark, awkward):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    rows = audit.flagged(awkward, labels)
    assert rows.count() == len(ROWS) == rows.select("id").distinct().count()
    removed = {(r["filter"], r["earlier"], r["part"]): r["removed"]
               for r in audit.removals(rows).collect()}
    assert all(f not in earlier for f, earlier, _ in removed)
    # removed after more filters is never more
    assert all(n <= removed[f, "", p] for (f, _, p), n in removed.items())


def plain_divergence(rows, min_docs, top=10):
    docs = [(lang or "", s or "", re.findall(
        r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or "")))
        for lang, s, t in rows]
    often = Counter((lang, x) for lang, _, w in docs for x in set(w))
    kept = defaultdict(list)
    for (lang, x), n in often.items():
        if n >= min_docs:
            kept[lang].append(x)
    counts = defaultdict(Counter)
    for lang, s, w in docs:
        counts[lang, s].update(x for x in w if x in set(kept[lang]))
    out = {}

    def parts(count, lang):
        total = sum(count.values()) + 2 * len(kept[lang])
        return {x: 1 + 10**9 * (count[x] + 2) // total for x in kept[lang]}

    def f(p, q):
        return (p - q) ** 2 // (p + q)

    for lang, s in list(counts):
        own = parts(counts[lang, s], lang)
        peers = {}
        for other_lang, other in list(counts):
            if other_lang == lang and other != s:
                q = parts(counts[lang, other], lang)
                peers[other] = sum(f(own[x], q[x]) for x in kept[lang])
        everywhere = Counter()
        for (a, _), c in counts.items():
            if a == lang:
                everywhere.update(c)
        q = parts(everywhere, lang)
        terms = {x: f(own[x], q[x]) for x in kept[lang]
                 if counts[lang, s][x] > 0 and own[x] > q[x]}
        for part, values, most in (("pair", peers, None), ("term", terms, top)):
            order = sorted(values, key=lambda x: (-values[x], x.encode()))[:most]
            out.update({(lang, s, part, x): (values[x], i + 1) for i, x in enumerate(order)})
    return out


def got_divergence(df):
    return {(r["lang"], r["source"], r["part"], r["item"]): (r["value"], r["rank"])
            for r in df.collect()}


@pytest.mark.parametrize("min_docs", [1, 2, 10])
@pytest.mark.parametrize("block", [divergence.BLOCK, 3])
def test_divergence_of_awkward_rows(spark, monkeypatch, min_docs, block):
    monkeypatch.setattr(divergence, "BLOCK", block)
    rows = [("en", f"s{i % 4}", f"The cat-{i % 3} É é{'x' * (i % 5)} the THE b{i % 7}c") for i in range(24)]
    rows += [(None, None, None), (None, "s1", "x y"), ("", "s2", "x"), ("fr", "a", ""),
             ("fr", "b", "un deux"), ("fr", "b", "un deux"), ("de", "only", "ein ein"),
             ("en", "s0", " ".join(f"t{i % 900}" for i in range(20000))), ("en", "none", "123 !")]
    df = spark.createDataFrame(rows, "lang string, source string, text string").selectExpr(
        "*", "1 AS at", "2 AS value", "'z' AS term", "3 AS n")
    assert got_divergence(divergence.audit_sources(df, min_docs=min_docs)) == \
        plain_divergence(rows, min_docs)
    assert divergence.audit_sources(df.limit(0)).count() == 0


def test_divergence_in_small_steps(spark, monkeypatch):
    monkeypatch.setattr(divergence, "STEP", 5)
    monkeypatch.setattr(divergence, "HELD", 3)
    rows = [("en", f"s{i % 3}", "a b c " * (i % 4) + f"d{i % 2}") for i in range(12)]
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    assert got_divergence(divergence.audit_sources(df, min_docs=2)) == plain_divergence(rows, 2)


def test_parts_are_exact():
    import numpy as np

    n = np.array([2, 3, 10**15, 7 * 10**14 + 1], np.int64)
    total = np.array([9 * 10**15, 7, 10**15, 9 * 10**15 - 1], np.int64)
    assert divergence._parts(n, total).tolist() == [
        1 + 10**9 * int(a) // int(b) for a, b in zip(n, total)]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLES[name]) == []
