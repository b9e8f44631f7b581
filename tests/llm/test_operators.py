"""Operators against plain versions: on the smallest tables and on awkward rows."""

import math
import os
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lendmart.llm import (blobs, chat, common, decontaminate, jaccard, langid, lines, lm, packing,
                          pii, queries, sharding, topk)
import brute as B

SF = "/root/testdata/sf0.001"
LONG = "word " * 30000 + "é" * 20000
NEAR = " ".join(f"w{i}" for i in range(100))
AWKWARD = [
    (1, None), (2, ""), (3, "   \n\t"), (4, "A b"), (4, "A b"), (None, "a B c d e f"),
    (5, "a b c d e f"), (6, LONG), (7, "mail x.y@ex-a.org, a@b.c_d@e.f 1.2.3.4.5 300.1.1.1 é"),
    (8, "4111 1111 1111 1111 and +1 (988) 555-2485 or 4111-1111-1111-1112"),
    (9, NEAR), (10, NEAR + " x"), (11, NEAR.replace("w50 ", "q ")), (12, "\\<b> <|x|> </turn>"),
    (13, "one two three four five six seven eight nine ten eleven"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    """Extra columns bear names that operators use inside or return."""
    return spark.createDataFrame(AWKWARD, "doc_id long, text string").selectExpr(
        "*", "1 AS t", "'x' AS size", "2 AS shard", "'c' AS c0", "'k' AS class", "3 AS n_words")


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return [(r["doc_id"], r["text"]) for r in rows]


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def check_spans(rows, texts):
    for i, text in texts:
        spans = B.base_spans(text)
        assert [rows[i][f"n_{k}"] for k in B.KINDS] == [
            sum(at == j for _, at, _ in spans) for j in range(4)]
        assert rows[i]["base_sha256"] == B.sha(B.written(spans))
        found = set(rows[i]["spans"].split(",")) - {""}
        assert {x for x in B.written(spans).split(",") if x} <= found


def test_personal_data(spark, docs):
    check_spans(by_id(queries.QUERIES["op4_bootstrapped_contexts"](spark, SF)), docs)


def test_personal_data_of_awkward_rows(awkward):
    got = {(r["d"]): r["base"] for r in pii.extract(awkward).collect()}
    for i, text in AWKWARD:
        assert [(s["start"], s["kind"], s["end"]) for s in got[i]] == B.base_spans(text)


def test_contexts_discover_unseen_identifiers(spark):
    seen = [(i, f"my card number 41111111111{i:02d}11 thanks") for i in range(60)]
    rows = [(i, t) for i, t in seen]
    got = pii.extract(spark.createDataFrame(rows, "doc_id long, text string"), trust=0.05,
                      min_seeds=2).collect()
    more = [r for r in got if len(r["spans"]) > len(r["base"])]
    assert more and all(s["kind"] == 2 for r in more for s in r["spans"])


def test_contexts_discover_unseen_shapes(spark):
    """With the parameters of production; the last context has only discovered instances."""
    texts = [f"call me on +1 (988) 555-{1000 + i} soon" for i in range(20)]
    texts += [f"call me on 977-444-{1000 + i} soon" for i in range(30)]
    texts += [f"please dial 977-444-{1000 + i} or 12 now" for i in range(20)]
    texts += ["please dial 966-333-1000 or 12 now", "call me on 12 soon", "room 977-555-1000 soon"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["d"]: [(s["kind"], texts[r["d"]][s["start"]:s["end"]]) for s in r["spans"]]
           for r in pii.extract(df).collect()}
    assert [got[i] for i in range(20)] == [[(3, f"+1 (988) 555-{1000 + i}")] for i in range(20)]
    assert [got[20 + i] for i in range(30)] == [[(3, f"977-444-{1000 + i}")] for i in range(30)]
    assert [got[50 + i] for i in range(20)] == [[(3, f"977-444-{1000 + i}")] for i in range(20)]
    assert [got[i] for i in (70, 71, 72)] == [[(3, "966-333-1000")], [], []]


def test_decontamination(spark, docs):
    items = [(r["item_id"], r["text"]) for r in
             spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = by_id(queries.QUERIES["op9_winnowing"](spark, SF))
    for (i, _), (n, hit, found) in zip(docs, B.contaminated([t for _, t in docs], items)):
        assert (rows[i]["n_words"], rows[i]["n_hit"], rows[i]["n_items"],
                rows[i]["items_sha256"]) == (n, hit, len(found), B.sha(",".join(found)))


def test_decontamination_of_awkward_rows(spark, awkward):
    items = [(1, "two three"), (None, "A B"), (3, None), (4, ""),
             (5, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 zz"), (6, "one two three four five six seven "
              "eight nine ten")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"])
                  for r in decontaminate.decontaminate(awkward, bench).collect())
    want = Counter((i, n, hit, tuple(found), hit > 0) for (i, _), (n, hit, found) in
                   zip(AWKWARD, B.contaminated([t for _, t in AWKWARD], items)))
    assert got == want


def test_chat(spark):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in
            spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    rows += [(-7, 0, "user", chat.PROBE), (-7, 1, "assistant", chat.PROBE)]
    got = by_id(queries.QUERIES["op7_content_parts"](spark, SF), "conv_id")
    want = B.chat(rows)
    assert {c: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"])
            for c, r in got.items()} == want


def test_chat_parts(spark):
    df = spark.createDataFrame([
        (1, 0, "us>er", [("text", "a<image/>\\l", None, None), ("image", None, "i.png", None),
                         ("video", None, "v", 7), ("text", "\\b", None, None)]),
        (1, None, None, None), (None, 1, "assistant", [("text", None, None, None)])],
        f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    got = by_id(chat.format_chat(df).withColumn("turns", chat.read_turns(F.col("formatted"))),
                "conv_id")
    one = got[1]
    assert [t["role"] for t in one["turns"]] == ["", "us>er"]
    assert [(a["kind"], a["ref"], a["tokens"]) for a in one["attachments"]] == [
        ("image", "i.png", 576), ("document", "v", 7)] and one["expanded_tokens"] == 583
    assert "".join(s["text"] for s in one["segments"]) == one["formatted"]
    body = one["turns"][1]["body"]
    assert body.count("<image/>") == 1 and body.count("<document/>") == 1
    assert got[None]["formatted"] == "<turn assistant></turn>\n"


def test_top_k_with_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4) / 4]) for i in range(300)]
    rows += [(350, None), (400, [1.0, None, 0.0, 0.0]), (450, [float("nan")] * 4), (None, [1.0] * 4)]
    got = defaultdict(list)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for r in topk.top_k(df.filter("vec_id % 50 = 0"), df).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    m = np.floor(np.array([v for _, v in rows[:300]]) * 256).astype(int)
    assert sorted(got) == [0, 50, 100, 150, 200, 250]
    for q, found in got.items():
        s = m @ m[q]
        best = [i for i in sorted(range(300), key=lambda i: (-s[i], i)) if i != q][:5]
        assert sorted(found) == [(k + 1, i, s[i]) for k, i in enumerate(best)]


def test_components(spark, docs):
    got = by_id(queries.QUERIES["op6_metric_join"](spark, SF))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == B.components(docs)


def test_components_of_chains_and_awkward_rows(spark, awkward):
    base = [f"t{i}" for i in range(120)]
    chain = [(100 + k, " ".join(f"s{k}x{i}" if i < 3 * k else w for i, w in enumerate(base)))
             for k in range(12)]  # neighbours are near, the ends are not
    rows = [(i, t) for i, t in dict(AWKWARD).items() if i is not None] + chain
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in jaccard.join_groups(df).collect()}
    assert got == B.components(rows)
    assert jaccard.join_groups(awkward).count() == len(AWKWARD)


def test_a_pair_of_pivots_counts_for_both(spark):
    """10 and 20 lead region 1, but only 20, which holds 30, leads region 2."""
    keys = {20: [*range(92), *range(200, 208)], 10: [*range(8, 100), *range(300, 308)],
            30: [*range(100)], **{c: range(c * 1000, c * 1000 + 100) for c in range(40, 49)}}
    sets, bits = [], {}
    for c, own in keys.items():
        own = np.sort(np.array(own, np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        bits[c] = [int(x) for x in jaccard._bitmap(own)]
        sets.append((c, own.tobytes(), 100, *bits[c]))
    columns = ", ".join(f"{w} long" for w in jaccard.BITS)
    sets = spark.createDataFrame(sets, f"class long, set binary, n long, {columns}")
    regions = {1: [(40, 0), (20, 3), (10, 5)],
               2: [(41, 0), *[(c, 2) for c in range(42, 49)], (20, 3), (10, 5), (30, 6)]}
    members = [(p, c, 100, float(alone), *bits[c]) for p, own in regions.items()
               for c, alone in own]
    members = spark.createDataFrame(members, f"pivot long, class long, n long, alone double, {columns}")
    links = jaccard._boundary(jaccard._balls(members, sets, 80), sets, 80)
    assert {tuple(sorted(r)) for r in links.select("a", "b").collect()} == {(20, 30), (10, 30)}


def test_components_of_random_families(spark):
    """Families of 10 to 60 near copies, whose regions need several rounds."""
    rng = np.random.default_rng(5)
    rows = []
    for family in range(30):
        base = [f"f{family}w{i}" for i in range(80)]
        for _ in range(rng.integers(10, 61)):
            text = list(base)
            for k in range(rng.integers(0, 4)):
                text[rng.integers(0, 80)] = f"x{rng.integers(0, 6)}"
            rows.append((len(rows), " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in jaccard.join_groups(df).collect()}
    assert got == B.components(rows)


def test_language_model_counts(spark, docs):
    got = by_id(queries.QUERIES["op2_deleted_interpolation"](spark, SF))
    tokens = {i: [*B.words(t), None] for i, t in docs}
    fold = {i: zlib.crc32(str(i).encode()) % 7 for i, _ in docs}
    c = Counter(w for i, ws in tokens.items() if fold[i] != 2 for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in tokens.items():
        r = got[i]
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            fold[i] == 2, len(ws), sum(c[w] > 0 for w in ws), n)
        assert r["base_score"] == pytest.approx(base)
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def plain_interpolation(texts, folds):
    """Score of each text by the definition, order 2, with dictionaries."""
    rows = [(f, [*B.words(t), None]) for t, f in zip(texts, folds)]

    def counted(keep):
        one, two, starts = Counter(), Counter(), 0
        for f, ws in rows:
            if f in keep:
                starts += 1
                one.update(ws)
                two.update(zip(["start", *ws], ws))
        return one, two, {**one, "start": starts}, sum(one.values())

    def levels(ws, counts, weights, uniform):
        one, two, context, total = counts
        for a, w in zip(["start", *ws], ws):
            here, p = [], uniform
            for k, (n, c) in enumerate(((one[w], total), (two[a, w], context.get(a, 0)))):
                bucket = min(int(math.log2(max(c, 1))), lm.BUCKETS - 1)
                x = weights.get((k, bucket), 0.5) if c else 0.0
                here.append((k, bucket, x, n / c if c else 0.0, p, c > 0))
                p = x * here[-1][3] + (1 - x) * p
            yield p, here

    whole = counted({0, 1})
    uniform, weights, less = 1 / (len(whole[0]) + 1), {}, counted({0})
    for _ in range(lm.STEPS):
        uses, chances = Counter(), Counter()
        for f, ws in rows:
            for _, here in levels(ws, less, weights, uniform) if f == 1 else ():
                reach = 1.0
                for k, bucket, x, own, below, usable in reversed(here):
                    p = x * own + (1 - x) * below
                    use = reach * x * own / p if p else 0.0
                    if usable:
                        uses[k, bucket] += use
                        chances[k, bucket] += reach
                    reach -= use
        new = weights | {b: min(uses[b] / chances[b], 0.9999) for b in chances if chances[b] > 0}
        change = max((abs(new[b] - weights.get(b, 0.5)) for b in new), default=0)
        weights = new
        if change < 1e-3:
            break
    return [sum(math.log10(p) for p, _ in levels(ws, whole, weights, uniform)) for _, ws in rows]


def test_language_model_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    texts = [" ".join(rng.choice(list("abcdefg"), rng.integers(0, 30),
                                 p=[.4, .2, .15, .1, .05, .05, .05])) for _ in range(60)]
    folds = [int(x) for x in rng.choice([0, 1, 2], 60, p=[.6, .2, .2])]
    df = spark.createDataFrame(list(zip(range(60), texts, folds)), "doc_id long, text string, f int")
    want = plain_interpolation(texts, folds)
    for tokens in (2_000_000, 50):
        got = by_id(lm.score(df, F.col("f"), chunk_tokens=tokens))
        assert [got[i]["score"] for i in range(60)] == pytest.approx(want, rel=1e-9)


def test_counts_beyond_32_bits():
    import pandas as pd
    import pyarrow as pa
    batch = pa.record_batch([pa.array([1, 2]), pa.array(["a b a", "b"]), pa.array([0, 1])],
                            names=["id", "text", "fold"])
    own = next(lm._chunks(100, 2)([batch])).to_pandas()
    asked = pd.concat(lm._asked(2, 1)([own]))
    answers = pd.concat([lm._answer(2)((key,), rows) for key, rows in asked.groupby("range")])
    more = 5_000_000_000
    answers["kept"] = [lm.pack(lm.unpack(x, np.uint64) + np.uint64(more), np.uint64)
                       for x in answers["kept"]]
    out = lm._counted(2, more, 1)((0,), own, answers).iloc[0]
    assert lm.unpack_counts(out["n1"]).min() > more
    assert lm.unpack_counts(out["x2"]).min() >= more
    assert lm.unpack_counts(lm.pack_counts(np.array([2**32 - 1]))).tolist() == [2**32 - 1]


def test_packing(spark, docs):
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(packing.vocabulary_path())
    own.encode_special_tokens = True
    ids = {i: np.array([*own.encode(t, add_special_tokens=False).ids, 1], "<u4") for i, t in docs}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in queries.QUERIES["op3_least_squares"](spark, SF).collect():
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(part) == r["length"] and zlib.crc32(part.tobytes()) == r["ids_crc32"]
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, x in ids.items():
        assert sum(n for _, n in pieces[i]) == len(x)
    for parts in [*pieces.values(), *sequences.values()]:
        end = 0
        for at, n in sorted(parts):
            assert at == end
            end += n
    assert max(sum(n for _, n in p) for p in sequences.values()) <= 2048


def test_encoder_on_awkward_texts():
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(packing.vocabulary_path())
    own.encode_special_tokens = True
    texts = ["", " ", "a  b\n\n c\t", "it's 12é", "日本 語", "<|endoftext|>", "x" * 3000, "\x1c \x85a "]
    for text, ids in zip(texts, packing.Encoder(packing.vocabulary_path()).encode(texts)):
        assert list(ids) == own.encode(text, add_special_tokens=False).ids


def test_ids_agree_on_all_texts_and_odd_strings():
    """The faster library against the file's own."""
    import duckdb
    rng = np.random.default_rng(7)
    texts = [r[0] for r in duckdb.sql(
        "SELECT text FROM '/root/testdata/sf0.1/documents.parquet' WHERE text IS NOT NULL").fetchall()]
    signs = list("aAeé ñß  \t\n\n'’.,;-_/0129sStT¡ÿĀɏ\xa0") + ["'s", "'LL", "  ", "in", "the"]
    texts += ["".join(rng.choice(signs, rng.integers(1, 40))) for _ in range(20000)]
    encoder = packing.Encoder(packing.vocabulary_path())
    encoder._any("")
    own = encoder.own.encode_batch(texts, add_special_tokens=False)
    assert all(list(a) == b.ids for a, b in zip(encoder.encode(texts), own))


def test_ids_are_as_wide_as_the_vocabulary(tmp_path):
    import json
    for size, width in ((65536, "<u2"), (65537, "<u4")):
        path = tmp_path / f"{size}.json"
        path.write_text(json.dumps({"model": {"vocab": {"a": 0, "b": size - 1}}}))
        assert packing.id_width(str(path)) == np.dtype(width)
    assert packing.id_width(packing.vocabulary_path()) == np.dtype("<u2")


def test_plan_uses_every_piece_once():
    rng = np.random.default_rng(2)
    counts = np.zeros(2049, np.int64)
    np.add.at(counts, rng.integers(1, 2049, 20000), 1)
    used = np.zeros(2049, np.int64)
    steps = packing.plan(counts, 2048)
    for combo, repeats in steps:
        assert sum(combo) <= 2048
        np.add.at(used, list(combo), repeats)
    assert (used == counts).all()
    full = (counts * np.arange(2049)).sum() / (2048 * sum(r for _, r in steps))
    assert full > 0.98


def test_language_accuracy(spark):
    got = queries.QUERIES["op5_mixture"](spark, SF).join(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.collect())


def test_language_of_awkward_rows(spark, awkward, empty):
    known = spark.createDataFrame([("a b c word", "en"), ("é à", "fr"), (None, "en"), ("q", None)],
                                  "text string, lang string")
    got = langid.identify(awkward, known).collect()
    assert len(got) == len(AWKWARD)
    assert {r["doc_id"]: r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3)} == {
        1: "und", 2: "und", 3: "und"}
    assert {r["lang_pred"] for r in langid.identify(awkward, empty.select("text", "lang")).collect()} \
        == {"und"}


def test_line_dedup_generalises_fields(spark, awkward):
    texts = [(i, f"own {i}\nUser bob{i} logged in from home at  {i}:30\tsharp\n{'x y' * i}")
             for i in range(1, 6)] + [(6, None), (7, "")]
    got = by_id(lines.drop_lines(spark.createDataFrame(texts, "doc_id long, text string")))
    assert {i: r["text"] for i, r in got.items()} == kept(texts)
    assert [got[i]["n_dropped"] for i in range(1, 8)] == [0, 1, 1, 1, 1, 0, 0]
    assert lines.drop_lines(awkward).count() == len(AWKWARD)


def test_line_dedup_drops_short_lines(spark):
    texts = [(i, f"Les.\n日本語の行です\nown{'x' * i}\nAll rights reserved.\nPage {i}\n{i}\n")
             for i in range(1, 5)]
    got = by_id(lines.drop_lines(spark.createDataFrame(texts, "doc_id long, text string")))
    assert got[1]["text"] == texts[0][1]
    assert {i: got[i]["text"] for i in (2, 3, 4)} == {
        i: f"own{'x' * i}\nPage {i}\n{i}\n" for i in (2, 3, 4)}


def kept(texts):
    """{id: kept text} by the definition with lines of any length and relative constants."""
    found, docs_of = [], defaultdict(set)
    for i, text in texts:
        for k, line in enumerate((text or "").split("\n")):
            w = tuple(lines.FIELD if re.search("[0-9]", x) else x for x in line.split())
            if w:
                found.append((i, k, (len(w), w[:3]), w))
                docs_of[found[-1][2]].add(i)
    found = [x for x in found if len(docs_of[x[2]]) >= 3]
    owners, tokens = defaultdict(set), Counter()
    for i, _, leaf, w in found:
        owners[leaf, w].add(i)
    for (leaf, w), own in owners.items():
        for at, x in enumerate(w):
            if x != lines.FIELD:
                tokens[leaf, at, x] += len(own)
    sharing, places, form = defaultdict(set), defaultdict(list), {}
    for leaf, w in owners:
        often = [tokens[leaf, at, x] for at, x in enumerate(w)]
        needed = max(min(4, len(w)), math.ceil(0.7 * len(w)))
        solid = sorted(often, reverse=True)[needed - 1]
        if solid >= 3:
            form[leaf, w] = leaf, tuple(x if n >= 3 and 10 * n >= solid else lines.FIELD
                                        for x, n in zip(w, often))
    for i, k, leaf, w in found:
        if (leaf, w) in form:
            sharing[form[leaf, w]].add(i)
            places[form[leaf, w]].append((i, k))
    gone = {p for f, own in places.items() if len(sharing[f]) >= 3 for p in sorted(own)[1:]}
    return {i: t and "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone)
            for i, t in texts}


def test_line_dedup_of_all_lines(spark, docs):
    got = by_id(queries.QUERIES["op1_log_templates"](spark, SF))
    assert {i: r["text"] for i, r in got.items()} == kept(docs)


def name(k):
    return "v" + "".join(chr(97 + int(x)) for x in str(k))


@pytest.mark.parametrize("n", [50, 1000, 40000])
def test_line_dedup_generalises_frequent_values(spark, n):
    """Fields without digits, each with 200 values, in a leaf that others share."""
    rng = np.random.default_rng(3)
    pairs = rng.integers(0, 200, (n, 2))
    texts = [(i, f"please note that user {name(a)} from {name(b)} has signed in here today")
             for i, (a, b) in enumerate(pairs)]
    texts += [(n + i, "please note that all of these books were printed in London again")
              for i in range(4)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    left = [r["doc_id"] for r in lines.drop_lines(df).filter("n_dropped = 0").collect()]
    assert sorted(left) == [0, n]


def check_shards(rows, texts, most):
    sizes = Counter()
    for s in range(24):
        own = [r for r in rows if r["shard"] == s]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        sizes[s] = sum(r["size"] for r in own)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * most
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter(
        (i, len((t or "").encode()) + 8) for i, t in texts)


def test_sharding(spark, docs):
    rows = queries.QUERIES["op10_histogram_sort"](spark, SF).collect()
    check_shards(rows, docs, max(len(t.encode()) for _, t in docs))
    texts = dict(docs)
    assert all(r["text_crc32"] == B.crc(texts[r["doc_id"]]) for r in rows)


def test_sharding_splits_a_hot_text_and_takes_awkward_rows(spark, awkward):
    texts = [(i, "same text" if i % 3 else f"text {i}") for i in range(3000)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    check_shards(sharding.shard_by_bytes(df).collect(), texts, 100)
    assert sharding.shard_by_bytes(awkward).count() == len(AWKWARD)


def test_empty_tables(spark, empty):
    bench = spark.createDataFrame([], "item_id long, text string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    for df in (lines.drop_lines(empty), lm.score(empty, F.lit(0)),
               packing.pack(empty, packing.vocabulary_path()), pii.extract(empty),
               langid.identify(empty, empty), jaccard.join_groups(empty),
               topk.top_k(vectors, vectors), decontaminate.decontaminate(empty, bench),
               sharding.shard_by_bytes(empty)):
        assert df.count() == 0


def test_awkward_rows_are_scored_and_packed(awkward):
    assert lm.score(awkward, F.lit(0)).count() == len(AWKWARD)
    assert packing.pack(awkward, packing.vocabulary_path()).select(
        "doc_id", "doc_tokens").distinct().count() == len(AWKWARD) - 1


def test_pipeline_keeps_clean_documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    assert corpus_pipeline.STAGES[0][1](spark, rows, SF).count() == rows.count()
    kept = corpus_pipeline.STAGES[2][1](spark, rows, SF)
    groups = B.components([(r["doc_id"], r["text"]) for r in rows.collect()])
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(
        i for i, (_, least) in groups.items() if i == least)
    assert kept.columns == rows.columns
    clean = corpus_pipeline.STAGES[3][1](spark, kept, SF)
    marked = by_id(queries.QUERIES["op9_winnowing"](spark, SF))
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(
        r["doc_id"] for r in kept.collect() if not marked[r["doc_id"]]["contaminated"])


def test_pipeline_runs_as_a_whole(spark, tmp_path):
    """All stages over the smallest table, with awkward rows and columns."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit("own"))
    odd = [(-1, None), (-2, ""), (-3, " "), (-4, "A b"), (-4, "A b"), (None, "A text without id")]
    more = spark.createDataFrame([(i, t, "en", None, 1, "own") for i, t in odd], rows.schema)
    for name, df in (("documents", rows.union(more)),
                     ("benchmark", spark.read.parquet(f"{SF}/benchmark.parquet"))):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r["length"] for r in out)[-1] <= packing.WINDOW
    whole = {}
    for r in out:
        whole.setdefault((r["doc_id"], r["doc_tokens"]), 0)
        whole[r["doc_id"], r["doc_tokens"]] += r["length"]
    assert all(n % key[1] == 0 for key, n in whole.items())
    ids = {r["doc_id"] for r in out}
    assert not ids & {-1, -2, -3} and len(ids) > 100


def test_native_operators_run_no_python(spark):
    for name in ("op4_bootstrapped_contexts", "op7_content_parts", "op9_winnowing",
                 "op10_histogram_sort"):
        plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
    assert common.UPPER.lower() == common.LOWER


def peak(run):
    """(result, bytes allocated at most while it runs)."""
    tracemalloc.start()
    try:
        out = run()
        return out, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_arrays_are_unpacked_and_placed_in_little_memory():
    values = np.random.default_rng(1).integers(0, 2 ** 63, 400_000, dtype=np.uint64)
    blob = blobs.pack(values, np.uint64)
    out, most = peak(lambda: blobs.unpack(blob, np.uint64))
    assert (out == values).all() and most < 1.5 * values.nbytes
    keys, place = np.unique(values % np.uint64(1000), return_inverse=True)
    ours = blobs.places(values % np.uint64(1000))
    assert (ours[0] == keys).all() and (ours[1] == place).all()
    assert [len(x) for x in blobs.places(values[:0])] == [0, 0]


def test_tasks_leave_no_free_memory_behind():
    if blobs._libc() is None:
        pytest.skip("this C library keeps what is free")

    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")

    def fill(n):
        held = [np.ones(2000, np.uint8) for _ in range(n)]
        kept.append(held[-1])  # above the others: they stay with the process
        return n

    kept, start = [], resident()
    assert list(blobs.lean(lambda batches: map(fill, batches))([50_000])) == [50_000]
    assert resident() - start < 50e6  # 100 MB without
    assert blobs.lean_group(lambda key, rows: fill(rows))(0, 50_000) == 50_000
    assert blobs.lean_cogroup(lambda key, left, right: fill(left))(0, 50_000, 1) == 50_000
    assert resident() - start < 50e6


def test_tasks_of_the_join_and_the_language_model_are_lean(spark, monkeypatch, awkward):
    def noted(wrap):
        def lean(run):
            names.append(run.__qualname__.split(".")[0])
            return wrap(run)
        return lean

    names = []
    for module, wraps in ((jaccard, ("lean", "lean_group")),
                          (lm, ("lean", "lean_group", "lean_cogroup"))):
        for wrap in wraps:
            monkeypatch.setattr(module, wrap, noted(getattr(module, wrap)))
    assert jaccard.join_groups(awkward).count() == lm.score(awkward, F.lit(0)).count()
    assert {"_chunked", "_opened", "_members", "_shared", "_chunks", "_counted", "_expectation",
            "_scored"} <= set(names)
    assert names.count("_asked") == names.count("_answer") == 2


def test_chunks_of_the_language_model_read_few_texts_at_once():
    import pyarrow as pa
    n = 10 * lm.ROWS
    batch = pa.record_batch([pa.array(range(n)), pa.array(["x" * 4000] * n),
                             pa.array(np.zeros(n, np.int32))], names=["id", "text", "fold"])
    chunk, most = peak(lambda: next(lm._chunks(10 ** 9, 2)([batch])).to_pylist()[0])
    assert blobs.unpack(chunk["sizes"], np.uint32).tolist() == [2] * n
    assert most < batch.nbytes / 2


def test_grams_of_a_chunk_take_little_memory():
    rng = np.random.default_rng(2)
    tokens = rng.integers(0, 5000, 400_000).astype(np.uint32)
    row = SimpleNamespace(
        sizes=blobs.pack(np.full(400, 1000), np.uint32), folds=blobs.pack(np.zeros(400), np.uint8),
        tokens=blobs.pack(tokens, np.uint32),
        words=rng.integers(0, 2 ** 63, 5000, dtype=np.uint64).tobytes())
    chunk = lm.Chunk(row)
    (keys, place), most = peak(lambda: chunk.distinct(2))
    assert most < 45 * len(tokens)  # 65 with np.unique
    before = chunk.vocabulary[tokens]
    grams = blobs.mix(chunk.shifted(before, lm._START), before)
    assert (keys[place] == grams).all() and (np.diff(keys) > 0).all()


def test_chunks_and_sets_of_the_join_move_once(spark, monkeypatch):
    """They are read by buckets of their key: no measurement shuffles all sets again."""
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame(
        [(1, " ".join(words)), (2, " ".join([*words[:-1], "other"])), (3, None)],
        "doc_id long, text string")
    met, measure, regions = [], jaccard.measure, jaccard.regions

    def seen(frame, key):
        met.append(frame.groupBy(key).count()._jdf.queryExecution().executedPlan().toString())

    monkeypatch.setattr(jaccard, "measure", lambda pairs, sets: (
        seen(sets, "class"), measure(pairs, sets))[1])
    monkeypatch.setattr(jaccard, "regions", lambda chunks, *rest: (
        seen(chunks, "chunk"), regions(chunks, *rest))[1])
    rows = jaccard.join_groups(docs).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in rows) == [(1, 1), (2, 1), (3, 3)]
    assert len(met) > 1 and not any("Exchange" in plan for plan in met)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("lendmart_")]


def test_chunks_of_the_join_and_their_counts_take_little_memory():
    import pandas as pd
    import pyarrow as pa
    words = np.random.default_rng(3).integers(0, 2 ** 60, (400, 500))
    texts = [" ".join(map(str, row)) for row in words]
    batch = pa.record_batch([pa.array(range(400)), pa.array(range(400)), pa.array(texts)],
                            names=["doc_id", "t", "text"])
    chunk, most = peak(lambda: next(jaccard._chunked(5, 150_000)([batch])).to_pylist()[0])
    assert chunk["n_keys"] == 400 * 496
    assert most < 150 * chunk["n_keys"]  # 201 with words remembered
    keys = blobs.unpack_sorted(chunk["keys"])
    assert (np.diff(keys) > 0).all() and set(blobs.unpack(chunk["times"], np.uint32)) == {1}

    cuts = [keys[:150_000], keys[50_000:]]
    times = [np.arange(len(k), dtype=np.uint32) % np.uint32(7) + np.uint32(1) for k in cuts]
    times[0][60_000] = 2 ** 32 - 1  # with the other's, beyond 32 bits
    asked = pd.DataFrame({"chunk": [1, 2], "keys": [blobs.pack_sorted(k) for k in cuts],
                          "times": [blobs.pack(x, np.uint32) for x in times]})
    out, most = peak(lambda: jaccard._answer((0,), asked))
    assert most < 33 * sum(map(len, cuts))  # 38 with places and float sums
    want = np.zeros(len(keys), np.uint64)
    want[:150_000] += times[0]
    want[50_000:] += times[1]
    want = np.minimum(want, 2 ** 32 - 1)
    for got, part in zip(out["sums"], (want[:150_000], want[50_000:])):
        assert (blobs.unpack(got, np.uint32) == part).all()


def test_runs_of_equal_keys(monkeypatch):
    keys = np.sort(np.random.default_rng(4).integers(0, 50, 1000).astype(np.uint64))
    want = np.unique(keys, return_counts=True)
    for part in (1, 7, 1 << 20):  # runs cross the parts
        monkeypatch.setattr(jaccard, "PART", part)
        for one, other in zip(jaccard._runs(keys.copy()), want):
            assert (one == other).all()
        assert [len(x) for x in jaccard._runs(keys[:0].copy())] == [0, 0]
