"""Personal data by bootstrapped contextual extraction.

Base entities (e-mail, IP address, card, phone) are found by pattern and are the seeds.
Every seed, and every other token with a digit or ``@``, is an instance that occurs with
lexical patterns: the word before or the words around it, together with a coarse class of
the instance (mail-like, with letters, long or short number). Scores then pass over the
graph of patterns and instances:

    pattern   = weight of its instances believed to be of its kind
                / (weight of its instances believed to be of any kind + 1)
    instance  = 1 for a seed, else its best trusted pattern's score, of that one's kind

A pattern is trusted with enough distinct believed instances and a high score. Instances
that nothing is known of yet do not count against it: they are what it is to find. After
the last round the trusted patterns' instances that no base span covers are reported as
spans of the pattern's kind. Base spans always stay.

Offsets are code points, end exclusive. Null and empty texts have no spans. Rows equal in
id and text get equal results. Results carry the id and the hash of the text; other input
columns are not read. Everything is column expressions; texts are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lendmart.llm.common import same_key, table, whole
from lendmart.sources.snapshots import stage

KINDS = ("email", "ip", "card", "phone")
ROUNDS, MIN_SEEDS, TRUST = 3, 5, 0.9

# The base patterns. The look-behind allows a match to begin only where a run begins or the
# last match ended; elsewhere in a run it would fail as it failed at its beginning, so
# matches are the same and long runs take linear time. Repeated groups are possessive,
# which Java runs as a loop.
_LOCAL, _DOMAIN = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}+@{_DOMAIN}+(?:\.{_DOMAIN}+)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = r"[^\s,;|<>\"'()\[\]{}]"
TOKEN = (rf"(?:(?<!{_PART})|\G)[^\s,;|<>\"'()\[\]{{}}0-9@]*+[0-9@](?:{_PART}*[0-9\p{{L}}])?")
#: A cheap condition without which a pattern cannot match.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}",
         "phone": r"\+[0-9]"}
_INSTANCE = ("array<struct<kind:int,start:int,end:int,token:string,left:string,"
             "right:string>>")
_BLOCK = 256


def luhn(digits: Column) -> Column:
    """Whether the digits' Luhn sum is a multiple of ten."""
    n = F.length(digits)

    def add(total, i):
        digit = F.substr(digits, n - i + 1, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(found, r"\."), lambda part: F.coalesce(
            part.try_cast("decimal(38,0)") <= 255, F.lit(False)))
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _sums(numbers: Column) -> Column:
    """0 and the running sums of an array. Each step copies what it has, so this is for
    short arrays."""
    return F.aggregate(numbers, F.array(F.lit(0)),
                       lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + x))


def _running(numbers: Column) -> Column:
    """Running sums of an array of any length, block by block."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / _BLOCK).cast("int")),
        lambda b: F.slice(numbers, b * _BLOCK + 1, F.lit(_BLOCK)))
    inner = F.transform(blocks, _sums)
    before = F.slice(_sums(F.transform(inner, lambda s: F.element_at(s, -1))), F.lit(1),
                     F.size(inner))
    return F.flatten(F.zip_with(inner, before, lambda s, add: F.transform(
        F.slice(s, F.lit(2), F.greatest(F.size(s) - 1, F.lit(0))), lambda x: x + add)))


def _blank(piece: Column) -> Column:
    return F.translate(piece, "\n\r\t", "   ")


def _last_word(piece: Column) -> Column:
    return F.lower(F.substring_index(F.rtrim(_blank(F.right(piece, F.lit(80)))), " ", -1))


def _first_word(piece: Column) -> Column:
    return F.lower(F.substring_index(F.ltrim(_blank(F.left(piece, F.lit(80)))), " ", 1))


def _located(rows: DataFrame, out: str, kind: int, pattern: str, needs: str,
             valid=None) -> DataFrame:
    """Adds the matches of a pattern: [{kind, start, end, token, left, right}].

    Pieces between matches and matches alternate, so adding up their lengths gives the
    offsets. ``left`` and ``right`` are the neighbouring words within the adjoining
    pieces, looking at 80 characters.
    """
    here = F.regexp_like("text", F.lit(needs))
    rows = rows.withColumns({
        "found": F.when(here, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))),
        "pieces": F.when(here, F.split("text", pattern, -1))})
    rows = rows.withColumn("ends", F.when(F.size("found") > 0, _running(F.zip_with(
        F.slice("pieces", F.lit(1), F.size("found")), F.col("found"),
        lambda p, m: F.char_length(p) + F.char_length(m)))))
    spans = F.transform("found", lambda m, i: F.struct(
        F.lit(kind).alias("kind"), (F.get("ends", i) - F.char_length(m)).alias("start"),
        F.get("ends", i).alias("end"), m.alias("token"),
        _last_word(F.get("pieces", i)).alias("left"),
        _first_word(F.get("pieces", i + 1)).alias("right")))
    if valid is not None:
        spans = F.filter(spans, lambda s: valid(s["token"]))
    return rows.withColumn(out, F.when(F.size("found") > 0, spans).otherwise(
        F.array().cast(_INSTANCE))).drop("found", "pieces", "ends")


def instances(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``base`` spans, and ``other`` tokens that no base span covers."""
    rows = df.select(F.col(doc_id).alias("d"), F.xxhash64(whole(text)).alias("t"),
                     whole(text).alias("text"))
    for at, kind in enumerate(KINDS):
        rows = _located(rows, kind, at, PATTERNS[kind], NEEDS[kind],
                        lambda token, kind=kind: _valid(kind, token))
    rows = _located(rows, "token", len(KINDS), TOKEN, "[0-9@]")
    rows = rows.select("d", "t", F.array_sort(F.concat(*KINDS), _in_order).alias("base"), "token")
    return rows.select("d", "t", "base", F.filter("token", lambda s: ~F.exists(
        "base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))).alias("other"))


def _in_order(a: Column, b: Column) -> Column:
    """By start, then kind as listed, then end."""
    def less(x, y):
        return ((x["start"] < y["start"]) | (x["start"] == y["start"])
                & ((x["kind"] < y["kind"]) | (x["kind"] == y["kind"]) & (x["end"] < y["end"])))
    return F.when(less(a, b), -1).when(less(b, a), 1).otherwise(0)


def _class(token: Column) -> Column:
    """What a token looks like, roughly: base entities are mail-like or long numbers, which
    are those of seven digits or four groups."""
    digits = F.length(F.regexp_replace(token, "[^0-9]", ""))
    return F.when(F.contains(token, F.lit("@")), "@").when(
        F.regexp_like(token, F.lit(r"\p{L}")), "a").when(
        (digits >= 7) | F.regexp_like(token, F.lit(r"(?:[0-9]+[^0-9]+){3}[0-9]")), "9").otherwise("1")


def _occurrences(found: DataFrame) -> DataFrame:
    """A row for each instance occurrence and pattern."""
    each = found.select("d", "t", F.explode(F.concat("base", "other")).alias("s")).select(
        "d", "t", "s.*").withColumn("class", _class(F.col("token")))
    patterns = F.array(F.concat_ws("\x1f", F.lit("L"), "left", "class"),
                       F.concat_ws("\x1f", F.lit("B"), "left", "right", "class"))
    return each.select("d", "t", "kind", "start", "end",
                       F.xxhash64(F.lower("token")).alias("instance"),
                       F.explode(patterns).alias("pattern"))


def trusted_patterns(graph: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS,
                     trust: float = TRUST) -> DataFrame:
    """(pattern, kind, score) of the patterns to believe.

    ``graph``: one row (pattern, instance, kind) per pair, kind null where the instance is
    no seed. Each round is a few grouped sums; a frequent pattern or instance reaches the
    shuffle as one row per task.
    """
    believed = graph.filter("kind IS NOT NULL").select("pattern", "kind", F.lit(1.0).alias("weight"))
    for last in [False] * (rounds - 1) + [True]:
        by_kind = believed.groupBy("pattern", "kind").agg(
            F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("n"))
        top = F.max(F.struct("weight", (-F.col("kind")).alias("kind"), "n")).alias("top")
        scores = by_kind.groupBy("pattern").agg(F.sum("weight").alias("all"), top).select(
            "pattern", (-F.col("top.kind")).alias("kind"), F.col("top.n").alias("n"),
            (F.col("top.weight") / (F.col("all") + 1)).alias("score"))
        scores = stage(scores.filter((F.col("n") >= min_seeds) & (F.col("score") >= trust))
                       .select("pattern", "kind", "score"))
        if last:
            return scores
        found = graph.filter("kind IS NULL").select("pattern", "instance")
        best = found.join(scores, "pattern").groupBy("instance").agg(
            F.max(F.struct("score", (-F.col("kind")).alias("kind"))).alias("best"))
        believed = graph.filter("kind IS NOT NULL").select(
            "pattern", "kind", F.lit(1.0).alias("weight")).unionByName(
            found.join(best, "instance").select("pattern", (-F.col("best.kind")).alias("kind"),
                                                F.col("best.score").alias("weight")))


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def extract(df: DataFrame, doc_id: str = "doc_id", text: str = "text",
            rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS,
            trust: float = TRUST) -> DataFrame:
    """The rows with ``base`` and ``spans``: arrays of {kind, start, end}, kind as its place
    in ``KINDS``; ``spans`` has the discovered ones too."""
    found = stage(instances(df, doc_id, text))
    occurring = _occurrences(found)
    pairs = stage(occurring.groupBy("pattern", "instance").agg(F.min(
        F.when(F.col("kind") < len(KINDS), F.col("kind"))).alias("kind")))
    trusted = trusted_patterns(pairs, rounds, min_seeds, trust)
    more = (occurring.filter(F.col("kind") == len(KINDS)).drop("kind")
            .join(trusted, "pattern").groupBy("d", "t", "start", "end")
            .agg(F.max(F.struct("score", -F.col("kind"))).alias("best"))
            .groupBy("d", "t").agg(F.collect_list(F.struct(
                (-F.col("best.col2")).alias("kind"), "start", "end")).alias("more")))
    plain = F.transform("base", lambda s: F.struct(s["kind"], s["start"], s["end"]))
    rows = found.select("d", "t", plain.alias("base"))
    joined = rows.join(more, same_key(rows, more), "left").select(
        rows["d"], rows["t"], "base", F.array_sort(F.concat(
            "base", F.coalesce("more", F.array().cast("array<struct<kind:int,start:int,end:int>>"))),
            _in_order).alias("spans"))
    return joined


def op4_bootstrapped_contexts(spark, sf_dir: str) -> DataFrame:
    out = extract(table(spark, sf_dir, "documents"))

    def count(at):
        return F.size(F.filter("base", lambda s: s["kind"] == at)).cast("long")

    return out.select(F.col("d").alias("doc_id"),
                      *[count(at).alias(f"n_{kind}") for at, kind in enumerate(KINDS)],
                      F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
                      _written(F.col("spans")).alias("spans"))
