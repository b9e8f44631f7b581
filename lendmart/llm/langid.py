"""Language identification as multilingual mixture inference.

Every learned language has a distribution over hashed character n-grams of a bounded
number of buckets. A document's n-grams are a mixture of languages: expectation
maximisation estimates its proportions; languages are added in the order of their
proportions while the likelihood gains more than the penalty of one more language
(half the logarithm of the number of n-grams, times ``penalty``). The prediction is the
largest proportion within the chosen set.

Training reads a bounded sample of labelled rows: about ``TRAIN_ROWS`` per language,
those with the smallest hashes of text, so it does not grow with the input; a language's
rows with fewer are all used. The model is languages x buckets numbers.

Null texts and texts without a letter are ``und`` with score 0, as is everything if nothing
was learned. Rows with a null or empty language teach nothing. Input columns pass through;
one with the name of a result is replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lendmart.llm.common import remainder, table, unpacked

TRAIN_ROWS = 4000
BUCKETS_BITS, ORDERS, SMOOTHING = 15, (1, 2, 3, 4), 0.5
STEPS, PENALTY = 12, 4.0
UNKNOWN = "und"


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of the UTF-8 bytes of the lower-cased letters and spaces,
    with their counts."""
    letters = "".join(c if c.isalpha() else " " for c in text.lower()) \
        if not text.isalpha() else text.lower()
    data = np.frombuffer(" ".join(letters.split()).encode("utf-8", "replace"), np.uint8)
    data = np.concatenate([[32], data, [32]]).astype(np.uint32)
    found, value = [], np.zeros(len(data), np.uint32)
    for order in range(1, max(ORDERS) + 1):
        value = (value[:len(data) - order + 1] << np.uint32(8)) | data[order - 1:]
        if len(value) == 0:
            break
        if order in ORDERS:
            found.append(((value ^ np.uint32(order * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B))
                         >> np.uint32(32 - BUCKETS_BITS))
    counts = np.bincount(np.concatenate(found), minlength=1 << BUCKETS_BITS)
    seen = np.flatnonzero(counts)
    return seen, counts[seen].astype(float)


def _totals(batches):
    """Per language, the counts of a task's rows as one array."""
    sums: dict[str, np.ndarray] = {}
    for pdf in batches:
        for text, lang in zip(pdf["text"], pdf["lang"]):
            seen, n = ngrams(text)
            own = sums.setdefault(lang, np.zeros(1 << BUCKETS_BITS))
            own[seen] += n
    for lang, own in sums.items():
        seen = np.flatnonzero(own)
        yield pd.DataFrame({"lang": lang, "bucket": seen.astype("int32"), "n": own[seen]})


def train(labelled: DataFrame, rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray]:
    """(languages, log probability by language and bucket) from columns text and lang."""
    usable = labelled.filter("text IS NOT NULL AND lang IS NOT NULL AND lang <> ''") \
        .withColumn("h", F.pmod(F.xxhash64("text", F.lit(5)), F.lit(1 << 30)))
    counted = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not counted:
        return [], np.zeros((0, 1 << BUCKETS_BITS))
    keep = F.lit(False)
    for lang, n in counted.items():
        keep = keep | (F.col("lang") == lang) & (F.col("h") < int((1 << 30) * min(1, rows / n)))
    sums = usable.filter(keep).select("text", "lang").mapInPandas(
        _totals, "lang string, bucket int, n double").groupBy("lang", "bucket").agg(
            F.sum("n").alias("n")).toPandas()  # languages x buckets at most
    langs = sorted(counted)
    table_ = np.full((len(langs), 1 << BUCKETS_BITS), SMOOTHING)
    at = {lang: i for i, lang in enumerate(langs)}
    table_[sums["lang"].map(at).to_numpy(), sums["bucket"].to_numpy()] += sums["n"].to_numpy()
    return langs, np.log(table_ / table_.sum(axis=1, keepdims=True))


def _fit(p: np.ndarray, n: np.ndarray, steps: int) -> tuple[np.ndarray, float]:
    """Proportions and log likelihood of a mixture of the rows of ``p`` for counts ``n``."""
    share = np.full(len(p), 1 / len(p))
    for _ in range(steps if len(p) > 1 else 0):
        share = share * (p @ (n / (share @ p))) / n.sum()
    return share, float(n @ np.log(share @ p))


def infer(logs: np.ndarray, text: str, steps: int = STEPS,
          penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the chosen languages, largest proportion first, and proportions."""
    seen, n = ngrams(text)
    own = logs[:, seen]
    top = own.max(axis=0)
    p = np.exp(own - top)  # a factor per n-gram changes no proportion and no comparison
    shares, _ = _fit(p, n, steps)
    # the best single language and then the others by their share of the full mixture
    first = int(np.argmax(own @ n))
    order = [first, *[i for i in np.argsort(-shares, kind="stable") if i != first]]
    chosen, best = order[:1], _fit(p[order[:1]], n, steps)
    for k in range(2, len(order) + 1):
        more = _fit(p[order[:k]], n, steps)
        if more[1] - best[1] <= penalty * 0.5 * np.log(n.sum()):
            break
        chosen, best = order[:k], more
    rank = np.argsort(-best[0], kind="stable")
    return np.array(chosen)[rank], best[0][rank]


def _predict(langs: list[str], logs: np.ndarray):
    def one(text):
        if text is None or not langs or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, "", 0
        chosen, share = infer(logs, text)
        return (langs[chosen[0]], float(min(1.0, share[0])),
                ",".join(f"{langs[i]}:{s:.3f}" for i, s in zip(chosen, share)), len(chosen))

    @F.pandas_udf("lang_pred string, score double, languages string, n_languages int")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(t) for t in texts],
                            columns=["lang_pred", "score", "languages", "n_languages"])

    return predict


def identify(df: DataFrame, labelled: DataFrame, text: str = "text") -> DataFrame:
    """The rows with ``lang_pred``, ``score``, ``languages`` (the chosen ones with their
    proportions) and ``n_languages``; learned from ``labelled`` (text, lang)."""
    langs, logs = train(labelled)
    rows = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)],
                     _predict(langs, logs)(F.col(text)).alias("found"))
    return unpacked(rows, df.columns, **{
        c: F.col(f"found.{c}") for c in ("lang_pred", "score", "languages", "n_languages")})


def op5_mixture(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", (remainder("doc_id", 5) == 0).alias("held_out"))
    out = identify(docs.select("doc_id", "text", "held_out"),
                   docs.filter(~F.col("held_out")).select("text", "lang"))
    return out.select("doc_id", "held_out", "lang_pred", "score", "languages", "n_languages")
