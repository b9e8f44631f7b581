"""Language-model scoring by deleted interpolation.

P(w | context) mixes the maximum-likelihood estimates of the n-gram and of all shorter
n-grams with a uniform share. The weight of an order depends on the bucket of its
context's frequency (by powers of two) and is learned by expectation maximisation on the
counts of a deleted part of the training documents, against counts without that part.

How it runs: tasks turn documents into chunks of token numbers, which are written out. A
chunk asks for the counts of its distinct n-grams, in compact blobs by ranges of the hash;
a range adds up what all chunks ask about and answers each. So every count covers all
training documents, a frequent n-gram costs one entry per chunk, and no table of n-grams
is ever held by one task or the driver, which gets only totals and weights. N-grams are
known by 64-bit hashes.

Null texts count as empty: one end token. A null id counts as empty text for the folds.
Every row is a document of its own, repeated or not. Without training tokens, all
probability is uniform. An empty table gives no rows. Other input columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from lendmart.llm.blobs import (lean, lean_cogroup, lean_group, mix, pack, pack_counts,
                                pack_sorted, places, unpack, unpack_counts, unpack_sorted)
from lendmart.llm.common import release, remainder, table, whole
from lendmart.sources.snapshots import stage

ORDER = 2
CHUNK_TOKENS = 2_000_000
RANGE_GRAMS = 1_000_000   # n-grams a range of hashes adds up, about
BUCKETS, STEPS = 24, 12
ROWS = 500                # documents that a task has as Python texts at once
SLICE = 200_000           # positions whose probabilities are computed at once
KEPT, DELETED, HELD_OUT = 0, 1, 2
NO_ID = 4                 # added to the fold of a row without an id
CHUNK = ("chunk long, ids binary, folds binary, sizes binary, tokens binary, "
         "words binary, n_grams long")


def words(text: str) -> list[bytes]:
    """ASCII-lower-cased words between ASCII white space."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def _hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


_END = xxhash.xxh3_64_intdigest(b"", seed=1)    # no word is empty
_START = np.uint64(xxhash.xxh3_64_intdigest(b"", seed=2))


class _Numbers(dict):
    """Consecutive numbers for words as they come; 0 is the end token."""

    def __missing__(self, word):
        self[word] = n = len(self) + 1
        return n


def _chunks(limit: int, order: int):
    def flush(ids, folds, tokens, numbers):
        sizes = np.array([len(t) for t in tokens], np.uint32)
        flat = np.concatenate(tokens)
        hashes = np.fromiter((_hash(w) for w in numbers), np.uint64, len(numbers))
        name = xxhash.xxh3_64(flat.tobytes())
        name.update(repr((ids, folds)).encode())
        return pd.DataFrame({
            "chunk": [name.intdigest() >> 1],
            "ids": [pack(np.array([i or 0 for i in ids]), np.int64)],
            "folds": [pack(np.array(folds) + [NO_ID * (i is None) for i in ids], np.uint8)], "sizes": [pack(sizes, np.uint32)],
            "tokens": [pack(flat, np.uint32)],
            "words": [np.insert(hashes, 0, np.uint64(_END)).tobytes()],
            "n_grams": [len(hashes) + 1 + len(flat) * (order - 1)]})

    def run(batches):
        ids, folds, tokens, numbers, n, part = [], [], [], _Numbers(), 0, 0
        parts = (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS))
        for part in parts:
            for doc, text, fold in zip(*(c.to_pylist() for c in part.columns)):
                own = np.fromiter(map(numbers.__getitem__, words(text)), np.uint32)
                ids.append(doc)
                folds.append(fold)
                tokens.append(np.append(own, np.uint32(0)))
                n += len(own) + 1
                if n >= limit:
                    yield flush(ids, folds, tokens, numbers)
                    ids, folds, tokens, numbers, n = [], [], [], _Numbers(), 0
        if ids:
            yield flush(ids, folds, tokens, numbers)

    def arrow(batches):
        import pyarrow as pa
        for pdf in run(batches):
            yield pa.RecordBatch.from_pandas(pdf, preserve_index=False)

    return arrow


class Chunk:
    """A chunk's tokens, and the hashes of its n-grams by position."""

    def __init__(self, row):
        self.sizes = unpack(row.sizes, np.uint32).astype(np.int64)
        self.tokens = unpack(row.tokens, np.uint32)
        self.vocabulary = np.frombuffer(row.words, np.uint64)
        self.fold = np.repeat(unpack(row.folds, np.uint8) % NO_ID, self.sizes)
        self.first = np.cumsum(self.sizes) - self.sizes

    def shifted(self, values: np.ndarray, at_start):
        """A position's value of the position before it in its document."""
        out = np.roll(values, 1)
        out[self.first] = at_start
        return out

    def distinct(self, order: int):
        """(ascending distinct hashes, the place of each position's n-gram among them)."""
        if order == 1:
            rank = np.argsort(self.vocabulary)
            place = np.empty(len(rank), np.uint32)  # as tokens are numbered
            place[rank] = np.arange(len(rank))
            return self.vocabulary[rank], place[self.tokens]
        grams = before = self.vocabulary[self.tokens]
        for _ in range(order - 1):
            before = self.shifted(before, _START)
            grams = mix(before, grams)
        del before
        return places(grams)


def _asked(order: int, ranges: int):
    """Rows (range, chunk, order, keys, kept, deleted): what a chunk has and asks."""
    def run(batches):
        for pdf in batches:
            for row in pdf.itertuples():
                chunk = Chunk(row)
                for k in range(1, order + 1):
                    keys, place = chunk.distinct(k)
                    kept, deleted = (
                        np.bincount(place[chunk.fold == f], minlength=len(keys)).astype(np.uint32)
                        for f in (KEPT, DELETED))
                    del place
                    cuts = np.searchsorted((keys >> np.uint64(32)).astype(np.int64),
                                           [(i << 32) // ranges for i in range(ranges + 1)])
                    out = []
                    for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                        if b > a:
                            out.append((i * order + k - 1, row.chunk, pack_sorted(keys[a:b]),
                                        pack(kept[a:b], np.uint32), pack(deleted[a:b], np.uint32)))
                    yield pd.DataFrame(out, columns=["range", "chunk", "keys", "kept", "deleted"])
    return run


def _answer(order: int):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        keys = [unpack_sorted(b) for b in pdf["keys"]]
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        keys = np.concatenate(keys)
        place = places(keys)[1]
        del keys
        sums = [np.bincount(place, np.concatenate([unpack(b, np.uint32) for b in pdf[c]]))
                .astype(np.uint64) for c in ("kept", "deleted")]
        known = sums[0] + sums[1]
        out = pd.DataFrame({
            "chunk": pdf["chunk"].to_numpy(), "order": int(key[0]) % order + 1,
            "range": int(key[0]) // order,
            "kept": [pack(x, np.uint64) for x in np.split(sums[0][place], cuts)],
            "deleted": [pack(x, np.uint64) for x in np.split(sums[1][place], cuts)],
            "types": 0, "tokens": 0, "lost": 0})
        if int(key[0]) % order == 0:  # words: totals on one row of the range
            out.loc[0, ["types", "tokens", "lost"]] = [int((known > 0).sum()), int(known.sum()),
                                                       int(sums[1].sum())]
        return out
    return run


def _counted(order: int, docs: int, lost_docs: int):
    """Chunks with the counts at every position: for each order the n-gram's and its
    context's, over all training documents; for deleted positions without that part."""
    def run(key, own: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        chunk, out = Chunk(next(own.itertuples())), {}
        gone = chunk.fold == DELETED
        for k in range(1, order + 1):
            place = chunk.distinct(k)[1]
            rows = answers[answers["order"] == k].sort_values("range")
            kept = _narrow(np.concatenate([unpack(b, np.uint64) for b in rows["kept"]]), docs)
            less = kept[place]
            out[f"m{k}"] = [pack_counts(less[gone])]
            if k < order:
                out[f"y{k + 1}"] = [pack_counts(
                    chunk.shifted(less, less.dtype.type(docs - lost_docs))[gone])]
            del less
            known = np.concatenate([unpack(b, np.uint64) for b in rows["deleted"]])
            known += kept
            del kept
            known = _narrow(known, docs)[place]
            del place
            out[f"n{k}"] = [pack_counts(known)]
            if k < order:
                out[f"x{k + 1}"] = [pack_counts(chunk.shifted(known, known.dtype.type(docs)))]
            del known
        return own[["ids", "folds", "sizes"]].assign(**out)
    return run


def _narrow(counts: np.ndarray, other: int) -> np.ndarray:
    """Counts in 32 bits where they and another number fit."""
    most = max(int(counts.max(initial=0)), other)
    return counts if most >> 32 else counts.astype(np.uint32)


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(context, 1)).astype(np.int64), BUCKETS - 1)


def _levels(counts: list[np.ndarray], contexts: list[np.ndarray], weights: np.ndarray,
            uniform: float, steps: list | None = None) -> np.ndarray:
    """Probability, from the uniform share up. ``steps`` gets each order's estimates,
    weights, buckets, usable places and the probability below it."""
    p = np.full(len(counts[0]), uniform)
    for k, (n, context) in enumerate(zip(counts, contexts)):
        bucket = _bucket(context)
        own = n / np.maximum(context, 1)
        a = np.where(context > 0, weights[k, bucket], 0.0)
        if steps is not None:
            steps.append((own, a, bucket, context > 0, p))
        p = a * own + (1 - a) * p
    return p


def _slices(row, count: str, context: str, order: int, total: int):
    """(counts, contexts, positions) by slices of a chunk's positions, all as floats."""
    counts = [unpack_counts(getattr(row, f"{count}{k}")) for k in range(1, order + 1)]
    contexts = [unpack_counts(getattr(row, f"{context}{k}")) for k in range(2, order + 1)]
    for at in range(0, len(counts[0]), SLICE):
        here = slice(at, at + SLICE)
        own = [c[here].astype(float) for c in counts]
        yield own, [np.full(len(own[0]), float(total)),
                    *[c[here].astype(float) for c in contexts]], here


def _expectation(order: int, weights: np.ndarray, kept: int, uniform: float):
    """Expected uses of every order, and of every order or a shorter one, by bucket."""
    def run(batches):
        uses, chances = np.zeros_like(weights), np.zeros_like(weights)
        for pdf in batches:
            for row in pdf.itertuples():
                for counts, contexts, _ in _slices(row, "m", "y", order, kept):
                    steps = []
                    p = _levels(counts, contexts, weights, uniform, steps)
                    reach = np.ones(len(p))  # posterior of using this order or a shorter one
                    for k in reversed(range(order)):
                        own, a, bucket, usable, below = steps[k]
                        here = a * own + (1 - a) * below
                        use = reach * np.divide(a * own, here, out=np.zeros(len(p)),
                                                where=here > 0)
                        uses[k] += np.bincount(bucket[usable], use[usable], BUCKETS)
                        chances[k] += np.bincount(bucket[usable], reach[usable], BUCKETS)
                        reach = reach - use
        at = np.indices(weights.shape)
        yield pd.DataFrame({"k": at[0].ravel(), "bucket": at[1].ravel(), "uses": uses.ravel(),
                            "chances": chances.ravel()})
    return run


def learn(counted: DataFrame, order: int, kept: int, uniform: float,
          steps: int = STEPS) -> np.ndarray:
    """Weights by order and bucket of the context's frequency."""
    weights = np.full((order, BUCKETS), 0.5)
    wanted = counted.select(*[f"m{k}" for k in range(1, order + 1)],
                            *[f"y{k}" for k in range(2, order + 1)])
    for _ in range(steps):
        sums = wanted.mapInPandas(
            lean(_expectation(order, weights, kept, uniform)),
            "k int, bucket int, uses double, chances double").groupBy("k", "bucket").agg(
                F.sum("uses").alias("uses"), F.sum("chances").alias("chances")).collect()
        old = weights.copy()
        for r in sums:
            if r["chances"] > 0:
                weights[r["k"], r["bucket"]] = min(r["uses"] / r["chances"], 0.9999)
        if np.abs(weights - old).max() < 1e-3:
            break
    return weights


def _scored(order: int, weights: np.ndarray, tokens: int, types: int):
    def run(batches):
        for pdf in batches:
            for row in pdf.itertuples():
                sizes = unpack(row.sizes, np.uint32).astype(np.int64)
                first = np.cumsum(sizes) - sizes
                p, base = np.empty(sizes.sum()), np.empty(sizes.sum())
                known = np.empty(len(p), bool)
                for counts, contexts, here in _slices(row, "n", "x", order, tokens):
                    p[here] = np.log10(_levels(counts, contexts, weights, 1 / (types + 1)))
                    base[here] = np.log10((counts[0] + 1) / (tokens + types + 1))
                    known[here] = counts[0] > 0
                folds = unpack(row.folds, np.uint8)
                ids = pd.array(unpack(row.ids, np.int64), dtype="Int64")
                ids[folds >= NO_ID] = pd.NA
                yield pd.DataFrame({
                    "doc_id": ids, "held_out": folds % NO_ID == HELD_OUT,
                    "n_tokens": sizes,
                    "n_known": np.add.reduceat(known, first, dtype=np.int64),
                    "train_tokens": tokens, "base_score": np.add.reduceat(base, first),
                    "score": np.add.reduceat(p, first)})
    return run


def score(df: DataFrame, fold, order: int = ORDER, doc_id: str = "doc_id", text: str = "text",
          chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """Per row of ``df``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score (log10 of the text's probability).

    ``fold``: a column that is 0 (train), 1 (train, deleted part) or 2 (held out).
    """
    chunks = stage(df.select(F.col(doc_id).cast("long").alias("id"), whole(text).alias("text"),
                             fold.cast("int").alias("fold"))
                   .mapInArrow(lean(_chunks(chunk_tokens, order)), CHUNK))
    totals = df.agg(F.count_if(fold != HELD_OUT).alias("docs"),
                    F.count_if(fold == DELETED).alias("lost")).first()
    grams = chunks.agg(F.sum("n_grams")).first()[0] or 0
    ranges = max(1, -(-grams // (RANGE_GRAMS * order)))
    asked = chunks.mapInPandas(lean(_asked(order, ranges)),
                               "range int, chunk long, keys binary, kept binary, deleted binary")
    answers = stage(asked.groupBy("range").applyInPandas(
        lean_group(_answer(order)), "chunk long, order int, range int, kept binary, "
                                    "deleted binary, types long, tokens long, lost long"))
    sums = answers.agg(F.sum("types"), F.sum("tokens"), F.sum("lost")).first()
    types, tokens, lost = (int(x or 0) for x in sums)
    release(df.sparkSession)
    fields = [f"{c}{k} binary" for k in range(1, order + 1) for c in "nm"]
    fields += [f"{c}{k} binary" for k in range(2, order + 1) for c in "xy"]
    counted = stage(chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(
        lean_cogroup(_counted(order, totals["docs"], totals["lost"])),
        "ids binary, folds binary, sizes binary, " + ", ".join(fields)))
    weights = learn(counted, order, tokens - lost, 1 / (types + 1))
    wanted = counted.select("ids", "folds", "sizes", *[f"n{k}" for k in range(1, order + 1)],
                            *[f"x{k}" for k in range(2, order + 1)])
    return wanted.mapInPandas(
        lean(_scored(order, weights, tokens, types)),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double")


def op2_deleted_interpolation(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rest = remainder("doc_id", 7)
    fold = F.when(rest == 2, HELD_OUT).when(rest == 3, DELETED).otherwise(KEPT)
    return score(docs, fold)
