"""Packing token pieces into fixed windows by non-negative least squares.

A document's ids, with one closing id, are cut where they fill whole windows; what is left
is one shorter piece. The lengths' histogram (one number per length, whatever the input's
size) is all that the driver sees: combinations of up to three lengths that fill a window
exactly are enumerated, their repeat counts solved by non-negative least squares against
the histogram and rounded down, and the residual lengths are packed greedily, longest
first. A piece finds its place from its length and its rank among the pieces of that
length; ranks are made in many small groups per length, so that no length is one task.

Null and empty texts are one closing id. Rows equal in id and text are packed each. Ties
in rank go by id and place. An empty table gives no rows. Other input columns are not
carried, as the result has a row per piece.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lendmart.llm.common import table, whole
from lendmart.sources.snapshots import stage

WINDOW, CLOSING, VOCABULARY = 2048, 1, "byte_bpe_50k.json"
GROUP_ROWS = 512      # pieces of a length that are ranked together, about
PIECE = "doc_id long, start long, length int, ids binary, doc_tokens long"


#: Texts of these characters only, without very long words, take the faster library.
PLAIN = re.compile(r"[^\t\n\r -~\xa1-\u024f]|[^\s]{1000}")


def byte_ranks(vocabulary: dict[str, int]) -> dict[bytes, int]:
    """A byte-level vocabulary by its bytes: printable Latin-1 characters stand for their
    own byte, the others for the remaining bytes in order from U+0100."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    of = {chr(b): b for b in own}
    of.update({chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in own)})
    return {bytes(of[c] for c in token): i for token, i in vocabulary.items()
            if all(c in of for c in token)}


class Encoder:
    """Ids of texts by the vocabulary file of a byte-level tokenizer.

    Two libraries read the same file and apply the same merges: plain Latin text goes to
    the one that is several times faster, everything else to the file's own.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        with open(path, encoding="utf-8") as file:
            ranks = byte_ranks(json.load(file)["model"]["vocab"])
        ranks = {k: v for k, v in ranks.items() if k != b"<|endoftext|>"}
        self.plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN,
                                       mergeable_ranks=ranks, special_tokens={})
        self.path, self.own = path, None

    def _any(self, text: str) -> list[int]:
        if self.own is None:
            from tokenizers import Tokenizer
            self.own = Tokenizer.from_file(self.path)
            self.own.encode_special_tokens = True
        return self.own.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(self._any(t) if PLAIN.search(t) else self.plain.encode_ordinary(t),
                         dtype=np.uint32) for t in texts]


def _tokenised(path: str, window: int, closing: int, width: type):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()),
                        ("ids", pa.binary()), ("doc_tokens", pa.int64())])

    def run(batches):
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder(path)
            for at in range(0, batch.num_rows, 500):
                docs, texts = (c.to_pylist() for c in batch.slice(at, 500).columns)
                rows = [[] for _ in schema]
                for doc, ids in zip(docs, encoder.encode(texts)):
                    ids = np.append(ids, np.uint32(closing)).astype(width)
                    for start in range(0, len(ids), window):
                        piece = ids[start:start + window]
                        for column, value in zip(rows, (doc, start, len(piece),
                                                        piece.tobytes(), len(ids))):
                            column.append(value)
                yield pa.record_batch(rows, schema=schema)

    return run


def combinations(window: int) -> np.ndarray:
    """Length combinations that fill a window: the whole, every pair, and for every length
    the triples that share the rest in a few ratios. Zero means no piece."""
    first = np.arange(1, window)
    out = [np.array([[window, 0, 0]])]
    pairs = np.stack([first, window - first, 0 * first], 1)
    out.append(pairs[first <= window // 2])
    for share in (2, 3, 5, 9):
        small = (window - first) // share
        triples = np.stack([first, small, window - first - small], 1)
        out.append(triples[(small > 0)])
    return np.unique(np.sort(np.concatenate(out), axis=1)[:, ::-1], axis=0)


def solve(combos: np.ndarray, counts: np.ndarray, steps: int = 400) -> np.ndarray:
    """Non-negative least squares of ``counts`` (by length) over the combinations, by
    accelerated projected gradient. A length's misfit weighs as its tokens do."""
    weight = np.arange(len(counts)) / len(counts)

    def times(x):
        out = np.zeros(len(counts))
        for k in range(combos.shape[1]):
            out += np.bincount(combos[:, k], x, len(counts))
        out[0] = 0
        return out

    def back(r):
        return (r * weight ** 2)[combos].sum(axis=1)

    x = np.ones(len(combos))
    for _ in range(20):  # the largest curvature, by power iteration
        x = back(times(x))
        size = np.linalg.norm(x)
        x /= size
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0, y - back(times(y) - counts) / size)
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan(counts: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, repeats) that use every piece of the histogram once."""
    left, out = counts.astype(np.int64).copy(), []

    def use(combo, repeats):
        lengths, each = np.unique(combo, return_counts=True)
        repeats = min(repeats, int((left[lengths] // each).min()))
        if repeats > 0:
            left[lengths] -= repeats * each
            out.append((tuple(int(x) for x in combo), repeats))

    if counts.sum():
        combos = combinations(window)
        rounded = np.floor(solve(combos, counts.astype(float))).astype(np.int64)
        for at in np.argsort(-rounded, kind="stable"):
            if rounded[at] < 1:
                break
            use([x for x in combos[at] if x], int(rounded[at]))
    while left.any():
        combo, room, free = [], window, left.copy()
        while True:
            fits = np.flatnonzero(free[:room + 1])
            if not len(fits):
                break
            combo.append(int(fits[-1]))
            free[combo[-1]] -= 1
            room -= combo[-1]
        use(combo, int(left.max()))
    return out


def places(steps, window: int) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: first ranks of its runs, with each run's first sequence and offset."""
    runs: dict[int, list] = {}
    used, sequence = np.zeros(window + 1, dtype=np.int64), 0
    for combo, repeats in steps:
        offset = 0
        for length in combo:
            runs.setdefault(length, []).append((used[length], sequence, offset))
            used[length] += repeats
            offset += length
        sequence += repeats
    return {length: tuple(np.array(c, dtype=np.int64) for c in zip(*r))
            for length, r in runs.items()}


def _placed(where: dict, width: type):
    def run(batches):
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            ranks = batch.column("rank").to_numpy()
            sequence = np.empty(len(ranks), dtype=np.int64)
            offset = np.empty(len(ranks), dtype=np.int64)
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                firsts, sequences, offsets = where[int(length)]
                run_of = np.searchsorted(firsts, ranks[rows], side="right") - 1
                sequence[rows] = sequences[run_of] + ranks[rows] - firsts[run_of]
                offset[rows] = offsets[run_of]
            ids = [np.frombuffer(x, dtype=width).astype("<u4").tobytes()
                   for x in batch.column("ids").to_pylist()]
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("start"),
                 pa.array(lengths.astype(np.int64)), pa.array(ids, pa.binary()),
                 batch.column("doc_tokens"), pa.array(sequence), pa.array(offset)],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return run


def pack(df: DataFrame, path: str, window: int = WINDOW, closing: int = CLOSING,
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32 bit),
    doc_tokens, sequence_id, offset. On the way ids are as wide as the vocabulary needs."""
    width = id_width(path, closing)
    pieces = stage(df.select(F.col(doc_id).cast("long"), whole(text)).mapInArrow(
        _tokenised(path, window, closing, width), PIECE))
    counts = np.zeros(window + 1, dtype=np.int64)
    for row in pieces.groupBy("length").count().collect():  # at most one row per length
        counts[row["length"]] = row["count"]
    where = places(plan(counts, window), window)
    groups = F.array(*[F.lit(int(max(1, -(-c // GROUP_ROWS)))) for c in counts])
    grouped = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start"),
                                               F.get(groups, F.col("length"))).cast("int"))
    sizes = grouped.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("length", "salt", (F.sum("n").over(
        Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "start")
    ranked = grouped.join(before, ["length", "salt"]).withColumn(
        "rank", F.col("before") + F.row_number().over(order) - 1)
    return ranked.select("doc_id", "start", "length", "ids", "doc_tokens", "rank").mapInArrow(
        _placed(where, width), "doc_id long, start long, length long, ids binary, "
                               "doc_tokens long, sequence_id long, offset long")


def id_width(path: str, closing: int = CLOSING) -> np.dtype:
    """16 bits for the ids of a vocabulary file where all fit, else 32."""
    with open(path, encoding="utf-8") as file:
        own = json.load(file)
    largest = max([closing, *own["model"]["vocab"].values(),
                   *[t["id"] for t in own.get("added_tokens", [])]])
    return np.dtype("<u2" if largest < 1 << 16 else "<u4")


def digest(packed: DataFrame) -> DataFrame:
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def vocabulary_path() -> str:
    """Where this machine has the public vocabulary file."""
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def op3_least_squares(spark, sf_dir: str) -> DataFrame:
    return digest(pack(table(spark, sf_dir, "documents"), vocabulary_path()))
