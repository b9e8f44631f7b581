"""N-gram Jaccard join in the metric space of shingle sets.

Distance is 1 - |x & y| / |x | y|; sets within 1 - ``similarity`` are linked.

Regions. Two sets that share nothing are at distance 1 from each other and from every
pivot between them, so no sample of documents can tell them apart. The first pivots are
therefore the smallest sets there are, single shingles: a set is nearest to those it
holds, ties broken by a fixed order of shingles (those in fewest sets first, by counts of
all sets, then by hash). A set is replicated to its first |x| - ceil(s |x|) + l pivots, the
window that no linked pair can miss: sets that overlap so much share l pivots within both
windows. With l a twentieth of a set's size, a set that shares fewer of its pivots with
others has no link and leaves early.

Recursion. Inside a region, distances to document pivots are computed. Sets within the
radius of a pivot are linked to it and need no comparison among each other. The rest of
the region is joined again with new pivots, more of them each time, until it is empty.
By the triangle inequality a link can cross a pivot's ball only from the ring up to twice
the radius, and only between sets whose distances to the pivot differ by at most the
radius; these boundary pairs are compared, nearest first, until their parts are linked
or none is left. So every link between different texts is either found or implied by
links that are, and components are exact.

Regions with the same members are one region, and large ones are merged with those much
like them. Every class has a bitmap of its set, each shingle flipping one bit: two sets
differ in at least as many shingles as their bitmaps in bits, so pairs too different to
matter are left out where they meet. Pairs left out this way are never links, nor within
twice the radius of a pivot.

Sets equal in all shingles are one class from the start. Regions, balls and classes are
rows that meet in equi-joins. Leads of a region or ball are ranked in a frame of their own,
which Spark limits within each task before the shuffle, up to 1,000 leads.

Null texts and texts without words have an empty set, linked with nothing. Shingles and
classes are known by 64-bit hashes. Rows without an id take part and are never the
smallest id; a group of only such rows has a null component. Rows equal in id and text get
equal results. Other input columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from lendmart.llm.blobs import (PART, lean, lean_group, mix, pack, pack_sorted, unpack,
                                unpack_sorted)
from lendmart.llm.common import release, table, whole
from lendmart.llm.graph import components
from lendmart.sources.snapshots import bucketed, stage

SHINGLE, PERCENT = 5, 80
EXTRA = 20            # a window has one pivot more for every so many shingles
BITMAP = 8            # words of 64 bits of a set's bitmap
LARGE, MINIMA = 16, 4    # members of regions that may become one with others; hashes compared
HOMES = 32            # regions of a set that are known where it meets others
CHUNK_KEYS, RANGE_KEYS = 3_000_000, 3_000_000
KEY_BITS = 40         # leading bits of a shingle's hash that are counted: order of pivots only
KEY_SHIFT = np.uint64(64 - KEY_BITS)
CHUNK = ("chunk long, ids binary, absent binary, t binary, classes binary, n binary, "
         "own binary, lengths binary, texts binary, keys binary, times binary, n_keys long")


class Sets:
    """Sorted distinct shingle hashes of texts."""

    def __init__(self, n: int):
        self.n = n

    def of(self, texts: list[str]) -> list[np.ndarray]:
        words, sizes = [], []
        for text in texts:
            own = text.encode("utf-8", "surrogatepass").lower().split()
            words += own
            sizes.append(len(own))
        # a word is hashed faster than looked up among those hashed before, which take room
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        rolled = hashes
        for k in range(1, self.n):
            rolled = mix(rolled[:-1], hashes[k:]) if len(rolled) > 1 else rolled[:0]
        out, at = [], 0
        for size in sizes:
            if size >= self.n:
                found = np.sort(rolled[at:at + size - self.n + 1])
                new = np.empty(len(found), bool)
                new[0] = True
                np.not_equal(found[1:], found[:-1], out=new[1:])
                out.append(found[new])
            else:  # the whole text as one shingle, told from longer ones by its length
                one = hashes[at:at + min(size, 1)] + np.uint64(size)
                for k in range(1, size):
                    one = mix(one, hashes[at + k:at + k + 1])
                out.append(one)
            at += size
        # views of one array: small arrays that outlive the texts would leave holes between them
        flat = np.concatenate([np.empty(0, np.uint64), *out])
        ends = np.cumsum([len(s) for s in out])
        return [flat[end - len(s):end] for s, end in zip(out, ends)]


def _window(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1 + n // EXTRA if n else 0


def _needed(n: int, percent: int) -> int:
    """Pivots that a set of size ``n`` shares with every set it is linked to, at least."""
    return 1 + -(-percent * n // 100) // EXTRA


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of an ascending array, moved to its front, and how often each is there."""
    times, n, last = np.empty(len(keys), np.uint32), 0, None
    for at in range(0, len(keys), PART):
        part = keys[at:at + PART]
        new = np.ones(len(part), bool)
        np.not_equal(part[1:], part[:-1], out=new[1:])
        new[0] = last is None or part[0] != last
        first, last = np.flatnonzero(new), part[-1]
        times[n:n + len(first)] = first + at
        keys[n:n + len(first)] = part[first]
        n += len(first)
    if n:
        times[:n - 1] = times[1:n] - times[:n - 1]
        times[n - 1] = len(keys) - int(times[n - 1])
    return keys[:n], times[:n]


def _keys(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct counted bits of the sets' shingles, ascending, and how many sets hold each.
    Sorted and counted where they are: a chunk's keys are large beside a task's memory. A
    list's arrays are let go of one by one, so it is to be one that nobody else needs."""
    keys = np.empty(sum(map(len, sets)), np.uint64)
    end = len(keys)
    while sets:
        own = sets.pop()
        np.right_shift(own, KEY_SHIFT, out=keys[end - len(own):end])
        end -= len(own)
    keys.sort()
    return _runs(keys)


def _chunked(n: int, limit: int):
    """Chunks of documents with their classes, the texts of their distinct sets, and how
    many sets hold each key."""
    def flush(rows, own, sets, texts):
        ids, hashes, names, counts = zip(*rows)
        keys, times = _keys(sets)
        chunk = xxhash.xxh3_64(repr(rows).encode()).intdigest() >> 1
        return pa.RecordBatch.from_pylist([{
            "chunk": chunk, "ids": pack(np.array([i or 0 for i in ids]), np.int64),
            "absent": pack(np.array([i is None for i in ids]), np.uint8),
            "t": pack(np.array(hashes), np.int64), "classes": pack(np.array(names), np.int64),
            "n": pack(np.array(counts), np.int64),
            "own": pack(np.array(list(own), np.int64), np.int64),
            "lengths": pack(np.array(list(own.values()), np.uint32), np.uint32),
            "texts": texts.blob(),
            "keys": pack_sorted(keys), "times": pack(times, np.uint32), "n_keys": len(keys)}])

    def run(batches):
        sets, rows, own, kept, size, texts = Sets(n), [], {}, [], 0, _Texts()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                docs, hashes, here = (c.to_pylist() for c in batch.slice(at, 500).columns)
                new = []
                for doc, t, text, s in zip(docs, hashes, here, sets.of(here)):
                    name = xxhash.xxh3_64_intdigest(s.tobytes()) >> 1
                    rows.append((doc, t, name, len(s)))
                    if len(s) and name not in own:
                        own[name] = texts.add(text)
                        new.append(s)
                        size += len(s)
                if new:
                    kept.append(np.concatenate(new))
                if size >= limit:
                    chunk = flush(rows, own, kept, texts)
                    rows, own, kept, size, texts = [], {}, [], 0, _Texts()
                    yield chunk
        if rows:
            chunk = flush(rows, own, kept, texts)
            del rows, own, kept, texts
            yield chunk
    return run


class _Texts:
    """Texts as one compressed value, compressed as they come."""

    def __init__(self):
        self.to, self.parts = zstandard.ZstdCompressor(level=1).compressobj(), []

    def add(self, text: str) -> int:
        own = text.encode("utf-8", "surrogatepass")
        self.parts.append(self.to.compress(own))
        return len(own)

    def blob(self) -> bytes:
        return b"".join([*self.parts, self.to.flush()])


def _opened(batches):
    """A row per document of the chunks: chunk, doc_id, t, class, n."""
    for batch in batches:
        for row in batch.to_pylist():
            absent = unpack(row["absent"], np.uint8).astype(bool)
            yield pa.record_batch([
                pa.array(np.full(len(absent), row["chunk"], np.int64)),
                pa.array(unpack(row["ids"], np.int64), mask=absent),
                *[pa.array(unpack(row[c], np.int64)) for c in ("t", "classes", "n")]],
                names=["chunk", "doc_id", "t", "class", "n"])


def _asked(ranges: int):
    """A chunk's keys and how often it has them, by ranges."""
    cuts = [(i << KEY_BITS) // ranges for i in range(ranges + 1)]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys, times = unpack_sorted(row["keys"]), unpack(row["times"], np.uint32)
                at = np.searchsorted(keys, np.array(cuts, np.uint64))
                out = [(i, row["chunk"], pack_sorted(keys[a:b]), pack(times[a:b], np.uint32))
                       for i, (a, b) in enumerate(zip(at[:-1], at[1:])) if b > a]
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(zip(*out), (
                        pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                    names=["range", "chunk", "keys", "times"])
    return run


def _answer(key, pdf: pd.DataFrame) -> pd.DataFrame:
    """Of every key asked about, how many sets of all chunks hold it."""
    every = np.concatenate([unpack_sorted(b) for b in pdf["keys"]])
    every.sort()
    every = _runs(every)[0]
    sums = np.zeros(len(every), np.uint64)
    for keys, times in zip(pdf["keys"], pdf["times"]):  # a chunk has a key once
        sums[np.searchsorted(every, unpack_sorted(keys))] += unpack(times, np.uint32)
    sums = np.minimum(sums, np.uint64(2 ** 32 - 1)).astype(np.uint32)
    return pd.DataFrame({"chunk": pdf["chunk"].to_numpy(), "range": key[0], "sums": [
        pack(sums[np.searchsorted(every, unpack_sorted(keys))], np.uint32)
        for keys in pdf["keys"]]})


#: Columns of a bitmap.
BITS = [f"bits{i}" for i in range(BITMAP)]


def _bitmap(keys: np.ndarray) -> np.ndarray:
    """Words whose bits tell whether an odd number of keys fell on them."""
    odd = np.bincount((keys % np.uint64(64 * BITMAP)).astype(np.int64),
                      minlength=64 * BITMAP) % 2
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _members(n: int, percent: int):
    """Sets at home in a chunk with enough shared pivots in their windows: class, n, these
    pivots, the set and its bitmap. A set's rarest shingles come first, ties by their hash."""
    def run(own: pa.Table, answers: pa.Table) -> pa.Table:
        row = own.slice(0, 1).to_pylist()[0]
        home = pa.concat_arrays([pa.array([], pa.int64()), *[
            c.flatten() for c in answers.column("home").chunks]]).to_numpy()
        ranges = dict(zip(*(answers.column(c).to_pylist() for c in ("range", "sums"))))
        sums = np.concatenate([unpack(ranges[i], np.uint32)
                               for i in sorted(i for i in ranges if i is not None)])
        names = unpack(row["own"], np.int64)
        ends = np.cumsum(unpack(row["lengths"], np.uint32).astype(np.int64))
        texts = zstandard.ZstdDecompressor().decompressobj().decompress(row["texts"])
        sets, found = Sets(n), []
        for at in range(0, len(names), 500):
            found += sets.of([texts[ends[i - 1] if i else 0:ends[i]].decode(
                "utf-8", "surrogatepass") for i in range(at, min(at + 500, len(names)))])
        del sets, texts, row, own
        keys = _keys(list(found))[0]
        held_by, chosen, size = [], [], 0
        for i, here in enumerate(np.isin(names, home)):
            s, found[i] = found[i], None
            held = sums[np.searchsorted(keys, s >> KEY_SHIFT)] if here else s[:0]
            window, alone = _window(len(s), percent), int((held == 1).sum())
            if here and window - alone >= _needed(len(s), percent):
                held_by.append(s[np.argsort(held, kind="stable")[alone:window]])
                chosen.append(i)
                found[i] = s
        kept = [found[i] for i in chosen]
        lists = pa.ListArray.from_arrays(_ends(held_by, 1), pa.array(
            np.concatenate([np.empty(0, np.uint64), *held_by]).view(np.int64)))
        bits = np.array([_bitmap(s) for s in kept], np.int64).reshape(-1, BITMAP)
        del found, keys, held_by
        values = pa.py_buffer(np.concatenate([np.empty(0, np.uint64), *kept]))
        blobs = pa.Array.from_buffers(pa.binary(), len(kept),
                                      [None, _ends(kept, 8).buffers()[1], values])
        return pa.table([pa.array(names[chosen]), pa.array([len(s) for s in kept], pa.int64()),
                         lists, blobs, *map(pa.array, bits.T.copy())],
                        names=["class", "n", "pivots", "set", *BITS])
    return run


def _ends(arrays: list[np.ndarray], width: int) -> pa.Array:
    """Offsets of arrays that follow each other, ``width`` bytes a value."""
    return pa.array(np.cumsum([0, *[len(x) * width for x in arrays]]), pa.int32())


def _may_reach(percent: int, a: str, b: str):
    """False only of pairs with a similarity below ``percent``; ``a`` and ``b`` are prefixes
    of both sides' n and bitmap columns. Such a similarity needs sizes that near, and at
    most (100 - percent) / (100 + percent) of the sizes' sum may be in one set only."""
    n_a, n_b = F.col(f"{a}n"), F.col(f"{b}n")
    apart = sum((F.bit_count(F.col(a + w).bitwiseXOR(F.col(b + w))) for w in BITS), F.lit(0))
    return (100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)) & (
        apart * (100 + percent) <= (n_a + n_b) * (100 - percent))


def _named(df: DataFrame, prefix: str) -> DataFrame:
    """n and bitmap columns under a prefix."""
    return df.withColumnsRenamed({c: prefix + c for c in ("n", *BITS)})


def _shared(batches):
    for batch in batches:
        out = []
        for a, b in zip(batch.column("a_set").to_pylist(), batch.column("b_set").to_pylist()):
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            if len(a) > len(b):
                a, b = b, a
            at = np.minimum(np.searchsorted(b, a), len(b) - 1)
            both = int((b[at] == a).sum())
            out.append((both, len(a) + len(b) - both))
        both, either = np.array(out, np.int64).reshape(-1, 2).T
        yield pa.record_batch([batch.column("a"), batch.column("b"), pa.array(both),
                               pa.array(either)], names=["a", "b", "both", "either"])


def measure(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, both, either) of pairs of classes, exactly."""
    left = sets.select(F.col("class").alias("a"), F.col("set").alias("a_set"))
    right = sets.select(F.col("class").alias("b"), F.col("set").alias("b_set"))
    return stage(pairs.join(right, "b").join(left, "a").select("a", "b", "a_set", "b_set")
                 .mapInArrow(lean(_shared), "a long, b long, both long, either long"))


def _linked(percent: int):
    return 100 * F.col("both") >= percent * F.col("either")


def _merged(rows: DataFrame) -> DataFrame:
    """Regions of several members. Of regions with the same members one is left, and larger
    regions that are alike, in their size and the smallest hashes of their members, become
    one with the members of all: no pair is lost, and a pair meets less often."""
    alike = [f"m{k}" for k in range(MINIMA)]
    names = rows.groupBy("pivot").agg(
        F.count(F.lit(1)).alias("members"), F.bit_xor(F.xxhash64("class")).alias("x"),
        F.bit_xor(F.xxhash64("class", F.lit(-1))).alias("y"),
        *[F.min(F.xxhash64("class", F.lit(k))).alias(m) for k, m in enumerate(alike)]
    ).filter("members > 1")
    one = stage(names.groupBy("members", "x", "y").agg(
        F.min("pivot").alias("pivot"), *[F.first(m).alias(m) for m in alike])
        .withColumn("scale", F.floor(F.log2("members"))))
    large = one.filter(F.col("members") >= LARGE)
    region = large.groupBy("scale", *alike).agg(F.min("pivot").alias("region"))
    into = stage(large.join(region, ["scale", *alike]).select("pivot", "region"))
    others = [c for c in rows.columns if c != "pivot"]
    return stage(rows.join(one.filter(F.col("members") < LARGE).select("pivot"), "pivot", "left_semi")
                 .select("pivot", *others).union(
        rows.join(into, "pivot").select(F.col("region").alias("pivot"), *others)
        .dropDuplicates(["pivot", "class"])))


def _some(rows: DataFrame, member: str, name: str) -> DataFrame:
    """A member's first regions. The list is short: it saves repeated pairs, no more."""
    return stage(rows.groupBy(member).agg(
        F.slice(F.sort_array(F.collect_list("pivot")), 1, HOMES).alias(name)))


def _balls(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Distances of the regions' members (see ``regions``) to document pivots: (a, b, both,
    either) with ``a`` the document pivot. Every pair of a region is either measured, or has
    one of its sets within the ball of a pivot that both were measured against, or is too
    far apart from it or from each other to matter."""
    reach = 2 * percent - 100  # sets further from a pivot than twice the radius never matter
    found, left, leads = None, members, 1
    while not left.isEmpty():
        if leads == 1:
            own = ["alone", "class", "n", *BITS]
            first = left.groupBy("pivot").agg(F.min(F.struct(*own)).alias("lead")).select(
                "pivot", F.col("lead.class").alias("a"), *[F.col(f"lead.{c}").alias(f"a_{c}")
                                                           for c in ("n", *BITS)])
            near = left.withColumn("first", F.lit(False))
        else:
            rank = Window.partitionBy("pivot").orderBy("alone", "class")
            ahead = left.select("pivot", "class", "alone").withColumn(
                "rank", F.row_number().over(rank)).filter(F.col("rank") <= leads).select(
                    "pivot", "class", F.lit(True).alias("first"))
            near = stage(left.join(ahead, ["pivot", "class"], "left").withColumn(
                "first", F.coalesce("first", F.lit(False))))
            first = _named(near.filter("first").drop("alone", "first"), "a_").withColumnRenamed(
                "class", "a")
        first = stage(first)
        # of two pivots, only the smaller asks, for both; a pair meets in its first common region
        common = F.array_min(F.array_intersect("led", "homes"))
        asked = _named(near, "b_").join(_some(left, "class", "homes"), "class").join(
            first.join(_some(first, "a", "led"), "a"), "pivot").filter(
                (F.col("class") != F.col("a")) & ~(F.col("first") & (F.col("class") < F.col("a")))
                & _may_reach(reach, "a_", "b_")
                & (common.isNull() | (F.col("pivot") <= common))).select(
                    "a", F.col("class").alias("b")).distinct()
        if found is not None:
            asked = asked.join(found, ["a", "b"], "left_anti")
        measured = measure(asked, sets)
        if leads > 1:  # the larger pivot has balls too, also in regions where it leads alone
            known = measured if found is None else measured.unionByName(found)
            both_ways = measured.join(first.select(F.col("a").alias("b")).distinct(), "b",
                                      "left_semi").select(
                F.col("b").alias("a"), F.col("a").alias("b"), "both", "either")
            measured = measured.unionByName(
                both_ways.join(known.select("a", "b"), ["a", "b"], "left_anti"))
        found = measured if found is None else stage(found.unionByName(measured))
        balls = found.filter(_linked(percent)).select("a", F.col("b").alias("class"))
        covered = left.select("pivot", "class").join(balls, "class").join(
            first, ["pivot", "a"], "left_semi").select("pivot", "class")
        covered = covered.union(first.select("pivot", F.col("a").alias("class"))).distinct()
        left = _merged(stage(left.join(covered, ["pivot", "class"], "left_anti")))
        leads *= 8
    return found


def _boundary(found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All links (a, b), after comparing across the boundaries of balls."""
    far = F.col("both") / F.col("either")
    bitmaps = sets.select("class", "n", *BITS)
    links = found.filter(_linked(percent)).select("a", "b")
    inner = stage(found.filter(_linked(percent) & (F.col("both") < F.col("either"))).select(
        F.col("a").alias("ball"), F.col("b").alias("inside"), far.alias("s_in")).join(
            _named(bitmaps, "in_").withColumnRenamed("class", "inside"), "inside"))
    rest = stage(found.filter(~_linked(percent) & (
        100 * F.col("both") >= (2 * percent - 100) * F.col("either"))).select(
            F.col("a").alias("ball"), F.col("b").alias("outside"), far.alias("s_out"))
        .join(inner.select("ball").distinct(), "ball", "left_semi"))
    most = 1
    while True:
        if rest.isEmpty():
            return links
        labels = components(links)
        of = labels.select(F.col("node").alias("outside"), F.col("label").alias("part"))
        home = labels.select(F.col("node").alias("ball"), F.col("label").alias("home"))
        rest = stage(rest.join(of, "outside", "left").join(home, "ball", "left").withColumn(
            "part", F.coalesce("part", "outside")).filter(
                F.col("part") != F.coalesce("home", "ball")).drop("home"))
        order = Window.partitionBy("ball", "part").orderBy(F.desc("s_out"), "outside")
        ahead = stage(rest.withColumn("rank", F.row_number().over(order)).filter(
            F.col("rank") <= most).drop("part", "rank"))
        # the radius leaves a little room for rounding: comparing more never changes links
        asked = ahead.join(
            _named(bitmaps, "out_").withColumnRenamed("class", "outside"), "outside").join(
                inner, "ball").filter(_may_reach(percent, "in_", "out_") & (
                    F.col("s_in") <= F.col("s_out") + (100 - percent) / 100 + 1e-9)).select(
                F.col("outside").alias("a"), F.col("inside").alias("b")).distinct()
        links = stage(links.union(measure(asked, sets).filter(_linked(percent)).select("a", "b")))
        rest = stage(rest.drop("part").join(ahead.select("ball", "outside"),
                                            ["ball", "outside"], "left_anti"))
        most *= 8


def regions(chunks: DataFrame, rows: DataFrame, n: int,
            percent: int) -> tuple[DataFrame, DataFrame]:
    """Members (pivot, class, n, alone) of the regions that hold more than one class, merged;
    and their sets (class, n, set, bitmap).

    All shingles are counted, exactly, by ranges of their hash. A class found in several
    chunks takes part in one of them.

    ``alone`` is smallest for the sets that share most of their pivots. Such a set lies in
    the middle of its near copies, which differ from it less than from each other, so it
    comes first as a document pivot.
    """
    total = chunks.agg(F.sum("n_keys")).first()[0] or 0
    ranges = max(1, -(-total // RANGE_KEYS))
    sums = chunks.filter("n_keys > 0").select("chunk", "keys", "times").mapInArrow(
        lean(_asked(ranges)), "range int, chunk long, keys binary, times binary").groupBy(
            "range").applyInPandas(lean_group(_answer), "chunk long, range int, sums binary")
    homes = rows.filter("n > 0").groupBy("class").agg(F.min("chunk").alias("chunk")).groupBy(
        "chunk").agg(F.collect_list("class").alias("home"))
    answers = sums.unionByName(homes, allowMissingColumns=True)
    bits = ", ".join(f"{w} long" for w in BITS)
    able = stage(chunks.filter("n_keys > 0").select("chunk", "own", "lengths", "texts")
                 .groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
                     lean_group(_members(n, percent)),
                     f"class long, n long, pivots array<long>, set binary, {bits}"))
    rows = able.select(F.explode("pivots").alias("pivot"), "class", "n")
    for _ in range(2):  # a region that a leaving set empties may let others leave
        several = stage(rows.groupBy("pivot").agg(F.min("class").alias("lo"),
                                                  F.max("class").alias("hi"))
                        .filter("lo < hi").select("pivot"))
        rows = stage(rows.join(several, "pivot", "left_semi"))
        enough = 1 + F.floor(F.ceil(percent * F.col("n") / 100) / EXTRA)
        full = stage(rows.groupBy("class", "n").count().filter(F.col("count") >= enough)
                     .select("class"))
        rows = stage(rows.join(full, "class", "left_semi"))
    alone = rows.groupBy("class").agg((-F.count(F.lit(1)) / F.first("n")).alias("alone"))
    members = stage(_merged(rows).join(stage(alone), "class"))
    # every measurement joins sets with pairs: they are dealt out once, here
    return members, bucketed(able.drop("pivots").join(
        members.select("class").distinct().hint("merge"), "class", "left_semi"), "class")


def link_classes(df: DataFrame, n: int = SHINGLE, percent: int = PERCENT, doc_id: str = "doc_id",
                 text: str = "text") -> tuple[DataFrame, DataFrame | None]:
    """(rows, links): per input row doc_id, t, class, n; and links (a, b) between classes
    whose components are those of all linked pairs."""
    spark = df.sparkSession
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"),
                     F.xxhash64(whole(text)).alias("t"), whole(text).alias("text"))
    # a row is a file's worth: written by buckets, chunks meet their answers without a shuffle
    chunks = bucketed(docs.mapInArrow(lean(_chunked(n, CHUNK_KEYS)), CHUNK), "chunk")
    rows = stage(chunks.select("chunk", "ids", "absent", "t", "classes", "n").mapInArrow(
        lean(_opened), "chunk long, doc_id long, t long, class long, n long"))
    members, sets = regions(chunks, rows, n, percent)
    members = stage(members.join(sets.select("class", *BITS), "class"))
    release(spark)
    found = _balls(members, sets, percent)
    return rows, None if found is None else _boundary(found, sets, percent)


def join_groups(df: DataFrame, n: int = SHINGLE, percent: int = PERCENT, doc_id: str = "doc_id",
                text: str = "text") -> DataFrame:
    """Per input row: doc_id, t (hash of the text), n_shingles, component_id (the smallest
    id reachable through links)."""
    rows, links = link_classes(df, n, percent, doc_id, text)
    linked = rows.filter("n > 0").groupBy("class").agg(F.min("doc_id").alias("least"),
                                                       F.count(F.lit(1)).alias("size"))
    if links is not None:
        labels = stage(components(links))
        linked = linked.join(labels.withColumnRenamed("node", "class"), "class", "left")
    else:
        linked = linked.withColumn("label", F.lit(None).cast("long"))
    linked = stage(linked.filter("size > 1 OR label IS NOT NULL").withColumn(
        "label", F.coalesce("label", "class")).select("class", "label", "least"))
    smallest = linked.groupBy("label").agg(F.min("least").alias("component"))
    group = stage(linked.join(stage(smallest), "label").select("class", "component"))
    own = group.withColumn("grouped", F.lit(True))
    return rows.join(own, "class", "left").select(
        "doc_id", "t", F.col("n").alias("n_shingles"),
        F.when(F.col("grouped") & (F.col("n") > 0), F.col("component"))
        .otherwise(F.col("doc_id")).alias("component_id"))


def op6_metric_join(spark, sf_dir: str) -> DataFrame:
    return join_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles",
                                                                 "component_id")
