"""Exact top-k by inner product through distributed histogram selection.

Components become floor(256 x); scores are integer inner products. Query and candidate
vectors travel in blocks of matrices. All scores are counted in a histogram per query,
first over the whole range that the blocks' norms allow, then over the one bin that holds
the k-th score, until a bin is one score wide: the exact k-th value of every query. A last
pass keeps the scores that reach it; ties at the k-th value go to the smaller id, so a
block never sends more than k candidates of a query, however many tie.

The number of passes depends on the range of scores, not on the rows. Vectors that are
null, empty, or hold null or non-finite components, and rows without an id, take no part.
Vectors are compared with those of their own length. A row repeated among the candidates
counts each time; a repeated query id is asked once, with its smallest vector. A query's
own id is never its candidate. Results carry no other input columns.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lendmart.llm.common import table
from lendmart.sources.snapshots import stage

K, EVERY, SCALE = 5, 50, 256.0
BLOCK = 2048          # rows of a block
BINS = 512


def _block(pdf: pd.DataFrame) -> pd.DataFrame:
    ids = pdf["id"].to_numpy(np.int64)
    order = np.argsort(ids, kind="stable")
    rows = np.stack(pdf["v"].to_numpy())[order].astype(np.int64)
    return pd.DataFrame({"dim": [rows.shape[1]], "n": [len(ids)],
                         "ids": [ids[order].tobytes()], "rows": [rows.tobytes()],
                         "norm": [float(np.sqrt((rows.astype(float) ** 2).sum(axis=1)).max())]})


def _read(ids: bytes, rows: bytes, dim: int):
    return np.frombuffer(ids, np.int64), np.frombuffer(rows, np.int64).reshape(-1, dim)


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products: in floating point where every sum is exact, else in 64-bit
    integers."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0))
    if most * queries.shape[1] < 2 ** 52:
        return (queries.astype(float) @ rows.T.astype(float)).astype(np.int64)
    return queries @ rows.T


def blocks(vectors: DataFrame, size: int = BLOCK) -> DataFrame:
    """(dim, n, ids, rows, norm) from (id, v): about ``size`` rows of one length each."""
    n = max(1, -(-vectors.count() // size))
    made = vectors.withColumn("b", F.pmod(F.xxhash64("id", "v"), F.lit(n))).groupBy(
        F.size("v").alias("dim"), "b")
    return made.applyInPandas(lambda key, pdf: _block(pdf),
                              "dim int, n int, ids binary, rows binary, norm double")


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    scaled = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * SCALE))
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < float("inf")))
    return df.filter(F.col(vec_id).isNotNull() & (F.size(vector) > 0) & finite).select(
        F.col(vec_id).cast("long").alias("id"), scaled.cast("array<long>").alias("v"))


def _pairs(queries: DataFrame, candidates: DataFrame, state: DataFrame | None = None):
    """Every query block with every candidate block of its dimension."""
    asked = queries if state is None else queries.join(state, "block")
    return asked.join(candidates, "dim")


def _histogram(batches):
    """Counts of scores in ``BINS`` equal bins from each query's ``low``."""
    for pdf in batches:
        for r in pdf.itertuples():
            q_ids, q = _read(r.q_ids, r.q_rows, r.dim)
            ids, rows = _read(r.ids, r.rows, r.dim)
            found = scores(q, rows)
            low = np.frombuffer(r.low, np.int64)[:, None]
            bins = (found - low) // r.width
            inside = (bins >= 0) & (bins < BINS) & (q_ids[:, None] != ids[None, :])
            where = (np.arange(len(q_ids))[:, None] * BINS + bins)[inside]
            counts = np.bincount(where, minlength=len(q_ids) * BINS)
            above = ((bins >= BINS) & (q_ids[:, None] != ids[None, :])).sum(axis=1)
            seen = np.flatnonzero(counts)
            yield pd.DataFrame({"block": r.block, "q": (seen // BINS).astype("int32"),
                                "bin": (seen % BINS).astype("int32"), "n": counts[seen]})
            more = np.flatnonzero(above)
            yield pd.DataFrame({"block": r.block, "q": more.astype("int32"),
                                "bin": np.int32(BINS), "n": above[more]})


def _refine(k: int):
    def run(key, old: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        low = np.frombuffer(old["low"].iloc[0], np.int64).copy()
        width, size = int(old["width"].iloc[0]), len(low)
        counts = np.zeros((size, BINS + 1), np.int64)
        counts[found["q"].to_numpy(), found["bin"].to_numpy()] = found["n"].to_numpy()
        reach = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1]  # scores at or above a bin
        enough = reach[:, :BINS] >= k
        at = np.where(enough.any(axis=1), BINS - 1 - np.argmax(enough[:, ::-1], axis=1), 0)
        return pd.DataFrame({"block": [key[0]], "low": [(low + at * width).tobytes()],
                             "width": [-(-width // BINS)], "exact": [width == 1]})
    return run


def _best(k: int):
    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples():
                q_ids, q = _read(r.q_ids, r.q_rows, r.dim)
                ids, rows = _read(r.ids, r.rows, r.dim)
                found, low = scores(q, rows), np.frombuffer(r.low, np.int64)
                own = q_ids[:, None] == ids[None, :]
                reach = (found >= low[:, None]) & ~own
                out = []
                for i in np.flatnonzero(reach.any(axis=1)):
                    at = np.flatnonzero(reach[i])  # ids ascend within a block
                    at = at[np.argsort(-found[i, at], kind="stable")[:k]]
                    out.append(pd.DataFrame({"query_id": q_ids[i], "vec_id": ids[at],
                                             "score": found[i, at]}))
                if out:
                    yield pd.concat(out)
    return run


def _top(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        best = pdf.sort_values(["score", "vec_id"], ascending=[False, True],
                               kind="stable").head(k)
        return best.assign(rank=np.arange(1, len(best) + 1, dtype=np.int32))[
            ["query_id", "rank", "vec_id", "score"]]
    return run


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K, vec_id: str = "vec_id",
          vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best candidates of every query."""
    once = usable(queries, vec_id, vector).groupBy("id").agg(F.min("v").alias("v"))
    asked = stage(blocks(once, BLOCK // 8).select(
        F.xxhash64("ids").alias("block"), "dim", F.col("ids").alias("q_ids"),
        F.col("rows").alias("q_rows"), F.col("n").alias("q_n"), F.col("norm").alias("q_norm")))
    rows = stage(blocks(usable(candidates, vec_id, vector)).select("dim", "ids", "rows", "norm"))
    norms = rows.groupBy("dim").agg(F.max("norm").alias("norm"))

    def start(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for r in pdf.itertuples():
            most = int(r.q_norm * r.norm * (1 + 1e-9)) + 1
            out.append((r.block, np.full(r.q_n, -most, np.int64).tobytes(),
                        (2 * most + 1) // BINS + 1, False))
        return pd.DataFrame(out, columns=["block", "low", "width", "exact"])

    shape = "block long, low binary, width long, exact boolean"
    state = stage(asked.select("block", "dim", "q_n", "q_norm").join(norms, "dim").mapInPandas(
        lambda batches: map(start, batches), shape))
    while not state.filter("NOT exact").isEmpty():
        counts = _pairs(asked, rows, state).repartition(_tasks(asked, rows)).mapInPandas(
            _histogram, "block long, q int, bin int, n long")
        merged = counts.groupBy("block", "q", "bin").agg(F.sum("n").alias("n"))
        state = stage(state.groupBy("block").cogroup(merged.groupBy("block")).applyInPandas(
            _refine(k), shape))
    found = _pairs(asked, rows, state).repartition(_tasks(asked, rows)).mapInPandas(
        _best(k), "query_id long, vec_id long, score long")
    return found.groupBy("query_id").applyInPandas(
        _top(k), "query_id long, rank int, vec_id long, score long")


def _tasks(asked: DataFrame, rows: DataFrame) -> int:
    """Tasks for all pairs of blocks."""
    return max(1, min(100_000, asked.count() * rows.count() // 8))


def op8_histogram_selection(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors.filter(F.col("vec_id") % EVERY == 0), vectors)
