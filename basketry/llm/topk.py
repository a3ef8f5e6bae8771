"""Exact top-k search by distributed histogram selection.

Components become ``floor(scale * x)``; a score is the integer inner product.
Queries are taken in blocks of ``BLOCK`` (each block is one bounded broadcast);
a block meets every candidate row:

1. every task scores its rows and counts scores per query in ``BINS`` equal
   bins of the query's interval; the counts are added up;
2. the bin that holds the query's k-th highest score becomes its interval, and
   scoring repeats until the interval is one score: the exact k-th score;
3. rows above the k-th score, and the smallest ids among those equal to it,
   are filtered out of a last scoring and ranked.

Only counts and at most k rows per query, task and side of the k-th score
leave a task; vectors are never shuffled. Scores are 64-bit integers; products
run in double precision while every partial sum is exact there, else in 64-bit
integers.

Defined cases: vectors that are null, hold null or non-finite components take
no part, nor do rows with a null id; with mixed lengths only equal lengths
meet; rows that repeat an id other than the query's are candidates each; a
query row repeated gives its results once; fewer than k candidates give all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

K, SCALE, BLOCK, BINS = 5, 256, 2048, 1024


def _valid(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    whole = F.transform(v, lambda x: F.floor(x * SCALE))
    ok = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))
    clean = vectors.select(F.col(id_col).cast("long").alias("__i"), F.when(ok, whole).alias("__v"))
    return clean.where(F.col("__i").isNotNull() & F.col("__v").isNotNull())


def _matrix(col: pa.Array) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else flat.reshape(0, 0)


def _exact(q: np.ndarray, v: np.ndarray):
    """Inner products, v rows x q rows, as 64-bit integers."""
    if not q.size or not v.size:
        return np.zeros((len(v), len(q)), np.int64)
    if float(np.abs(q).max()) * float(np.abs(v).max()) * q.shape[1] < 2.0 ** 53:
        return (v.astype(np.float64) @ q.T.astype(np.float64)).astype(np.int64)
    return v @ q.T


def _blocks(batch, rows: int = 1024):
    ids = batch.column("__i").to_numpy()
    for lo in range(0, len(batch), rows):
        yield ids[lo:lo + rows], _matrix(batch.column("__v")[lo:lo + rows])


def _histogram(held):
    def run(batches):
        qid, q, low, high, width = held.value
        counts = np.zeros((len(qid), BINS), np.int64)
        for batch in batches:
            for ids, v in _blocks(batch):
                score = _exact(q, v)
                bin_ = (score - low) // width
                use = (score >= low) & (score < high) & (ids[:, None] != qid)
                flat = bin_ + np.arange(len(qid)) * BINS
                counts += np.bincount(flat[use], minlength=counts.size).reshape(counts.shape)
        at = np.flatnonzero(counts)
        for lo in range(0, len(at), 100_000):
            x = at[lo:lo + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array((x // BINS).astype(np.int32)), pa.array((x % BINS).astype(np.int32)), pa.array(counts.reshape(-1)[x])], ["q", "b", "n"])
    return run


def _select(held, k: int):
    def run(batches):
        qid, q, kth = held.value
        best = [np.zeros((0, 2), np.int64)] * len(qid)
        for batch in batches:
            for ids, v in _blocks(batch):
                score = _exact(q, v)
                r, c = np.nonzero((score >= kth) & (ids[:, None] != qid))
                for j in np.unique(c):
                    mine = r[c == j]
                    both = np.concatenate([best[j], np.stack([score[mine, j], ids[mine]], axis=1)])
                    best[j] = both[np.lexsort((both[:, 1], -both[:, 0]))[:k]]
        for lo in range(0, len(qid), 1024):
            part = best[lo:lo + 1024]
            n = [len(x) for x in part]
            if sum(n):
                rows = np.concatenate(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(qid[lo:lo + 1024], n)), pa.array(rows[:, 1]), pa.array(rows[:, 0])], ["query_id", "vec_id", "score"])
    return run


def _kth_scores(rows: DataFrame, qid: np.ndarray, q: np.ndarray, reach: float, k: int) -> np.ndarray:
    """Each query's k-th highest score; the lowest possible with fewer candidates."""
    sc = rows.sparkSession.sparkContext
    bound = np.ceil(np.sqrt((q.astype(np.float64) ** 2).sum(axis=1)) * reach) + 1
    bound = np.minimum(bound, 2.0 ** 61).astype(np.int64)
    low, high = -bound, bound + 1  # half open
    above = np.zeros(len(qid), np.int64)
    few = np.zeros(len(qid), bool)
    while (high - low > 1).any():
        width = np.maximum(1, -((low - high) // BINS))
        held = sc.broadcast((qid, q, low, high, width))
        got = rows.mapInArrow(_histogram(held), "q int, b int, n bigint").groupBy("q", "b").agg(F.sum("n").alias("n"))
        # per query the first bin from the top that reaches k, found by Spark
        run = F.sum("n").over(Window.partitionBy("q").orderBy(F.desc("b")))
        at = got.withColumn("run", run).join(
            F.broadcast(rows.sparkSession.createDataFrame([(int(j), int(a)) for j, a in enumerate(above)], "q int, above bigint")), "q")
        hit = at.where(F.col("run") + F.col("above") >= k).groupBy("q").agg(
            F.max(F.struct("b", (F.col("run") - F.col("n")).alias("before"))).alias("top")).select("q", "top.b", "top.before")
        found = hit.toArrow()
        j, b, before = (found.column(c).to_numpy() for c in ("q", "b", "before"))
        missing = np.ones(len(qid), bool)
        missing[j] = False
        few |= missing
        high[j] = np.minimum(high[j], low[j] + (b + 1) * width[j])
        low[j] = low[j] + b * width[j]
        above[j] += before
        high[few] = low[few] + 1
        held.unpersist()
    return np.where(few, -bound, low)


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", *, k: int = K) -> DataFrame:
    """Rows (``query_id``, ``rank`` from 1, ``vec_id``, ``score``) for all rows
    where ``is_query`` holds, against all other rows."""
    rows = cut_lineage(_valid(vectors, id_col, vec_col), "op10-vectors")
    ask = cut_lineage(rows.where(is_query).groupBy("__i").agg(F.min("__v").alias("__v")), "op10-queries")
    parts = []
    for size, reach in rows.groupBy(F.size("__v").alias("n")).agg(F.max(F.sqrt(F.aggregate(
            "__v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))).alias("r")).orderBy("n").collect():
        mine = rows.where(F.size("__v") == size)
        own = ask.where(F.size("__v") == size)
        start = None
        while True:
            block = own if start is None else own.where(F.col("__i") > start)
            got = block.orderBy("__i").limit(BLOCK).toArrow().combine_chunks()
            if not got.num_rows:
                break
            qid, q = got.column("__i").to_numpy(), _matrix(got.column("__v").chunk(0))
            start = int(qid[-1])
            kth = _kth_scores(mine, qid, q, float(reach), k)
            held = mine.sparkSession.sparkContext.broadcast((qid, q, kth))
            best = mine.mapInArrow(_select(held, k), "query_id bigint, vec_id bigint, score bigint")
            w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
            parts.append(cut_lineage(best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k), "op10-block"))
    empty = vectors.sparkSession.createDataFrame([], "query_id bigint, vec_id bigint, score bigint, rank int")
    for p in parts:
        empty = empty.unionByName(p)
    return empty.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
