"""Centroid clustering by equal-average equal-variance search.

Components become ``floor(scale * x)``. A vector of ``n`` integers has the sum
``S`` and the deviation ``V = sqrt(n * sum of squares - S ** 2)``. For a vector
x and a centroid c with squared distance d::

    n * d >= (Sx - Sc) ** 2 + (Vx - Vc) ** 2

Centroids are sorted by sum. Each vector starts at the centroid whose sum is
nearest and goes outward, on the side that is nearer at the moment:

* ``(Sx - Sc) ** 2 > n * best``: this centroid and all farther ones on either
  side are out, the search ends (exact, in integers);
* the whole bound is above ``n * best``: this centroid is out (in doubles, with
  a margin above their rounding error, so a possible tie is never lost);
* otherwise the distance is worked out exactly in integers; the smaller
  distance, then the smaller centroid number, stays.

Each round assigns all vectors in tasks, against the centroids of the round
(``k * size`` integers, the only thing that tasks are sent), and returns at most
``k`` rows of sums a task; Spark adds them up, and ``k`` rows come to the driver
for the exact floor of sum by count. An empty centroid stays. Vectors are
written once, as integers, and never shuffled.

Defined cases: vectors of another length, null, or with a null or non-finite
component take no part; a vector with a null id is clustered but starts no
centroid; repeated rows count as often as they occur, and may start a centroid
each; with fewer than ``k`` vectors (with an id) there are fewer centroids;
without any, no rows are returned; equal centroids: the smaller number takes
all. A component whose integer reaches ``limit(size)`` (2 ** 27 for 64) in size
is an error, as distances would not fit into 64 bits. Extra columns take no part and are not
returned.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

K, ROUNDS, SIZE, SCALE, SEED = 40, 5, 64, 256, "2"
_BLOCK = 4096  # vectors a task handles at once


class Centroids:
    """Centroids (rows of integers, numbered from 0) ready for the search."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.n = rows.shape[1]
        sums = rows.sum(axis=1)
        self.number = np.lexsort((np.arange(len(rows)), sums))  # of each place in the order by sum
        self.sorted = rows[self.number]
        self.sums = sums[self.number]
        self.spread = _spread(self.sorted, self.sums)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of each row's nearest centroid; how many
        distances were worked out."""
        rows, k, n = len(x), len(self.rows), self.n
        best = np.full(rows, np.iinfo(np.int64).max)
        number = np.full(rows, k)
        sums = x.sum(axis=1)
        spread = _spread(x, sums)
        right = np.searchsorted(self.sums, sums)  # the next place to look at on either side
        left = right - 1
        open_ = np.arange(rows)
        worked = 0
        while len(open_):
            lo, hi, s = left[open_], right[open_], sums[open_]
            down = np.where(lo >= 0, s - self.sums[np.maximum(lo, 0)], np.iinfo(np.int64).max)
            up = np.where(hi < k, self.sums[np.minimum(hi, k - 1)] - s, np.iinfo(np.int64).max)
            go_down = down <= up
            gap, at = np.minimum(down, up), np.where(go_down, lo, hi)
            # sums are below 2 ** 34 * n in size: squares are compared in doubles only when far apart
            more = (lo >= 0) | (hi < k)
            limit = best[open_]
            first = limit == np.iinfo(np.int64).max
            more &= first | (gap <= np.floor(np.sqrt(limit.astype(np.float64) * n)) + 1)
            open_, at, gap, go_down, limit, first = (v[more] for v in (open_, at, gap, go_down, limit, first))
            left[open_] -= go_down
            right[open_] += ~go_down
            bound = gap.astype(np.float64) ** 2 + (spread[open_] - self.spread[at]) ** 2
            look = first | (bound <= limit.astype(np.float64) * n * (1 + 1e-9) + 1)
            row, at = open_[look], at[look]
            d = ((x[row] - self.sorted[at]) ** 2).sum(axis=1)
            worked += len(row)
            better = (d < best[row]) | ((d == best[row]) & (self.number[at] < number[row]))
            best[row[better]] = d[better]
            number[row[better]] = self.number[at[better]]
        return number, best, worked


def limit(size: int) -> int:
    """Bound of components, so that squared distances stay under 2 ** 62."""
    return math.isqrt((1 << 62) // max(size, 1)) // 2


def _spread(x: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Square root of n * sum of squares - square of the sum."""
    f = x.astype(np.float64)
    centred = f - (sums / x.shape[1])[:, None]
    return np.sqrt(x.shape[1] * (centred ** 2).sum(axis=1))


def _matrices(batch: pa.RecordBatch, size: int):
    for lo in range(0, len(batch), _BLOCK):
        part = batch.slice(lo, _BLOCK)
        yield part, part.column("__v").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _sums(held):
    def run(batches):
        centroids = Centroids(held.value)
        k, size = held.value.shape
        total, count = np.zeros((k, size), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for _, x in _matrices(batch, size):
                number, _, _ = centroids.nearest(x)
                order = np.argsort(number, kind="stable")
                have, start = np.unique(number[order], return_index=True)
                total[have] += np.add.reduceat(x[order], start, axis=0)
                count += np.bincount(number, minlength=k)
        have = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(have.astype(np.int32)), pa.array(count[have]), *[pa.array(total[have, j]) for j in range(size)]],
            ["__k", "__n", *[f"__s{j}" for j in range(size)]])
    return run


def _assign(held):
    def run(batches):
        centroids = Centroids(held.value)
        for batch in batches:
            for part, x in _matrices(batch, centroids.n):
                number, d, _ = centroids.nearest(x)
                yield pa.RecordBatch.from_arrays([part.column("__i"), pa.array(number.astype(np.int32)), pa.array(d)],
                                                 ["__i", "cluster", "distance"])
    return run


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, size: int, scale: int) -> DataFrame:
    """Rows (``__i``, ``__v``): vectors of ``size`` components, as integers."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    ok = F.coalesce((F.size(vec_col) == size) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))
    big = F.exists(v, lambda x: F.abs(x * scale) >= limit(size))
    whole = F.when(big, F.raise_error(F.lit(f"a component reaches {limit(size)} / {scale}")).cast("array<bigint>")).otherwise(
        F.transform(v, lambda x: F.floor(x * scale)))
    return vectors.select(F.col(id_col).alias("__i"), F.when(ok, whole).alias("__v")).where(F.col("__v").isNotNull())


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", *, k: int = K, rounds: int = ROUNDS,
            size: int = SIZE, scale: int = SCALE, seed: str = SEED) -> DataFrame:
    """One row per vector that takes part: its id, ``cluster``, ``distance``
    (squared), ``cluster_inertia`` and ``inertia`` (distance summed over the
    cluster and over all) and ``centroid`` (the final integers).

    Centroids start as the ``k`` vectors with the smallest sha256 of
    ``seed:id``. The final assignment is written once."""
    spark = vectors.sparkSession
    rows = cut_lineage(integer_vectors(vectors, id_col, vec_col, size, scale), "op12-vectors")
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("__i").cast("string")), 256)
    start = rows.where(F.col("__i").isNotNull()).select(key.alias("h"), "__v").orderBy("h", "__v").limit(k).collect()
    kind = rows.schema["__i"].dataType.simpleString()
    if not start:
        return spark.createDataFrame([], f"`{id_col}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid array<bigint>")
    centroids = np.array([r["__v"] for r in start], np.int64)
    names = [f"__s{j}" for j in range(size)]
    for _ in range(rounds):
        held = spark.sparkContext.broadcast(centroids)
        sums = rows.mapInArrow(_sums(held), "__k int, __n bigint, " + ", ".join(f"{c} bigint" for c in names))
        whole = sums.groupBy("__k").agg(*[F.sum(c).alias(c) for c in ("__n", *names)]).toArrow()  # at most k rows
        found = np.stack([whole.column(c).to_numpy() for c in ("__k", "__n", *names)], axis=1).astype(np.int64)
        centroids = centroids.copy()
        centroids[found[:, 0]] = found[:, 2:] // found[:, 1:2]
        held.destroy()
    held = spark.sparkContext.broadcast(centroids)
    placed = cut_lineage(rows.mapInArrow(_assign(held), f"__i {kind}, cluster int, distance bigint"), "op12-placed")
    held.destroy()
    per = placed.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()
    total = sum(r["d"] for r in per)
    about = spark.createDataFrame([(r["cluster"], r["d"], total, centroids[r["cluster"]].tolist()) for r in per],
                                  "cluster int, cluster_inertia long, inertia long, centroid array<bigint>")
    # at most k rows
    return placed.join(F.broadcast(about), "cluster").select(
        F.col("__i").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid")
