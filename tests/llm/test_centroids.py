"""Centroid clustering: the search against all distances, the whole against SQL and plain k-means."""
import hashlib

import numpy as np
import pytest

from basketry.llm import oracle, queries
from basketry.llm.centroids import Centroids, cluster, limit


@pytest.mark.parametrize("reach", [2, 40, 3000, limit(64) - 1])
def test_search_is_exact(reach):
    rng = np.random.default_rng(reach)
    for k in (1, 2, 40):
        c = rng.integers(-reach, reach + 1, (k, 64))
        c[k // 2:] = np.where(rng.random((k - k // 2, 64)) < 0.5, c[: k - k // 2], c[k // 2:])  # near and equal centroids
        x = np.concatenate([rng.integers(-reach, reach + 1, (300, 64)), c, (c[:1] + c) // 2])
        number, d, worked = Centroids(c).nearest(x)
        every = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
        assert (d == every.min(axis=1)).all() and (number == every.argmin(axis=1)).all()
        assert worked <= len(x) * k
    assert len(Centroids(c).nearest(x[:0])[0]) == 0


def test_search_rejects(spark):
    rng = np.random.default_rng(3)
    c = rng.integers(-60, 60, (40, 64)) + rng.integers(-100, 100, (40, 1))
    x = c[rng.integers(0, 40, 2000)] + rng.integers(-5, 6, (2000, 64))
    assert Centroids(c).nearest(x)[2] < 2000 * 40 / 4


def _plain(rows, k, rounds):
    def floor(v):
        return [int(np.floor(256 * float(x))) for x in v]
    kept = [(i, floor(v)) for i, v in rows if v is not None and len(v) == 4 and all(x is not None and np.isfinite(x) for x in v)]
    key = lambda r: (hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1])
    c = [v for _, v in sorted((r for r in kept if r[0] is not None), key=key)[:k]]

    def place():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, w)) for w in c]
            out.append((d.index(min(d)), min(d)))
        return out
    for _ in range(rounds if c else 0):
        at = place()
        for j in range(len(c)):
            mine = [v for (_, v), (m, _) in zip(kept, at) if m == j]
            if mine:
                c[j] = [sum(col) // len(mine) for col in zip(*mine)]
    at = place() if c else []
    per = [sum(d for m, d in at if m == j) for j in range(len(c))]
    return sorted(((i, m, d, per[m], sum(per), c[m]) for (i, _), (m, d) in zip(kept, at)), key=repr) if c else []


@pytest.mark.parametrize("k", [1, 3, 60])
def test_odd_rows_match_plain(spark, k):
    rng = np.random.default_rng(k)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(40)]
    rows += [(None, [0.5, 0.5, 0.0, 1.0]), (3, rows[3][1]), (3, rows[3][1]), (50, None), (51, []), (52, [1.0, None, 0.0, 0.0]),
             (53, [float("nan"), 0.0, 0.0, 0.0]), (54, [float("inf"), 0.0, 0.0, 0.0]), (55, [1.0] * 5)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, cluster int, __v string").repartition(3)
    got = cluster(df, k=k, size=4)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == _plain(rows, k, 5)


def test_empty_and_too_large(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert cluster(df).count() == 0
    big = spark.createDataFrame([(1, [1e9] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="a component reaches"):
        cluster(big).count()


def test_query_matches_sql(spark, duck):
    sf = "/root/testdata/sf0.001"
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    got = queries.op12_centroids(spark, sf)
    want = duck.sql(oracle.OP12)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(repr, (tuple(r) for r in got.select(*want.columns).collect()))) == sorted(map(repr, want.fetchall()))
