"""The ordinal fit: likelihood and slopes against plain loops, reruns, held-out rows."""
import math

import numpy as np
from pyspark.sql import functions as F

from basketry.llm import quality as Q

SF = "/root/testdata/sf0.01"


def _plain(rows, grade, each, weights, cuts):
    total = 0.0
    for entries, g, e in zip(rows, grade, each):
        s = sum(v * weights[p] for p, v in entries)
        above = [1.0, *(1 / (1 + math.exp(-(s - c))) for c in cuts), 0.0]
        total -= e * math.log(above[g] - above[g + 1])
    return total


def test_likelihood_and_slopes():
    rng = np.random.default_rng(1)
    rows = [[(int(p), float(v)) for p, v in zip(rng.integers(0, 7, 4), rng.normal(size=4))] for _ in range(30)]
    grade, each = rng.integers(0, 3, 30), rng.random(30)
    row = np.repeat(np.arange(30), 4)
    place, value = (np.array([x[i] for r in rows for x in r]) for i in (0, 1))
    weights, cuts = rng.normal(size=7), np.array([-0.4, 0.9])
    loss, by_weight, by_cut = Q.likelihood(row, place, value, grade, each, weights, cuts)
    assert abs(loss - _plain(rows, grade, each, weights, cuts)) < 1e-9
    for vector, slope in ((weights, by_weight), (cuts, by_cut)):
        for j in range(len(vector)):
            up, down = vector.copy(), vector.copy()
            up[j] += 1e-5
            down[j] -= 1e-5
            ends = [_plain(rows, grade, each, *((v, cuts) if vector is weights else (weights, v))) for v in (up, down)]
            assert abs((ends[0] - ends[1]) / 2e-5 - slope[j]) < 1e-6


def test_minimise_reaches_the_minimum():
    a = np.diag([1.0, 50.0, 900.0]) + 0.3
    b = np.array([1.0, -2.0, 3.0])
    got = Q.minimise(lambda x: (0.5 * x @ a @ x - b @ x + 10, a @ x - b), np.zeros(3), 200)
    assert np.allclose(got, np.linalg.solve(a, b), atol=1e-2)


def test_fit_does_not_depend_on_partitions(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    one, again = Q.fit(docs.repartition(2), labels), Q.fit(docs.repartition(2), labels)
    assert np.allclose(one["weights"], again["weights"], atol=1e-4) and np.allclose(one["cuts"], again["cuts"], atol=1e-4)


def test_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    rated = Q.rate(docs, Q.fit(docs, labels.where(~held))).join(labels.where(held), "doc_id")
    toxic, good = (rated.where(c).agg(F.avg(F.col("keep").cast("int"))).first()[0] for c in ("toxic = 1", "toxic = 0 AND quality = 1"))
    assert toxic < 0.2 and good > 0.94
    graded = rated.withColumn("g", F.when(F.col("toxic") > 0, 0).when(F.col("quality") > 0, 2).otherwise(1)).groupBy("g").agg(F.avg("expected_grade").alias("e"))
    e = {r["g"]: r["e"] for r in graded.collect()}
    assert e[0] < e[1] < e[2]
