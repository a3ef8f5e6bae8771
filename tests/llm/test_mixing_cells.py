"""Cells of the mix hold few documents, whatever the weights."""
import pytest
from pyspark.sql import functions as F

from basketry.llm import mixing as M


@pytest.mark.parametrize("weight", [1.0, 0.1, 0.05, 1e-6, 1e6])
def test_cells_are_small(spark, weight):
    n = 1 << 20
    u = (F.col("id") + 0.5) / n  # every quantile once
    cells = spark.range(n).select((-F.log(u) / weight).alias("__x")).select(M._cell(1).alias("a"), M._cell(2).alias("b"))
    first = cells.groupBy("a").count().agg(F.max("count")).first()[0]
    second = cells.groupBy("a", "b").count().agg(F.max("count")).first()[0]
    assert first < 0.013 * n and second <= 8


def test_lightest_documents_meet_their_target(spark):
    """All weights at the minimum, one source with nearly all rows."""
    rows = [(i, " ".join(["1" * 60] * (i % 11 + 1)), "a" if i % 50 else "b") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = M.mix(df)
    assert got.agg(F.max("weight")).first()[0] == M.MIN_WEIGHT
    for r in got.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect():
        assert abs(r["taken"] - r["target"]) <= 1
    again = M.mix(df.repartition(3))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, again.collect()))
