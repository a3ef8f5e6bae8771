"""NTILE and RANK from histograms against Spark's windows."""
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from basketry.operators import histograms
from basketry.operators.histograms import Order, histogram_rank, ntiles

ORDERS = [Order("a", "ta", ascending=False), Order("b", "tb"), Order("c", "tc"), Order("d", "td", ascending=False)]


def _frame(spark, n, seed):
    rnd = random.Random(seed)
    ids = rnd.sample(range(-2 ** 61, 2 ** 61), n)  # beyond what a double tells apart
    ids[:n // 2] = [ids[-1] + 1 + i for i in range(n // 2)]
    rows = [(i, rnd.choice([None, rnd.random() * 10 ** rnd.randint(-9, 9)]), rnd.choice([None, 1, 1, 1, 2, 7]),
             rnd.choice([5, rnd.randint(-10 ** 17, 10 ** 17)]), rnd.randint(0, 3) * 0.1) for i in ids]
    return spark.createDataFrame(rows, "id long, a double, b int, c long, d double").repartition(3)


@pytest.mark.parametrize("n,k,bins", [(0, 4, 2048), (1, 4, 2048), (3, 4, 2048), (10, 4, 3), (1001, 4, 16), (500, 7, 2048), (8, 8, 2)])
def test_ntiles_match_window(spark, monkeypatch, n, k, bins):
    monkeypatch.setattr(histograms, "BINS", bins)
    df = _frame(spark, n, n)
    got = ntiles(df, k, ORDERS, "id")
    want = df
    for o in ORDERS:
        by = F.col(o.col).asc_nulls_last() if o.ascending else F.col(o.col).desc_nulls_last()
        want = want.withColumn(o.out, F.ntile(k).over(Window.orderBy(by, "id")))
    assert got.dtypes == want.dtypes
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_ntiles_move_no_rows(spark):
    """The result's plan is a projection: no exchange, sort or join."""
    plan = ntiles(_frame(spark, 50, 1), 4, ORDERS, "id")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Sort" not in plan and "Join" not in plan and "Window" not in plan


@pytest.mark.parametrize("col,bins", [("a", 2048), ("a", 4), ("b", 2048), ("c", 16), ("d", 3)])
def test_rank_matches_window(spark, monkeypatch, col, bins):
    monkeypatch.setattr(histograms, "BINS", bins)
    df = _frame(spark, 700, 3).withColumn("g", F.when(F.col("d") < 0.25, F.col("b")))
    for groups in ([], ["g"]):
        for ascending, nulls_last in ((False, False), (True, True), (True, False), (False, True)):
            got = histogram_rank(df, groups, col, "r", ascending, nulls_last)
            by = {(False, False): "desc_nulls_first", (True, True): "asc_nulls_last", (True, False): "asc_nulls_first", (False, True): "desc_nulls_last"}
            want = df.withColumn("r", F.rank().over(Window.partitionBy(*groups).orderBy(getattr(F.col(col), by[ascending, nulls_last])())))
            assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_rank_of_nothing(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    assert [r["r"] for r in histogram_rank(df, [], "v", "r").collect()] == [1, 1]
    assert histogram_rank(df.limit(0), [], "v", "r").count() == 0


def test_product_ranks_sort_no_products(spark):
    """Neither rank sorts or range-partitions the products."""
    from basketry.plans.products import product_ranks
    rows = [(p, p % 3, (p * 7 % 11) / 10, p * p % 17) for p in range(200)]
    plan = product_ranks(spark.createDataFrame(rows, "product_id long, department_id long, reorder_rate double, times_ordered long")
                         )._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Window" not in plan
