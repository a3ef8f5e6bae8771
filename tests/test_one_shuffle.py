"""Numbering by window and range agree, and order lines are moved once, whatever the distinct counts."""
import re

from pyspark.sql import functions as F

from basketry.operators import ranking as R
from basketry.plans.customers import order_line_stats
from basketry.sources import fixtures


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def _exchanges(df):
    return len(re.findall(r"(?<!Broadcast)Exchange (?:hash|range)", df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]))


def _tables(spark, where):
    orders = [(i, None if i % 11 == 0 else 7 if i % 2 else i % 5, f"1995-01-{1 + i % 28:02d}") for i in range(120)] + [(None, 7, "1995-02-01"), (3, 7, "1995-01-04")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, d string").select("o_orderkey", "o_custkey", F.col("d").cast("date").alias("o_orderdate")) \
        .write.parquet(f"{where}/orders.parquet")
    lines = [(9 if i % 3 else i % 40, i % 70, i % 7) for i in range(400)] + [(None, 1, 1), (5, None, None), (5, None, 2)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int").write.parquet(f"{where}/lineitem.parquet")


def test_hot_groups_are_numbered_like_the_others(spark, tmp_path, monkeypatch):
    _tables(spark, tmp_path)
    plain = [_rows(fixtures.numbered_orders(spark, str(tmp_path))), _rows(fixtures.carted_lines(spark, str(tmp_path)))]
    monkeypatch.setattr(R, "HOT_ROWS", 20)
    _, hot = R.split_hot(spark.read.parquet(f"{tmp_path}/lineitem.parquet"), ["l_orderkey"])
    assert {r[0] for r in hot.select("l_orderkey").distinct().collect()} == {9}
    assert [_rows(fixtures.numbered_orders(spark, str(tmp_path))), _rows(fixtures.carted_lines(spark, str(tmp_path)))] == plain


def test_lines_are_moved_once_by_order(spark, tmp_path):
    _tables(spark, tmp_path)
    assert _exchanges(fixtures.carted_lines(spark, str(tmp_path))) == 1
    assert _exchanges(fixtures.numbered_orders(spark, str(tmp_path))) == 1


def test_line_totals_need_one_shuffle(spark):
    lines = spark.createDataFrame([(1, 2, True, 1, True), (1, 2, False, 2, False), (None, 3, None, None, None)],
                                  "order_id long, product_id long, is_reordered boolean, add_to_cart_order int, is_early_cart_addition boolean")
    got = order_line_stats(lines)
    assert _exchanges(got) == 1
    assert {r["order_id"]: (r["total_items"], r["unique_items"], r["reordered_items"]) for r in got.collect()} == {1: (2, 1, 1), None: (1, 1, 0)}
