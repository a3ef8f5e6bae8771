import hashlib

from pyspark.sql import functions as F

from basketry.functions import scalar as S


def col_values(spark, values, expr, dtype="int"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_day_name_and_out_of_range(spark):
    got = col_values(spark, [0, 1, 2, 3, 4, 5, 6, 7, None], S.day_name)
    assert got == ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", None, None]


def test_time_of_day_boundaries(spark):
    got = col_values(spark, [4, 5, 11, 12, 16, 17, 20, 21, None], S.time_of_day)
    assert got == ["Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening", "Night", "Night"]


def test_cart_and_early_flags(spark):
    assert col_values(spark, [5, 6, 15, 16, None], S.cart_position_bucket) == [
        "1-5 Staples", "6-15 Regular", "6-15 Regular", "16+ Browse", "16+ Browse"]
    assert col_values(spark, [5, 6, None], S.is_early_cart) == [True, False, False]


def test_frequency_loyalty_reorder_popularity(spark):
    assert col_values(spark, [7.0, 14.0, 30.0, 30.1, None], S.order_frequency_bucket, "double") == [
        "Weekly", "Bi-Weekly", "Monthly", "Infrequent", "Infrequent"]
    rates = [0.39996, 0.4, 0.69996, 0.7, None]
    assert col_values(spark, rates, S.loyalty_tier, "double") == [
        "Low Loyalty", "Medium Loyalty", "Medium Loyalty", "High Loyalty", "Low Loyalty"]
    assert col_values(spark, rates, S.reorder_tier, "double") == [
        "Low Reorder", "Medium Reorder", "Medium Reorder", "High Reorder", "Low Reorder"]
    assert col_values(spark, [100, 101, 500, 501, 1000, 1001], S.popularity_tier) == [
        "Top 100", "Top 500", "Top 500", "Top 1000", "Top 1000", "Long Tail"]


EXPECTED_SEGMENTS = {
    (4, 4): "Champion", (3, 3): "Champion", (4, 2): "Loyal Customer", (3, 2): "Loyal Customer",
    (4, 1): "New Customer", (3, 1): "New Customer", (2, 4): "At Risk", (2, 3): "At Risk",
    (2, 2): "Needs Attention", (1, 4): "Cant Lose Them", (1, 3): "Cant Lose Them",
    (1, 1): "Hibernating", (2, 1): "Unknown", (1, 2): "Unknown", (4, 3): "Champion", (3, 4): "Champion",
}


def test_segment_matrix_all_16_cells(spark):
    df = spark.createDataFrame(list(EXPECTED_SEGMENTS), "r int, f int")
    got = {(r.r, r.f): r.s for r in df.select("r", "f", S.customer_segment("r", "f").alias("s")).collect()}
    assert got == EXPECTED_SEGMENTS
    nulls = spark.createDataFrame([(None, 3)], "r int, f int").select(S.customer_segment("r", "f")).first()[0]
    assert nulls == "Unknown"


def test_safe_divide(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (3, 4)], "n int, d int")
    assert [r[0] for r in df.select(S.safe_divide("n", "d")).collect()] == [None, None, 0.75]
    assert [r[0] for r in df.select(S.safe_divide("n", "d", 0)).collect()] == [0.0, 0.0, 0.75]


def test_round_n_is_decimal_half_up(spark):
    df = spark.createDataFrame([(23, 40), (57, 200), (1, 3)], "a int, b int")
    got = [r[0] for r in df.select(S.round_n(F.col("a") / F.col("b"), 2)).collect()]
    assert got == [0.58, 0.29, 0.33]


def test_rfm_average(spark):
    df = spark.createDataFrame([(1, 1, 2), (4, 4, 3), (1, 1, 1)], "r int, f int, m int")
    assert [r[0] for r in df.select(S.rfm_average("r", "f", "m")).collect()] == [1.33, 3.67, 1.0]


def test_surrogate_key_matches_md5_convention(spark):
    df = spark.createDataFrame([(1, 2), (5, None)], "a long, b long")
    got = [r[0] for r in df.select(S.surrogate_key("a", "b")).collect()]
    assert got[0] == hashlib.md5(b"1-2").hexdigest()
    assert got[1] == hashlib.md5(b"5-_dbt_utils_surrogate_key_null_").hexdigest()
    lit = df.select(S.surrogate_key("a", F.lit("2019-01-01"))).first()[0]
    assert lit == hashlib.md5(b"1-2019-01-01").hexdigest()
    single = df.select(S.surrogate_key("a")).first()[0]
    assert single == hashlib.md5(b"1").hexdigest()


def test_join_small_measures_and_falls_back(spark):
    from basketry.operators.joins import join_small, measured_bytes
    small = spark.createDataFrame([(1, "abcd"), (2, None)], "k long, name string")
    assert measured_bytes(small) == 2 * 16 + 4 * 4
    big = spark.range(10).withColumnRenamed("id", "k")
    hinted = join_small(big, small, "k", "left")
    assert "BroadcastHashJoin" in hinted._jdf.queryExecution().executedPlan().toString()
    assert hinted.count() == 10
    shuffled = join_small(big, small, "k", "left", max_bytes=10)
    assert shuffled.count() == 10
