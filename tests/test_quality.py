from pyspark.sql import functions as F

from basketry.operators import quality as Q


def test_single_checks_count_one_violation(spark):
    df = spark.createDataFrame([(1, 0, "a"), (2, 1, None), (2, 7, "c"), (None, 1, "d")],
                               "k long, flag int, name string")
    nn = {r.column_name: r.failures for r in Q.dq_not_null(df, ["k", "name", "flag"]).collect()}
    assert nn == {"k": 1, "name": 1, "flag": 0}
    assert Q.dq_unique(df, "k").first().failures == 1           # value 2 twice; NULL ignored
    assert Q.dq_accepted(df, "flag", [0, 1]).first().failures == 1
    parent = spark.createDataFrame([(1,), (2,)], "k long")
    child = spark.createDataFrame([(1,), (3,), (3,), (None,)], "k long")
    assert Q.dq_relationship(child, "k", parent, "k").first().failures == 2   # rows, not values
    assert Q.dq_range(spark.createDataFrame([(0.5,), (1.2,), (-0.1,)], "r double"), "r", 0, 1).count() == 2


def test_clean_frame_passes(spark):
    df = spark.createDataFrame([(1, 0), (2, 1)], "k long, flag int")
    assert Q.dq_unique(df, "k").first().failures == 0
    assert Q.dq_accepted(df, "flag", [0, 1]).first().failures == 0
    assert Q.dq_relationship(df, "k", df, "k").first().failures == 0


def test_freshness_levels(spark):
    df = spark.createDataFrame([("2024-01-01 06:00:00",)], "t string").select(F.to_timestamp("t").alias("t"))
    status = lambda now: Q.dq_freshness(df, "t", now).first().status
    assert status("2024-01-01 20:00:00") == "pass"
    assert status("2024-01-02 12:00:00") == "warn"
    assert status("2024-01-04 00:00:00") == "error"


def test_suite_counts_and_reports_known_gap(spark):
    import __spark_entry__ as E
    report = E.queries()["dq_suite"](spark, "/root/testdata/sf0.01")
    rows = {(r.table_name, r.column_name, r.check_name): (r.failures, r.status) for r in report.collect()}
    assert len(rows) == 73 == len(Q.CHECKS)
    # users whose only order is their first are not in dim_users: their orders have no user_key
    assert rows[("fact_orders", "user_key", "not_null")] == (2, "fail")
    assert rows[("fact_orders", "user_key", "relationships")] == (0, "pass")
    failing = {k for k, v in rows.items() if v[1] == "fail"}
    assert failing == {("fact_orders", "user_key", "not_null")}


def test_suite_flags_broken_table(spark):
    broken = spark.createDataFrame([(1, 1), (1, 9)], "order_id long, order_dow int")
    checks = [Q.Check("orders", "order_id", "unique"), Q.Check("orders", "order_dow", "accepted_values", Q.DOW_VALUES)]
    got = {r.check_name: (r.failures, r.status) for r in Q.dq_suite({"orders": broken}, checks).collect()}
    assert got == {"unique": (1, "fail"), "accepted_values": (1, "fail")}


def test_suite_with_freshness(spark):
    df = spark.createDataFrame([(1,)], "order_id long").select(
        "order_id", F.to_timestamp(F.lit("2024-01-01 06:00:00")).alias("_loaded_at"))
    tables = {t: df for t in Q.FRESHNESS_TABLES}
    rows = {(r.table_name, r.check_name): r.status
            for r in Q.dq_suite(tables, [Q.Check("orders", "order_id", "not_null")], now="2024-01-02 12:00:00").collect()}
    assert rows[("orders", "not_null")] == "pass"
    assert rows[("departments", "freshness")] == "warn"


def test_parallel_runner_equals_union_suite(spark):
    import __spark_entry__ as E
    from basketry.queries import _SuiteTables, models
    tables = _SuiteTables(models(spark, "/root/testdata/sf0.001"))
    lazy = sorted(tuple(r) for r in Q.dq_suite(tables).collect())
    run = sorted(tuple(r) for r in Q.run_dq_suite(tables, threads=4).collect())
    assert lazy == run and len(run) == 73
    with_fresh = Q.run_dq_suite(tables, now="2024-01-02 12:00:00").filter("check_name = 'freshness'")
    assert {r.status for r in with_fresh.collect()} == {"warn"}
