import datetime as dt


from basketry.operators.incremental import newer_than, scd2_as_of, scd2_merge, unseen, upsert
from basketry.plans.dims import dim_products


def test_upsert_replaces_and_appends_columns(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    updates = spark.createDataFrame([(2, "B", 1.5), (3, "c", 2.5)], "k long, v string, extra double")
    got = sorted(tuple(r) for r in upsert(target, updates, ["k"], append_new_columns=True).collect())
    assert got == [(1, "a", None), (2, "B", 1.5), (3, "c", 2.5)]
    ignored = upsert(target, updates, ["k"])
    assert ignored.columns == ["k", "v"]
    assert sorted(tuple(r) for r in ignored.collect()) == [(1, "a"), (2, "B"), (3, "c")]


def test_upsert_repeated_batch_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a")], "k long, v string")
    batch = spark.createDataFrame([(2, "b")], "k long, v string")
    once = upsert(target, batch, ["k"])
    twice = upsert(once, batch, ["k"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_watermark_empty_target_both_behaviours(spark):
    src = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2))], "k long, t timestamp")
    empty = src.limit(0)
    assert newer_than(src, empty, "t").count() == 2                          # chosen: load everything
    assert newer_than(src, empty, "t", null_loads_all=False).count() == 0    # as coded: t > NULL
    assert [r.k for r in newer_than(src, src.filter("k = 1"), "t").collect()] == [2]


def test_unseen_skips_late_lines_of_known_orders(spark):
    target = spark.createDataFrame([(10, "10-1")], "order_id long, order_product_id string")
    lines = spark.createDataFrame([(10, "10-2"), (11, "11-1"), (None, "x")], "order_id long, order_product_id string")
    assert [r.order_product_id for r in unseen(lines, target, "order_id").collect()] == ["11-1"]
    by_line = sorted(r.order_product_id for r in unseen(lines, target, "order_product_id").collect())
    assert by_line == ["10-2", "11-1", "x"]


def _catalog(spark, rows):
    return spark.createDataFrame(rows, "product_id long, product_name string, aisle_id long, aisle_name string, "
                                       "department_id long, department_name string")


TRACKED = ["product_name", "aisle_id", "aisle_name", "department_id", "department_name"]


def test_scd2_merge_closes_and_opens_versions(spark):
    base = _catalog(spark, [(1, "apple", 1, "fruit", 1, "produce"), (2, "milk", 2, "dairy", 2, "dairy")])
    dim = dim_products(base, "2019-01-01", "2024-01-01 00:00:00")
    snap = _catalog(spark, [(1, "apple", 1, "fruit", 1, "produce"), (2, "milk", 2, "dairy", 3, "frozen"),
                            (3, "pear", 1, "fruit", 1, "produce")])
    merged = scd2_merge(dim, snap, "product_id", TRACKED, "2019-07-01", "2024-07-01 00:00:00")
    rows = sorted((r.product_id, r.department_id, str(r.valid_from), str(r.valid_to), r.is_current)
                  for r in merged.collect())
    assert rows == [(1, 1, "2019-01-01", "None", True), (2, 2, "2019-01-01", "2019-07-01", False),
                    (2, 3, "2019-07-01", "None", True), (3, 1, "2019-07-01", "None", True)]
    assert merged.select("product_key").distinct().count() == 4
    # merging the same snapshot again changes nothing
    again = scd2_merge(merged, snap, "product_id", TRACKED, "2019-09-01", "2024-09-01 00:00:00")
    assert sorted(merged.collect()) == sorted(again.collect())
    before = {r.product_id: r.department_id for r in scd2_as_of(merged, "2019-03-01").collect()}
    after = {r.product_id: r.department_id for r in scd2_as_of(merged, "2019-08-01").collect()}
    assert before == {1: 1, 2: 2} and after == {1: 1, 2: 3, 3: 1}


def test_scd2_same_date_replaces_and_earlier_date_fails(spark):
    import pytest
    dim = dim_products(_catalog(spark, [(1, "milk", 2, "dairy", 2, "dairy")]), "2019-01-01", "2024-01-01 00:00:00")
    frozen = _catalog(spark, [(1, "milk", 2, "dairy", 3, "frozen")])
    drinks = _catalog(spark, [(1, "milk", 2, "dairy", 4, "drinks")])
    once = scd2_merge(dim, frozen, "product_id", TRACKED, "2019-07-01", "2024-07-01 00:00:00")
    twice = scd2_merge(once, drinks, "product_id", TRACKED, "2019-07-01", "2024-07-01 12:00:00")
    rows = sorted((str(r.valid_from), str(r.valid_to), r.department_id, r.is_current) for r in twice.collect())
    assert rows == [("2019-01-01", "2019-07-01", 2, False), ("2019-07-01", "None", 4, True)]
    assert twice.select("product_key").distinct().count() == 2
    with pytest.raises(Exception, match="change effective before"):
        scd2_merge(once, drinks, "product_id", TRACKED, "2019-06-01", "2024-07-01 12:00:00").collect()


def test_two_load_fact_equals_full_build(spark):
    import __spark_entry__ as E
    full = E.queries()["fact_orders"](spark, "/root/testdata/sf0.001").drop("loaded_at")
    inc = E.queries()["fact_orders_incremental"](spark, "/root/testdata/sf0.001").drop("loaded_at")
    assert full.count() == inc.count()
    assert inc.exceptAll(full.select(*inc.columns)).count() == 0
