"""The model graph on hand-built raw tables with the edge cases the sample
data does not reach: a user whose only order is the first, an order with no
lines, a line whose product is not in the catalog, 16+ cart positions."""
import pytest
from pyspark.sql import functions as F

from basketry import schemas
from basketry.operators.quality import dq_suite
from basketry.plans.pipeline import Models

TS = "2024-01-01 06:00:00"


def _raw(spark, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return df.withColumns({"_loaded_at": F.to_timestamp(F.lit(TS)), "_source_file": F.lit("test.csv")})


@pytest.fixture(scope="module")
def m(spark):
    orders = [  # order_id, user_id, order_number, dow, hour, days
        (1, 10, 1, 1, 8, None), (2, 10, 2, 3, 17, 7.0), (3, 10, 3, 0, 23, 14.0),  # user 10; order 3 has no lines
        (4, 20, 1, 6, 12, None),                                                    # user 20: first order only
    ]
    prior = [(1, 100, 1, 0), (1, 101, 2, 1), (4, 999, 1, 0)]   # product 999 is not in the catalog
    train = [(2, 100, 1, 1)] + [(2, 200 + i, 2 + i, 0) for i in range(16)]  # cart positions up to 17
    products = [(100, "apple", 1, 1), (101, "milk", 2, 2)] + [(200 + i, f"p{i}", 1, 1) for i in range(16)]
    raw = {
        "orders": _raw(spark, orders, schemas.ORDERS),
        "order_products_prior": _raw(spark, prior, schemas.ORDER_PRODUCTS),
        "order_products_train": _raw(spark, train, schemas.ORDER_PRODUCTS),
        "products": _raw(spark, products, schemas.PRODUCTS),
        "aisles": _raw(spark, [(1, "fruit"), (2, "dairy")], schemas.AISLES),
        "departments": _raw(spark, [(1, "produce"), (2, "dairy")], schemas.DEPARTMENTS),
    }
    return Models(spark, raw, TS)


def test_customer_history(m):
    rows = {r.user_id: r for r in m.customer_history.collect()}
    assert set(rows) == {10}                      # user 20 has no non-first order
    h = rows[10]
    assert (h.total_orders, h.avg_days_between_orders, h.min_days_between_orders, h.max_days_between_orders) \
        == (2, 10.5, 7.0, 14.0)
    assert (h.most_common_order_day, h.most_common_order_hour) == ("Wednesday", 23)   # MAX, not mode
    assert (h.total_items_ordered, h.total_reordered_items) == (19, 2)               # first order included
    assert h.avg_basket_size == pytest.approx(19 / 2)   # orders 1 and 2 have lines
    assert h.reorder_rate == pytest.approx(2 / 19)


def test_order_fact(m):
    f = {r.order_id: r for r in m.fact_orders.collect()}
    assert (f[3].total_items, f[3].unique_items, f[3].order_reorder_rate, f[3].avg_cart_position) == (0, 0, 0.0, None)
    assert f[4].user_key is None and f[1].user_key is not None
    assert (f[2].total_items, f[2].first_item_cart_pos, f[2].last_item_cart_pos, f[2].early_cart_items) == (17, 1, 17, 5)
    assert f[1].order_time_of_day == "Morning" and f[3].order_time_of_day == "Night"


def test_line_fact_and_product_mart(m):
    lines = {(r.order_id, r.product_id): r for r in m.fact_order_products.collect()}
    assert lines[(4, 999)].product_key is None and lines[(4, 999)].user_key is None
    buckets = {r.cart_position_bucket for r in m.fact_order_products.collect()}
    assert buckets == {"1-5 Staples", "6-15 Regular", "16+ Browse"}
    pp = {r.product_id: r for r in m.product_performance.collect()}
    assert 999 not in pp                               # inner join with the catalog
    assert (pp[100].times_ordered, pp[100].times_reordered, pp[100].reorder_rate) == (2, 1, 0.5)
    assert pp[100].overall_popularity_rank == 1 and pp[101].overall_popularity_rank == 2


def test_quality_reports_the_gaps(m):
    class T:
        def __getitem__(self, k):
            return m.raw[k] if k in m.raw else getattr(m, k)
    rows = {(r.table_name, r.column_name, r.check_name): r.failures for r in dq_suite(T()).collect()}
    assert rows[("fact_orders", "user_key", "not_null")] == 1
    assert rows[("fact_order_products", "product_key", "not_null")] == 1
    assert rows[("fact_order_products", "product_key", "relationships")] == 0
    assert rows[("customer_360", "reorder_rate", "range")] == 0


def test_history_with_an_order_loaded_twice(spark):
    from basketry.plans.customers import customer_history
    orders = spark.createDataFrame(
        [(1, 10, False, 7.0, "Monday", 9)] * 2 + [(2, 10, True, None, "Sunday", 8)],
        "order_id long, user_id long, is_first_order boolean, days_since_prior_order double, "
        "order_day_name string, order_hour_of_day int")
    lines = spark.createDataFrame(
        [(1, 5, 1, True, True)],
        "order_id long, product_id long, add_to_cart_order int, is_reordered boolean, is_early_cart_addition boolean")
    r = customer_history(orders, lines).first()
    assert (r.total_orders, r.total_items_ordered, r.avg_basket_size, r.avg_days_between_orders) == (1, 2, 2.0, 7.0)
