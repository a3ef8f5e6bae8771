"""Reporting queries of the dashboard and the documented business questions.

Each report is a Spark aggregation over the marts and facts; only the small
result is meant to reach a caller. Top-k reports break ties by a stable
column so the first k rows are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import round_n, safe_divide
from ..operators.joins import join_small
from ..operators.pairs import top_pairs

# The limits and the popularity threshold of the dashboard.
TOP_PRODUCTS_MIN_TIMES, TOP_PRODUCTS_LIMIT = 1000, 15
TOP_REORDERED_LIMIT = 20
PEAK_TIMES_LIMIT = 10
HOUR_LABEL_SUFFIX = ":00"


def rpt_kpi(fact_orders: DataFrame) -> DataFrame:
    """Orders, customers (NULL user keys ignored), average basket (1 dp) and
    average order reorder rate (3 dp).

    The two distinct counts come from two partial states that add up, one row
    per order and one per user (map-side combined); together in one aggregation
    Spark would expand every order to a row per count."""
    measures = ["total_items", "order_reorder_rate"]
    state = [f(c).alias(f"{c}_{n}") for c in measures for n, f in (("sum", F.sum), ("n", F.count))]
    added = [F.sum(f"{c}_{n}").alias(f"{c}_{n}") for c in measures for n in ("sum", "n")]
    per_order = fact_orders.groupBy("order_id").agg(*state).agg(F.count("order_id").alias("orders"), *added)
    per_user = fact_orders.select("user_key").groupBy("user_key").agg(F.lit(1).alias("one")).agg(F.count("user_key").alias("users"))
    both = per_order.unionByName(per_user, allowMissingColumns=True)
    return both.agg(F.sum("orders").alias("total_orders"), F.sum("users").alias("total_users"), *added).select(
        "total_orders", "total_users",
        round_n(safe_divide("total_items_sum", "total_items_n"), 1).alias("avg_basket_size"),
        round_n(safe_divide("order_reorder_rate_sum", "order_reorder_rate_n"), 3).alias("avg_reorder_rate"))


def _by_customer_attribute(customer_360: DataFrame, col: str) -> DataFrame:
    return (customer_360.groupBy(col)
            .agg(F.count(F.lit(1)).alias("customers"),
                 round_n(F.avg("reorder_rate") * 100, 1).alias("avg_reorder_pct"))
            .orderBy(F.col("customers").desc(), F.col(col).asc()))


def rpt_segments(customer_360: DataFrame) -> DataFrame:
    """Customers and average reorder % (1 dp) per RFM segment, largest first."""
    return _by_customer_attribute(customer_360, "customer_segment")


def rpt_loyalty(customer_360: DataFrame) -> DataFrame:
    """Customers and average reorder % (1 dp) per loyalty tier, largest first."""
    return _by_customer_attribute(customer_360, "loyalty_tier")


def rpt_frequency(customer_360: DataFrame) -> DataFrame:
    """Customers and average reorder % (1 dp) per order-frequency bucket."""
    return _by_customer_attribute(customer_360, "order_frequency_bucket")


def rpt_segment_rate(customer_360: DataFrame) -> DataFrame:
    """Customers and average reorder rate (3 dp) per RFM segment."""
    return (customer_360.groupBy("customer_segment")
            .agg(F.count(F.lit(1)).alias("customers"),
                 round_n(F.avg("reorder_rate"), 3).alias("avg_reorder_rate"))
            .orderBy(F.col("customers").desc(), F.col("customer_segment").asc()))


def rpt_top_products(product_performance: DataFrame, min_times: int = TOP_PRODUCTS_MIN_TIMES,
                     limit: int = TOP_PRODUCTS_LIMIT) -> DataFrame:
    """Top products by reorder rate among those ordered more than
    ``min_times`` times (top-k: per-partition top-k, then a bounded merge)."""
    return (product_performance
            .filter(F.col("times_ordered") > min_times)
            .orderBy(F.col("reorder_rate").desc(), F.col("product_id").asc())
            .limit(limit)
            .select("product_name", "department_name",
                    round_n(F.col("reorder_rate") * 100, 1).alias("reorder_pct"),
                    "times_ordered"))


def rpt_hourly(fact_orders: DataFrame) -> DataFrame:
    """Orders per hour of day with an "H:00" label, by hour."""
    return (fact_orders.groupBy("order_hour_of_day")
            .agg(F.count(F.lit(1)).alias("order_count"))
            .select(F.col("order_hour_of_day").alias("hour"), "order_count",
                    F.concat(F.col("order_hour_of_day").cast("string"), F.lit(HOUR_LABEL_SUFFIX))
                    .alias("hour_label"))
            .orderBy("hour"))


def rpt_daily(fact_orders: DataFrame) -> DataFrame:
    """Orders per day of week (name and number), by day number."""
    return (fact_orders.groupBy("order_day_name", "order_day_of_week")
            .agg(F.count(F.lit(1)).alias("order_count"))
            .select(F.col("order_day_name").alias("day"), F.col("order_day_of_week").alias("day_num"),
                    "order_count")
            .orderBy("day_num"))


def _current_products(dim_products: DataFrame) -> DataFrame:
    """Current versions by product: a line of an earlier version (whose key the
    fact keeps) resolves to the product's current one through ``product_id``."""
    return dim_products.filter(F.col("is_current") == F.lit(True)).select(
        "product_id", "product_name", "department_name")


def rpt_departments(fact_order_products: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Line count, reorder % and distinct orders per department (line
    weighted). The catalog side is broadcast behind a size check; the
    distinct order count is Spark's two-level distinct aggregation, so one
    large department is spread over the (department, order) hash space."""
    joined = join_small(fact_order_products.select("product_id", "order_id", "is_reordered"),
                        _current_products(dim_products), "product_id", "inner")
    return (joined.groupBy("department_name")
            .agg(F.count(F.lit(1)).alias("total_line_items"),
                 round_n(F.avg(F.col("is_reordered").cast("int")) * 100, 1).alias("reorder_pct"),
                 F.countDistinct("order_id").alias("unique_orders"))
            .orderBy(F.col("total_line_items").desc(), F.col("department_name").asc()))


def rpt_top_reordered(fact_order_products: DataFrame, dim_products: DataFrame,
                      limit: int = TOP_REORDERED_LIMIT) -> DataFrame:
    """Top (product name, department) pairs by average reorder flag over
    current product versions. Lines are reduced per product first (sum and
    count of the non-NULL flags: the average is their ratio, NULL when there
    is none), then joined to the catalog."""
    per_product = (fact_order_products.groupBy("product_id")
                   .agg(F.sum(F.col("is_reordered").cast("int")).alias("reordered"),
                        F.count("is_reordered").alias("flags")))
    joined = join_small(per_product, _current_products(dim_products), "product_id", "inner")
    return (joined.groupBy("product_name", "department_name")
            .agg(round_n(safe_divide(F.sum("reordered"), F.sum("flags")), 3).alias("reorder_rate"))
            .orderBy(F.col("reorder_rate").desc(), F.col("product_name").asc(),
                     F.col("department_name").asc())
            .limit(limit))


def rpt_peak_times(fact_orders: DataFrame, limit: int = PEAK_TIMES_LIMIT) -> DataFrame:
    """Busiest (day, hour) pairs: top-k by order count, ties by day and hour."""
    return (fact_orders.groupBy("order_day_name", "order_hour_of_day")
            .agg(F.count(F.lit(1)).alias("order_count"))
            .orderBy(F.col("order_count").desc(), F.col("order_day_name").asc(),
                     F.col("order_hour_of_day").asc())
            .limit(limit))


# --- documented business questions without shipped SQL --------------------------
FIRST_IN_CART_LIMIT = 20
FIRST_CART_POSITION = 1


def rpt_basket_by_segment(fact_orders: DataFrame, dim_users: DataFrame) -> DataFrame:
    """How basket size varies by customer segment: orders, customers and
    average items per order for each segment. Orders are pre-aggregated per
    user before the join, so the join runs at user grain."""
    per_user = (fact_orders.filter(F.col("user_key").isNotNull())
                .groupBy("user_key")
                .agg(F.count(F.lit(1)).alias("orders"), F.sum("total_items").alias("items")))
    joined = per_user.join(dim_users.select("user_key", "customer_segment"), "user_key", "inner")
    return (joined.groupBy("customer_segment")
            .agg(F.sum("orders").alias("orders"),
                 F.count(F.lit(1)).alias("customers"),
                 round_n(F.sum("items") / F.sum("orders"), 2).alias("avg_basket_size"))
            .orderBy(F.col("avg_basket_size").desc(), F.col("customer_segment").asc()))


def rpt_first_in_cart(fact_order_products: DataFrame, dim_products: DataFrame,
                      limit: int = FIRST_IN_CART_LIMIT) -> DataFrame:
    """Products most often added first to the cart: share of a product's
    lines at cart position 1 (top-k, ties by count then product id). Lines
    are aggregated per product before the catalog join."""
    per_product = (fact_order_products.groupBy("product_id")
                   .agg(F.count(F.lit(1)).alias("times_ordered"),
                        F.count_if(F.col("add_to_cart_order") == FIRST_CART_POSITION).alias("times_first")))
    joined = join_small(per_product, _current_products(dim_products), "product_id", "inner")
    return (joined.select("product_id", "product_name", "department_name", "times_ordered", "times_first",
                          round_n(F.col("times_first") / F.col("times_ordered"), 4).alias("pct_first_in_cart"))
            .orderBy(F.col("pct_first_in_cart").desc(), F.col("times_first").desc(), F.col("product_id").asc())
            .limit(limit))


PAIRS_LIMIT = 20


def rpt_pairs(fact_order_products: DataFrame, dim_products: DataFrame, limit: int = PAIRS_LIMIT) -> DataFrame:
    """Products most often bought together: the pairs that share most orders,
    with the orders of each product (ties go to the smaller ids). Exact, by a
    support bound (:mod:`basketry.operators.pairs`); only the ``limit`` pairs
    meet the catalog. Pairs of products the catalog does not have are left out
    beforehand, as the inner join of the other reports does."""
    catalog = _current_products(dim_products).select("product_id", "product_name")
    known = join_small(fact_order_products.select("order_id", "product_id"), catalog.select("product_id"), "product_id", "left_semi")
    top = top_pairs(known, "order_id", "product_id", limit)
    for side in ("a", "b"):
        names = catalog.select(F.col("product_id").alias(f"item_{side}"), F.col("product_name").alias(f"product_{side}"))
        top = names.join(F.broadcast(top), f"item_{side}")  # at most ``limit`` rows
    return (top.select(F.col("item_a").alias("product_id_a"), "product_a", F.col("item_b").alias("product_id_b"), "product_b",
                       F.col("baskets").alias("orders_together"), F.col("baskets_a").alias("orders_a"), F.col("baskets_b").alias("orders_b"))
            .orderBy(F.desc("orders_together"), "product_id_a", "product_id_b"))


def upper_columns(df: DataFrame) -> DataFrame:
    """Result columns upper-cased, as the dashboard presents them."""
    return df.toDF(*[c.upper() for c in df.columns])
