"""Fact tables: one row per order and one row per order line.

Both have a full build and an incremental form (``target`` given): the
incremental rules follow the reference models (watermark on load time for
orders, unseen orders for lines) and produce the new table version through
:func:`basketry.operators.incremental.upsert`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import cart_position_bucket, round_n, safe_divide, surrogate_key
from ..operators.incremental import newer_than, unseen, upsert
from ..operators.joins import join_small
from ..session import COMPACT, cut_lineage
from .customers import order_line_stats

# Upsert keys of the incremental facts.
FACT_ORDERS_KEY = ["order_id"]
FACT_ORDER_PRODUCTS_KEY = ["order_product_id"]


def fact_orders_build(stg_orders: DataFrame, stg_order_products: DataFrame, dim_users: DataFrame,
                      line_stats: DataFrame | None = None) -> DataFrame:
    """Order fact rows for the given orders (no incremental filter)."""
    li = line_stats if line_stats is not None else order_line_stats(stg_order_products)
    users = dim_users.select("user_id", "user_key")
    # users last: their hex keys are not moved with the orders
    joined = (stg_orders
              .join(li, "order_id", "left")
              .join(users, "user_id", "left"))
    order_rate = safe_divide("reordered_items", "total_items")
    return joined.select(
        surrogate_key("order_id").alias("order_key"),
        "order_id",
        "user_key",
        F.col("order_day_of_week").alias("date_key"),
        "order_sequence_number",
        "order_day_of_week",
        "order_day_name",
        "order_hour_of_day",
        "order_time_of_day",
        "is_first_order",
        "days_since_prior_order",
        F.coalesce(F.col("total_items"), F.lit(0)).alias("total_items"),
        F.coalesce(F.col("unique_items"), F.lit(0)).alias("unique_items"),
        F.coalesce(F.col("reordered_items"), F.lit(0)).alias("reordered_items"),
        F.coalesce(round_n(order_rate, 4), F.lit(0.0)).alias("order_reorder_rate"),
        round_n("avg_cart_position", 2).alias("avg_cart_position"),
        "first_item_cart_pos",
        "last_item_cart_pos",
        F.coalesce(F.col("early_cart_items"), F.lit(0)).alias("early_cart_items"),
        "loaded_at",
    )


def fact_orders(stg_orders: DataFrame, stg_order_products: DataFrame, dim_users: DataFrame,
                target: DataFrame | None = None, line_stats: DataFrame | None = None,
                watermark_null_loads_all: bool = True) -> DataFrame:
    """Full build, or (``target`` given) the next version of ``target``:
    orders loaded after the target's latest ``loaded_at`` are upserted on
    ``order_id``; new columns are appended."""
    if target is None:
        return fact_orders_build(stg_orders, stg_order_products, dim_users, line_stats)
    updates = fact_orders_updates(stg_orders, stg_order_products, dim_users, target, watermark_null_loads_all)
    return upsert(target, updates, FACT_ORDERS_KEY, append_new_columns=True)


def fact_orders_updates(stg_orders: DataFrame, stg_order_products: DataFrame, dim_users: DataFrame,
                        target: DataFrame, watermark_null_loads_all: bool = True) -> DataFrame:
    """Order fact rows of orders loaded after the target's watermark. Only the
    lines of those orders are aggregated."""
    fresh = newer_than(stg_orders, target, "loaded_at", null_loads_all=watermark_null_loads_all)
    lines = stg_order_products.join(fresh.select("order_id"), "order_id", "left_semi")
    return fact_orders_build(fresh, lines, dim_users)


def fact_order_products_build(stg_order_products: DataFrame, dim_products: DataFrame,
                              stg_orders: DataFrame, dim_users: DataFrame) -> DataFrame:
    """Line fact rows. Orders are joined to users first (order grain), so
    the lines are shuffled once, by ``order_id``; current products are a
    reference table (broadcast behind a size check), joined last. Hex keys are
    as long as all else in a line and do not compress: a line's own key is made
    anew behind the joins, and moved only where it is another one."""
    products = dim_products.filter(F.col("is_current") == F.lit(True)).select("product_id", "product_key")
    users = dim_users.select("user_id", "user_key")
    order_side = (stg_orders.select("order_id", "user_id", F.col("order_day_of_week").alias("date_key"))
                  .join(users, "user_id", "left")
                  .select("order_id", "user_key", "date_key"))
    key = surrogate_key("order_id", "product_id")
    other = F.when(~F.col("order_product_id").eqNullSafe(key), F.struct("order_product_id"))
    lines = stg_order_products.select("order_id", "product_id", "add_to_cart_order", "is_reordered", "is_early_cart_addition", "order_set",
                                      other.alias("__other"))
    joined = join_small(lines.join(order_side, "order_id", "left"), products, "product_id", "left")
    return joined.select(
        F.when(F.col("__other").isNull(), key).otherwise(F.col("__other.order_product_id")).alias("order_product_id"),
        "order_id",
        "product_key",
        "user_key",
        "date_key",
        "product_id",
        "add_to_cart_order",
        "is_reordered",
        "is_early_cart_addition",
        cart_position_bucket("add_to_cart_order").alias("cart_position_bucket"),
        "order_set",
    )


def fact_order_products(stg_order_products: DataFrame, dim_products: DataFrame, stg_orders: DataFrame,
                        dim_users: DataFrame, target: DataFrame | None = None,
                        line_grain: bool = False, shares: int = 1) -> DataFrame:
    """Full build, or the next version of ``target`` (a written frame): lines of
    orders not yet in the target are added (``line_grain=True``: lines whose
    ``order_product_id`` is not yet in the target), upserted on
    ``order_product_id``. The new lines are written once, in ``shares`` of the
    orders, since they are both looked up and added."""
    if target is None:
        return fact_order_products_build(stg_order_products, dim_products, stg_orders, dim_users)
    updates = fact_order_products_updates(stg_order_products, dim_products, stg_orders, dim_users,
                                          target, line_grain)
    updates = cut_lineage(updates, "new-lines", COMPACT, "order_id", shares)
    return upsert(target, updates, FACT_ORDER_PRODUCTS_KEY, written=True)


def fact_order_products_updates(stg_order_products: DataFrame, dim_products: DataFrame,
                                stg_orders: DataFrame, dim_users: DataFrame, target: DataFrame,
                                line_grain: bool = False) -> DataFrame:
    """Line fact rows of orders (or, with ``line_grain``, lines) not yet in
    the target."""
    key = "order_product_id" if line_grain else "order_id"
    fresh = unseen(stg_order_products, target, key)
    return fact_order_products_build(fresh, dim_products, stg_orders, dim_users)
