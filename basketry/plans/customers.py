"""Customer models: order history per user and the RFM customer mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import (DAY_NAMES, count_if, customer_segment, loyalty_tier,
                                order_frequency_bucket, rfm_average, round_n, safe_divide)
from ..operators.histograms import Order, ntiles
from ..session import by_key, cut_lineage

NTILE_BUCKETS = 4
# Day names in text order: MAX over a name's position in this list equals
# MAX over the names as text, with an integer aggregation buffer (Spark's
# hash aggregation keeps no strings in its buffers; a string MAX would force
# a sort-based aggregation over all orders).
_DAY_NAMES_BY_TEXT = sorted(DAY_NAMES)


def _text_position(name):
    expr = None
    for i, n in enumerate(_DAY_NAMES_BY_TEXT):
        expr = F.when(name == n, i) if expr is None else expr.when(name == n, i)
    return expr


def _name_at(position):
    expr = None
    for i, n in enumerate(_DAY_NAMES_BY_TEXT):
        expr = F.when(position == i, n) if expr is None else expr.when(position == i, n)
    return expr


def order_line_stats(stg_order_products: DataFrame, dealt: bool = False) -> DataFrame:
    """Per-order line aggregates. Computed once and shared by the customer
    history and the order fact: pre-aggregating lines to order grain before
    any join cuts the join input by the basket size. The needed columns are moved
    once, by order; the distinct count alone would move every line again with
    the partial states of all totals. Lines that are ``dealt`` by order already
    (bucketed tables) are not moved."""
    lines = stg_order_products.select("order_id", "product_id", "is_reordered", "add_to_cart_order", "is_early_cart_addition")
    return (lines if dealt else by_key(lines, "order_id")).groupBy("order_id").agg(
        F.count("product_id").alias("total_items"),
        F.countDistinct("product_id").alias("unique_items"),
        count_if("is_reordered").alias("reordered_items"),
        F.avg("add_to_cart_order").alias("avg_cart_position"),
        F.min("add_to_cart_order").alias("first_item_cart_pos"),
        F.max("add_to_cart_order").alias("last_item_cart_pos"),
        count_if("is_early_cart_addition").alias("early_cart_items"),
    )


def customer_history(stg_orders: DataFrame, stg_order_products: DataFrame,
                     line_stats: DataFrame | None = None) -> DataFrame:
    """One row per user with at least one non-first order.

    Order statistics use non-first orders only; item statistics use every
    order with lines (first orders included). Orders meet their line stats and
    are reduced to one row per order on the partitioning of that join, with the
    number of times the order was loaded: an order loaded twice is one order,
    its rows and lines count twice. Users without any line keep NULL item
    statistics.
    """
    stats = line_stats if line_stats is not None else order_line_stats(stg_order_products)
    stats = stats.select("order_id", "total_items", "reordered_items", "early_cart_items")
    orders = stg_orders.select("order_id", "user_id", "is_first_order", "days_since_prior_order",
                               "order_day_name", "order_hour_of_day")
    per_order = orders.join(stats, "order_id", "left")
    repeat = ~F.col("is_first_order")
    gap = F.when(repeat, F.col("days_since_prior_order"))
    one = per_order.groupBy("order_id", "user_id").agg(
        F.count(F.lit(1)).alias("times"),
        F.count(F.when(repeat, 1)).alias("repeats"),
        F.sum(gap).alias("gap_sum"), F.count(gap).alias("gaps"),
        F.min(gap).alias("gap_min"), F.max(gap).alias("gap_max"),
        F.max(F.when(repeat, _text_position(F.col("order_day_name")))).alias("day_position"),
        F.max(F.when(repeat, F.col("order_hour_of_day"))).alias("hour"),
        *[F.max(c).alias(c) for c in ("total_items", "reordered_items", "early_cart_items")],
    )
    agg = one.groupBy("user_id").agg(
        F.count(F.when(F.col("repeats") > 0, F.col("order_id"))).alias("total_orders"),
        safe_divide(F.sum("gap_sum"), F.sum("gaps")).alias("avg_days_between_orders"),
        F.min("gap_min").alias("min_days_between_orders"),
        F.max("gap_max").alias("max_days_between_orders"),
        F.max("day_position").alias("max_day_position"),
        F.max("hour").alias("most_common_order_hour"),
        F.sum(F.col("total_items") * F.col("times")).alias("total_items_ordered"),
        F.count(F.when(F.col("total_items").isNotNull(), F.col("order_id"))).alias("orders_with_lines"),
        F.sum(F.col("reordered_items") * F.col("times")).alias("total_reordered_items"),
        F.sum(F.col("early_cart_items") * F.col("times")).alias("early_items"),
    )
    return agg.filter(F.col("total_orders") > 0).select(
        "user_id",
        "total_orders",
        "avg_days_between_orders",
        "min_days_between_orders",
        "max_days_between_orders",
        _name_at(F.col("max_day_position")).alias("most_common_order_day"),
        "most_common_order_hour",
        "total_items_ordered",
        safe_divide("total_items_ordered", "orders_with_lines").alias("avg_basket_size"),
        "total_reordered_items",
        safe_divide("total_reordered_items", "total_items_ordered").alias("reorder_rate"),
        safe_divide("early_items", "total_items_ordered").alias("pct_items_early_cart"),
    )


def order_modes(stg_orders: DataFrame) -> DataFrame:
    """Most frequent order day and hour per user over non-first orders (the
    mode; ties go to the lowest value). The customer mart itself keeps the
    MAX() definition of ``most_common_order_day/hour``; this is the variant
    with the meaning the names suggest. Both domains are small, so the modes
    come from one hash aggregate of conditional counts."""
    repeat = stg_orders.filter(~F.col("is_first_order"))
    days, hours = len(_DAY_NAMES_BY_TEXT), 24
    counts = repeat.groupBy("user_id").agg(
        *[F.count_if(F.col("order_day_name") == n).alias(f"d{i}") for i, n in enumerate(_DAY_NAMES_BY_TEXT)],
        *[F.count_if(F.col("order_hour_of_day") == h).alias(f"h{h}") for h in range(hours)])

    def first_most(prefix: str, n: int):
        at = F.array(*[F.col(f"{prefix}{i}") for i in range(n)])
        return F.when(F.array_max(at) > 0, (F.array_position(at, F.array_max(at)) - 1).cast("int"))

    return counts.select("user_id", _name_at(first_most("d", days)).alias("most_common_order_day_mode"),
                         first_most("h", hours).alias("most_common_order_hour_mode"))


_RFM = [Order("avg_days_between_orders", "recency_score", ascending=False),
        Order("total_orders", "frequency_score"),
        Order("total_items_ordered", "monetary_score")]


def with_rfm_scores(history: DataFrame) -> DataFrame:
    """``history`` (a written table) with recency_score, frequency_score and
    monetary_score: quartiles (NTILE 4) over all users.

    Recency: shorter average gap scores higher (DESC, NULLs last); frequency
    and monetary: ascending, NULLs last. Ties are broken by ``user_id``. The
    nine quartile ends are found together in value histograms, and scores are a
    projection: no user row is sorted, shuffled or joined.
    """
    return ntiles(history, NTILE_BUCKETS, _RFM, "user_id")


def rfm_scores(history: DataFrame) -> DataFrame:
    """(user_id, recency_score, frequency_score, monetary_score)."""
    keys = history.select("user_id", *[o.col for o in _RFM])
    return with_rfm_scores(cut_lineage(keys, "rfm-keys")).select("user_id", *[o.out for o in _RFM])


def customer_360(history: DataFrame) -> DataFrame:
    """RFM mart: one row per user of ``history``.

    The history is read several times (quartile ends, result); it is written
    once at user grain, so the orders and lines behind it are aggregated once."""
    s = with_rfm_scores(cut_lineage(history, "history"))
    return s.select(
        "user_id",
        "total_orders",
        "avg_days_between_orders",
        "min_days_between_orders",
        "max_days_between_orders",
        F.coalesce(F.col("most_common_order_day"), F.lit("Unknown")).alias("most_common_order_day"),
        F.coalesce(F.col("most_common_order_hour"), F.lit(0)).alias("most_common_order_hour"),
        "total_items_ordered",
        round_n("avg_basket_size", 2).alias("avg_basket_size"),
        "total_reordered_items",
        round_n("reorder_rate", 4).alias("reorder_rate"),
        round_n("pct_items_early_cart", 4).alias("pct_items_early_cart"),
        "recency_score",
        "frequency_score",
        "monetary_score",
        rfm_average("recency_score", "frequency_score", "monetary_score").alias("rfm_average"),
        customer_segment("recency_score", "frequency_score").alias("customer_segment"),
        order_frequency_bucket("avg_days_between_orders").alias("order_frequency_bucket"),
        loyalty_tier("reorder_rate").alias("loyalty_tier"),
    )
