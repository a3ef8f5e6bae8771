"""Product performance mart: per-product metrics, ranks and tiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import count_if, popularity_tier, reorder_tier, round_n, safe_divide
from ..operators.joins import join_small
from ..operators.histograms import histogram_rank
from ..session import cut_lineage


def product_metrics(stg_order_products: DataFrame) -> DataFrame:
    """Per-product line metrics (map-side combined; COUNT DISTINCT runs as
    Spark's two-level distinct aggregation, so a hot product is spread over
    the (product, order) hash space)."""
    m = stg_order_products.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("times_ordered"),
        F.countDistinct("order_id").alias("unique_orders"),
        count_if("is_reordered").alias("times_reordered"),
        F.avg("add_to_cart_order").alias("avg_cart_position"),
        F.min("add_to_cart_order").alias("min_cart_position"),
        count_if("is_early_cart_addition").alias("early_items"),
    )
    return m.select(
        "product_id", "times_ordered", "unique_orders", "times_reordered",
        safe_divide("times_reordered", "times_ordered").alias("reorder_rate"),
        "avg_cart_position", "min_cart_position",
        safe_divide("early_items", "times_ordered").alias("pct_early_cart"),
    )


def product_ranks(joined: DataFrame) -> DataFrame:
    """(product_id, dept_reorder_rank, overall_popularity_rank), computed on
    the four key columns only and joined back 1:1 by the caller."""
    keys = joined.select("product_id", "department_id", "reorder_rate", "times_ordered")
    ranked = histogram_rank(keys, ["department_id"], "reorder_rate", "dept_reorder_rank")
    ranked = histogram_rank(ranked, [], "times_ordered", "overall_popularity_rank")
    return ranked.select("product_id", "dept_reorder_rank", "overall_popularity_rank")


def product_performance(stg_order_products: DataFrame, stg_products: DataFrame) -> DataFrame:
    """One row per product with at least one line and a catalog entry.

    ``dept_reorder_rank`` = RANK within department by reorder rate (DESC);
    ``overall_popularity_rank`` = RANK over all products by times ordered
    (DESC). Both are exact and distributed (see operators.histograms). Tiers use
    the unrounded rate.
    """
    metrics = product_metrics(stg_order_products)
    products = stg_products.select("product_id", "product_name", "aisle_id", "aisle_name",
                                   "department_id", "department_name")
    # Read twice (ranks, join back): written once at product grain, so the
    # lines behind the metrics are aggregated once.
    joined = cut_lineage(join_small(metrics, products, "product_id", "inner"), "product_metrics")
    ranked = joined.join(product_ranks(joined), "product_id", "left")
    return ranked.select(
        "product_id", "product_name", "aisle_id", "aisle_name", "department_id", "department_name",
        "times_ordered", "unique_orders", "times_reordered",
        round_n("reorder_rate", 4).alias("reorder_rate"),
        round_n("avg_cart_position", 2).alias("avg_cart_position"),
        "min_cart_position",
        round_n("pct_early_cart", 4).alias("pct_early_cart"),
        "dept_reorder_rank",
        "overall_popularity_rank",
        reorder_tier("reorder_rate").alias("reorder_tier"),
        popularity_tier("overall_popularity_rank").alias("popularity_tier"),
    )
