"""Staging: rename, cast and flag the raw tables (lazy views)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import day_name, is_early_cart, surrogate_key, time_of_day
from ..operators.joins import join_small


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    """One row per order. ``loaded_at`` carries the raw load time so that
    incremental watermarks compare real load times."""
    dow = F.col("order_dow").cast("int")
    hour = F.col("order_hour_of_day").cast("int")
    days = F.col("days_since_prior_order").cast("double")
    return raw_orders.select(
        F.col("order_id").cast("long").alias("order_id"),
        F.col("user_id").cast("long").alias("user_id"),
        F.col("order_number").cast("int").alias("order_sequence_number"),
        dow.alias("order_day_of_week"),
        hour.alias("order_hour_of_day"),
        day_name(dow).alias("order_day_name"),
        time_of_day(hour).alias("order_time_of_day"),
        days.alias("days_since_prior_order"),
        days.isNull().alias("is_first_order"),
        F.col("_loaded_at").alias("loaded_at"),
    )


def _lines(df: DataFrame, order_set: str) -> DataFrame:
    return df.select(
        F.col("order_id").cast("long").alias("order_id"),
        F.col("product_id").cast("long").alias("product_id"),
        F.col("add_to_cart_order").cast("int").alias("add_to_cart_order"),
        F.col("reordered").cast("int").alias("reordered"),
        F.lit(order_set).alias("order_set"),
    )


def all_lines(prior: DataFrame, train: DataFrame) -> DataFrame:
    """Prior ∪ train lines (duplicates kept), cast and not yet keyed."""
    return _lines(prior, "prior").unionByName(_lines(train, "train"))


def stg_order_products(prior: DataFrame, train: DataFrame) -> DataFrame:
    """Prior ∪ train lines (duplicates kept), keyed by md5(order-product)."""
    return keyed_lines(all_lines(prior, train))


def keyed_lines(lines: DataFrame) -> DataFrame:
    """Staged lines of :func:`all_lines`."""
    return lines.select(
        surrogate_key("order_id", "product_id").alias("order_product_id"),
        "order_id",
        "product_id",
        "add_to_cart_order",
        F.col("reordered").cast("boolean").alias("is_reordered"),
        "order_set",
        is_early_cart("add_to_cart_order").alias("is_early_cart_addition"),
    )


def stg_aisles(raw_aisles: DataFrame) -> DataFrame:
    """(aisle_id, aisle_name)."""
    return raw_aisles.select(F.col("aisle_id").cast("long").alias("aisle_id"),
                             F.col("aisle").alias("aisle_name"))


def stg_departments(raw_departments: DataFrame) -> DataFrame:
    """(department_id, department_name)."""
    return raw_departments.select(F.col("department_id").cast("long").alias("department_id"),
                                  F.col("department").alias("department_name"))


def stg_products(products: DataFrame, aisles: DataFrame, departments: DataFrame) -> DataFrame:
    """Products with aisle and department names (LEFT joins on the two
    reference tables, broadcast behind a size check)."""
    p = products.select(
        F.col("product_id").cast("long").alias("product_id"),
        "product_name",
        F.col("aisle_id").cast("long").alias("aisle_id"),
        F.col("department_id").cast("long").alias("department_id"),
    )
    a = aisles.select(F.col("aisle_id").cast("long").alias("aisle_id"), F.col("aisle").alias("aisle_name"))
    d = departments.select(F.col("department_id").cast("long").alias("department_id"),
                           F.col("department").alias("department_name"))
    joined = join_small(join_small(p, a, "aisle_id", "left"), d, "department_id", "left")
    return joined.select("product_id", "product_name", "aisle_id", "aisle_name",
                         "department_id", "department_name")


def staging(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All five staging views from the six raw tables."""
    return {
        "stg_orders": stg_orders(raw["orders"]),
        "stg_order_products": stg_order_products(raw["order_products_prior"],
                                                 raw["order_products_train"]),
        "stg_products": stg_products(raw["products"], raw["aisles"], raw["departments"]),
        "stg_aisles": stg_aisles(raw["aisles"]),
        "stg_departments": stg_departments(raw["departments"]),
    }
