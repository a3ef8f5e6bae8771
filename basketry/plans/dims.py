"""Star-schema dimensions: dates, users (SCD1), departments (SCD1) and
products (initial SCD2 state; merges live in operators.incremental)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import WEEKEND_DOW, date_spine, dow0, season
from ..functions.scalar import round_n, surrogate_key
from ..sources.fixtures import DEFAULT_RUN_TS

# The calendar range of the date dimension and the initial
# validity date of product versions.
DATE_START, DATE_END = "2019-01-01", "2019-12-31"
PRODUCT_VALID_FROM = "2019-01-01"


def _ts(run_ts) -> F.Column:
    return F.to_timestamp(F.lit(run_ts)) if isinstance(run_ts, str) else run_ts


def date_columns(spine: DataFrame) -> DataFrame:
    """Date-dimension attributes of each ``date_day`` (unpadded names, ISO
    week, day of week with 0 = Sunday)."""
    d = F.col("date_day")
    dow = dow0(d)
    return spine.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter_number"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_short_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        dow.alias("day_of_week_number"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "EEE").alias("day_short_name"),
        dow.isin(*WEEKEND_DOW).alias("is_weekend"),
        (~dow.isin(*WEEKEND_DOW)).alias("is_weekday"),
        season(F.month(d)).alias("season"),
    )


def dim_dates(spark: SparkSession, start=DATE_START, end=DATE_END, inclusive_end: bool = False) -> DataFrame:
    """Calendar dimension; the end date is exclusive by default (364 rows
    for the fixed 2019 range)."""
    return date_columns(date_spine(spark, start, end, inclusive_end)).orderBy("full_date")


def dim_dates_for(dates: DataFrame, date_col: str) -> DataFrame:
    """Calendar dimension spanning the dates of a data column (first to last
    date, both included)."""
    bounds = dates.agg(F.min(F.col(date_col).cast("date")).alias("lo"),
                       F.max(F.col(date_col).cast("date")).alias("hi"))
    spine = date_spine(dates.sparkSession, F.col("lo"), F.col("hi"), inclusive_end=True, source=bounds)
    return date_columns(spine)


def dim_users(customer_360: DataFrame, run_ts=DEFAULT_RUN_TS) -> DataFrame:
    """User dimension (SCD1): md5 key, mart attributes, rounded measures."""
    return customer_360.select(
        surrogate_key("user_id").alias("user_key"),
        "user_id",
        "total_orders",
        "total_items_ordered",
        round_n("avg_basket_size", 2).alias("avg_basket_size"),
        round_n("avg_days_between_orders", 1).alias("avg_days_between_orders"),
        "most_common_order_day",
        "most_common_order_hour",
        "customer_segment",
        "loyalty_tier",
        "order_frequency_bucket",
        round_n("reorder_rate", 4).alias("reorder_rate"),
        "recency_score",
        "frequency_score",
        "monetary_score",
        "rfm_average",
        _ts(run_ts).alias("updated_at"),
    )


def dim_departments(stg_departments: DataFrame, run_ts=DEFAULT_RUN_TS) -> DataFrame:
    """Department dimension (SCD1) with md5 key and load times."""
    return stg_departments.select(
        surrogate_key("department_id").alias("department_key"),
        "department_id",
        "department_name",
        _ts(run_ts).alias("created_at"),
        _ts(run_ts).alias("updated_at"),
    )


def dim_products(stg_products: DataFrame, valid_from: str = PRODUCT_VALID_FROM,
                 run_ts=DEFAULT_RUN_TS) -> DataFrame:
    """Initial product versions: key = md5(product_id-valid_from), open
    validity, current."""
    return stg_products.select(
        surrogate_key("product_id", F.lit(valid_from)).alias("product_key"),
        "product_id",
        "product_name",
        "aisle_id",
        "aisle_name",
        "department_id",
        "department_name",
        F.to_date(F.lit(valid_from)).alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
        _ts(run_ts).alias("created_at"),
    )
