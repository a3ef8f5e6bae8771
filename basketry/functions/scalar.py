"""Column-level business functions.

Every function here returns a ``Column`` built only from built-in Spark
expressions, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's definitions for identical
# results. Kept together, in their natural order.
# ---------------------------------------------------------------------------
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
# Time-of-day buckets: inclusive hour ranges; anything else (incl. NULL) is Night.
TIME_OF_DAY = [("Morning", 5, 11), ("Afternoon", 12, 16), ("Evening", 17, 20)]
TIME_OF_DAY_DEFAULT = "Night"
EARLY_CART_MAX_POSITION = 5
CART_POSITION_BUCKETS = [(5, "1-5 Staples"), (15, "6-15 Regular")]
CART_POSITION_DEFAULT = "16+ Browse"
ORDER_FREQUENCY_BUCKETS = [(7, "Weekly"), (14, "Bi-Weekly"), (30, "Monthly")]
ORDER_FREQUENCY_DEFAULT = "Infrequent"
LOYALTY_TIERS = [(0.7, "High Loyalty"), (0.4, "Medium Loyalty")]
LOYALTY_DEFAULT = "Low Loyalty"
REORDER_TIERS = [(0.7, "High Reorder"), (0.4, "Medium Reorder")]
REORDER_DEFAULT = "Low Reorder"
POPULARITY_TIERS = [(100, "Top 100"), (500, "Top 500"), (1000, "Top 1000")]
POPULARITY_DEFAULT = "Long Tail"
CUSTOMER_SEGMENTS = ["Champion", "Loyal Customer", "New Customer", "At Risk",
                     "Needs Attention", "Cant Lose Them", "Hibernating", "Unknown"]
# Surrogate keys: md5 over parts joined by '-', NULL parts replaced by this
# sentinel (the public dbt-utils convention the reference relies on).
SURROGATE_KEY_SEPARATOR = "-"
SURROGATE_KEY_NULL = "_dbt_utils_surrogate_key_null_"
# Rounding carrier: doubles are rounded through this decimal type.
ROUND_CARRIER = "decimal(38,10)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_divide(num, den, default=None) -> Column:
    """``num / den`` as double; ``default`` (NULL unless given) when the
    denominator is 0 or NULL."""
    num, den = _c(num), _c(den)
    fallback = F.lit(default) if not isinstance(default, Column) else default
    return (F.when((den == 0) | den.isNull(), fallback.cast("double"))
            .otherwise(num.cast("double") / den.cast("double")))


def round_n(x, n: int) -> Column:
    """``ROUND(x::NUMERIC, n)`` half away from zero, returned as double.

    Rounding a double directly is subject to binary representation (23/40
    becomes 0.57); going through a decimal keeps decimal semantics.
    """
    return F.round(_c(x).cast(ROUND_CARRIER), n).cast("double")


def surrogate_key(*parts) -> Column:
    """md5 hex of the parts cast to text, joined by '-', NULL → sentinel.

    String literals are passed as ``F.lit('...')``; names as strings.
    """
    cols = [F.coalesce(_c(p).cast("string"), F.lit(SURROGATE_KEY_NULL)) for p in parts]
    joined = cols[0] if len(cols) == 1 else F.concat_ws(SURROGATE_KEY_SEPARATOR, *cols)
    return F.md5(joined)


def day_name(dow) -> Column:
    """0..6 → Sunday..Saturday; anything else NULL (no ELSE branch)."""
    dow = _c(dow)
    expr = None
    for i, name in enumerate(DAY_NAMES):
        expr = F.when(dow == i, name) if expr is None else expr.when(dow == i, name)
    return expr


def time_of_day(hour) -> Column:
    """Morning 5-11, Afternoon 12-16, Evening 17-20, else (and NULL) Night."""
    hour = _c(hour)
    expr = None
    for name, lo, hi in TIME_OF_DAY:
        cond = hour.between(lo, hi)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise(TIME_OF_DAY_DEFAULT)


def is_early_cart(pos) -> Column:
    """``add_to_cart_order <= 5``; NULL position → FALSE."""
    return F.coalesce(_c(pos) <= EARLY_CART_MAX_POSITION, F.lit(False))


def _threshold_chain(x: Column, table, default: str, op: str) -> Column:
    expr = None
    for bound, label in table:
        cond = (x <= bound) if op == "le" else (x >= bound)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default)


def cart_position_bucket(pos) -> Column:
    """<= 5 staples, <= 15 regular, else (and NULL) 16+ browse."""
    return _threshold_chain(_c(pos), CART_POSITION_BUCKETS, CART_POSITION_DEFAULT, "le")


def order_frequency_bucket(avg_days) -> Column:
    """On the unrounded average; NULL → Infrequent."""
    return _threshold_chain(_c(avg_days), ORDER_FREQUENCY_BUCKETS, ORDER_FREQUENCY_DEFAULT, "le")


def loyalty_tier(rate) -> Column:
    """On the unrounded reorder rate: >= 0.7 High, >= 0.4 Medium, else/NULL Low."""
    return _threshold_chain(_c(rate), LOYALTY_TIERS, LOYALTY_DEFAULT, "ge")


def reorder_tier(rate) -> Column:
    """On the unrounded reorder rate: >= 0.7 High, >= 0.4 Medium, else/NULL Low."""
    return _threshold_chain(_c(rate), REORDER_TIERS, REORDER_DEFAULT, "ge")


def popularity_tier(rank) -> Column:
    """Top 100 / Top 500 / Top 1000 / Long Tail by overall popularity rank."""
    return _threshold_chain(_c(rank), POPULARITY_TIERS, POPULARITY_DEFAULT, "le")


def customer_segment(recency, frequency) -> Column:
    """RFM segment from recency and frequency scores (monetary not used).

    Rules are evaluated in order; (R=2, F=1) and (R=1, F=2) and NULL scores
    fall through to Unknown.
    """
    r, f = _c(recency), _c(frequency)
    return (F.when((r >= 3) & (f >= 3), "Champion")
            .when((r >= 3) & (f >= 2), "Loyal Customer")
            .when((r >= 3) & (f < 2), "New Customer")
            .when((r == 2) & (f >= 3), "At Risk")
            .when((r == 2) & (f >= 2), "Needs Attention")
            .when((r < 2) & (f >= 3), "Cant Lose Them")
            .when((r < 2) & (f < 2), "Hibernating")
            .otherwise("Unknown"))


def rfm_average(r, f, m) -> Column:
    """``ROUND((R + F + M)::NUMERIC / 3, 2)``."""
    return round_n((_c(r) + _c(f) + _c(m)).cast("double") / 3.0, 2)


def count_if(cond) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` over rows (NULL over no rows)."""
    return F.sum(F.when(_c(cond), 1).otherwise(0))
