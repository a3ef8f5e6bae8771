"""Calendar helpers: a gap-free date spine and the date-dimension columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Meteorological seasons by month number.
SEASONS = [("Winter", (12, 1, 2)), ("Spring", (3, 4, 5)),
           ("Summer", (6, 7, 8)), ("Fall", (9, 10, 11))]
WEEKEND_DOW = (0, 6)  # Sunday, Saturday with 0 = Sunday


def _as_date(x) -> Column:
    if isinstance(x, Column):
        return x.cast("date")
    if isinstance(x, (dt.date, dt.datetime)):
        x = x.isoformat()[:10]
    return F.to_date(F.lit(str(x)))


def date_spine(spark: SparkSession, start, end, inclusive_end: bool = False,
               source: DataFrame | None = None) -> DataFrame:
    """One row per day from ``start`` up to ``end`` (exclusive by default,
    like the public date_spine macro), column ``date_day``.

    ``start``/``end`` may be literals or Columns; Columns are evaluated over
    ``source`` (a one-row frame, e.g. an aggregate of the data).
    """
    last = _as_date(end) if inclusive_end else F.date_sub(_as_date(end), 1)
    base = source if source is not None else spark.range(1)
    spine = base.select(F.sequence(_as_date(start), last).alias("days"))
    return spine.select(F.explode("days").alias("date_day"))


def dow0(d) -> Column:
    """Day of week with 0 = Sunday (Spark's dayofweek is 1 = Sunday)."""
    return F.dayofweek(d) - 1


def season(month) -> Column:
    """Meteorological season of a month number (NULL outside 1..12)."""
    expr = None
    for name, months in SEASONS:
        cond = month.isin(*months)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr
