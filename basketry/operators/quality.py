"""Data-quality checks as Spark jobs.

Failure counts follow the usual test-query semantics: ``not_null`` counts
NULL rows; ``unique`` counts duplicated (non-NULL) values; ``accepted_values``
counts distinct non-NULL values outside the list; ``relationships`` counts
child rows with a non-NULL key missing from the parent; a range assertion
counts violating rows. A check passes with zero failures.

The suite runs all NULL and accepted-value checks of one table in a single
aggregation pass and all uniqueness checks of one value type in a single
shuffle; foreign keys are anti joins (AQE broadcasts a small parent).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """One declared check: table, column, kind and its argument (values,
    parent table/column or bounds)."""
    table: str
    column: str
    kind: str  # not_null | unique | accepted_values | relationships | range
    arg: object = None


def _checks(table: str, spec: Sequence[tuple]) -> list[Check]:
    return [Check(table, *item) for item in spec]


# The declared checks (sources, staging models, core models)
# and the singular range assertion, in declaration order.
DOW_VALUES = [0, 1, 2, 3, 4, 5, 6]
REORDERED_VALUES = [0, 1]
SEGMENT_VALUES = ["Champion", "Loyal Customer", "New Customer", "At Risk", "Needs Attention",
                  "Cant Lose Them", "Hibernating", "Unknown"]
CHECKS: list[Check] = (
    _checks("orders", [("order_id", "unique"), ("order_id", "not_null"), ("user_id", "not_null"),
                       ("order_number", "not_null"), ("order_dow", "not_null"),
                       ("order_dow", "accepted_values", DOW_VALUES),
                       ("order_hour_of_day", "not_null")])
    + _checks("order_products_prior", [("order_id", "not_null"), ("product_id", "not_null"),
                                       ("add_to_cart_order", "not_null"),
                                       ("reordered", "accepted_values", REORDERED_VALUES)])
    + _checks("order_products_train", [("order_id", "not_null"), ("product_id", "not_null")])
    + _checks("products", [("product_id", "unique"), ("product_id", "not_null"),
                           ("product_name", "not_null"), ("aisle_id", "not_null"),
                           ("aisle_id", "relationships", ("aisles", "aisle_id")),
                           ("department_id", "not_null"),
                           ("department_id", "relationships", ("departments", "department_id"))])
    + _checks("aisles", [("aisle_id", "unique"), ("aisle_id", "not_null"), ("aisle", "not_null")])
    + _checks("departments", [("department_id", "unique"), ("department_id", "not_null"),
                              ("department", "not_null")])
    + _checks("stg_orders", [("order_id", "unique"), ("order_id", "not_null"), ("user_id", "not_null")])
    + _checks("stg_products", [("product_id", "unique"), ("product_id", "not_null"),
                               ("product_name", "not_null")])
    + _checks("stg_order_products", [("order_product_id", "unique"), ("order_product_id", "not_null")])
    + _checks("stg_aisles", [("aisle_id", "unique"), ("aisle_id", "not_null")])
    + _checks("stg_departments", [("department_id", "unique"), ("department_id", "not_null")])
    + _checks("dim_dates", [("date_key", "unique"), ("date_key", "not_null"), ("full_date", "unique"),
                            ("full_date", "not_null"), ("is_weekend", "not_null")])
    + _checks("dim_departments", [("department_key", "unique"), ("department_key", "not_null"),
                                  ("department_id", "unique"), ("department_id", "not_null"),
                                  ("department_name", "not_null")])
    + _checks("dim_products", [("product_key", "unique"), ("product_key", "not_null"),
                               ("product_id", "not_null"), ("is_current", "not_null"),
                               ("valid_from", "not_null")])
    + _checks("dim_users", [("user_key", "unique"), ("user_key", "not_null"), ("user_id", "unique"),
                            ("user_id", "not_null"), ("customer_segment", "not_null"),
                            ("customer_segment", "accepted_values", SEGMENT_VALUES)])
    + _checks("fact_orders", [("order_key", "unique"), ("order_key", "not_null"), ("order_id", "unique"),
                              ("order_id", "not_null"), ("user_key", "not_null"),
                              ("user_key", "relationships", ("dim_users", "user_key")),
                              ("total_items", "not_null")])
    + _checks("fact_order_products", [("order_product_id", "unique"), ("order_product_id", "not_null"),
                                      ("order_id", "not_null"), ("product_key", "not_null"),
                                      ("product_key", "relationships", ("dim_products", "product_key")),
                                      ("is_reordered", "not_null")])
    + _checks("customer_360", [("reorder_rate", "range", (0, 1))])
)
# Source freshness on the load-time column: warn after 24 h, error after 48 h.
FRESHNESS_WARN_HOURS, FRESHNESS_ERROR_HOURS = 24, 48

SUITE_SCHEMA = "table_name string, column_name string, check_name string, failures long, status string"


# --- single checks ---------------------------------------------------------
def not_null_failures(col: str):
    """Aggregate: rows where ``col`` is NULL."""
    return F.count_if(F.col(col).isNull())


def accepted_failures(col: str, values):
    """Aggregate: distinct non-NULL values of ``col`` outside ``values``."""
    c = F.col(col)
    return F.count_distinct(F.when(~c.isin(*values), c))


def dq_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, failures) for each column, in one pass."""
    row = df.agg(*[not_null_failures(c).alias(c) for c in cols])
    return row.unpivot([], list(cols), "column_name", "failures")


def dq_unique(df: DataFrame, col: str) -> DataFrame:
    """Number of non-NULL values occurring more than once (one row)."""
    dup = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return dup.agg(F.count_if(F.col("n") > 1).alias("failures"))


def dq_accepted(df: DataFrame, col: str, values) -> DataFrame:
    """Distinct non-NULL values outside the accepted list (one row)."""
    return df.agg(accepted_failures(col, values).alias("failures"))


def dq_relationship(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row (one row)."""
    keys = parent.select(F.col(parent_col).alias("__parent_key"))
    orphans = (child.select(col).filter(F.col(col).isNotNull())
               .join(keys, F.col(col) == F.col("__parent_key"), "left_anti"))
    return orphans.agg(F.count(F.lit(1)).alias("failures"))


def dq_range(df: DataFrame, col: str, lo, hi, keep: Sequence[str] = ()) -> DataFrame:
    """Violating rows: ``col < lo OR col > hi`` (zero rows = pass)."""
    c = F.col(col)
    return df.filter((c < lo) | (c > hi)).select(*keep, col)


def dq_freshness(df: DataFrame, col: str, now, warn_hours: float = FRESHNESS_WARN_HOURS,
                 error_hours: float = FRESHNESS_ERROR_HOURS) -> DataFrame:
    """Age of ``MAX(col)`` at ``now`` → pass / warn / error (one row)."""
    now_c = F.to_timestamp(F.lit(now)) if isinstance(now, (str, dt.datetime)) else now
    latest = df.agg(F.max(col).alias("max_loaded_at"))
    age = (F.unix_timestamp(now_c) - F.unix_timestamp("max_loaded_at")) / 3600.0
    return latest.select(
        "max_loaded_at",
        age.alias("age_hours"),
        F.when(F.col("max_loaded_at").isNull(), "error")
        .when(age > error_hours, "error")
        .when(age > warn_hours, "warn")
        .otherwise("pass").alias("status"),
    )


# --- suite -------------------------------------------------------------------
def _tag(df: DataFrame, check: Check) -> DataFrame:
    return df.select(F.lit(check.table).alias("table_name"), F.lit(check.column).alias("column_name"),
                     F.lit(check.kind).alias("check_name"), F.col("failures").cast("long"))


def _unique_failures(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> list[DataFrame]:
    """Every uniqueness check, those of one value type in one shuffle: each
    column is scanned alone, as (check, value) with the value as it is, and
    counted with the other columns of its type. Check numbers are constants, so
    nothing is repeated or cast."""
    by_type: dict[str, list[tuple[int, Check]]] = {}
    for i, c in enumerate(checks):
        by_type.setdefault(tables[c.table].schema[c.column].dataType.simpleString(), []).append((i, c))
    reports = []
    for group in by_type.values():
        values, labels = None, []
        for i, c in group:
            one = tables[c.table].select(F.lit(i).alias("check"), F.col(c.column).alias("value")).where(F.col(c.column).isNotNull())
            values = one if values is None else values.unionByName(one)
            labels.append(F.struct(F.lit(i).alias("check"), F.lit(c.table).alias("table_name"), F.lit(c.column).alias("column_name"),
                                   F.lit(c.kind).alias("check_name")))
        repeated = (values.groupBy("check", "value").agg(F.count(F.lit(1)).alias("n"))
                    .groupBy("check").agg(F.count_if(F.col("n") > 1).alias("failures")))
        # tables without rows have no group: the map of the few counts is read for each check
        counts = repeated.agg(F.map_from_entries(F.collect_list(F.struct("check", "failures"))).alias("m"))
        reports.append(counts.select("m", F.explode(F.array(*labels)).alias("c")).select(
            "c.table_name", "c.column_name", "c.check_name", F.coalesce(F.col("m")[F.col("c.check")], F.lit(0)).cast("long").alias("failures")))
    return reports


# Source tables with a freshness rule on their load time.
FRESHNESS_TABLES = ["orders", "order_products_prior", "order_products_train", "products", "aisles",
                    "departments"]


def dq_parts(tables: Mapping[str, DataFrame], checks: Sequence[Check] = CHECKS) -> list[DataFrame]:
    """One small report DataFrame per table (and check family): the pieces
    of :func:`dq_suite`, each runnable on its own."""
    parts: list[DataFrame] = []
    by_table: dict[str, list[Check]] = {}
    for c in checks:
        by_table.setdefault(c.table, []).append(c)
    for table, tchecks in by_table.items():
        df = tables[table]
        # One pass for every NULL / accepted-values check of this table.
        scans = [c for c in tchecks if c.kind in ("not_null", "accepted_values")]
        if scans:
            aggs = [(not_null_failures(c.column) if c.kind == "not_null"
                     else accepted_failures(c.column, c.arg)).alias(f"c{i}")
                    for i, c in enumerate(scans)]
            row = df.agg(*aggs)
            parts.append(row.select(F.explode(F.array(*[
                F.struct(F.lit(c.table).alias("table_name"), F.lit(c.column).alias("column_name"),
                         F.lit(c.kind).alias("check_name"), F.col(f"c{i}").cast("long").alias("failures"))
                for i, c in enumerate(scans)])).alias("r")).select("r.*"))
        for c in tchecks:
            if c.kind == "relationships":
                parent, parent_col = c.arg
                parts.append(_tag(dq_relationship(df, c.column, tables[parent], parent_col), c))
            elif c.kind == "range":
                lo, hi = c.arg
                parts.append(_tag(dq_range(df, c.column, lo, hi).agg(F.count(F.lit(1)).alias("failures")), c))
    return parts + _unique_failures(tables, [c for c in checks if c.kind == "unique"])


class FailedChecks(RuntimeError):
    """Checks that must pass before anything is built on their tables."""


def gate(tables: Mapping[str, DataFrame], checks: Sequence[Check], threads: int = 4) -> None:
    """Raise :class:`FailedChecks`, naming them, unless all ``checks`` pass."""
    failed = run_dq_suite(tables, checks, threads=threads).where("status = 'fail'").orderBy("table_name", "column_name", "check_name").collect()
    if failed:
        raise FailedChecks("; ".join(f"{r.table_name}.{r.column_name} {r.check_name}: {r.failures}" for r in failed))


def dq_suite(tables: Mapping[str, DataFrame], checks: Sequence[Check] = CHECKS, now=None) -> DataFrame:
    """All checks over the given tables → one report row per check
    (table_name, column_name, check_name, failures, status). With ``now``,
    the sources' freshness rows are added (failures 0 / 1, status pass /
    warn / error)."""
    parts = dq_parts(tables, checks)
    report = parts[0]
    for p in parts[1:]:
        report = report.unionByName(p)
    report = report.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))
    if now is not None:
        report = report.unionByName(_freshness_rows(tables, now))
    return report


def _freshness_rows(tables: Mapping[str, DataFrame], now) -> DataFrame:
    rows = None
    for t in FRESHNESS_TABLES:
        fresh = dq_freshness(tables[t], "_loaded_at", now).select(
            F.lit(t).alias("table_name"), F.lit("_loaded_at").alias("column_name"),
            F.lit("freshness").alias("check_name"),
            F.when(F.col("status") == "pass", 0).otherwise(1).cast("long").alias("failures"), "status")
        rows = fresh if rows is None else rows.unionByName(fresh)
    return rows


def run_dq_suite(tables: Mapping[str, DataFrame], checks: Sequence[Check] = CHECKS, now=None,
                 threads: int = 4) -> DataFrame:
    """Execute the suite with each table's checks as its own query, several
    at a time (many small independent plans instead of one large union),
    and return the report (one row per check) as a small DataFrame."""
    from concurrent.futures import ThreadPoolExecutor
    parts = dq_parts(tables, checks)
    spark = parts[0].sparkSession
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        rows = [r for chunk in pool.map(lambda p: p.collect(), parts) for r in chunk]
    report = spark.createDataFrame([tuple(r) for r in rows],
                                   "table_name string, column_name string, check_name string, failures long")
    report = report.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))
    if now is not None:
        report = report.unionByName(_freshness_rows(tables, now))
    return report
