"""Adapter: TPC-H-like driver tables → the six raw grocery inputs.

The driver's test data has orders, line items and parts but not the grocery
dataset's columns, so each raw column is derived by a fixed rule (the same
rules are written independently in the SQL oracle):

* orders: ``order_number`` = position of the order among the customer's
  orders by (date, key); ``order_dow`` from the date (0 = Sunday);
  ``order_hour_of_day`` = (order_id * 7 + user_id) mod 24 (dates carry no
  hour); ``days_since_prior_order`` = days since the customer's previous order
  mod 31, NULL on the first order.
* line items: one line per (order, part), keeping the smallest line number;
  ``add_to_cart_order`` = position in the order by (line number, part);
  ``reordered`` = a deterministic 0/1 rule; lines of each customer's last order
  form the ``train`` set, the rest ``prior``.
* products: part key and name; aisle = dense id of brand, department = dense
  id of type, both ordered by name.

Per-customer and per-order numbering use the skew-safe operators of
:mod:`basketry.operators.ranking`: windows over one shuffle by customer or
order, and for a hot one range numbering, with the previous order from an
equi-join on (user, order_number - 1), so that it never lands in a single task.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ranking import group_row_number, range_row_number, sort_key, split_hot, window_row_number
from ..session import COMPACT, by_key, cut_lineage, drop_anchor

# Fixed load timestamp of reproducible fixture runs (UTC).
DEFAULT_RUN_TS = "2024-01-01 06:00:00"
# Fixed adapter constants (see module docstring).
HOUR_MULTIPLIER, HOURS = 7, 24
GAP_MODULUS = 31
REORDER_ORDER_MUL, REORDER_PART_MUL, REORDER_MOD = 31, 17, 100
REORDER_PART_MOD, REORDER_USER_MOD = 50, 51


def _load_time(run_ts: str, second_load: tuple[str, str] | None):
    """Load time of a row: ``run_ts``, or with ``second_load = (cutoff_date,
    second_ts)`` the second load's time for rows of orders placed on or after
    the cutoff (a two-day load history derived from the order dates)."""
    first = F.to_timestamp(F.lit(run_ts))
    if second_load is None:
        return first
    cutoff, second_ts = second_load
    return F.when(F.col("order_date") >= F.to_date(F.lit(cutoff)), F.to_timestamp(F.lit(second_ts))) \
        .otherwise(first)


def _audit(df: DataFrame, run_ts: str, source_file: str, loaded_at=None) -> DataFrame:
    return df.withColumns({
        "_loaded_at": F.to_timestamp(F.lit(run_ts)) if loaded_at is None else loaded_at,
        "_source_file": F.lit(source_file),
    })


def numbered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with ``order_number``, the customer's order count and the
    previous order's date."""
    src = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").cast("long").alias("order_id"),
        F.col("o_custkey").cast("long").alias("user_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )
    order = [sort_key("order_date"), sort_key("order_id")]
    rest, hot = split_hot(src, ["user_id"])
    # an order without a user has no previous one
    previous = F.when(F.col("user_id").isNotNull(), F.lag("order_date").over(Window.partitionBy("user_id").orderBy(*order)))
    numbered = window_row_number(rest, ["user_id"], order, "order_number", "user_orders").withColumn("prior_date", previous)
    if hot is not None:
        numbered = numbered.unionByName(_with_previous(range_row_number(hot, ["user_id"], order, "order_number", "user_orders")))
    return numbered


def _with_previous(numbered: DataFrame) -> DataFrame:
    """Numbered orders with the date of the order before, by a join."""
    prior = numbered.select(
        "user_id",
        (F.col("order_number") + 1).alias("order_number"),
        F.col("order_date").alias("prior_date"),
    )
    return numbered.join(prior, ["user_id", "order_number"], "left")


def raw_orders(numbered: DataFrame, run_ts: str = DEFAULT_RUN_TS,
               second_load: tuple[str, str] | None = None) -> DataFrame:
    """The raw orders table with audit columns."""
    out = numbered.select(
        "order_id",
        "user_id",
        F.col("order_number").cast("int").alias("order_number"),
        (F.dayofweek("order_date") - 1).cast("int").alias("order_dow"),
        ((F.col("order_id") * HOUR_MULTIPLIER + F.col("user_id")) % HOURS).cast("int")
        .alias("order_hour_of_day"),
        (F.datediff("order_date", "prior_date") % GAP_MODULUS).cast("double")
        .alias("days_since_prior_order"),
        _load_time(run_ts, second_load).alias("_loaded_at"),
    )
    return _audit(out, run_ts, "orders.parquet", F.col("_loaded_at"))


def carted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated lines with their cart position (independent of the
    order numbering, so both can be built at the same time)."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_orderkey").cast("long").alias("order_id"),
        F.col("l_partkey").cast("long").alias("product_id"),
        "l_linenumber",
    )
    order = [sort_key("line_rank"), sort_key("product_id")]
    dedup = lambda lines: lines.groupBy("order_id", "product_id").agg(F.min("l_linenumber").alias("line_rank"))
    rest, hot = split_hot(li, ["order_id"])
    # lines are moved once, by order: duplicates, positions and the orders' columns all meet there
    carted = window_row_number(dedup(by_key(rest, "order_id")), ["order_id"], order, "add_to_cart_order")
    if hot is not None:
        carted = carted.unionByName(range_row_number(dedup(hot), ["order_id"], order, "add_to_cart_order"))
    return carted


def raw_lines(carted: DataFrame, numbered: DataFrame) -> DataFrame:
    """Lines with cart position, reorder flag and train flag."""
    owners = numbered.select(
        "order_id", "user_id", "order_date",
        (F.col("order_number") == F.col("user_orders")).alias("is_last"),
    )
    lines = carted.join(owners, "order_id", "left")
    reordered = (((F.col("order_id") * REORDER_ORDER_MUL + F.col("product_id") * REORDER_PART_MUL)
                  % REORDER_MOD)
                 < (F.col("product_id") % REORDER_PART_MOD) + (F.col("user_id") % REORDER_USER_MOD))
    return lines.select(
        "order_id", "product_id",
        F.col("add_to_cart_order").cast("int").alias("add_to_cart_order"),
        reordered.cast("int").alias("reordered"),
        F.coalesce(F.col("is_last"), F.lit(False)).alias("is_train"),
        "order_date",
    )


def raw_products(spark: SparkSession, sf_dir: str, run_ts: str = DEFAULT_RUN_TS):
    """(products, aisles, departments) raw tables from the part table."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        F.col("p_partkey").cast("long").alias("product_id"),
        F.col("p_name").alias("product_name"),
        "p_brand", "p_type",
    )
    # Dense ids of brands (aisles) and types (departments) in one numbering
    # pass over the union of both distinct value sets, numbered per kind.
    values = (part.select(F.lit("aisle").alias("kind"), F.col("p_brand").alias("value"))
              .unionByName(part.select(F.lit("department").alias("kind"), F.col("p_type").alias("value")))
              .distinct())
    ids = group_row_number(values, ["kind"], [sort_key("value")], "id")
    aisles = ids.filter(F.col("kind") == "aisle").select(F.col("value").alias("aisle"),
                                                         F.col("id").alias("aisle_id"))
    departments = ids.filter(F.col("kind") == "department").select(F.col("value").alias("department"),
                                                                   F.col("id").alias("department_id"))
    products = (part
                .join(aisles, part["p_brand"] == aisles["aisle"], "left")
                .join(departments, part["p_type"] == departments["department"], "left")
                .select("product_id", "product_name",
                        F.col("aisle_id").cast("long"), F.col("department_id").cast("long")))
    aisles = aisles.select(F.col("aisle_id").cast("long"), "aisle")
    departments = departments.select(F.col("department_id").cast("long"), "department")
    return (_audit(products, run_ts, "part.parquet"), _audit(aisles, run_ts, "part.parquet"),
            _audit(departments, run_ts, "part.parquet"))


class FixtureTables:
    """The six raw tables derived from ``sf_dir``, each built on first use
    (``tables["orders"]`` ...); shared intermediate frames are built once."""

    def __init__(self, spark: SparkSession, sf_dir: str, run_ts: str = DEFAULT_RUN_TS,
                 second_load: tuple[str, str] | None = None):
        self.spark, self.sf_dir, self.run_ts = spark, sf_dir, run_ts
        self.second_load = second_load
        self._cache: dict[str, DataFrame] = {}
        self._locks: dict[str, threading.Lock] = {}
        self._guard = threading.Lock()

    def _get(self, key: str, build):
        # One build per key even when several threads ask at once.
        with self._guard:
            lock = self._locks.setdefault(key, threading.Lock())
        with lock:
            if key not in self._cache:
                self._cache[key] = build()
        return self._cache[key]

    def prepare(self, pool) -> None:
        """Build the independent parts (order numbering, cart numbering,
        catalog) concurrently on ``pool``, then the lines from the first two."""
        for f in [pool.submit(self._numbered), pool.submit(self._carted), pool.submit(self._catalog)]:
            f.result()
        self._lines()

    def _numbered(self) -> DataFrame:
        return self._get("numbered", lambda: cut_lineage(numbered_orders(self.spark, self.sf_dir), "orders", COMPACT))

    def _lines(self) -> DataFrame:
        # Both line tables (prior, train) read this frame: write it once to
        # the shared checkpoint folder instead of deriving it twice.
        return self._get("lines", lambda: cut_lineage(raw_lines(self._carted(), self._numbered()), "lines", COMPACT))

    def _carted(self) -> DataFrame:
        return self._get("carted", lambda: carted_lines(self.spark, self.sf_dir))

    def _catalog(self):
        return self._get("catalog", lambda: raw_products(self.spark, self.sf_dir, self.run_ts))

    def _line_set(self, train: bool) -> DataFrame:
        cols = ["order_id", "product_id", "add_to_cart_order", "reordered"]
        flag = F.col("is_train") if train else ~F.col("is_train")
        lines = self._lines().filter(flag)
        return _audit(lines.select(*cols, _load_time(self.run_ts, self.second_load).alias("_loaded_at")),
                      self.run_ts, "lineitem.parquet", F.col("_loaded_at"))

    def __getitem__(self, name: str) -> DataFrame:
        builders = {
            "orders": lambda: raw_orders(self._numbered(), self.run_ts, self.second_load),
            "order_products_prior": lambda: self._line_set(False),
            "order_products_train": lambda: self._line_set(True),
            "products": lambda: self._catalog()[0],
            "aisles": lambda: self._catalog()[1],
            "departments": lambda: self._catalog()[2],
        }
        return self._get("raw:" + name, builders[name])

    def drop(self) -> None:
        """Delete what was written on the way. Neither these tables nor what is
        derived from them, and not written, can be read any more."""
        for key in ("numbered", "lines"):
            if key in self._cache:
                drop_anchor(self._cache[key])
        self._cache.clear()

    def keys(self):
        return ["orders", "order_products_prior", "order_products_train", "products", "aisles",
                "departments"]


def raw_from_parquet(spark: SparkSession, sf_dir: str, run_ts: str = DEFAULT_RUN_TS,
                     second_load: tuple[str, str] | None = None) -> FixtureTables:
    """The six raw tables (with audit columns) derived from ``sf_dir``,
    built lazily by name."""
    return FixtureTables(spark, sf_dir, run_ts, second_load)
