"""The model graph: raw → staging → marts → dimensions → facts → reports.

:class:`Models` builds each model lazily and once (a model used by several
downstream models is the same DataFrame object, so Spark reuses its
exchanges within a query). :func:`materialize` writes the graph in
dependency order as versioned tables in shared storage and re-reads each
one, so later models start from written tables (lineage cut, no recompute
after executor loss).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality
from ..session import COMPACT, cut_lineage, drop_anchor, free_shuffles, shares_of
from ..sources import tables
from ..schemas import RAW_TABLES
from ..sources.fixtures import DEFAULT_RUN_TS, raw_from_parquet
from . import customers, dims, facts, products, reports, staging

# The models in dependency order with their materialisation,
# as the reference configures them: staging as views, the intermediate
# history ephemeral (inlined), marts and dimensions as tables rebuilt each
# run, facts incremental.
MATERIALIZATION = {
    "stg_orders": "view", "stg_order_products": "view", "stg_products": "view",
    "stg_aisles": "view", "stg_departments": "view",
    "customer_history": "ephemeral",
    # our own: order-grain line totals, kept up to date so that lines are aggregated once
    "order_line_stats": "incremental",
    "customer_360": "table", "product_performance": "table",
    "dim_dates": "table", "dim_users": "table", "dim_departments": "table", "dim_products": "table",
    "fact_orders": "incremental", "fact_order_products": "incremental",
}
MODEL_ORDER = list(MATERIALIZATION)
# Written models each model reads (beyond raw tables and staging views):
# models of one level have no dependency on each other and build in
# parallel (the reference builds with 4 threads).
DEPENDS_ON = {
    "order_line_stats": [], "customer_360": ["order_line_stats"], "product_performance": [], "dim_dates": [], "dim_departments": [],
    "dim_products": [], "dim_users": ["customer_360"], "fact_orders": ["dim_users", "order_line_stats"],
    "fact_order_products": ["dim_products", "dim_users"],
}
# The models that feed the facts, and the facts.
DAILY_MODELS = ["stg_orders", "stg_order_products", "stg_products", "stg_aisles", "stg_departments",
                "order_line_stats", "customer_360", "dim_users", "dim_products", "fact_orders", "fact_order_products"]
BUILD_THREADS = 4
# Tables whose segments are pruned by order: a key of theirs belongs to one order.
PRUNED_BY = {name: "order_id" for name in (
    "raw_orders", "raw_order_products_prior", "raw_order_products_train",
    "order_line_stats", "fact_orders", "fact_order_products")}
# What an incremental model notes with its version: the latest load time it has seen.
LOADED_UNTIL = "loaded_until"


def build_levels(names) -> list[list[str]]:
    """Written models grouped into dependency levels, in order."""
    todo = [n for n in names if MATERIALIZATION[n] in ("table", "incremental")]
    done: set[str] = set()
    levels = []
    while todo:
        level = [n for n in todo if all(d in done or d not in todo for d in DEPENDS_ON.get(n, []))]
        if not level:
            raise ValueError(f"dependency cycle among {todo}")
        levels.append(level)
        done.update(level)
        todo = [n for n in todo if n not in level]
    return levels


LINE_TABLES = ("order_products_prior", "order_products_train")


class Models:
    """Lazily built model graph over six raw DataFrames."""

    def __init__(self, spark: SparkSession, raw: dict[str, DataFrame], run_ts: str = DEFAULT_RUN_TS):
        self.spark = spark
        self.raw = raw
        self.run_ts = run_ts
        self.root: str | None = None  # where the raw tables lie, if they are written tables
        self.bucketed = False  # whether the raw tables are bucketed by order
        self._overrides: dict[str, DataFrame] = {}
        self._anchors: dict[str, list[DataFrame]] = {}  # what incremental models have written on their way

    @classmethod
    def from_fixtures(cls, spark: SparkSession, sf_dir: str, run_ts: str = DEFAULT_RUN_TS) -> "Models":
        return cls(spark, raw_from_parquet(spark, sf_dir, run_ts), run_ts)

    @classmethod
    def from_tables(cls, spark: SparkSession, root: str, run_ts: str = DEFAULT_RUN_TS) -> "Models":
        """The graph over raw tables already loaded into ``root`` (by the CSV
        loader, the streaming load or :func:`load_raw`)."""
        models = cls(spark, {t: tables.read(spark, root, f"raw_{t}") for t in RAW_TABLES}, run_ts)
        models.root = root
        return models

    def use(self, name: str, df: DataFrame) -> None:
        """Replace a model by an already materialised table."""
        self._overrides[name] = df
        self.__dict__[name] = df

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.raw["orders"])

    @cached_property
    def stg_order_products(self) -> DataFrame:
        return staging.stg_order_products(self.raw["order_products_prior"], self.raw["order_products_train"])

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.raw["products"], self.raw["aisles"], self.raw["departments"])

    @cached_property
    def stg_aisles(self) -> DataFrame:
        return staging.stg_aisles(self.raw["aisles"])

    @cached_property
    def stg_departments(self) -> DataFrame:
        return staging.stg_departments(self.raw["departments"])

    @cached_property
    def order_line_stats(self) -> DataFrame:
        return customers.order_line_stats(self.stg_order_products, self.bucketed)

    @property
    def line_stats(self) -> DataFrame:
        return self.order_line_stats

    @cached_property
    def customer_history(self) -> DataFrame:
        return customers.customer_history(self.stg_orders, self.stg_order_products, self.line_stats)

    @cached_property
    def customer_360(self) -> DataFrame:
        return customers.customer_360(self.customer_history)

    @cached_property
    def product_performance(self) -> DataFrame:
        return products.product_performance(self.stg_order_products, self.stg_products)

    @cached_property
    def dim_dates(self) -> DataFrame:
        return dims.dim_dates(self.spark)

    @cached_property
    def dim_users(self) -> DataFrame:
        return dims.dim_users(self.customer_360, self.run_ts)

    @cached_property
    def dim_departments(self) -> DataFrame:
        return dims.dim_departments(self.stg_departments, self.run_ts)

    @cached_property
    def dim_products(self) -> DataFrame:
        return dims.dim_products(self.stg_products, run_ts=self.run_ts)

    @cached_property
    def fact_orders(self) -> DataFrame:
        return facts.fact_orders(self.stg_orders, self.stg_order_products, self.dim_users,
                                 line_stats=self.line_stats)

    @cached_property
    def fact_order_products(self) -> DataFrame:
        return facts.fact_order_products(self.stg_order_products, self.dim_products, self.stg_orders,
                                         self.dim_users)

    # incremental ----------------------------------------------------------
    def _of_orders(self, table: str, orders: DataFrame) -> DataFrame:
        """Rows of a raw table of the given orders (``order_id``). Of a written
        table only the segments that may hold them are scanned."""
        if self.root:
            only = tables.holding(orders, self.root, f"raw_{table}", "order_id")
            rows = tables.read(self.spark, self.root, f"raw_{table}", only=only)
        else:
            rows = self.raw[table]
        return rows.join(orders.select("order_id").distinct(), "order_id", "left_semi")

    def _lines_since(self, until: str | None) -> DataFrame:
        """Lines, not yet keyed, loaded after ``until`` (all, if it is None); load
        times are constant within a load, so earlier row groups are skipped."""
        fresh = [self.raw[t] if until is None else self.raw[t].where(F.col("_loaded_at") > F.lit(until).cast("timestamp"))
                 for t in LINE_TABLES]
        return staging.all_lines(*fresh)

    def _anchor(self, name: str, df: DataFrame, label: str) -> DataFrame:
        """``df`` written for the model ``name``, until :meth:`drop_anchors`."""
        out = cut_lineage(df, label, COMPACT)
        self._anchors.setdefault(name, []).append(out)
        return out

    def drop_anchors(self, name: str) -> None:
        """Delete what :meth:`incremental` wrote for ``name``, whose rows are written now."""
        for df in self._anchors.pop(name, []):
            drop_anchor(df)

    def shares(self, name: str) -> int:
        """Shares in which the model ``name`` is written: by the rows that it moves, of
        written tables. Other frames are evaluated once."""
        if self._anchors.get(name):
            return shares_of(self._anchors[name][0].count())
        if not self.root or name not in PRUNED_BY:
            return 1
        return shares_of(sum(self.raw[t].count() for t in (["orders"] if name == "fact_orders" else LINE_TABLES)))

    def loaded_until(self, name: str) -> str | None:
        """Latest load time among the raw rows that the model ``name`` is fed by."""
        sources = ["orders"] if name == "fact_orders" else LINE_TABLES
        found = [t for t in (self.raw[s].agg(F.max("_loaded_at").cast("string")).first()[0] for s in sources) if t]
        return max(found, default=None)

    def incremental(self, name: str, root: str):
        """(update rows, key, append_new_columns) of an incremental model of
        ``root``, given its current version there."""
        until = tables.properties(self.spark, root, name).get(LOADED_UNTIL)
        whole = lambda only=None: tables.read(self.spark, root, name, only=only)
        if name == "order_line_stats":
            # orders with new lines are aggregated anew, over all their lines
            orders = self._anchor(name, self._lines_since(until).select("order_id").where("order_id IS NOT NULL").distinct(), "stats-orders")
            lines = staging.stg_order_products(*(self._of_orders(t, orders) for t in LINE_TABLES))
            return customers.order_line_stats(lines), ["order_id"], True
        if name == "fact_orders":
            fresh = self.stg_orders.where(F.col("loaded_at") > F.lit(until).cast("timestamp")) if until else facts.newer_than(self.stg_orders, whole(), "loaded_at")
            fresh = self._anchor(name, fresh, "fresh-orders")
            if tables.exists(self.spark, root, "order_line_stats"):
                only = tables.holding(fresh, root, "order_line_stats", "order_id")
                stats = tables.read(self.spark, root, "order_line_stats", only=only)
            else:
                stats = customers.order_line_stats(self.stg_order_products.join(fresh.select("order_id"), "order_id", "left_semi"))
            return facts.fact_orders_build(fresh, self.stg_order_products, self.dim_users, stats), facts.FACT_ORDERS_KEY, True
        if name == "fact_order_products":
            fresh = staging.keyed_lines(self._anchor(name, self._lines_since(until), "fresh-lines"))
            only = tables.holding(fresh, root, name, "order_id")
            lines = facts.unseen(fresh, whole(only), "order_id")
            orders = staging.stg_orders(self._of_orders("orders", fresh))
            return (facts.fact_order_products_build(lines, self.dim_products, orders, self.dim_users),
                    facts.FACT_ORDER_PRODUCTS_KEY, False)
        raise KeyError(name)

    # reports -------------------------------------------------------------
    def report(self, name: str, **kw) -> DataFrame:
        fn = getattr(reports, name)
        if name in ("rpt_kpi", "rpt_hourly", "rpt_daily", "rpt_peak_times"):
            return fn(self.fact_orders, **kw)
        if name in ("rpt_segments", "rpt_loyalty", "rpt_frequency", "rpt_segment_rate"):
            return fn(self.customer_360, **kw)
        if name == "rpt_top_products":
            return fn(self.product_performance, **kw)
        if name in ("rpt_departments", "rpt_top_reordered", "rpt_first_in_cart", "rpt_pairs"):
            return fn(self.fact_order_products, self.dim_products, **kw)
        if name == "rpt_basket_by_segment":
            return fn(self.fact_orders, self.dim_users, **kw)
        raise KeyError(name)


# Raw tables at order grain: bucketed by order_id when requested.
ORDER_GRAIN_RAW = ("orders", "order_products_prior", "order_products_train")


def load_raw(models: Models, root: str, threads: int = BUILD_THREADS,
             bucket_by_order: int | None = None) -> dict[str, str]:
    """The load step: write the six raw tables as tables of ``root``
    (concurrently) and continue from the written tables.

    ``bucket_by_order=N`` writes the order-grain tables bucketed by
    ``order_id`` (N buckets, catalog tables of this session): the per-order
    aggregation of all lines then reads co-located data and needs no
    shuffle. Other sessions read the same files without the bucketing."""
    raw = models.raw

    def write(table: str) -> tuple[str, str]:
        if bucket_by_order and table in ORDER_GRAIN_RAW:
            return table, tables.commit_bucketed(raw[table], root, f"raw_{table}", bucket_by_order, "order_id")
        return table, tables.commit(raw[table], root, f"raw_{table}", prune=PRUNED_BY.get(f"raw_{table}"))

    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        if hasattr(raw, "prepare"):
            raw.prepare(pool)
        written = {f"raw_{t}": path for t, path in pool.map(write, RAW_TABLES)}
    models.raw = {t: tables.read(models.spark, root, f"raw_{t}") for t in RAW_TABLES}
    models.root = root
    models.bucketed = bool(bucket_by_order)
    return written


# Tracked attributes of the type-2 product dimension.
PRODUCT_TRACKED = ["product_name", "aisle_id", "aisle_name", "department_id", "department_name"]


def materialize(models: Models, root: str, names=MODEL_ORDER, load: bool = True,
                full_refresh: bool = False, scd2_products: bool = False,
                threads: int = BUILD_THREADS, gate: bool = False) -> dict[str, str]:
    """Build the models in dependency order (after writing the raw tables
    when ``load``): views are registered as temp views, ephemeral models
    stay inline, tables are written as the next version of ``root/<name>``
    (rebuilt: SCD1 for dimensions) and incremental facts with a previous
    version get only their new rows (unless ``full_refresh``). With
    ``scd2_products`` an existing product dimension is merged with the
    current catalog as a type-2 dimension (changed products get a closed and
    a new version, effective on the run date) instead of rebuilt. Models of
    one dependency level are built concurrently on ``threads`` threads (Spark
    runs their jobs side by side); later levels read the written tables.
    With ``gate`` the checks declared on the raw tables and the staging views run
    first, and a failing one stops the build (:class:`quality.FailedChecks`)
    before any model is written. Returns the written paths."""
    written = load_raw(models, root) if load else {}
    for name in names:
        if MATERIALIZATION[name] == "view":
            getattr(models, name).createOrReplaceTempView(name)
    if gate:
        upstream = {**models.raw, **{n: getattr(models, n) for n, kind in MATERIALIZATION.items() if kind == "view"}}
        quality.gate(upstream, [c for c in quality.CHECKS if c.table in upstream], threads)
    # Shared lazy inputs are built once on this thread before any worker
    # touches them.
    for name in ("stg_orders", "stg_order_products", "stg_products", "stg_departments"):
        getattr(models, name)

    def build(name: str) -> tuple[str, str]:
        kind = MATERIALIZATION[name]
        exists = not full_refresh and tables.exists(models.spark, root, name)
        prune = PRUNED_BY.get(name)
        until = models.loaded_until(name) if kind == "incremental" else None
        notes = {LOADED_UNTIL: until} if until else None
        if kind == "incremental" and exists:
            updates, key, new_cols = models.incremental(name, root)
            path = tables.upsert_commit(updates, root, name, key, append_new_columns=new_cols, prune=prune, notes=notes, shares=models.shares(name))
            models.drop_anchors(name)
        elif name == "dim_products" and scd2_products and exists:
            from ..operators.incremental import scd2_merge
            merged = scd2_merge(tables.read(models.spark, root, name), models.stg_products, "product_id",
                                PRODUCT_TRACKED, models.run_ts[:10], models.run_ts)
            path = tables.commit(merged, root, name)
        else:
            path = tables.commit(getattr(models, name), root, name, prune, notes, models.shares(name))
        free_shuffles(models.spark)
        return name, path

    for level in build_levels(names):
        if threads > 1 and len(level) > 1:
            with ThreadPoolExecutor(max_workers=threads) as pool:
                results = list(pool.map(build, level))
        else:
            results = [build(n) for n in level]
        for name, path in results:
            models.use(name, tables.read(models.spark, root, name))
            written[name] = path
    return written
