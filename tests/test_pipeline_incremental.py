from pyspark.sql import functions as F

from basketry.plans.pipeline import Models, materialize
from basketry.sources import tables
from basketry.sources.fixtures import raw_from_parquet

SF = "/root/testdata/sf0.001"
SECOND = ("1998-08-01", "2024-01-02 06:00:00")


def test_daily_runs_upsert_facts(spark, scratch):
    raw = raw_from_parquet(spark, SF, second_load=SECOND)
    first_ts = F.to_timestamp(F.lit("2024-01-01 06:00:00"))
    day1 = {t: raw[t].filter(F.col("_loaded_at") == first_ts) if t.startswith("order") else raw[t]
            for t in raw.keys()}
    materialize(Models(spark, day1), scratch)
    n1 = tables.read(spark, scratch, "fact_orders").count()
    # day 2: all loads arrived; facts are built incrementally from version 1
    m2 = Models(spark, {t: raw[t] for t in raw.keys()})
    materialize(m2, scratch)
    assert tables.current_version(spark, scratch, "fact_orders") == 2
    inc = tables.read(spark, scratch, "fact_orders")
    full = Models(spark, {t: raw[t] for t in raw.keys()}).fact_orders
    assert n1 < inc.count() == full.count()
    assert inc.select("order_id").exceptAll(full.select("order_id")).count() == 0
    lines = tables.read(spark, scratch, "fact_order_products")
    n_lines = sum(tables.read(spark, scratch, f"raw_order_products_{s}").count() for s in ("prior", "train"))
    assert lines.count() == n_lines
    # the day-2 facts were appended as a segment, not rewritten
    assert tables.segments(spark, scratch, "fact_orders") == [1, 2]
    assert tables.segments(spark, scratch, "fact_order_products") == [1, 2]
    # day 3, nothing new: the facts keep their rows
    materialize(Models(spark, {t: raw[t] for t in raw.keys()}), scratch)
    assert tables.read(spark, scratch, "fact_orders").count() == inc.count()


def _rows(df):
    return sorted(map(repr, (tuple(r) for r in df.select(*sorted(df.columns)).collect())))


def test_daily_run_scans_only_segments_that_may_hold_its_orders(spark, scratch):
    """Four loads of order ids in ascending ranges: the plans of the last build's
    line and order rows name the files of the last load alone, and every fact
    row equals a full build's."""
    from basketry.plans.pipeline import DAILY_MODELS, Models, PRUNED_BY
    raw = raw_from_parquet(spark, SF)
    for t in ("products", "aisles", "departments"):
        tables.commit(raw[t], scratch, f"raw_{t}")
    high = raw["orders"].agg(F.max("order_id")).first()[0]
    step, plans = high // 4 + 1, []
    for load in range(4):
        ts = F.to_timestamp(F.lit(f"2024-01-0{load + 1} 06:00:00"))
        for t in ("orders", "order_products_prior", "order_products_train"):
            part = raw[t].where(F.col("order_id").between(load * step, (load + 1) * step - 1)).withColumn("_loaded_at", ts)
            tables.append(part, scratch, f"raw_{t}", prune=PRUNED_BY[f"raw_{t}"])
        m = Models.from_tables(spark, scratch)
        if load == 3:
            m.use("dim_users", tables.read(spark, scratch, "dim_users"))
            m.use("dim_products", tables.read(spark, scratch, "dim_products"))
            for name in ("order_line_stats", "fact_orders", "fact_order_products"):
                if name == "fact_orders":  # reads the order totals, which its build has brought up to date
                    rows, key, new = m.incremental("order_line_stats", scratch)
                    tables.upsert_commit(rows, scratch, "order_line_stats", key, new, prune="order_id")
                plans.append((name, m.incremental(name, scratch)[0].inputFiles()))
        materialize(Models.from_tables(spark, scratch), scratch, DAILY_MODELS, load=False)
    for name, files in plans:
        incremental = [f for f in files if any(f"/{t}/" in f for t in PRUNED_BY)]
        assert all(f"seg=00000{s}" not in f for f in incremental for s in (1, 2, 3)), (name, incremental)
        assert files
    full = Models.from_tables(spark, scratch)
    assert _rows(tables.read(spark, scratch, "order_line_stats")) == _rows(full.order_line_stats)
    facts_now = tables.read(spark, scratch, "fact_orders")
    same = ["order_id", "total_items", "unique_items", "order_reorder_rate", "first_item_cart_pos", "loaded_at"]
    assert _rows(facts_now.select(*same)) == _rows(full.fact_orders.select(*same))
    lines = tables.read(spark, scratch, "fact_order_products")
    assert _rows(lines.drop("user_key")) == _rows(full.fact_order_products.drop("user_key"))


def test_scd2_product_dimension_across_runs(spark, scratch):
    raw = raw_from_parquet(spark, SF)
    base = {t: raw[t] for t in raw.keys()}
    materialize(Models(spark, base, "2024-01-01 06:00:00"), scratch, names=["stg_products", "dim_products"],
                scd2_products=True)
    moved = dict(base)
    moved["products"] = base["products"].withColumn(
        "department_id", F.when(F.col("product_id") <= 3, F.lit(1).cast("long")).otherwise(F.col("department_id")))
    materialize(Models(spark, moved, "2024-03-01 06:00:00"), scratch, names=["stg_products", "dim_products"],
                scd2_products=True)
    dim = tables.read(spark, scratch, "dim_products")
    changed = base["products"].filter("product_id <= 3 AND department_id <> 1").count()
    assert dim.filter("NOT is_current").count() == changed
    assert dim.filter("is_current").count() == base["products"].count()
    assert dim.filter("is_current AND product_id <= 3").select("department_id").distinct().collect()[0][0] == 1
    closed = dim.filter("NOT is_current").select("valid_to").distinct().collect()
    assert changed > 0 and [str(r.valid_to) for r in closed] == ["2024-03-01"]
    again = dict(base)
    again["products"] = base["products"].withColumn(
        "department_id", F.when(F.col("product_id") <= 3, F.lit(2).cast("long")).otherwise(F.col("department_id")))
    materialize(Models(spark, again, "2024-03-01 18:00:00"), scratch, names=["stg_products", "dim_products"],
                scd2_products=True)
    dim = tables.read(spark, scratch, "dim_products")
    assert dim.select("product_key").distinct().count() == dim.count()
    assert dim.where("valid_from = valid_to").count() == 0
    assert {r.department_id for r in dim.where("is_current AND product_id <= 3").collect()} == {2}
    assert dim.where("is_current").count() == base["products"].count()


def test_bucketed_load_gives_same_models(spark, scratch):
    from basketry.plans.pipeline import load_raw
    plain = Models(spark, {t: raw_from_parquet(spark, SF)[t] for t in raw_from_parquet(spark, SF).keys()})
    bucketed = Models.from_fixtures(spark, SF)
    load_raw(bucketed, scratch, bucket_by_order=4)
    hist = bucketed.customer_history._jdf.queryExecution().executedPlan().toString()
    assert hist.count("Exchange hashpartitioning") == 1          # only the shuffle by user_id
    for name in ("customer_history", "fact_orders"):
        a, b = getattr(plain, name), getattr(bucketed, name)
        assert a.count() == b.count() and a.exceptAll(b.select(*a.columns)).count() == 0
