"""Disk: what the daily runs and the incremental line fact leave written, and that shares lose no row."""
import datetime as dt
import glob
import os
import random

from basketry import queries as Q
from basketry import session
from basketry.operators.incremental import upsert
from basketry.plans import facts
from basketry.plans.pipeline import Models
from basketry.plans.staging import stg_order_products
from basketry.session import cut_lineage, ensure_checkpoint_dir, write_shares
from basketry.sources import tables

LINES = "order_id long, product_id long, add_to_cart_order int, reordered int"


def _rows(df):
    return sorted(map(repr, (tuple(r) for r in df.select(*sorted(df.columns)).collect())))


def _size(folder):
    return sum(os.path.getsize(f) for f in glob.glob(f"{folder}/**/*.parquet", recursive=True))


def _input(spark, where, orders=3000, parts=400):
    """Orders around the second load's cutoff; some without a customer, some lines twice or without a part."""
    rng, day = random.Random(4), dt.date(1998, 8, 1)
    placed = [(i, None if i % 50 == 3 else rng.randrange(orders // 10), day + dt.timedelta(days=rng.randrange(-300, 300))) for i in range(orders)]
    spark.createDataFrame(placed, "o_orderkey long, o_custkey long, o_orderdate date").write.parquet(f"{where}/orders.parquet")
    lines = [(i % orders, None if i % 997 == 5 else rng.randrange(parts), i // orders) for i in range(4 * orders)] + [(7, 7, 1), (7, 7, 2), (None, 3, 1)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int").write.parquet(f"{where}/lineitem.parquet")
    spark.createDataFrame([(i, f"p{i}", f"b{i % 5}", f"t{i % 3}", i % 50) for i in range(parts)],
                          "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{where}/part.parquet")
    return str(where)


def test_daily_runs_keep_their_tables_alone(spark, tmp_path, monkeypatch):
    """Written in shares, with the rows of a plain build; the load's anchors and replaced segments are gone."""
    src = _input(spark, tmp_path)
    monkeypatch.setattr(session, "SHARE_ROWS", 3000)
    anchors = f"{ensure_checkpoint_dir(spark).replace('file:', '')}/basketry-anchors"
    before = set(glob.glob(f"{anchors}/*"))
    root = Q.daily_runs(spark, src)
    left = {os.path.basename(f).rsplit("-", 1)[0] for f in set(glob.glob(f"{anchors}/*")) - before}
    assert not left & {"orders", "lines", "fresh-orders", "fresh-lines", "stats-orders"}
    folder = root.replace("file:", "")
    for name in ("raw_orders", "fact_orders", "fact_order_products", "dim_users"):
        assert len(glob.glob(f"{folder}/{name}/data/seg=*")) == len(tables.segments(spark, root, name))
    lines = tables.read(spark, root, "fact_order_products")
    assert _size(f"{folder}/fact_order_products/data") < 60 * lines.count()
    plain = Models.from_tables(spark, root)
    assert _rows(Q.daily_full_refresh(spark, src)) == _rows(plain.fact_orders)
    known = lines.select("order_product_id").distinct()  # late lines of known orders stay out
    assert known.count() == lines.count()
    # users of the first day's lines are those of that day
    assert _rows(lines.drop("user_key")) == _rows(plain.fact_order_products.drop("user_key").join(known, "order_product_id", "left_semi"))


def test_written_shares_hold_each_row_once(spark, tmp_path):
    df = spark.createDataFrame([(None if i % 7 == 0 else i % 40, i) for i in range(200)] + [(1, 1)] * 3, "k long, v long")
    write_shares(df.where("v < 9"), f"{tmp_path}/t")
    write_shares(df, f"{tmp_path}/t", "k", 5)
    assert _rows(spark.read.parquet(f"{tmp_path}/t")) == _rows(df)


def test_incremental_lines_are_written_once(spark, tmp_path, monkeypatch):
    """The result of the incremental line fact reads what is written, in shares: nothing is shuffled for it."""
    src = _input(spark, tmp_path)
    monkeypatch.setattr(session, "SHARE_ROWS", 3000)
    got = Q.fact_order_products_incremental(spark, src)
    assert _rows(got) == _rows(Q.REGISTRY["fact_order_products"](spark, src).where("order_id IS NOT NULL"))
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    files = [f.replace("file:", "").replace("//", "/") for f in got.inputFiles()]
    assert sum(map(os.path.getsize, files)) < 60 * got.count()


def test_line_keys_are_made_behind_the_joins_and_others_kept(spark):
    staged = stg_order_products(spark.createDataFrame([(1, 2, 1, 1), (None, 3, None, None), (4, None, 9, 0), (1, 2, 1, 1)], LINES),
                                spark.createDataFrame([(5, 2, 1, 0)], LINES))
    other = staged.selectExpr("CASE WHEN order_id = 1 THEN 'mine' WHEN order_id = 4 THEN NULL ELSE order_product_id END AS order_product_id",
                              "order_id", "product_id", "add_to_cart_order", "is_reordered", "order_set", "is_early_cart_addition")
    products = spark.createDataFrame([(2, "p2", True), (2, "old", False)], "product_id long, product_key string, is_current boolean")
    orders = spark.createDataFrame([(1, 8, 3), (5, None, 4)], "order_id long, user_id long, order_day_of_week int")
    users = spark.createDataFrame([(8, "u8")], "user_id long, user_key string")
    for lines in (staged, other):
        got = facts.fact_order_products_build(lines, products, orders, users)
        assert _rows(got.select("order_id", "product_id", "order_product_id")) == _rows(lines.select("order_id", "product_id", "order_product_id"))
    assert {(r.order_id, r.product_key, r.user_key, r.date_key) for r in got.collect()} == {(1, "p2", "u8", 3), (None, None, None, None), (4, None, None, None), (5, "p2", None, 4)}


def test_upsert_of_written_rows(spark):
    target = cut_lineage(spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v long"))
    new, again = (cut_lineage(spark.createDataFrame(rows, "k string, v long")) for rows in ([("c", 4), (None, 5)], [("b", 6)]))
    for updates in (new, again):
        assert _rows(upsert(target, updates, ["k"], written=True)) == _rows(upsert(target, updates, ["k"]))


def test_upsert_replaces_rows_of_orders_that_both_have(spark, scratch, monkeypatch):
    monkeypatch.setattr(session, "SHARE_ROWS", 2)
    frame = lambda rows: spark.createDataFrame(rows, "k string, order_id long, v int")
    tables.upsert_commit(frame([("1-1", 1, 0), ("1-2", 1, 0), ("2-1", 2, 0), ("x", None, 0), (None, 9, 0)]), scratch, "t", ["k"], prune="order_id", shares=2)
    tables.upsert_commit(frame([("1-3", 1, 1), ("3-1", 3, 1)]), scratch, "t", ["k"], prune="order_id")
    assert tables.segments(spark, scratch, "t") == [1, 2]  # an order in common, no key
    tables.upsert_commit(frame([("1-1", 1, 2), ("x", None, 2), (None, 9, 2)]), scratch, "t", ["k"], prune="order_id")
    assert _rows(tables.read(spark, scratch, "t").select("k", "v")) == sorted(map(repr, [
        ("1-1", 2), ("1-2", 0), ("2-1", 0), ("x", 2), (None, 0), ("1-3", 1), ("3-1", 1), (None, 2)]))
