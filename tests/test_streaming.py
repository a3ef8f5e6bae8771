import os

from basketry.sources import tables
from basketry.streaming.daily_load import run_daily_load

HEADER = "order_id,user_id,order_number,order_dow,order_hour_of_day,days_since_prior_order\n"


def test_available_now_daily_load_upserts(spark, scratch):
    landing = os.path.join(scratch, "landing", "orders.csv")
    os.makedirs(landing)
    root, ckpt = os.path.join(scratch, "wh"), os.path.join(scratch, "stream-ckpt")
    with open(os.path.join(landing, "day1.csv"), "w") as f:
        f.write(HEADER + "1,1,1,0,9,\n2,1,2,1,10,3.0\n")
    run_daily_load(spark, os.path.join(scratch, "landing"), root, ckpt, ["orders"])
    assert tables.read(spark, root, "raw_orders").count() == 2
    with open(os.path.join(landing, "day2.csv"), "w") as f:
        f.write(HEADER + "2,1,2,1,11,3.0\n3,2,1,5,12,\n")
    run_daily_load(spark, os.path.join(scratch, "landing"), root, ckpt, ["orders"])
    got = {r.order_id: r.order_hour_of_day for r in tables.read(spark, root, "raw_orders").collect()}
    assert got == {1: 9, 2: 11, 3: 12}
    # a rerun with nothing new keeps the table as it is
    run_daily_load(spark, os.path.join(scratch, "landing"), root, ckpt, ["orders"])
    assert tables.read(spark, root, "raw_orders").count() == 3


def test_the_file_written_last_wins_within_a_batch(spark, scratch):
    base = os.path.join(scratch, "corrections")
    landing = os.path.join(base, "landing", "orders.csv")
    os.makedirs(landing)
    # the correction has the smaller value and the smaller file name
    for name, hour, when in (("b.csv", 20, 1_700_000_000), ("a.csv", 4, 1_700_000_100)):
        with open(os.path.join(landing, name), "w") as f:
            f.write(HEADER + f"1,1,1,0,{hour},\n")
        os.utime(os.path.join(landing, name), (when, when))
    run_daily_load(spark, os.path.join(base, "landing"), os.path.join(base, "wh"), os.path.join(base, "ckpt"), ["orders"])
    rows = tables.read(spark, os.path.join(base, "wh"), "raw_orders").collect()
    assert [(r.order_id, r.order_hour_of_day, r._source_file) for r in rows] == [(1, 4, "a.csv")]
    assert rows[0].__fields__[-2:] == ["_loaded_at", "_source_file"]


def test_one_per_key_prefers_latest(spark):
    df = spark.createDataFrame([(1, "z", 1), (1, "a", 2), (2, "b", None), (2, "c", None), (None, "q", 3)], "k int, v string, at int")
    assert sorted(tables.one_per_key(df, ["k"], ["at"]).collect(), key=lambda r: r.v) == [(1, "a", 2), (2, "c", None), (None, "q", 3)]
