import os

from basketry.sources.csv_loader import load_raw_csv, write_raw_csv
from basketry.sources.fixtures import raw_from_parquet

SF = "/root/testdata/sf0.001"


def test_round_trip_and_summary(spark, scratch):
    raw = raw_from_parquet(spark, SF)
    landing = os.path.join(scratch, "landing")
    write_raw_csv(raw, landing)
    loaded, summary = load_raw_csv(spark, landing, os.path.join(scratch, "wh"), "2024-01-01 06:00:00")
    s = {r.table_name: (r.rows, r.status) for r in summary.collect()}
    assert s["TOTAL"] == (sum(raw[t].count() for t in raw.keys()), "loaded")
    for t in raw.keys():
        assert s[t] == (raw[t].count(), "loaded")
        cols = [c for c in raw[t].columns if not c.startswith("_")]
        assert loaded[t].select(*cols).exceptAll(raw[t].select(*cols)).count() == 0
    assert loaded["orders"].where("_source_file IS NULL OR _loaded_at IS NULL").count() == 0


def test_quotes_missing_and_bad_files(spark, scratch):
    landing = os.path.join(scratch, "landing")
    os.makedirs(landing)
    with open(os.path.join(landing, "products.csv"), "w") as f:
        f.write('product_id,product_name,aisle_id,department_id\n')
        f.write('1,"Chocolate ""Sandwich"" Cookies, family size",61,19\n')
        f.write('2,All-Seasons Salt,104,13\n')
    with open(os.path.join(landing, "orders.csv"), "w") as f:
        f.write('order_id,user_id,order_number,order_dow,order_hour_of_day,days_since_prior_order\n')
        f.write('1,1,1,2,08,\n')
        f.write('2,1,2,3,07,15.0\n')
    with open(os.path.join(landing, "aisles.csv"), "w") as f:
        f.write('aisle_id,aisle\nnot-a-number,x\n')
    loaded, summary = load_raw_csv(spark, landing, os.path.join(scratch, "wh"), "2024-01-01 06:00:00")
    s = {r.table_name: r.status for r in summary.collect()}
    assert s == {"orders": "loaded", "products": "loaded", "aisles": "failed", "departments": "missing",
                 "order_products_prior": "missing", "order_products_train": "missing", "TOTAL": "partial"}
    total = [r for r in summary.collect() if r.table_name == "TOTAL"][0]
    assert total.rows == 4 and "aisles" in total.error
    p = {r.product_id: (r.product_name, r.aisle_id, r.department_id) for r in loaded["products"].collect()}
    assert p[1] == ('Chocolate "Sandwich" Cookies, family size', 61, 19)
    o = {r.order_id: (r.order_hour_of_day, r.days_since_prior_order) for r in loaded["orders"].collect()}
    assert o == {1: (8, None), 2: (7, 15.0)}


def test_columns_by_header_name(spark, scratch):
    landing = os.path.join(scratch, "landing")
    os.makedirs(landing)
    with open(os.path.join(landing, "orders.csv"), "w") as f:
        f.write('user_id,order_id,eval_set,order_number,order_dow,order_hour_of_day,days_since_prior_order\n')
        f.write('7,1,prior,1,2,08,\n')
    with open(os.path.join(landing, "aisles.csv"), "w") as f:
        f.write('aisle_id,name\n1,x\n')
    with open(os.path.join(landing, "departments.csv"), "w") as f:
        f.write('department_id,department\nabc,x\n')
    loaded, summary = load_raw_csv(spark, landing, os.path.join(scratch, "wh"), "2024-01-01 06:00:00")
    r = loaded["orders"].first()
    assert (r.order_id, r.user_id, r.order_hour_of_day, r._source_file) == (1, 7, 8, "orders.csv")
    assert loaded["orders"].columns[:2] == ["order_id", "user_id"] and "eval_set" not in loaded["orders"].columns
    errors = {r.table_name: r.error for r in summary.collect()}
    assert "no column aisle" in errors["aisles"] and "abc" in errors["departments"]


def test_malformed_streamed_row_fails(spark, scratch):
    import pytest
    from basketry.streaming.daily_load import run_daily_load
    folder = os.path.join(scratch, "landing", "aisles.csv")
    os.makedirs(folder)
    with open(os.path.join(folder, "one.csv"), "w") as f:
        f.write('aisle_id,aisle\nabc,x\n')
    with pytest.raises(Exception):
        run_daily_load(spark, os.path.join(scratch, "landing"), os.path.join(scratch, "wh"),
                       os.path.join(scratch, "ckpt"), ["aisles"])
