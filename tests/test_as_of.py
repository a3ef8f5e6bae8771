"""As-of join, build gate and plans of the reports and checks."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from basketry.operators import quality as Q
from basketry.operators.incremental import as_of_join


@pytest.mark.parametrize("group_rows", [1_000_000, 7])
def test_as_of_join_matches_plain(spark, group_rows):
    rng = random.Random(1)
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(n)
    versions = []
    for k in range(6):
        cuts = sorted(rng.sample(range(0, 60), 3))
        ends = [*cuts[1:], None if k % 2 else 70]
        versions += [(k, day(a), b if b is None else day(b), f"{k}@{a}") for a, b in zip(cuts, ends)]
    versions.append((None, day(0), None, "null"))
    # one key holds most rows; nulls, unknown keys, repeated rows
    rows = [(i % 50, rng.choice([0, 0, 0, 1, 2, 3, 4, 5, 9, None]), rng.choice([None, day(rng.randint(-5, 80))])) for i in range(400)] * 2
    left = spark.createDataFrame(rows, "id int, k int, on date").repartition(4)
    right = spark.createDataFrame(versions, "k int, valid_from date, valid_to date, name string")
    want = [(*r, next((n for k, a, b, n in versions if k is not None and k == r[1] and r[2] and a <= r[2] and (b is None or r[2] < b)), None)) for r in rows]
    got = as_of_join(left, right, "k", "on", ["name"], group_rows=group_rows)
    assert got.columns == ["id", "k", "on", "name"]
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, want))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan and "Join Inner, (on" not in plan
    assert as_of_join(left.limit(0), right, "k", "on", ["name"]).count() == 0
    assert as_of_join(left, right.limit(0), "k", "on", ["name"]).where("name IS NOT NULL").count() == 0


def test_kpi_counts_without_expand(spark):
    from basketry.plans.reports import rpt_kpi
    rows = [(1, "a", 3, 0.5), (1, "b", 3, 0.5), (2, "a", 2, 1.0), (3, None, None, None), (None, "c", 1, 0.0)]
    kpi = rpt_kpi(spark.createDataFrame(rows, "order_id long, user_key string, total_items long, order_reorder_rate double"))
    assert tuple(kpi.first()) == (3, 3, 2.3, 0.5)
    assert "Expand" not in kpi._jdf.queryExecution().executedPlan().toString()


def test_unique_checks_share_a_shuffle_by_type(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, "y"), (2, "y"), (None, None)], "k long, s string")
    b = spark.createDataFrame([(1,), (1,), (1,)], "k long")
    checks = [Q.Check("a", "k", "unique"), Q.Check("a", "s", "unique"), Q.Check("b", "k", "unique"), Q.Check("c", "k", "unique")]
    tables = {"a": a, "b": b, "c": b.limit(0)}
    parts = Q._unique_failures(tables, checks)
    assert len(parts) == 2
    got = {(r.table_name, r.column_name): r.failures for p in parts for r in p.collect()}
    assert got == {("a", "k"): 2, ("a", "s"): 1, ("b", "k"): 1, ("c", "k"): 0}
    for p in parts:
        plan = p._jdf.queryExecution().optimizedPlan().toString()
        above = plan[:plan.index("Union")] if "Union" in plan else plan
        assert plan.count("Generate") == above.count("Generate") == 1  # over the counts, never over table rows
        assert "cast(value" not in plan


def test_gate_stops_the_build(spark, scratch):
    from basketry.plans.pipeline import Models, materialize
    from basketry.sources import tables
    from basketry.sources.fixtures import raw_from_parquet
    raw = raw_from_parquet(spark, "/root/testdata/sf0.001")
    good = {t: raw[t] for t in raw.keys()}
    names = ["stg_orders", "stg_order_products", "stg_products", "stg_aisles", "stg_departments", "dim_departments"]
    broken = dict(good, departments=good["departments"].union(good["departments"].limit(1)))
    with pytest.raises(Q.FailedChecks, match=r"departments.department_id unique: 1"):
        materialize(Models(spark, broken), scratch, names, load=False, gate=True)
    assert not tables.exists(spark, scratch, "dim_departments")
    materialize(Models(spark, good), scratch, names, load=False, gate=True)
    assert tables.exists(spark, scratch, "dim_departments")


def test_load_scans_each_file_once(spark, scratch, monkeypatch):
    """Row counts are observed during the write: no count of what was loaded."""
    from pyspark.sql import DataFrame
    from basketry.schemas import RAW_FILES
    from basketry.sources.csv_loader import load_raw_csv, write_raw_csv
    from basketry.sources.fixtures import raw_from_parquet
    raw = raw_from_parquet(spark, "/root/testdata/sf0.001")
    files = {t: RAW_FILES[t] for t in ("aisles", "departments")}
    write_raw_csv({t: raw[t] for t in files}, f"{scratch}/in", files)
    want = {t: raw[t].count() for t in files}
    monkeypatch.setattr(type(spark.range(1)), "count", lambda self: pytest.fail("a second scan"))
    loaded, summary = load_raw_csv(spark, f"{scratch}/in", f"{scratch}/wh", "2024-01-01 06:00:00", files)
    monkeypatch.undo()
    assert {r.table_name: r.rows for r in summary.collect() if r.table_name != "TOTAL"} == want
    assert {t: df.count() for t, df in loaded.items()} == want
    assert loaded["aisles"].select(F.min("_source_file").like("part-%.csv")).first()[0]
