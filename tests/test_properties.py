"""Property tests: random inputs against brute-force expectations."""
from hypothesis import given, settings, strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from basketry.operators.incremental import scd2_merge, upsert
from basketry.operators.ranking import global_rank, group_rank

keys = st.lists(st.integers(0, 30), unique=True, max_size=15)


@settings(max_examples=6, deadline=None)
@given(keys, keys, st.integers(0, 9))
def test_upsert_matches_dict_update(spark, old, new, salt):
    target = spark.createDataFrame([(k, f"old{k}") for k in old], "k long, v string")
    updates = spark.createDataFrame([(k, f"new{k + salt}") for k in new], "k long, v string")
    expected = {k: f"old{k}" for k in old}
    expected.update({k: f"new{k + salt}" for k in new})
    got = {r.k: r.v for r in upsert(target, updates, ["k"]).collect()}
    assert got == expected


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.sampled_from([None, 1, 2, 3])), max_size=25),
       st.booleans())
def test_rank_matches_native(spark, rows, asc):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(rows)] or [(0, 0, 1)],
                               "id long, g long, v int")
    ours = global_rank(df, "v", asc, None, ["id"], "r")
    order = F.col("v").asc_nulls_last() if asc else F.col("v").desc_nulls_first()
    native = df.withColumn("r", F.rank().over(Window.orderBy(order)))
    assert sorted(ours.select("id", "r").collect()) == sorted(native.select("id", "r").collect())
    ours = group_rank(df, ["g"], "v", asc, None, ["id"], "r")
    native = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(order)))
    assert sorted(ours.select("id", "r").collect()) == sorted(native.select("id", "r").collect())


TRACKED = ["name", "dept"]


@settings(max_examples=5, deadline=None)
@given(st.dictionaries(st.integers(0, 10), st.sampled_from(["a", "b"]), max_size=8),
       st.dictionaries(st.integers(0, 10), st.sampled_from(["a", "b", "c"]), max_size=8))
def test_scd2_invariants(spark, first, second):
    schema = "product_id long, name string, dept string"
    dim0 = spark.createDataFrame([(k, "n", d) for k, d in first.items()] or [(99, "n", "a")], schema)
    dim = dim0.select(F.md5(F.col("product_id").cast("string")).alias("product_key"), "*",
                      F.to_date(F.lit("2019-01-01")).alias("valid_from"),
                      F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current"),
                      F.to_timestamp(F.lit("2024-01-01 00:00:00")).alias("created_at"))
    snap = spark.createDataFrame([(k, "n", d) for k, d in second.items()] or [(98, "n", "a")], schema)
    merged = scd2_merge(dim, snap, "product_id", TRACKED, "2019-07-01", "2024-07-01 00:00:00").collect()
    current = {}
    for r in merged:
        if r.is_current:
            assert r.product_id not in current          # one current version per product
            current[r.product_id] = r.dept
        else:
            assert str(r.valid_to) == "2019-07-01"      # closed at the effective date
    before = {r.product_id: r.dept for r in dim0.collect()}
    after = {r.product_id: r.dept for r in snap.collect()}
    assert current == {**before, **after}               # snapshot wins, missing keys stay current
    changed = {k for k in after if k in before and after[k] != before[k]}
    assert sum(1 for r in merged if not r.is_current) == len(changed)
    assert len({r.product_key for r in merged}) == len(merged)
