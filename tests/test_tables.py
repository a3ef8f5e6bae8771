from basketry.sources import tables


def test_versions_and_read_while_writing(spark, scratch):
    p1 = tables.commit(spark.range(5), scratch, "t")
    assert p1.endswith("seg=000001")
    current = tables.read(spark, scratch, "t")
    # the next version is computed from the current one and written beside it
    tables.commit(current.union(spark.range(5, 8)), scratch, "t")
    assert tables.read(spark, scratch, "t").count() == 8
    assert tables.read(spark, scratch, "t", version=1).count() == 5
    assert tables.current_version(spark, scratch, "missing") is None


def test_append_and_upsert_commit(spark, scratch):
    tables.commit(spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"), scratch, "u")
    tables.upsert_commit(spark.createDataFrame([(3, "c")], "k long, v string"), scratch, "u", ["k"])
    assert tables.segments(spark, scratch, "u") == [1, 2]          # appended, nothing rewritten
    tables.upsert_commit(spark.createDataFrame([], "k long, v string"), scratch, "u", ["k"])
    assert tables.current_version(spark, scratch, "u") == 2         # empty batch: no new version
    tables.upsert_commit(spark.createDataFrame([(2, "B"), (4, "d")], "k long, v string"), scratch, "u", ["k"])
    assert tables.segments(spark, scratch, "u") == [4, 2, 3]       # key 2 was in segment 1: only that is rewritten
    got = sorted(tuple(r) for r in tables.read(spark, scratch, "u").collect())
    assert got == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    assert sorted(tuple(r) for r in tables.read(spark, scratch, "u", version=2).collect()) == \
        [(1, "a"), (2, "b"), (3, "c")]


def test_appends_never_rewrite_and_compaction_is_on_request(spark, scratch):
    for i in range(5):
        tables.append(spark.range(i * 10, i * 10 + 10), scratch, "c")
    assert tables.segments(spark, scratch, "c") == [1, 2, 3, 4, 5]
    tables.compact(spark, scratch, "c")
    assert tables.segments(spark, scratch, "c") == [6]
    assert tables.read(spark, scratch, "c").count() == 50


def test_marker_of_a_crashed_commit_is_ignored(spark, scratch):
    tables.commit(spark.range(5), scratch, "m")
    for n, text in ((2, ""), (3, "1\n2")):
        with open(f"{scratch}/m/_versions/{n:06d}", "w") as f:
            f.write(text)
    assert tables.current_version(spark, scratch, "m") == 1 and tables.versions(spark, scratch, "m") == [1]
    assert tables.read(spark, scratch, "m").count() == 5
    tables.append(spark.range(5, 7), scratch, "m")
    assert tables.segments(spark, scratch, "m") == [1, 4] and tables.read(spark, scratch, "m").count() == 7


def test_one_row_per_key_and_missing_columns(spark, scratch):
    rows = spark.createDataFrame([(1, "a", None), (1, "b", 2), (2, "c", 1)], "k long, v string, w int")
    assert sorted(map(tuple, tables.one_per_key(rows, ["k"]).collect())) == [(1, "b", 2), (2, "c", 1)]
    tables.commit(rows.where("k = 2"), scratch, "w")
    tables.upsert_commit(spark.createDataFrame([(3, "d")], "k long, v string"), scratch, "w", ["k"])
    assert sorted(map(tuple, tables.read(spark, scratch, "w").collect())) == [(2, "c", 1), (3, "d", None)]


def test_bucketed_commit_reads_without_shuffle(spark, scratch):
    from pyspark.sql import functions as F
    df = spark.range(0, 2000).select((F.col("id") % 97).alias("order_id"), F.col("id").alias("v"))
    tables.commit_bucketed(df, scratch, "b", 8, "order_id")
    t = tables.read(spark, scratch, "b")
    agg = t.groupBy("order_id").agg(F.sum("v").alias("s"))
    assert "Exchange" not in agg._jdf.queryExecution().executedPlan().toString()
    assert agg.count() == 97 and t.count() == 2000
    # without the catalog entry the files still read as a plain table
    plain = spark.read.parquet(*tables.paths(spark, scratch, "b"))
    assert plain.count() == 2000


def _files(root, name):
    from pathlib import Path
    return {str(p): p.stat().st_mtime_ns for p in Path(root, name, "data").rglob("part-*")}


def test_collisions_rewrite_only_their_segments(spark, scratch):
    """Files of segments without colliding keys keep their names and times."""
    row = lambda *ids: spark.createDataFrame([(i, f"v{i}") for i in ids], "k long, v string")
    for ids in ((1, 2, 3), (11, 12), (21, 22), (31,)):
        tables.upsert_commit(row(*ids), scratch, "c", ["k"], prune="k")
    before = _files(scratch, "c")
    late = spark.createDataFrame([(12, "new"), (31, "new"), (40, "v40")], "k long, v string")
    tables.upsert_commit(late, scratch, "c", ["k"], prune="k")
    assert tables.segments(spark, scratch, "c") == [1, 6, 3, 5]  # 4 held nothing else and is gone
    after = _files(scratch, "c")
    assert before.items() <= after.items()  # older versions stay readable
    got = dict(tuple(r) for r in tables.read(spark, scratch, "c").collect())
    assert got == {**{i: f"v{i}" for i in (1, 2, 3, 11, 21, 22, 40)}, 12: "new", 31: "new"}
    assert tables.read(spark, scratch, "c", version=4).where("v = 'new'").count() == 0
    # the next version's number is above those of rewritten segments
    tables.append(row(50), scratch, "c", prune="k")
    assert tables.segments(spark, scratch, "c") == [1, 6, 3, 5, 7]
    assert tables.expire(spark, scratch, "c") > 0
    assert tables.versions(spark, scratch, "c") == [7] and tables.read(spark, scratch, "c").count() == 10
    live = {f"seg={s:06d}" for s in tables.segments(spark, scratch, "c")}
    assert {p.split("/")[-2] for p in _files(scratch, "c")} == live


def test_a_crashed_rewrite_leaves_nothing(spark, scratch):
    import os
    for ids in ((1,), (2, 3)):
        tables.upsert_commit(spark.createDataFrame([(i, "a") for i in ids], "k long, v string"), scratch, "x", ["k"], prune="k")
    for seg in (3, 4):  # rewritten folders of a commit that never made its marker
        spark.createDataFrame([(99, "stale")], "k long, v string").write.parquet(f"{scratch}/x/data/seg={seg:06d}")
    tables.upsert_commit(spark.createDataFrame([(1, "b")], "k long, v string"), scratch, "x", ["k"], prune="k")
    assert sorted(map(tuple, tables.read(spark, scratch, "x").collect())) == [(1, "b"), (2, "a"), (3, "a")]
    assert not os.path.exists(f"{scratch}/x/data/seg=000004")


def test_segments_that_may_hold_keys(spark, scratch):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "k long")
    for n in range(4):
        tables.append(spark.range(n * 1000, n * 1000 + 1000, 2).toDF("k"), scratch, "b", prune="k")
    assert tables.holding(ids(1500, 3998), scratch, "b", "k") == [2, 4]
    assert tables.holding(ids(5000, -1), scratch, "b", "k") == [] == tables.holding(ids().limit(0), scratch, "b", "k")
    absent = [i for i in range(1, 4000, 2)]
    passed = sum(bool(tables.holding(ids(i), scratch, "b", "k")) for i in absent[::100])
    assert passed <= 3  # in bounds, kept out by the filter
    every = spark.range(0, 4000, 2).toDF("k")
    assert tables.holding(every, scratch, "b", "k") == [1, 2, 3, 4]
    # text keys, nulls, and segments without bounds
    tables.append(spark.createDataFrame([("a",), (None,), ("m",)], "s string"), scratch, "s", prune="s")
    tables.append(spark.createDataFrame([(None,)], "s string"), scratch, "s", prune="s")
    tables.append(spark.createDataFrame([("z",)], "s string"), scratch, "s")
    assert tables.holding(spark.createDataFrame([("m",), (None,)], "s string"), scratch, "s", "s") == [1, 3]


def test_new_columns_without_a_rewrite(spark, scratch):
    tables.commit(spark.createDataFrame([(1, "a")], "k long, v string"), scratch, "n", prune="k")
    before = _files(scratch, "n")
    tables.upsert_commit(spark.createDataFrame([(2.5, 2, "b")], "w double, k long, v string"), scratch, "n", ["k"], True, prune="k")
    assert before.items() <= _files(scratch, "n").items() and tables.segments(spark, scratch, "n") == [1, 2]
    df = tables.read(spark, scratch, "n")
    assert df.dtypes == [("k", "bigint"), ("v", "string"), ("w", "double")]
    assert sorted(map(tuple, df.collect())) == [(1, "a", None), (2, "b", 2.5)]
    assert tables.read(spark, scratch, "n", version=1).columns == ["k", "v"]
    # a later rewrite of the old segment, and a batch without the column
    tables.upsert_commit(spark.createDataFrame([(1, "A"), (3, "c")], "k long, v string"), scratch, "n", ["k"], True, prune="k")
    assert sorted(map(tuple, tables.read(spark, scratch, "n").collect())) == [(1, "A", None), (2, "b", 2.5), (3, "c", None)]


def test_published_view_with_new_column(spark, scratch):
    from basketry.sources.catalog import publish
    tables.commit(spark.createDataFrame([(1,)], "k long"), scratch, "pv")
    tables.append(spark.createDataFrame([(2, "x")], "k long, v string"), scratch, "pv")
    publish(spark, scratch, ["pv"], "bk_pv")
    assert sorted(map(tuple, spark.sql("SELECT * FROM bk_pv.pv").collect())) == [(1, None), (2, "x")]
    spark.sql("DROP DATABASE bk_pv CASCADE")
