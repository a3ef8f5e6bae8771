"""Pipeline stages against the operators' SQL and plain recomputation."""
from pyspark.sql import functions as F

import corpus_pipeline as P
from basketry.llm import oracle
from basketry.session import cut_lineage

SF = "/root/testdata/sf0.001"


def test_stages(spark, duck, as_table):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("m", F.lit(1))
    duck.execute(f"CREATE VIEW benchmark AS SELECT * FROM read_parquet('{SF}/benchmark.parquet')")
    seen = {}
    for name, stage in P.STAGES:
        as_table("documents", docs)
        got = cut_lineage(stage(spark, docs, SF), f"test-{name}")
        seen[name] = (docs.count(), got.count())
        if name != "mixing":
            assert got.columns == docs.columns
        if name == "lines":
            want = {r[0]: r[3] for r in duck.sql(oracle.OP1).fetchall()}
            assert {r[0]: r[1] for r in got.select("doc_id", F.sha2("text", 256)).collect()} == want
        if name == "decontamination":
            want = sorted(r[0] for r in duck.sql(oracle.OP4).fetchall() if not r[5])
            assert sorted(r[0] for r in got.select("doc_id").collect()) == want
        if name == "mixing":
            want = sorted((r[0], r[4]) for r in duck.sql(oracle.OP3).fetchall() if r[4] > 0)
            assert sorted(tuple(r) for r in got.select("doc_id", "taken").collect()) == want
        docs = got
    assert seen["lines"][0] == seen["lines"][1]
    assert all(0 < b <= a for a, b in seen.values())


def test_long_lines_of_two_documents(spark):
    words = lambda tag, n: " ".join(f"{tag}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(n))
    passage, short = words("p", 60), words("s", 12)
    texts = {1: [words("a", 70), passage, short], 2: [words("b", 70), passage], 3: [words("c", 70), short], None: [passage, words("d", 70)], 5: [words("e", 60)]}
    df = spark.createDataFrame([(i, "\n".join(x), len("\n".join(x))) for i, x in texts.items()], "doc_id long, text string, n_chars int")
    docs = cut_lineage(P.lines(spark, df, SF), "test-lines")
    got = {r[0]: (r[1], r[2]) for r in P.near_duplicates(spark, docs, SF).collect()}
    want = {i: "\n".join(x) for i, x in texts.items()} | {2: words("b", 70), None: words("d", 70)}
    assert got == {i: (t, len(t)) for i, t in want.items()}


def test_extra_columns_with_the_operators_names(spark):
    names = ["keep", "expected_grade", "n_lines", "n_dropped", "n_hit", "items", "contaminated", "class_id", "__t", "m"]
    words = lambda tag, n: " ".join(f"{tag}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(n))
    rows = [(i, words(f"t{i}", 40), "en", "s", 5, *[f"{c} of {i}" for c in names]) for i in range(6)]
    columns = ["doc_id", "text", "lang", "source", "n_chars", *names]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(f"{c} string" for c in names))
    for name, stage in P.STAGES[:-1]:
        got = stage(spark, docs, SF)
        assert got.dtypes == docs.dtypes, name
        for r in got.collect():
            assert [r[c] for c in names] == [f"{c} of {r['doc_id']}" for c in names], name
    assert P.mixing(spark, docs, SF).columns == ["doc_id", "source", "size", "source_size", "target", "taken"]
    assert columns == docs.columns
