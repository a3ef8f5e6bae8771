import os
import random
import tempfile

import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd():
    """Rows with nulls, empty, long and repeated texts, ties and a clashing extra column."""
    from random import Random
    rng = Random(5)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    long = prose(9000)
    base = prose(60)
    rows = [(1, base, "a"), (2, base, "a"), (3, base.replace(base.split()[30], "other", 1), "b"), (4, None, "b"), (5, "", None),
            (6, long, "c"), (None, prose(40), "c"), (7, prose(40) + "\n" + "boiler plate line number 7 here", "a"),
            (8, "boiler plate line number 8 here\n" + prose(30), "a"), (8, "boiler plate line number 8 here\n" + prose(30), "a"),
            (9, "!!! ???", "b"), (10, "one", "b"), (11, "é ß ñ", None)]
    rows += [(20 + i, f"boiler plate line number {i} here\n" + prose(25), "a") for i in range(8)]
    rows.append(rows[9])
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd):
    return spark.createDataFrame([(*r, "x", 1) for r in odd], "doc_id long, text string, source string, lang string, m int").repartition(3)


@pytest.fixture()
def duck():
    return duckdb.connect()


@pytest.fixture()
def as_table(duck):
    def put(name, df):
        path = os.path.join(tempfile.mkdtemp(prefix="bk-llm-"), "t")
        df.write.parquet(path)
        duck.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM read_parquet('{path}/*.parquet')")
    return put


@pytest.fixture(scope="session")
def shuffled():
    return random.Random(7)
