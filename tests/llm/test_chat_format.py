"""Chat formatting: exact round trip, loss mask and SQL."""
import re

import pytest
from pyspark.sql import functions as F

from basketry.llm import oracle, queries
from basketry.llm.chat_format import escape, format_chats, read_target, read_turns, unescape

SCHEMA = "conv_id long, turn long, role string, text string, example int, formatted string, __c int, __r int"
CONTROL = re.compile(r"</?s>|\[/?INST\]")


@pytest.fixture(scope="module")
def chats(spark):
    long = "word </s> \\ " * 30_000
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST]\\[/INST]<s>"), (1, 2, "user", "\\\\<\\/s>"), (1, 3, "assistant", ""),
            (1, 4, "user", None), (2, 0, "system", "s"), (2, 1, "user", "no answer"), (3, None, "assistant", "first"), (3, 0, None, "x"),
            (3, 0, "assistant", "tie b"), (3, 0, "assistant", "tie a"), (3, 0, "assistant", "tie a"), (None, 1, "assistant", "n"),
            (None, 0, "[/INST]</s>", "<"), (4, 0, "user", long), (4, 1, "assistant", long), (5, 0, "assistant", "é 𝄞 <\n"), (-7, 0, "user", "own")]
    return spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA).repartition(4)


def _want(chats):
    by = {}
    for r in chats.collect():
        by.setdefault(r.conv_id, []).append((r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
    return {c: [(x[2], x[3]) for x in sorted(v)] for c, v in by.items()}


def test_escape_round_trip(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st
    texts = []
    part = st.sampled_from(["\\", "<", "[", "/", "s>", "INST]", "</s>", "[INST]", "[/INST]", "<s>", "a", "\n", "é"])

    @settings(max_examples=300, database=None)
    @given(st.lists(part, max_size=12).map("".join))
    def draw(t):
        texts.append(t)
    draw()
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escape(F.col("t")).alias("e"))
    for t, e, back in df.select("t", "e", unescape(F.col("e"))).collect():
        assert back == t and not CONTROL.search(e)


def test_examples(chats):
    want = _want(chats)
    rows = format_chats(chats)
    assert rows.columns == ["conv_id", "example", "n_turns", "trainable", "formatted", "loss_start", "loss_end"]
    got = {}
    for r in rows.select("*", read_turns(F.col("formatted")).alias("turns"),
                         read_target(F.col("formatted"), F.col("loss_start"), F.col("loss_end")).alias("target")).collect():
        got.setdefault(r.conv_id, []).append(r)
    assert set(got) == set(want)
    for conv, turns in want.items():
        made = sorted(got[conv], key=lambda r: r.example)
        assert [r.example for r in made] == list(range(1, len(made) + 1))
        assert [r.n_turns for r in made if r.trainable] == [i + 1 for i, t in enumerate(turns) if t[0] == "assistant"]
        assert made[-1].n_turns == len(turns)
        for r in made:
            assert [tuple(t) for t in r.turns] == turns[:r.n_turns]
            assert r.target == (turns[r.n_turns - 1][1] if r.trainable else "")
            assert made[-1].formatted.startswith(r.formatted)


def test_query_matches_sql(spark, chats, duck, as_table, tmp_path):
    chats.write.parquet(f"{tmp_path}/conversations.parquet")
    as_table("conversations", chats)
    got = queries.op13_chat_format(spark, str(tmp_path))
    want = duck.sql(oracle.OP13)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(repr, (tuple(r) for r in got.select(*want.columns).collect()))) == sorted(map(repr, want.fetchall()))


def test_empty_table(spark, chats):
    assert format_chats(chats.limit(0)).count() == 0


def test_no_python_in_plan(chats):
    plan = format_chats(chats)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
