"""Conversation repair: matrices and ropes against all edit strings, the whole against plain code and SQL."""
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from basketry.llm import oracle, queries, repair as R

LETTERS = [R.symbol(i, f) for i in R.INITIALS for f in R.FAULTS]


def _every_repair(run):
    """All edit strings with up to three inserts in a row, as (cost, audit, state)."""
    ways = {(0, "", R.START)}
    for name in run:
        initial, fault = R.INITIALS[(ord(name) - 65) // 4], R.FAULTS[(ord(name) - 65) % 4]
        more, made = 5 * (fault == "truncated"), set()
        for cost, audit, state in ways:
            for _ in range(4):
                made.add((cost + 2, audit + "D", state))
                if fault not in ("blank", "duplicate"):
                    made.add((cost + 1 + more, audit + "R", R.NEXT[state]))
                    if (state, initial) in R.KEPT:
                        made.add((cost + more, audit + "K", R.KEPT[state, initial]))
                cost, audit, state = cost + 5, audit + "I", R.NEXT[state]
        ways = made
    return {(c + 5 * n, a + "I" * n, s) for c, a, t in ways for n, s in enumerate([t, R.NEXT[t], R.NEXT[R.NEXT[t]]])}


def _found(grammar, run):
    packed = grammar.compress(run)
    cost, state = R.ending(grammar.fold(packed)[0])
    return cost, grammar.spell(packed, R.START, state) + R.last_inserts(state)


def test_repairs_are_the_cheapest_and_least():
    rng = random.Random(4)
    for _ in range(300):
        run = "".join(rng.choice(LETTERS) for _ in range(rng.randint(1, 4)))
        want = min((c, a) for c, a, s in _every_repair(run) if s in (R.START, R.AFTER_A))
        assert _found(R.Grammar(), run) == want


def _plain(run):
    """Cheapest repair, one step after the other, with audits as strings."""
    now = {R.START: (0, "")}
    for name in run:
        after = {}
        for i, (cost, audit) in now.items():
            for j, edit in enumerate(R._edits(name)[i]):
                if edit:
                    after[j] = min(after.get(j, (1 << 60, "")), (cost + edit[0], audit + edit[1]))
        now = after
    return min((c + 5 * len(R.last_inserts(j)), a + R.last_inserts(j)) for j, (c, a) in now.items())


@pytest.mark.parametrize("size", [1, 7, 600])
def test_any_grammar_gives_the_same(size):
    rng = random.Random(size)
    for letters in (LETTERS, [R.symbol("u", ""), R.symbol("a", ""), R.symbol("a", "truncated")]):
        rules = []
        for n in range(60):
            names = letters + [chr(R.FIRST_RULE + i) for i in range(n)]
            rules.append((rng.choice(names), rng.choice(names)))
        for _ in range(5):
            run = "".join(rng.choice(letters) for _ in range(size))
            assert _found(R.Grammar(rules), run) == _found(R.Grammar(), run) == _plain(run)


def test_rules_are_shared(spark):
    runs = spark.createDataFrame([("PLPLPL",), ("PLPL",), ("PLPL",), ("PPPP",), ("A",)], "__run string")
    grammar = R.learn(runs)
    assert "".join(grammar.rules[0]) == "PL" and len(grammar.compress("PLPLPL")) < 3


def _whole(rows):
    """Plain repair of one conversation's ordered rows (turn, role, text)."""
    white, seen, run = " \t\n\x0b\x0c\r", set(), ""
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    for _, role, text in rows:
        cut = text.rstrip(white)
        fault = "blank" if not cut else "duplicate" if (role, text) in seen else "truncated" if cut[-1] not in ".!?" else ""
        seen.add((role, text))
        run += R.symbol(role[:1] if role[:1] in ("s", "u", "a") else "-", fault)
    cost, audit = _plain(run)
    out, left, state = [], iter(rows), R.START
    for edit in audit:
        _, role, text = (None, "", "") if edit == "I" else next(left)
        if edit == "K":
            out.append((role, text))
            state = R.KEPT[state, role[:1]]
        elif edit != "D":
            out.append((R.ROLE[state], text))
            state = R.NEXT[state]
    initials = "".join(r[:1] for r, _ in out)
    assert initials.lstrip("s") in ("ua" * (len(initials) // 2), "") and initials.count("s") <= 1
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    kinds = [R.FAULTS[(ord(x) - 65) % 4] for x in run]
    return (gaps, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"), illegal, cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(2)
    text = lambda: rng.choice(["Yes. ", "No", "", " \t\n", "same.", "é?", None, "A\nb!", f"t{rng.random()}."])
    role = lambda: rng.choice(["user", "user", "assistant", "assistant", "system", "tool", "User", "", None])
    rows = [(c, t * rng.choice([1, 1, 2]), role(), text()) for c in range(60) for t in range(rng.randint(1, 9))]
    rows += [(None, 3, "user", "who."), (None, None, "assistant", "me."), (61, None, "user", None), (62, 1, "user", "x" * 300_000 + "."),
             (62, 2, "assistant", "y. " * 200_000)]
    return rows + [(63, t, "user" if t % 3 else "assistant", f"turn {t // 2}.") for t in range(40)]


def test_odd_rows_match_plain(spark, odd_rows, monkeypatch):
    df = spark.createDataFrame([(*r, "x", 1) for r in odd_rows], "conv_id long, turn long, role string, text string, audit string, __p int").repartition(5)
    others = df.select("conv_id").union(spark.createDataFrame([(900,)], "conv_id long"))
    by = {}
    for c, t, r, x in odd_rows:
        by.setdefault(c, []).append((t, " " if r is None else r, " " if x is None else x))

    def order(c):
        def digest(row):
            k = "" if c is None else f"{len(str(c))}:{c}"
            return hashlib.md5("\n".join([k, str(len(row[1])), row[1], row[2]]).encode()).hexdigest()
        return lambda row: (row[0] is not None, row[0] or 0, digest(row))
    want = {c: _whole(sorted(rows, key=order(c))) for c, rows in by.items()}
    want[900] = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    for segment in (R.SEGMENT, 3):  # conversations of several segments, groups and levels
        monkeypatch.setattr(R, "SEGMENT", segment)
        got = R.repair(df, others)
        assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
        assert {r[0]: tuple(r)[1:] for r in got.collect()} == want


def test_one_hot_conversation(spark):
    n = 5000
    rows = [(1, t, ("user", "assistant", "tool")[t * t % 3], f"{t % 700}" + ".?x"[t % 3]) for t in range(n)]
    got = R.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8)).collect()
    assert [tuple(r)[1:] for r in got] == [_whole([(t, r, x) for _, t, r, x in rows])]


def test_query_matches_sql(spark, duck, as_table, tmp_path):
    rng = random.Random(8)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None]), rng.choice(["Yes.", "no", None, " ", "A? B"])) for c in range(80) for t in range(c % 7 + 1)]
    df = spark.createDataFrame(rows + [(None, 0, "user", "x."), (5, None, "user", "y.")], "conv_id long, turn long, role string, text string")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    as_table("conversations", df)
    got = queries.op11_repair(spark, str(tmp_path))
    want = duck.sql(oracle.OP11)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(repr, (tuple(r) for r in got.select(*want.columns).collect()))) == sorted(map(repr, want.fetchall()))


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert R.repair(df).where(F.lit(True)).count() == 0
