"""Conversation structure repair by grammar-compressed dynamic programming.

A conversation's rows, in order of turn, are a sequence of symbols: the role's
initial (s, u, a or another) with the row's fault. Edits keep a row, give it
another role, delete it or insert an empty turn, so that the initials become
``(s?(ua)+)?``. That language has four states (start, after s, after u, after
a); what an edit does to a state is fixed, so an edit string (the *audit*) says
everything about a repair.

* *Transfer matrix.* For a run of symbols: the cheapest cost from state i to
  state j, the inserts standing before a row. Of equal costs the ASCII-least
  audit counts. Matrices multiply by (min, +).
* *Audit rope.* No matrix holds audits. An entry of a product remembers the
  state in the middle, so its audit is the left factor's followed by the right
  factor's. For ties it is enough to know, per state i, the order of the audits
  to the states j: audits of one run from one state end in a row's edit and hold
  equally many of them, so none is a prefix of another, and two that lead to
  different states differ. A product's order follows from its factors'.
* *Grammar.* Conversations are cut into segments of at most ``SEGMENT`` rows;
  the distinct segments, with their numbers, are compressed by Re-Pair: the most
  frequent adjacent pairs, counted by Spark over all segments, become rules, a
  batch at a time, until no pair occurs twice or ``RULES`` are made. Each rule
  has one matrix, worked out bottom-up once and shared by all conversations.
  The bound on rules decides about speed alone: what stays uncompressed of a
  segment is multiplied symbol by symbol, with the same result.
* *Long conversations.* The segments of a conversation are multiplied in groups
  of ``SEGMENT``, and the groups again, until one is left (a conversation of one
  segment, the usual case, needs none of this); then the states found are handed
  down the same way. No task holds more than ``SEGMENT`` rows or matrices of a
  conversation at once.

Faults (the first that holds): blank (only ASCII white space), duplicate (role
and text seen earlier in the conversation), truncated (its last character that
is no white space is not one of ``.!?``). Costs: keep 0, another role 1, delete
2, insert 5; a truncated row that stays costs 5 more; blank and duplicate rows
must go.

A last pass streams each conversation's rows once, in order, next to the audits
of its segments, and digests the repaired texts: a sha256 over one conversation
cannot be split, so a hot conversation's rows pass through one task, a row at a
time, without being gathered. Its audit is one string by contract.

Defined cases: a null role or text is one space; null turns come first; rows of
one turn are ordered by a digest of role and text; rows with a null conversation id are
one conversation; an empty table gives no rows; other columns of the input,
whatever their names, take no part and are not returned.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranking import global_row_number, sort_key
from ..session import cut_lineage

SEGMENT, RULES, BATCH = 512, 4096, 128
KEEP, REROLE, DELETE, INSERT, STAY_TRUNCATED = 0, 1, 2, 5, 5

#: States: the start, after s, after u, after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STATES = range(4)
#: The state after an inserted turn or a row that gets another role, and that turn's role.
NEXT = {START: AFTER_U, AFTER_S: AFTER_U, AFTER_U: AFTER_A, AFTER_A: AFTER_U}
ROLE = {START: "user", AFTER_S: "user", AFTER_U: "assistant", AFTER_A: "user"}
#: The state after a kept row, by its initial.
KEPT = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
#: A symbol is a letter: initial by fault.
INITIALS, FAULTS = "sua-", ("blank", "duplicate", "truncated", "")
WHITE = " \t\n\x0b\x0c\r"
FIRST_RULE = 0x1000  # rules are named by the characters from here on

# A matrix: per entry (cost, state in the middle, place among the audits from i), or None.
Matrix = list[list[tuple[int, int, int] | None]]


def symbol(initial: str, fault: str) -> str:
    return chr(ord("A") + INITIALS.index(initial) * len(FAULTS) + FAULTS.index(fault))


@lru_cache(maxsize=None)
def _edits(name: str) -> tuple[tuple[tuple[int, str] | None, ...], ...]:
    """A symbol's (cost, audit) from state i to state j: inserts, then one edit."""
    initial, fault = INITIALS[(ord(name) - 65) // len(FAULTS)], FAULTS[(ord(name) - 65) % len(FAULTS)]
    out = []
    for i in STATES:
        best: dict[int, tuple[int, str]] = {}
        state, cost, audit = i, 0, ""
        for _ in STATES:  # more inserts than states come back to one seen before
            ways = [(state, DELETE, "D")]
            if fault not in ("blank", "duplicate"):
                more = STAY_TRUNCATED if fault == "truncated" else 0
                ways.append((NEXT[state], REROLE + more, "R"))
                if (state, initial) in KEPT:
                    ways.append((KEPT[state, initial], KEEP + more, "K"))
            for j, price, letter in ways:
                best[j] = min(best.get(j, (1 << 60, "")), (cost + price, audit + letter))
            state, cost, audit = NEXT[state], cost + INSERT, audit + "I"
        out.append(tuple(best.get(j) for j in STATES))
    return tuple(out)


def terminal(name: str) -> Matrix:
    rows = []
    for row in _edits(name):
        order = sorted((x[1], j) for j, x in enumerate(row) if x)
        place = {j: n for n, (_, j) in enumerate(order)}
        rows.append([(x[0], j, place[j]) if x else None for j, x in enumerate(row)])
    return rows


def product(a: Matrix, b: Matrix) -> Matrix:
    """The matrix of a's run followed by b's."""
    out: Matrix = []
    for i in STATES:
        found = []
        for j in STATES:
            ways = [(x[0] + b[k][j][0], x[2], k) for k, x in enumerate(a[i]) if x and b[k][j]]
            if ways:
                cost, left, k = min(ways)
                found.append((left, b[k][j][2], j, cost, k))
        row: list = [None] * len(STATES)
        for place, (_, _, j, cost, k) in enumerate(sorted(found)):
            row[j] = (cost, k, place)
        out.append(row)
    return out


def last_inserts(state: int) -> str:
    """The cheapest inserts that end a conversation in this state."""
    return {START: "", AFTER_S: "II", AFTER_U: "I", AFTER_A: ""}[state]


def ending(m: Matrix) -> tuple[int, int]:
    """(cost, state) of the cheapest repair of a whole conversation."""
    cost, _, state = min((x[0] + INSERT * len(last_inserts(j)), x[2], j) for j, x in enumerate(m[START]) if x)
    return cost, state


class Grammar:
    """Re-Pair rules, in the order they were made, with their matrices."""

    def __init__(self, rules: list[tuple[str, str]] = ()):
        self.rules: list[tuple[str, str]] = []
        self.matrix: dict[str, Matrix] = {symbol(i, f): terminal(symbol(i, f)) for i in INITIALS for f in FAULTS}
        self._audits: dict[tuple[str, int, int], str] = {}
        for pair in rules:
            self.add(*pair)

    def add(self, left: str, right: str) -> None:
        name = chr(FIRST_RULE + len(self.rules))
        self.matrix[name] = product(self.matrix[left], self.matrix[right])
        self.rules.append((left, right))

    def compress(self, run: str, start: int = 0) -> str:
        """``run`` with the rules from ``start`` on put in, oldest first."""
        for n in range(start, len(self.rules)):
            pair = "".join(self.rules[n])
            if pair in run:
                run = run.replace(pair, chr(FIRST_RULE + n))
                if len(run) == 1:
                    break
        return run

    def audit(self, name: str, i: int, j: int) -> str:
        """The rope of a symbol's entry, spelt out."""
        key = name, i, j
        if key not in self._audits:
            if ord(name) < FIRST_RULE:
                self._audits[key] = _edits(name)[i][j][1]
            else:
                left, right = self.rules[ord(name) - FIRST_RULE]
                k = self.matrix[name][i][j][1]
                self._audits[key] = self.audit(left, i, k) + self.audit(right, k, j)
        return self._audits[key]

    def fold(self, run: str) -> tuple[Matrix, list[Matrix]]:
        """The matrix of a compressed run, and those of its beginnings."""
        steps = [self.matrix[run[0]]]
        for name in run[1:]:
            steps.append(product(steps[-1], self.matrix[name]))
        return steps[-1], steps

    def spell(self, run: str, i: int, j: int) -> str:
        """The audit of a compressed run from state i to state j."""
        _, steps = self.fold(run)
        parts = []
        for at in range(len(run) - 1, 0, -1):
            k = steps[at][i][j][1]
            parts.append(self.audit(run[at], k, j))
            j = k
        return "".join([self.audit(run[0], i, j), *reversed(parts)])


def learn(runs: DataFrame, column: str = "__run") -> Grammar:
    """Rules from all ``runs`` (repeated runs count as often as they occur).
    Only batches of pairs, and the rules, come to the driver."""
    grammar, done = Grammar(), 0
    left = cut_lineage(runs.groupBy(F.col(column).alias("__r")).agg(F.count(F.lit(1)).alias("__n")), "op11-runs")
    while len(grammar.rules) < RULES:
        pairs = left.mapInArrow(_count_pairs, "__l string, __p string, __n bigint").groupBy("__l", "__p").agg(F.sum("__n").alias("__n"))
        # of equally frequent pairs the least: a rerun makes the same rules
        best = pairs.where(F.col("__n") > 1).orderBy(F.desc("__n"), "__l", "__p").limit(min(BATCH, RULES - done)).collect()
        if not best:
            break
        for p in best:
            grammar.add(p["__l"], p["__p"])
        left = cut_lineage(left.mapInArrow(_replace(list(grammar.rules), done), "__r string, __n bigint"), "op11-runs")
        done = len(grammar.rules)
    return grammar


def _count_pairs(batches):
    counts: Counter = Counter()
    for batch in batches:
        for run, n in zip(batch.column("__r").to_pylist(), batch.column("__n").to_pylist()):
            before = None  # in "aaa" the pair "aa" is there once
            for at in range(len(run) - 1):
                pair = run[at:at + 2]
                if pair == before and pair[0] == pair[1]:
                    before = None
                    continue
                counts[pair] += n
                before = pair
        if len(counts) > 100_000:  # the same pair may be told again: Spark adds up
            yield _pair_rows(counts)
            counts = Counter()
    yield _pair_rows(counts)


def _pair_rows(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([p[0] for p in counts], pa.string()), pa.array([p[1] for p in counts], pa.string()), pa.array(list(counts.values()), pa.int64())],
        ["__l", "__p", "__n"])


def _replace(rules, start):
    def run(batches):
        grammar = Grammar(rules)
        for batch in batches:
            made = [grammar.compress(r, start) for r in batch.column("__r").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.string()), batch.column("__n")], ["__r", "__n"])
    return run


def _flat(m: Matrix) -> list[int]:
    """16 times cost, middle and place; -1 where there is no way."""
    return [v for row in m for x in row for v in (x or (-1, -1, -1))]


def _square(v: list[int]) -> Matrix:
    return [[tuple(v[3 * (4 * i + j):3 * (4 * i + j) + 3]) if v[3 * (4 * i + j)] >= 0 else None for j in STATES] for i in STATES]


def _transfer(rules):
    """Tasks: each segment's matrix, and the end of a conversation of it alone;
    equal segments are worked out once a task."""
    def run(batches):
        grammar = Grammar(rules)

        @lru_cache(maxsize=20_000)
        def of(r: str):
            m = grammar.fold(grammar.compress(r))[0]
            return (_flat(m), *ending(m))
        for batch in batches:
            made = [of(r) for r in batch.column("__run").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("__c", "__at", "__p", "__run")), pa.array([x[0] for x in made], pa.list_(pa.int64())),
                 pa.array([x[1] for x in made], pa.int64()), pa.array([x[2] for x in made], pa.int32())],
                ["__c", "__at", "__p", "__run", "__m", "__cost", "__j"])
    return run


def _spell(rules):
    """Tasks: each segment's audit between the states handed to it."""
    def run(batches):
        grammar = Grammar(rules)

        @lru_cache(maxsize=20_000)
        def of(r: str, i: int, j: int) -> str:
            return grammar.spell(grammar.compress(r), i, j)
        for batch in batches:
            made = [of(*x) for x in zip(*(batch.column(c).to_pylist() for c in ("__run", "__i", "__j")))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("__c", "__p", "__run", "__cost")), pa.array(made, pa.string())],
                                             ["__c", "__p", "__run", "__cost", "__audit"])
    return run


def _steps(members) -> list[Matrix]:
    """The products of the first, the first two ... of at most SEGMENT matrices."""
    steps = [_square(members[0]["__m"])]
    for x in members[1:]:
        steps.append(product(steps[-1], _square(x["__m"])))
    return steps


@F.udf(T.StructType().add("__m", T.ArrayType(T.LongType())).add("__cost", T.LongType()).add("__j", T.IntegerType()))
def _multiplied(members):
    """The members' product, and the end of a conversation of them alone."""
    whole = _steps(members)[-1]
    return (_flat(whole), *ending(whole))


@F.udf(T.ArrayType(T.StructType().add("__i", T.IntegerType()).add("__j", T.IntegerType())))
def _handed_down(members, i, j):
    """Each member's states, from those of the product."""
    steps, out = _steps(members), []
    for at in range(len(members) - 1, 0, -1):
        k = steps[at][i][j][1]
        out.append((k, j))
        j = k
    return [(i, j), *reversed(out)]


def _states(segments: DataFrame) -> DataFrame:
    """``segments`` with the states (``__i``, ``__j``) that each goes between in
    the cheapest repair of its conversation, and the repair's ``__cost``."""
    about = ["__at", "__p", "__run", "__m"]
    level, groups = segments, []
    while (level.agg(F.max("__at")).first()[0] or 0) > 0:
        grouped = cut_lineage(level.groupBy("__c", F.floor(F.col("__at") / SEGMENT).alias("__up")).agg(
            F.sort_array(F.collect_list(F.struct(*about))).alias("__members")), "op11-groups")
        groups.append(grouped)
        level = cut_lineage(grouped.select("__c", F.col("__up").alias("__at"), F.lit(0).cast("long").alias("__p"), F.lit("").alias("__run"),
                                           _multiplied("__members").alias("__x")).select("__c", "__at", "__p", "__run", "__x.*"), "op11-level")
    found = level.withColumn("__i", F.lit(START))
    for grouped in reversed(groups):
        up = found.select(F.col("__c").alias("__c1"), F.col("__at").alias("__up1"), "__i", "__j", "__cost")
        met = grouped.join(up, grouped["__c"].eqNullSafe(F.col("__c1")) & (F.col("__up") == F.col("__up1")))
        pairs = F.arrays_zip(F.col("__members"), _handed_down("__members", "__i", "__j").alias("__s"))
        found = cut_lineage(met.select("__c", "__cost", F.explode(pairs).alias("__x")).select(
            "__c", "__cost", "__x.__members.*", "__x.__s.*"), "op11-states")
    return found.select("__c", "__p", "__run", "__cost", "__i", "__j")


class _Conversation:
    """A conversation as its rows pass: nothing is kept of them but counts and
    the digest's state."""

    def __init__(self, key):
        self.key, self.low, self.high, self.turns = key, None, None, 0
        self.faults, self.illegal, self.before = Counter(), 0, None
        self.cost, self.audits, self.state = 0, [], START
        self.symbols, self.edits = iter(""), iter("")
        self.digest, self.first = hashlib.sha256(), True

    def line(self, role: str, text: str) -> None:
        self.digest.update((("" if self.first else "\n") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.first = False

    def insert(self) -> None:
        self.line(ROLE[self.state], "")
        self.state = NEXT[self.state]

    def segment(self, symbols: str, audit: str, cost: int) -> None:
        self.cost, self.symbols, self.edits = cost, iter(symbols), iter(audit)
        self.audits.append(audit)

    def row(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        self.faults[FAULTS[(ord(next(self.symbols)) - 65) % len(FAULTS)]] += 1
        self.illegal += self.before is not None and self.before + role[:1] not in ("su", "ua", "au")
        self.before = role[:1]
        edit = next(self.edits)
        while edit == "I":
            self.insert()
            edit = next(self.edits)
        if edit == "R":
            self.line(ROLE[self.state], text)
            self.state = NEXT[self.state]
        elif edit == "K":
            self.line(role, text)
            self.state = KEPT[self.state, role[:1]]

    def result(self) -> tuple:
        self.audits.append(last_inserts(self.state))
        for _ in self.audits[-1]:
            self.insert()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.key, gaps, *(self.faults[f] for f in FAULTS[:3]), self.illegal, self.cost, "".join(self.audits), self.digest.hexdigest())


_RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _finish(batches):
    """Tasks: one row a conversation, from its marker, audits and rows in order."""
    now, out = None, []
    for batch in batches:
        kind = batch.schema.field("__c").type

        def told(kind=kind):
            cols = list(zip(*out))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], kind), *[pa.array(c, pa.int64()) for c in cols[1:7]],
                                               *[pa.array(c, pa.string()) for c in cols[7:]]], ["__c", *_RESULT])
        for lo in range(0, len(batch), 256):
            part = batch.slice(lo, 256)
            for key, what, number, left, right in zip(*(part.column(c).to_pylist() for c in ("__c", "__what", "__number", "__left", "__right"))):
                if now is None or key != now.key:
                    if now is not None:
                        out.append(now.result())
                    now = _Conversation(key)
                if what == 1:
                    now.segment(left, right, number)
                elif what == 2:
                    now.row(number, left, right)
        if len(out) >= 256:
            yield told()
            out = []
    if now is not None:
        out.append(now.result())
        yield told()


def _rows(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``__c``, ``__turn``, ``__role``, ``__text``, ``__d`` (a digest of conversation, role
    and text) and ``__p``, a number that orders the rows of each conversation."""
    conv, space = F.col(conv_col).cast("string"), F.lit(" ")
    taken = rows.select(F.col(conv_col).alias("__c"), F.col(turn_col).cast("long").alias("__turn"),
                        F.coalesce(F.col(role_col).cast("string"), space).alias("__role"), F.coalesce(F.col(text_col), space).alias("__text"),
                        F.when(conv.isNull(), "").otherwise(F.concat(F.length(conv).cast("string"), F.lit(":"), conv)).alias("__k"))
    taken = taken.withColumn("__d", F.md5(F.concat_ws("\n", "__k", F.length("__role").cast("string"), "__role", "__text"))).drop("__k")
    return global_row_number(taken, [sort_key("__c"), sort_key("__turn", nulls_last=False), sort_key("__d")], "__p")


def _segments(rows: DataFrame) -> DataFrame:
    """Rows (``__c``, ``__at``, ``__p``, ``__run``): symbols of up to SEGMENT rows each."""
    first = cut_lineage(rows.groupBy("__d").agg(F.min("__p").alias("__p1"), F.first("__c").alias("__c")), "op11-first")
    start = first.groupBy(F.col("__c").alias("__c1")).agg(F.min("__p1").alias("__start"))
    ends = F.rtrim("__text", F.lit(WHITE))
    last = F.substring(ends, -1, 1)
    seen = rows.select("__c", "__p", "__d", F.substring("__role", 1, 1).alias("__r"), last.alias("__last")).join(first.drop("__c"), "__d")
    seen = seen.join(start, seen["__c"].eqNullSafe(F.col("__c1")))
    initial = F.when(F.col("__r") == "s", 0).when(F.col("__r") == "u", 1).when(F.col("__r") == "a", 2).otherwise(3)
    fault = F.when(F.col("__last") == "", 0).when(F.col("__p") > F.col("__p1"), 1).when(~F.col("__last").isin(*".!?"), 2).otherwise(3)
    coded = seen.select("__c", "__p", F.floor((F.col("__p") - F.col("__start")) / SEGMENT).alias("__at"),
                        F.char(initial * len(FAULTS) + fault + ord("A")).alias("__s"))
    return coded.groupBy("__c", "__at").agg(F.sort_array(F.collect_list(F.struct("__p", "__s"))).alias("__x")).select(
        "__c", "__at", F.element_at("__x", 1)["__p"].alias("__p"), F.array_join(F.transform("__x", lambda x: x["__s"]), "").alias("__run"))


def repair(rows: DataFrame, conversations: DataFrame | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation of ``conversations`` (default: of ``rows``):
    ``gaps`` in its turns, rows by fault, ``illegal`` neighbours, ``cost`` and
    ``audit`` of the cheapest repair and the digest of the repaired lines
    ``role:text``. A conversation without rows has zeros, an empty audit and the
    digest of nothing."""
    placed = _rows(rows, conv_col, turn_col, role_col, text_col)
    segments = cut_lineage(_segments(placed), "op11-segments")
    rules = learn(segments).rules
    kind = segments.schema["__c"].dataType.simpleString()
    transfer = cut_lineage(segments.mapInArrow(
        _transfer(rules), f"__c {kind}, __at bigint, __p bigint, __run string, __m array<bigint>, __cost bigint, __j int"), "op11-transfer")
    audits = _states(transfer).mapInArrow(_spell(rules), f"__c {kind}, __p bigint, __run string, __cost bigint, __audit string")
    # in order: the conversation itself, before each segment's rows its audit, the rows
    parts = [((conversations if conversations is not None else rows).select(F.col(conv_col).alias("__c")).distinct(), F.lit(-1), 0, F.lit(None), F.lit(None), F.lit(None)),
             (audits, F.col("__p"), 1, F.col("__cost"), F.col("__run"), F.col("__audit")),
             (placed, F.col("__p"), 2, F.col("__turn"), F.col("__role"), F.col("__text"))]
    told = None
    for df, place, what, number, left, right in parts:
        part = df.select("__c", place.cast("long").alias("__p"), F.lit(what).alias("__what"), number.cast("long").alias("__number"),
                         left.cast("string").alias("__left"), right.cast("string").alias("__right"))
        told = part if told is None else told.unionByName(part)
    schema = f"__c {kind}, " + ", ".join(f"{c} bigint" for c in _RESULT[:6]) + ", audit string, repaired_sha256 string"
    done = told.repartition("__c").sortWithinPartitions("__c", "__p", "__what").mapInArrow(_finish, schema)
    return done.withColumnRenamed("__c", conv_col)
