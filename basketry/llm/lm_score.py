"""LM scoring: a hierarchical Pitman-Yor bigram model of tokens.

Each token is the context of the next one. A context is a restaurant of its own
for every one of the ``FREQUENT`` most frequent tokens, and one for all others
together; the start of a text is the context of the end of another. Its dishes
are the frequent tokens and one dish for all others. All contexts share one
parent, the restaurant of dishes without context, over a uniform base. A token
behind the common dish is drawn from a restaurant of the other tokens alone, over
a uniform base with one place for all unknown ones. So all probabilities of a
context sum to one, over the event space of an add-one unigram.

Pairs with one of the other tokens are kept as well (``other_pairs``, as the query
does): of every such token as a context there is a restaurant of its own, below
the common one, and of every frequent context one of the other tokens behind it,
below their restaurant without context. Their pairs are counted, a table a dish,
so that no token goes without its pairs however many there are.

Seating is sampled by blocked Gibbs sweeps: given the tables of all other dishes
and of the parent in the sweep before, the customers of a dish in a restaurant
take their seats anew, one after the other (blocks of customers for very frequent
pairs). A table sends a customer to the parent. Predictive probabilities are
averaged over the sweeps after ``BURN``.

Shape of the job. Pairs (context, dish) are numbers of 34 bits. Tasks count them
piece by piece and deal them out by *bucket* (the number modulo a power of two
that follows the corpus, some two million pairs a bucket); a task adds up a bucket
and holds its restaurants' dishes in rows of one bucket each. A sweep is a map
over the buckets: tables are drawn in tasks, and the tables of each context and
the customers of each dish are added up by Spark in slices. The driver holds
vectors over the frequent tokens, nothing that grows with the corpus. An other
token has a *home*, a bucket by its hash: there its occurrences arrive with both
neighbours (numbers, or the hash of one behind it that is no frequent token
either), and its count, its seats and its pairs are one row of packed numbers.

Score: a text's log probability is what it has without its pairs (a sum over
frequent tokens from those vectors) and what each seen pair adds. The ``HOT`` most
frequent pairs are looked up in the task; all others go to their bucket, where they
meet the table of pairs, and come back as sums by text. So do other tokens with
their pairs, from their homes. Broadcast are the vectors and the hot pairs, both of
fixed bounds.

Defined cases: null text is empty and has just its end; an id that is null
belongs to training unless ``held`` says otherwise; repeated rows are all
counted and scored; an empty table gives an empty result; without training rows
every token is unknown; tokens are told apart by 64-bit hashes.
"""

from __future__ import annotations

import gc
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, drop_anchor
from . import textkit as tk

SWEEPS, BURN, FREQUENT, HOT = 3, 1, 1 << 17, 1 << 18
PAIRS, OTHERS = 1 << 21, 1 << 18  # of training, that make a bucket: pairs, occurrences of other tokens
DISCOUNT, STRENGTH = (0.5, 0.8), (10.0, 5.0)  # of the parent, of contexts
RARE_DISCOUNT, RARE_STRENGTH = 0.8, 10.0
SLICES, _BINS = 16, 1024
_PIECE, _AT_ONCE = 1 << 20, 1 << 17  # bytes of text, pairs of a bucket that a task works on at once
_U = np.uint64


def _each(batch: pa.RecordBatch, *names: str):
    """The rows of a batch, binaries as views of it: none is copied."""
    cols = [batch.column(n) for n in names]
    for i in range(len(batch)):
        yield tuple(c[i].as_buffer() if pa.types.is_binary(c.type) else c[i].as_py() for c in cols)


def _tokens(data: np.ndarray, off: np.ndarray):
    low = tk.LOWER[data]
    starts, ends, row = tk.spans(tk.TOKEN[low], off)
    return low, starts, ends, row, tk.run_hashes(low, starts, ends)


_END = int(tk.run_hashes(np.zeros(1, np.uint8), np.zeros(1, np.int64), np.zeros(1, np.int64))[0])  # of the empty token


def _count(batches):
    """(token's hash, occurrences in training) of each piece; the empty token is the end of a text."""
    for batch in batches:
        train = ~batch.column("__held").to_numpy(zero_copy_only=False)
        for lo, hi, data, off in tk.pieces(batch, "__t", _PIECE):
            _, _, _, row, h = _tokens(data, off)
            use = train[lo:hi]
            one, back = np.unique(h, return_inverse=True)
            n = np.bincount(back, weights=use[row], minlength=len(one)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tk.as_long(np.append(one, _U(_END)))), pa.array(np.append(n, use.sum()))], ["h", "n"])


class Names:
    """Numbers of frequent tokens, the end of a text among them; ``rare`` is all others'."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, buckets: int, homes: int):
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order]
        self.rare = len(keys)
        self.size = len(keys) + 1
        self.step = self.size | 1  # odd, so that a bucket mixes contexts and dishes
        self.buckets, self.homes = buckets, homes  # the homes' numbers come after the buckets'
        self.end = int(np.searchsorted(self.keys, _U(_END)))

    def of(self, h: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        return np.where(self.keys[at] == h, at, self.rare)

    def steps(self, x: np.ndarray, row: np.ndarray, rows: int):
        """(row, context, dish) of all tokens and of the rows' ends."""
        before = np.full(len(x), self.end)
        before[1:] = np.where(row[1:] == row[:-1], x[:-1], self.end)
        count = np.bincount(row, minlength=rows)
        last = np.full(rows, self.end)
        last[count > 0] = x[np.cumsum(count)[count > 0] - 1]
        return (np.concatenate([row, np.arange(rows)]), np.concatenate([before, last]), np.concatenate([x, np.full(rows, self.end)]))

    def others(self, h: np.ndarray, x: np.ndarray, row: np.ndarray):
        """(positions, hashes, packed neighbours) of the other tokens of each home."""
        own = np.flatnonzero(x == self.rare)
        near = np.full((2, len(x)), self.end, np.uint32)
        same = row[1:] == row[:-1]
        near[0, 1:][same], near[1, :-1][same] = x[:-1][same], x[1:][same]
        home = (h[own] % _U(self.homes)).astype(np.int64)
        own = own[np.argsort(home, kind="stable")]
        have, start = np.unique(np.sort(home), return_index=True)
        for b, at in zip(have.tolist(), np.split(own, start[1:]) if len(have) else ()):
            left, right = near[0, at], near[1, at]
            yield self.buckets + b, at, h[at].tobytes(), _packed(left, right) + h[at[right == self.rare] + 1].tobytes()

    def pairs(self, context: np.ndarray, dish: np.ndarray) -> np.ndarray:
        return context.astype(np.int64) * self.step + dish

    def split(self, bucket: int, rest: np.ndarray):
        key = rest.astype(np.int64) * self.buckets + bucket
        return key, key // self.step, key % self.step

    def dealt(self, key: np.ndarray):
        """(bucket, positions of its pairs) of each bucket."""
        bucket = key % self.buckets
        order = np.argsort(bucket, kind="stable")
        have, start = np.unique(bucket[order], return_index=True)
        yield from zip(have.tolist(), np.split(order, start[1:]))


def _packed(*numbers: np.ndarray) -> bytes:
    """Numbers of 32 bits, first bytes first: what is small nearly vanishes once compressed."""
    return b"".join(np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes() for x in numbers)


def _unpacked(x, *sizes: int):
    """The numbers that ``_packed`` wrote, and the 64-bit ones behind them."""
    raw, out = np.frombuffer(x, np.uint8), []
    for n in sizes:
        out.append(np.ascontiguousarray(raw[:4 * n].reshape(4, n).T).view("<u4").reshape(-1).astype(np.int64))
        raw = raw[4 * n:]
    return *out, raw.copy().view(_U)


def _rise(at: np.ndarray) -> bytes:
    """Places as differences modulo the type's range, nearly all of them 0 or 1."""
    return np.diff(at, prepend=at.dtype.type(0)).tobytes()


def _pair_counts(held):
    """Tasks: pairs of training rows by bucket, with their number in a piece."""
    def run(batches):
        names = held.value
        for batch in batches:
            train = ~batch.column("__held").to_numpy(zero_copy_only=False)
            for lo, hi, data, off in tk.pieces(batch, "__t", _PIECE):
                _, _, _, row, h = _tokens(data, off)
                row, context, dish = names.steps(names.of(h), row, hi - lo)
                key, n = np.unique(names.pairs(context, dish)[train[lo:hi][row]], return_counts=True)
                at = [] if not len(key) else list(names.dealt(key))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, _ in at], pa.int32()), pa.array([(key[i] // names.buckets).astype(np.uint32).tobytes() for _, i in at], pa.binary()),
                     pa.array([n[i].astype(np.uint32).tobytes() for _, i in at], pa.binary())], ["bucket", "k", "n"])
    return run


def _merged(batches):
    """Tasks: one row per bucket, pairs in order with their number."""
    def whole(bucket, ks, ns):
        k, back = np.unique(np.concatenate(ks), return_inverse=True)
        n = np.bincount(back, weights=np.concatenate(ns), minlength=len(k)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([k.tobytes()], pa.binary()), pa.array([n.tobytes()], pa.binary())], ["bucket", "k", "c"])
    now, ks, ns = None, [], []
    for batch in batches:
        for b, k, n in _each(batch, "bucket", "k", "n"):
            if b != now and now is not None:
                yield whole(now, ks, ns)
                ks, ns = [], []
            now = b
            ks.append(np.frombuffer(k, np.uint32).copy())
            ns.append(np.frombuffer(n, np.uint32).copy())
            if len(ks) >= 64:  # pieces share most pairs: add up now and then
                one, back = np.unique(np.concatenate(ks), return_inverse=True)
                ks, ns = [one], [np.bincount(back, weights=np.concatenate(ns), minlength=len(one))]
    if now is not None:
        yield whole(now, ks, ns)


def seat(n: np.ndarray, pull: np.ndarray, d: float, seed: np.ndarray) -> np.ndarray:
    """Tables of ``n`` customers who eat the same dish, drawn in turn: the next
    one opens a table with weight ``pull`` (free mass times the dish's base
    probability) against ``seated - d * tables``. From the 256th customer on,
    customers come in blocks of a twentieth of those seated."""
    t = np.minimum(n, 1).astype(np.float64)
    live = np.flatnonzero(n > 1)
    done, turn = 1, 1
    while len(live):
        block = 1 if done < 256 else done // 20
        m = np.minimum(block, n[live] - done)
        p = pull[live] / (done - d * t[live] + pull[live])
        u = tk.mix(seed[live] ^ _U(turn * 0x9E3779B9)) / 2.0 ** 64
        t[live] += np.floor(m * p + u)
        done += block
        turn += 1
        live = live[n[live] > done]
    return np.minimum(t, n)


def _parts(batch: pa.RecordBatch):
    """(bucket, pairs, customers) of the batch's buckets, some pairs at a time."""
    for b, k, c in _each(batch, "bucket", "k", "c"):
        k, c = np.frombuffer(k, np.uint32), np.frombuffer(c, np.int64)
        for lo in range(0, len(k), _AT_ONCE):
            yield b, k[lo:lo + _AT_ONCE], c[lo:lo + _AT_ONCE]


def _drawn(names: Names, bucket: int, k: np.ndarray, n: np.ndarray, state, sweep: int):
    """Contexts and dishes of a bucket's pairs and the tables of one sweep."""
    key, context, dish = names.split(bucket, k)
    if state is None:
        return context, dish, np.minimum(n, 1).astype(np.float64)
    tables, parent = state
    pull = (STRENGTH[1] + DISCOUNT[1] * tables[context]) * parent[dish]
    return context, dish, seat(n, pull, DISCOUNT[1], tk.mix(key.view(_U) + _U(sweep * 0x632BE59B)))


def _tables(held):
    """Tasks: tables and customers by context, tables by dish, in slices."""
    def run(batches):
        names, state, sweep = held.value
        total = np.zeros((3, names.size), np.int64)
        for batch in batches:
            for b, k, n in _parts(batch):
                context, dish, t = _drawn(names, b, k, n, state, sweep)
                for i, (at, x) in enumerate(((context, t), (context, n), (dish, t))):
                    np.add.at(total[i], at, x.astype(np.int64))
        yield from _sliced(total.reshape(-1))
    return run


def _sliced(values: np.ndarray):
    parts = np.array_split(values, SLICES)
    yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([x.tobytes() for x in parts], pa.binary())], ["slice", "x"])


def _add(batches):
    now, total = None, None
    for batch in batches:
        for i, x in _each(batch, "slice", "x"):
            x = np.frombuffer(x, np.int64)
            if i != now:
                if now is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["slice", "x"])
                now, total = i, x.copy()
            else:
                total = total + x
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["slice", "x"])


def _added(df: DataFrame, run, size: int) -> np.ndarray:
    """Vectors of whole numbers from all tasks, added up by Spark; ``size`` numbers come to the driver."""
    parts = df.mapInArrow(run, "slice int, x binary").repartition("slice").sortWithinPartitions("slice").mapInArrow(_add, "slice int, x binary").collect()
    got = np.concatenate([np.frombuffer(r["x"], np.int64) for r in sorted(parts, key=lambda r: r["slice"])]) if parts else np.zeros(0, np.int64)
    return got if len(got) else np.zeros(size, np.int64)


def _parent(customers: np.ndarray, sweep: int, before: float) -> tuple[np.ndarray, float]:
    """The parent's probabilities of dishes, and its number of tables."""
    uniform = 1 / len(customers)
    t = np.zeros(len(customers))
    some = np.flatnonzero(customers)
    t[some] = seat(customers[some], np.full(len(some), (STRENGTH[0] + DISCOUNT[0] * before) * uniform), DISCOUNT[0],
                   tk.mix(some.astype(_U) + _U(sweep * 0x85EBCA6B + 1)))
    p = np.maximum(customers - DISCOUNT[0] * t, 0) + (STRENGTH[0] + DISCOUNT[0] * t.sum()) * uniform
    return p / (STRENGTH[0] + customers.sum()), t.sum()


def _extra(held):
    """Tasks: what each pair adds to the log10 probability without it."""
    def added(names, samples, b, k, n):
        p = base = 0.0
        for state, sweep, tables, parent in samples:
            context, dish, t = _drawn(names, b, k, n, state, sweep)
            own = (STRENGTH[1] + DISCOUNT[1] * tables[context]) * parent[dish]
            base = base + own
            p = p + own + np.maximum(n - DISCOUNT[1] * t, 0)
        return np.log10(p / base).astype(np.float32)

    def run(batches):
        names, samples, least = held.value
        for batch in batches:
            for i in range(len(batch)):
                one = batch.slice(i, 1)
                x = np.concatenate([np.zeros(0, np.float32), *[added(names, samples, *part) for part in _parts(one)]])
                (b, k, c), = _each(one, "bucket", "k", "c")
                k, often = np.frombuffer(k, np.uint32), _logs(c) >= least
                hot = names.split(b, k[often])[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b], pa.int32()), *[pa.array([v], pa.binary()) for v in (_packed(np.diff(k, prepend=np.uint32(0))), x.tobytes(), hot.tobytes(), x[often].tobytes())]],
                    ["bucket", "k", "x", "hot_k", "hot_x"])
    return run


def _sorted(k) -> np.ndarray:
    """A bucket's pairs, which are kept as packed differences."""
    return np.cumsum(_unpacked(k, len(k) // 4)[0]).astype(np.uint32)


def _as_numbers(batches):
    """Tasks: buckets with their pairs as plain numbers."""
    for batch in batches:
        for b, k, x in _each(batch, "bucket", "k", "x"):
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), *[pa.array([v], pa.binary()) for v in (_sorted(k).tobytes(), x.to_pybytes())]], ["bucket", "k", "x"])


def _logs(c) -> np.ndarray:
    return np.floor(np.log2(np.frombuffer(c, np.int64)) * 16)


def _how_often(batches):
    """Tasks: pairs by the logarithm of their number."""
    total = np.zeros(_BINS, np.int64)
    for batch in batches:
        for (c,) in _each(batch, "c"):
            total += np.bincount(_logs(c).astype(np.int64), minlength=_BINS)
    yield from _sliced(total)


def _hot(batches):
    for batch in batches:
        for k, x in _each(batch, "hot_k", "hot_x"):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(k, np.int64)), pa.array(np.frombuffer(x, np.float32))], ["k", "x"])


def _other_places(held):
    """Tasks: other tokens of training rows with their neighbours, by home."""
    def run(batches):
        names = held.value
        for batch in batches:
            train = ~batch.column("__held").to_numpy(zero_copy_only=False)
            for lo, hi, data, off in tk.pieces(batch, "__t", _PIECE):
                _, _, _, row, h = _tokens(data, off)
                use = train[lo:hi][row]
                h, row = h[use], row[use]
                at = list(names.others(h, names.of(h), row))
                yield pa.RecordBatch.from_arrays([pa.array([a[0] for a in at], pa.int32()), *[pa.array([a[i] for a in at], pa.binary()) for i in (2, 3)]], ["bucket", "k", "x"])
    return run


def _pair(context: np.ndarray, dish: np.ndarray) -> np.ndarray:
    return tk.mix(tk.mix(context) + dish * _U(0x9E3779B97F4A7C15))


_BEHIND = 1 << 31  # of a pair's other token that comes behind


def _settled(held):
    """Tasks: one row per home: its tokens (``k``), and packed in ``x`` how often
    they occur, their number of pairs, these pairs' frequent token and number, and
    pairs of two other tokens: the first one's place, their number, the second one."""
    def run(batches):
        names = held.value

        def whole(bucket, got):
            h, left, right, dish = (np.concatenate(v) for v in zip(*got))
            own, at, c = np.unique(h, return_inverse=True, return_counts=True)
            before, after = left != names.rare, right != names.rare
            pair, n = np.unique(np.concatenate([at[before] << 32 | left[before], at[after] << 32 | right[after] | _BEHIND]), return_counts=True)
            both = at[~after]
            _, first, m = np.unique(_pair(own[both], dish), return_index=True, return_counts=True)
            x = _packed(c, np.bincount(pair >> 32, minlength=len(own)), pair & 0xFFFFFFFF, n, both[first], m) + dish[first].tobytes()
            return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([own.tobytes()], pa.binary()), pa.array([x], pa.binary())], ["bucket", "k", "x"])
        now, got = None, []
        for batch in batches:
            for b, k, x in _each(batch, "bucket", "k", "x"):
                if b != now and now is not None:
                    yield whole(now, got)
                    got = []
                now = b
                h = np.frombuffer(k, _U).copy()
                got.append((h, *_unpacked(x, len(h), len(h))))
        if now is not None:
            yield whole(now, got)
    return run


class Home:
    """A home's tokens in order, their count ``c``, their pairs with frequent tokens
    (``at`` of the token, ``near`` with _BEHIND, number ``n``) and with other ones."""

    def __init__(self, k, x):
        self.own = np.frombuffer(k, _U).copy()
        size = len(self.own)
        self.c, pairs = _unpacked(x[:8 * size], size, size)[:2]
        x, pairs_in_all = x[8 * size:], int(pairs.sum())
        both = (len(x) - 8 * pairs_in_all) // 16
        self.near, self.n, self.both, self.both_n, self.dish = _unpacked(x, pairs_in_all, pairs_in_all, both, both)
        self.at = np.repeat(np.arange(size), pairs)
        self.behind = self.near >= _BEHIND
        self.number = self.near & (_BEHIND - 1)


def _homes(batches):
    for batch in batches:
        for b, k, x in _each(batch, "bucket", "k", "x"):
            yield b, Home(k, x)


def _frequent_rooms(names: Names):
    """Tasks: seats and tables of other tokens behind each frequent context."""
    def run(batches):
        total = np.zeros((2, names.size), np.int64)
        for _, home in _homes(batches):
            v = home.number[~home.behind]
            np.add.at(total[0], v, home.n[~home.behind])
            np.add.at(total[1], v, 1)
        yield from _sliced(total.reshape(-1))
    return run


def _home_counts(batches):
    """Tasks: other tokens of training and how often they occur."""
    for _, home in _homes(batches):
        yield pa.RecordBatch.from_arrays([pa.array(tk.as_long(home.own)), pa.array(home.c)], ["h", "c"])


def _second_ones(batches):
    """Tasks: the second tokens of pairs of two other tokens."""
    for b, home in _homes(batches):
        m = len(home.dish)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(m, b, np.int32)), pa.array(np.arange(m, dtype=np.int32)), pa.array(tk.as_long(home.dish))], ["bucket", "i", "h"])


def _to_homes(batches):
    """Tasks: how often those occur, for their home: ``k`` places, ``x`` counts."""
    for batch in batches:
        bucket, i, c = (batch.column(n).to_numpy() for n in ("bucket", "i", "c"))
        order = np.argsort(bucket, kind="stable")
        have, start = np.unique(bucket[order], return_index=True)
        at = np.split(order, start[1:]) if len(have) else []
        yield pa.RecordBatch.from_arrays([pa.array(have, pa.int32()), pa.array([_packed(i[a]) for a in at], pa.binary()), pa.array([_packed(c[a]) for a in at], pa.binary())], ["bucket", "k", "x"])


class Told:
    """What a home tells: the base's and the model's log10 probability of an other
    token and its pairs; ``home`` None: none of its tokens is known."""

    def __init__(self, home, seconds, names, ask):
        unknown, down, samples, rooms = ask
        self.home, self.names, self.rooms = home, names, rooms
        own = np.zeros(0, _U) if home is None else home.own
        c = np.zeros(0, np.int64) if home is None else home.c
        # one that the model has not met at all comes last
        self.c = np.append(c, 0)
        self.base = np.log10((self.c + 1) / down)
        lp = _rare_lp(own, c, samples) if len(own) else np.zeros(0)
        self.lp = np.append(lp, unknown)
        self.own = own
        if rooms is None or home is None:
            return
        free, behind = rooms
        tables = np.bincount(home.at[home.behind], minlength=len(own)) + np.bincount(home.both, minlength=len(own))
        mine = STRENGTH[1] + DISCOUNT[1] * tables
        self.lp[:-1] += np.log10(mine / (STRENGTH[1] + c))
        there = np.where(home.behind, mine[home.at] * 10 ** behind[home.number], free[home.number] * 10 ** lp[home.at])
        self.key, self.x = home.at << 32 | home.near, np.log10(1 + (home.n - DISCOUNT[1]) / there)
        pair = _pair(own[home.both], home.dish)  # in order
        count = np.zeros(len(pair), np.int64)
        for i, n in seconds:
            count[i] = n
        there = mine[home.both] * 10 ** (behind[names.rare] + (_rare_lp(home.dish, count, samples) if len(pair) else 0.0))
        self.pair, self.pair_x = pair, np.log10(1 + (home.both_n - DISCOUNT[1]) / there)

    def tell(self, h: np.ndarray, left: np.ndarray, right: np.ndarray, dish: np.ndarray):
        """(base, model, known) of each occurrence."""
        place = np.searchsorted(self.own, h)
        place[self.own[np.minimum(place, len(self.own) - 1)] != h if len(self.own) else slice(None)] = len(self.own)
        log = self.lp[place]
        if self.rooms is not None and self.home is not None:
            for near in (left, right | _BEHIND):
                _meet(log, self.key, self.x, place << 32 | near)
            both = np.flatnonzero(right == self.names.rare)
            if len(both):
                x = np.zeros(len(both))
                _meet(x, self.pair, self.pair_x, _pair(h[both], dish))
                log[both] += x
        return self.base[place], log, self.c[place] > 0


def _meet(to: np.ndarray, keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> None:
    if len(keys):
        place = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        seen = keys[place] == asked
        to[seen] += values[place[seen]]


def _behind_rare(names: Names):
    """Tasks: what the pairs of the common context add."""
    def run(batches):
        for batch in batches:
            for b, k, x in _each(batch, "bucket", "k", "x"):
                _, context, dish = names.split(b, _sorted(k))
                own = context == names.rare
                yield pa.RecordBatch.from_arrays([pa.array(dish[own]), pa.array(np.frombuffer(x, np.float32)[own])], ["dish", "x"])
    return run


def _rooms(names: Names, states, extra: DataFrame, table: DataFrame):
    """Free mass of each frequent context for other tokens; log10 probability of
    frequent tokens in the common context; what those contexts take from the others."""
    seats, tables = _added(table, _frequent_rooms(names), 2 * names.size).reshape(2, -1)
    free = STRENGTH[1] + DISCOUNT[1] * tables
    behind = np.log10(sum(factor[names.rare] * parent for factor, parent in states) / len(states))
    seen = extra.select("bucket", "k", "x").mapInArrow(_behind_rare(names), "dish bigint, x float").toArrow()  # at most a row per frequent token
    behind[seen.column("dish").to_numpy()] += seen.column("x").to_numpy()
    return free, behind, np.log10(free / (STRENGTH[1] + seats))


def _rare_tables(totals, sweep):
    """(customers, dishes, tables) of the restaurant of other tokens."""
    def run(batches):
        for batch in batches:
            c = batch.column("c").to_numpy()
            t = np.minimum(c, 1) if totals is None else _rare_drawn(batch, totals, sweep)
            yield pa.RecordBatch.from_arrays([pa.array([int(c.sum())]), pa.array([int((c > 0).sum())]), pa.array([int(t.sum())])], ["n", "v", "t"])
    return run


def _rare_drawn(batch, totals, sweep):
    return _rare_seated(batch.column("h").to_numpy().view(_U), batch.column("c").to_numpy(), totals, sweep)


def _rare_seated(h, c, totals, sweep):
    n, v, tables = totals
    pull = np.full(len(c), (RARE_STRENGTH + RARE_DISCOUNT * tables) / (v + 1))
    return seat(c, pull, RARE_DISCOUNT, tk.mix(h + _U(sweep * 0x27D4EB2F)))


def _rare_lp(h, c, samples):
    """log10 probability of other tokens behind the common dish."""
    p = 0.0
    for before, sweep, (n, v, tables) in samples:
        t = _rare_seated(h, c, before, sweep)
        p = p + (np.maximum(c - RARE_DISCOUNT * t, 0) + (RARE_STRENGTH + RARE_DISCOUNT * tables) / (v + 1)) / (RARE_STRENGTH + n)
    return np.log10(p / len(samples))


def _rare_logs(samples):
    def run(batches):
        for batch in batches:
            lp = _rare_lp(batch.column("h").to_numpy().view(_U), batch.column("c").to_numpy(), samples)
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("c"), pa.array(lp)], ["h", "c", "lp"])
    return run


def _rarer(keys: np.ndarray):
    """Tasks: tokens that are not among ``keys``."""
    def run(batches):
        own = keys.value
        for batch in batches:
            h = batch.column("h").to_numpy().view(_U)
            at = np.minimum(np.searchsorted(own, h), len(own) - 1)
            yield batch.filter(pa.array(own[at] != h))
    return run


def _often(tokens: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the most frequent tokens of training, FREQUENT at
    most, and of the end of a text."""
    end = F.col("h") == F.lit(_END - (1 << 64) if _END >> 63 else _END)
    step = F.floor(F.log2(F.col("c")) * 16)
    bins = tokens.where((F.col("c") > 0) & ~end).groupBy(step.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("least")).orderBy(F.desc("b")).collect()
    total, least = 0, 1 << 62
    for r in bins:
        total += r["n"]
        if total >= FREQUENT:
            break
        least = r["least"]
    got = tokens.where((F.col("c") >= least) | end).toArrow()
    return got.column("h").to_numpy().view(_U), got.column("c").to_numpy()


def _release(sc) -> None:
    """Let Spark delete the shuffle files of what has been written meanwhile: it
    does so once the driver's JVM has collected its garbage, which in a short
    job happens too late to spare the disks."""
    gc.collect()
    sc._jvm.System.gc()


def fit(docs: DataFrame, text_col: str = "text", held: Column | None = None, other_pairs: bool = False) -> dict | None:
    """``n`` (training tokens), ``v`` (distinct ones), ``names`` of frequent
    tokens, ``tokens`` (the others of training: hash ``h``, count ``c``, log10 probability
    behind the common dish ``lp``), ``states`` (per sample: log-free factor of
    each context and probability of each dish without context) and ``pairs``
    (what seen pairs add), ``hot`` ones among them, and ``homes`` of the other
    tokens; with ``other_pairs`` these are ``others`` too, with ``rooms`` and what
    frequent contexts take from other tokens (``gains``). None for an empty table."""
    sc = docs.sparkSession.sparkContext
    src = docs.select(F.col(text_col).alias("__t"), (F.lit(False) if held is None else F.coalesce(held, F.lit(False))).alias("__held"))
    tokens = cut_lineage(src.mapInArrow(_count, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("c")), "op9-tokens")
    n, v, rows = tokens.agg(F.sum("c"), F.sum((F.col("c") > 0).cast("long")), F.count(F.lit(1))).first()
    if not rows:
        return None
    buckets = 1 << max(3, (int(n) // PAIRS).bit_length())
    often = _often(tokens)
    names = Names(*often, buckets, 1 << max(3, (int(n - often[1].sum()) // OTHERS).bit_length()))
    held_names = sc.broadcast(names)
    counted = src.mapInArrow(_pair_counts(held_names), "bucket int, k binary, n binary")
    pairs = cut_lineage(counted.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_merged, "bucket int, k binary, c binary"), "op9-pairs")
    _release(sc)
    rare = cut_lineage(tokens.mapInArrow(_rarer(sc.broadcast(names.keys)), "h bigint, c bigint"), "op9-rare")
    drop_anchor(tokens)
    state, samples, parent_tables, totals, rare_samples = None, [], 0.0, None, []
    for sweep in range(SWEEPS + 1):
        tables, customers, dishes = _added(pairs, _tables(sc.broadcast((names, state, sweep))), 3 * names.size).reshape(3, -1)
        parent, parent_tables = _parent(dishes, sweep, parent_tables)
        drawn = rare.mapInArrow(_rare_tables(totals, sweep), "n bigint, v bigint, t bigint").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in "nvt"]).first()
        if sweep > BURN:
            samples.append((state, sweep, tables, parent))
            rare_samples.append((totals, sweep, tuple(drawn)))
        state, totals = (tables.astype(np.float64), parent), tuple(drawn)
    bins = _added(pairs.select("c"), _how_often, _BINS)
    least = next((b for b in range(_BINS) if bins[b:].sum() <= HOT), _BINS)
    extra = cut_lineage(pairs.mapInArrow(_extra(sc.broadcast((names, samples, least))), "bucket int, k binary, x binary, hot_k binary, hot_x binary"), "op9-extra")
    drop_anchor(pairs)
    hot = extra.select("hot_k", "hot_x").mapInArrow(_hot, "k bigint, x float").toArrow().combine_chunks().sort_by("k")  # at most HOT rows
    unknown = np.mean([(RARE_STRENGTH + RARE_DISCOUNT * t) / (k + 1) / (RARE_STRENGTH + m) for _, _, (m, k, t) in rare_samples])
    states = [((STRENGTH[1] + DISCOUNT[1] * t) / (STRENGTH[1] + customers), p) for _, _, t, p in samples]
    homes, rooms, gains, counts = None, None, None, rare
    if totals[1]:  # without other tokens in training there are no such pairs
        places = src.mapInArrow(_other_places(held_names), "bucket int, k binary, x binary")
        homes = cut_lineage(places.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_settled(held_names), "bucket int, k binary, x binary"), "op9-homes")
        _release(sc)
        drop_anchor(rare)
        counts = homes.mapInArrow(_home_counts, "h bigint, c bigint")
        if other_pairs:
            *rooms, gains = _rooms(names, states, extra, homes)
    return {"others": homes if rooms else None, "homes": homes, "rooms": rooms, "gains": gains, "rare": rare_samples,
            "tokens": counts.mapInArrow(_rare_logs(rare_samples), "h bigint, c bigint, lp double"),
            "n": int(n), "v": int(v), "names": names, "unknown": float(np.log10(unknown)), "states": states,
            "extra": extra, "pairs": extra.select("bucket", "k", "x").mapInArrow(_as_numbers, "bucket int, k binary, x binary"),
            "hot": (hot.column("k").to_numpy(), hot.column("x").to_numpy())}


def _rows(held, down):
    """Tasks: rows of texts (``bucket`` null), and rows of pairs for the buckets."""
    def run(batches):
        names, states, (hot_key, hot_x), gains = held.value
        rng = np.random.default_rng(int.from_bytes(os.urandom(8), "little"))
        base_of = np.log10((names.counts + 1) / down)
        for batch in batches:
            for lo, hi, data, off in tk.pieces(batch, "__t", _PIECE):
                rows = hi - lo
                piece = int(rng.integers(0, 2 ** 38)) << 24
                _, _, _, row, h = _tokens(data, off)
                x = names.of(h)
                at, context, dish = names.steps(x, row, rows)
                p = sum(factor[context] * parent[dish] for factor, parent in states) / len(states)
                step = np.log10(p)
                key = names.pairs(context, dish)
                place = np.minimum(np.searchsorted(hot_key, key), max(len(hot_key) - 1, 0))
                is_hot = hot_key[place] == key if len(hot_key) else np.zeros(len(key), bool)
                step[is_hot] += hot_x[place[is_hot]]
                if gains is not None:
                    step += np.where(dish == names.rare, gains[context], 0.0)
                log = np.bincount(at, weights=step, minlength=rows)
                own = dish != names.rare
                base = np.bincount(at[own], weights=base_of[dish[own]], minlength=rows)
                known = np.bincount(at[own], weights=names.counts[dish[own]] > 0, minlength=rows).astype(np.int64)
                words = np.bincount(at, minlength=rows)
                nothing = lambda m, kind: pa.nulls(m, kind)
                yield pa.RecordBatch.from_arrays(
                    [nothing(rows, pa.int32()), *[nothing(rows, pa.binary())] * 3,
                     batch.column("__d")[lo:hi], batch.column("__held")[lo:hi], pa.array(piece + np.arange(rows)), pa.array(words.astype(np.int64)),
                     pa.array(known), pa.array(base), pa.array(log)], _ROW)
                send = np.flatnonzero(~is_hot)
                kind = np.uint16 if rows <= 1 << 16 else np.uint32
                asked = [(b, (key[send[i]] // names.buckets).astype(np.uint32).tobytes(), _rise(at[send[i]].astype(kind)), None) for b, i in names.dealt(key[send])] if len(send) else []
                asked += [(b, k, _rise(row[i].astype(kind)), near) for b, i, k, near in names.others(h, x, row)]
                m = len(asked)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a[0] for a in asked], pa.int32()), *[pa.array([a[i] for a in asked], pa.binary()) for i in (1, 2, 3)],
                     nothing(m, batch.schema.field("__d").type), nothing(m, pa.bool_()), pa.array(np.full(m, piece)), *[nothing(m, pa.int64())] * 2,
                     *[nothing(m, pa.float64())] * 2], _ROW)
    return run


_ROW = ["bucket", "k", "at", "near", "__d", "__held", "__r", "n_tokens", "__known", "__base", "__lp"]


def _met(held):
    """Tasks: what a bucket's pairs, or a home's tokens with theirs, add to the
    texts of each piece: ``kind`` 0 pairs, 1 base, 2 model, 3 known tokens."""
    def run(batches):
        names, ask = held.value
        now, keys, values, seconds, told = None, None, None, [], None
        for batch in batches:
            for b, kind, piece, k, x, near in _each(batch, "bucket", "kind", "piece", "k", "x", "near"):
                if b != now:
                    now, keys, values, seconds, told = b, None, None, [], None
                if kind == 0:
                    keys, values = (None, Home(k, x)) if b >= names.buckets else (_sorted(k), np.frombuffer(x, np.float32).copy())  # outlive their batch
                elif kind == 1:
                    n = k.size // 4
                    seconds.append((_unpacked(k, n)[0], _unpacked(x, n)[0]))
                elif b < names.buckets:
                    if keys is not None:
                        add = np.zeros(k.size // 4)
                        _meet(add, keys, values, np.frombuffer(k, np.uint32))
                        yield _answer(piece, _places(x, len(add)), [(0, add, np.float32)])
                else:
                    told = told or Told(values, seconds, names, ask)
                    h = np.frombuffer(k, _U)
                    left, right, dish = _unpacked(near, len(h), len(h))
                    yield _answer(piece, _places(x, len(h)), [(i + 1, v, np.float64) for i, v in enumerate(told.tell(h, left, right, dish))])
    return run


def _places(x, n: int) -> np.ndarray:
    rise = np.frombuffer(x, np.uint16 if x.size == 2 * n else np.uint32)
    return np.cumsum(rise, dtype=rise.dtype)


def _answer(piece: int, row: np.ndarray, sums) -> pa.RecordBatch:
    out = []
    for kind, values, dtype in sums:
        add = np.bincount(row, weights=values)
        at = np.flatnonzero(add)
        out.append((kind, _rise(at.astype(np.uint32)), add[at].astype(dtype).tobytes()))
    return pa.RecordBatch.from_arrays([pa.array([piece] * len(out), pa.int64()), pa.array([o[0] for o in out], pa.int32()),
                                       *[pa.array([o[i] for o in out], pa.binary()) for i in (1, 2)]], ["piece", "kind", "at", "x"])


def _by_text(batches):
    """Tasks: sums of a piece's texts over all buckets."""
    now, total = None, None

    def told():
        at = np.flatnonzero((total != 0).any(axis=0))
        return pa.RecordBatch.from_arrays([pa.array(now + at), *[pa.array(v[at]) for v in total]], ["__r", "__x", "__b", "__l", "__k"])
    for batch in batches:
        for piece, kind, at, x in _each(batch, "piece", "kind", "at", "x"):
            if piece != now:
                if now is not None:
                    yield told()
                now, total = piece, np.zeros((4, 1024))
            at = np.cumsum(np.frombuffer(at, np.uint32), dtype=np.uint32)
            if len(at) and at[-1] >= total.shape[1]:
                total = np.concatenate([total, np.zeros((4, int(at[-1]) + 1))], axis=1)
            total[kind, at] += np.frombuffer(x, np.float64 if kind else np.float32)
    if now is not None:
        yield told()


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", held: Column | None = None) -> DataFrame:
    """One row per row: id, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score``, ``score`` and ``perplexity`` per token."""
    sc = docs.sparkSession.sparkContext
    down = float(model["n"] + model["v"] + 1)
    src = docs.select(F.col(id_col).alias("__d"), F.col(text_col).alias("__t"),
                      (F.lit(False) if held is None else F.coalesce(held, F.lit(False))).alias("__held"))
    kinds = [T.IntegerType(), *[T.BinaryType()] * 3, src.schema["__d"].dataType, T.BooleanType(), T.LongType(), T.LongType(), T.LongType(),
             T.DoubleType(), T.DoubleType()]
    schema = T.StructType([T.StructField(c, kind) for c, kind in zip(_ROW, kinds)])
    both = cut_lineage(src.mapInArrow(_rows(sc.broadcast((model["names"], model["states"], model["hot"], model["gains"])), down), schema), "op9-rows")
    _release(sc)
    rows = both.where(F.col("bucket").isNull())
    # a bucket's pairs or a home's tokens come first, then what the pieces ask of them
    row = lambda df, kind, piece, x, near: df.select("bucket", F.lit(kind).alias("kind"), piece.alias("piece"), "k", F.col(x).alias("x"), near.alias("near"))
    none, no_piece = F.lit(None).cast("binary"), F.lit(0).cast("long")
    told = row(model["extra"], 0, no_piece, "x", none).unionByName(row(both.where(F.col("bucket").isNotNull()), 2, F.col("__r"), "at", F.col("near")))
    if model["homes"] is not None:
        told = told.unionByName(row(model["homes"], 0, no_piece, "x", none))
    if model["others"] is not None:  # a pair of two other tokens lies in the first one's home
        second = model["others"].mapInArrow(_second_ones, "bucket int, i int, h bigint").join(model["others"].mapInArrow(_home_counts, "h bigint, c bigint"), "h")
        told = told.unionByName(row(second.mapInArrow(_to_homes, "bucket int, k binary, x binary"), 1, no_piece, "x", none))
    ask = sc.broadcast((model["names"], (model["unknown"], down, model["rare"], model["rooms"])))
    met = told.repartition("bucket").sortWithinPartitions("bucket", "kind").mapInArrow(_met(ask), "piece bigint, kind int, at binary, x binary")
    more = met.repartition("piece").sortWithinPartitions("piece").mapInArrow(_by_text, "__r bigint, __x double, __b double, __l double, __k double")
    zero = F.lit(0)
    got = rows.drop("bucket", "k", "at", "near").join(more, "__r", "left")
    total = F.col("__lp") + F.coalesce("__l", zero) + F.coalesce("__x", zero)
    return got.select(
        F.col("__d").alias(id_col), F.col("__held").alias("held_out"), "n_tokens",
        (F.col("__known") + F.coalesce("__k", zero)).cast("long").alias("n_known"), F.lit(model["n"]).cast("long").alias("train_tokens"),
        (F.col("__base") + F.coalesce("__b", zero)).alias("base_score"), total.alias("score"),
        F.pow(F.lit(10.0), -total / F.col("n_tokens")).alias("perplexity"))
