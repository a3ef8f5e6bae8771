"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades: 0 toxic, 1 not toxic but of low quality, 2 neither. One score
``w . x`` with weights shared by all grades meets ordered thresholds:
``P(grade > k) = sigmoid(w . x - cut_k)``, ``cut_0 < cut_1``. The thresholds
and weights are fit together on the penalised likelihood. ``x`` holds for each
word ``log(1 + occurrences)`` at two hashed places, so that a word that shares
one place with another still differs, and a few shares of character kinds.

The fit sees a sample of labelled rows of about ``FIT_ROWS`` at most (a hash of
the id picks them, whatever their texts; fewer labels are all used). The
sample's entries are written once. Each round sends the weights to the tasks,
which return the likelihood and its gradient summed by place, in whole numbers
of 2 ** -40, so that the sum does not depend on its order; Spark adds the tasks
up. The driver holds vectors of ``2 * DIMS`` places (L-BFGS with ``MEMORY``
pairs), never an entry of a row, however many or long the texts are. Places
that fewer than ``MIN_ROWS`` sample rows use keep no weight: a word of a few
rows teaches those rows alone. Every row is scored over its whole text.

Results: ``expected_grade`` (0 to 2), ``p_clean`` = P(grade > 0), ``p_good`` =
P(grade > 1) and ``keep`` (both at least 0.5).

Columns of the input that bear a result's name are replaced by it.

Defined cases: null, empty and wordless texts have grade features of an empty
text and are scored; several labels of one id are combined (worst grade wins);
labels with a null id or no rating are not used; without any label
nothing is learnt and every row is kept with p 0.5; extra columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from . import textkit as tk

FIT_ROWS, DIMS, ROUNDS, MIN_ROWS, RIDGE, MEMORY = 14_000, 1 << 17, 40, 10, 1e-3, 6
GRADES = 3
UNIT = 2.0 ** 40  # gradients are added up as whole numbers of this fraction
_U = np.uint64
_EXTRA = 8
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,'"]] = True


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word entries (row, word hash, value) and the rows' shares."""
    rows = len(off) - 1
    low = tk.LOWER[data]
    starts, ends, row = tk.spans(tk.WORD[low], off)
    h = tk.run_hashes(low, starts, ends)
    both = tk.mix(h ^ (row.astype(_U) * _U(0x9E3779B97F4A7C15)))
    _, one, count = np.unique(both, return_index=True, return_counts=True)
    at = row[one]
    words = np.bincount(row, minlength=rows)
    distinct = np.bincount(at, minlength=rows)
    size = np.maximum(np.diff(off), 1)

    def share(kind):
        total = np.append(0, np.cumsum(kind[data]))
        return (total[off[1:]] - total[off[:-1]]) / size

    repeat = 1 - distinct / np.maximum(words, 1)
    extra = np.stack([np.ones(rows), np.minimum(share(_UPPER) * 4, 2), np.minimum(share(_DIGIT) * 8, 2), np.minimum(share(_MARK) * 8, 2),
                      repeat, repeat ** 4, np.log1p(words) / 4, words < 20], axis=1)
    return at, h[one], np.log1p(count).astype(np.float32), extra.astype(np.float32)


def places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two hashed places of a word."""
    return (h % _U(DIMS)).astype(np.int32), (tk.mix(h) % _U(DIMS)).astype(np.int32) + DIMS


def design(row, h, value, extra) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, value) of all non-zero entries; the last places are the shares."""
    first, second = places(h)
    n = len(extra)
    own = np.repeat(np.arange(n, dtype=np.int32), _EXTRA)
    return (np.concatenate([row.astype(np.int32), row.astype(np.int32), own]),
            np.concatenate([first, second, np.tile(2 * DIMS + np.arange(_EXTRA, dtype=np.int32), n)]),
            np.concatenate([value, value, extra.reshape(-1)]))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def likelihood(row: np.ndarray, place: np.ndarray, value: np.ndarray, grade: np.ndarray, each: np.ndarray,
               weights: np.ndarray, cuts: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Weighted negative log likelihood of rows, and its slopes by the weights
    and by the two cuts. ``each`` weighs the rows."""
    n = len(grade)
    s = np.bincount(row, weights=value * weights[place], minlength=n)
    p = _sigmoid(s[:, None] - cuts)
    high = np.where(grade == 0, 1.0, p[np.arange(n), np.maximum(grade - 1, 0)])
    low = np.where(grade == GRADES - 1, 0.0, p[np.arange(n), np.minimum(grade, GRADES - 2)])
    mass = np.maximum(high - low, 1e-9)
    slope = p * (1 - p)
    by_cut = np.stack([(np.where(grade - 1 == k, slope[:, k], 0) - np.where(grade == k, slope[:, k], 0)) / mass
                       for k in range(GRADES - 1)], axis=1) * each[:, None]
    return (-float((each * np.log(mass)).sum()), np.bincount(place, weights=-value * by_cut.sum(axis=1)[row], minlength=len(weights)),
            by_cut.sum(axis=0))


def minimise(f, x: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """L-BFGS with halved steps; ``f`` gives value and slope."""
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    now, g = f(x)
    for _ in range(rounds):
        d, kept = -g, []
        for s, y in reversed(pairs):
            a = s @ d / (s @ y)
            d = d - a * y
            kept.append(a)
        d *= (pairs[-1][0] @ pairs[-1][1]) / (pairs[-1][1] @ pairs[-1][1]) if pairs else 1 / max(np.abs(g).sum(), 1e-12)
        for (s, y), a in zip(pairs, reversed(kept)):
            d = d + (a - y @ d / (s @ y)) * s
        step, fall = 1.0, g @ d
        while step > 1e-4:
            then, slope = f(x + step * d)
            if then <= now + 1e-4 * step * fall:
                break
            step /= 2
        else:
            return x
        s, y = step * d, slope - g
        if s @ y > 1e-12:
            pairs = [*pairs, (s, y)][-MEMORY:]
        x, g, gain, now = x + s, slope, now - then, then
        if gain < 1e-6 * max(now, 1e-12):
            return x
    return x


def grades(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One grade per labelled id."""
    g = F.when(F.col("toxic") > 0, 0).when(F.col("quality") > 0, 2).when(F.col("quality").isNotNull(), 1)
    return (labels.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("__lid"), g.alias("__grade"))
            .where(F.col("__grade").isNotNull()).groupBy("__lid").agg(F.min("__grade").alias("__grade")))


def _entries(batches):
    for batch in batches:
        for lo, hi, data, off in tk.pieces(batch, "__t"):
            row, h, value, extra = features(data, off)
            order = np.argsort(row, kind="stable")
            bounds = np.searchsorted(row[order], np.arange(hi - lo + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("__grade")[lo:hi], tk.lists(tk.as_long(h[order]), bounds),
                 tk.lists(value[order], bounds), tk.lists(extra.reshape(-1), np.arange(hi - lo + 1) * _EXTRA)],
                ["__grade", "__h", "__v", "__x"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
        fit_rows: int = FIT_ROWS) -> dict | None:
    """The model, or None without labelled rows."""
    graded = grades(labels, id_col)
    n = graded.count()
    if not n:
        return None
    pick = F.pmod(F.xxhash64(F.lit("quality-sample"), F.col("__lid").cast("string")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    # the sample of labels is bounded by fit_rows; texts are read for these ids only
    sample = F.broadcast(graded.where(pick < min(1.0, fit_rows / n)).limit(fit_rows * 2))
    known = docs.join(sample, docs[id_col] == F.col("__lid")).select("__grade", F.col(text_col).alias("__t"))
    rows = cut_lineage(known.mapInArrow(_entries, "__grade int, __h array<bigint>, __v array<float>, __x array<float>"), "op8-sample")
    count = {r["__grade"]: r["n"] for r in rows.groupBy("__grade").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not count:
        return None
    # rarer grades count more, by the root of their share; all rows weigh 1 together
    total = sum(count.values())
    share = np.array([(total / (GRADES * max(count.get(k, 0), 1))) ** 0.5 for k in range(GRADES)])
    share /= sum(share[k] * n for k, n in count.items())
    size = 2 * DIMS + _EXTRA
    # one aggregated row per place: at most ``size``
    used = _summed(rows, _places_used, "n bigint")
    seen = np.zeros(size, np.int64)
    seen[used.column("place").to_numpy()] = used.column("n").to_numpy()
    free = seen >= MIN_ROWS
    free[2 * DIMS:] = True
    sc = rows.sparkSession.sparkContext

    def value(theta: np.ndarray) -> tuple[float, np.ndarray]:
        weights = np.zeros(size)
        weights[free] = theta[:-2]
        held = sc.broadcast((weights, _cuts(theta), share))
        got = _summed(rows, _slopes(held), "n bigint")
        held.destroy()
        sums = np.zeros(size + 3)
        sums[got.column("place").to_numpy()] = got.column("n").to_numpy() / UNIT
        loss, (first, second) = sums[size + 2], sums[size:size + 2]
        slope = np.append(sums[:size][free] + RIDGE * theta[:-2], [first + second, second * np.exp(theta[-1])])
        return loss + RIDGE / 2 * float(theta[:-2] @ theta[:-2]), slope

    theta = minimise(value, np.append(np.zeros(int(free.sum())), [-1.0, 0.0]))
    weights = np.zeros(size, np.float32)
    weights[free] = theta[:-2]
    return {"weights": weights, "cuts": _cuts(theta)}


def _cuts(theta: np.ndarray) -> np.ndarray:
    """The ordered thresholds: the first, and the log of the distance to the second."""
    return np.array([theta[-2], theta[-2] + np.exp(theta[-1])])


def _design(batch: pa.RecordBatch):
    """(row, place, value), grades and number of rows of a batch of the sample."""
    h = batch.column("__h")
    row = np.repeat(np.arange(len(batch), dtype=np.int32), np.diff(h.offsets.to_numpy()))
    extra = batch.column("__x").flatten().to_numpy().reshape(len(batch), _EXTRA)
    return design(row, h.flatten().to_numpy().view(_U), batch.column("__v").flatten().to_numpy(), extra)


def _told(place: np.ndarray, n: np.ndarray):
    for lo in range(0, len(place), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(place[lo:lo + 100_000].astype(np.int32)), pa.array(n[lo:lo + 100_000].astype(np.int64))], ["place", "n"])


def _places_used(batches):
    total = np.zeros(2 * DIMS + _EXTRA, np.int64)
    for batch in batches:
        for lo in range(0, len(batch), 512):
            total += np.bincount(_design(batch.slice(lo, 512))[1], minlength=len(total))
    at = np.flatnonzero(total)
    yield from _told(at, total[at])


def _slopes(held):
    """Tasks: slopes by place, then by the cuts, then the value, as whole numbers."""
    def run(batches):
        weights, cuts, share = held.value
        total = np.zeros(len(weights) + 3)
        for batch in batches:
            for lo in range(0, len(batch), 512):
                part = batch.slice(lo, 512)
                grade = part.column("__grade").to_numpy().astype(np.int64)
                loss, by_weight, by_cut = likelihood(*_design(part), grade, share[grade], weights, cuts)
                total[:-3] += by_weight
                total[-3:-1] += by_cut
                total[-1] += loss
        at = np.flatnonzero(total)
        yield from _told(at, np.rint(total[at] * UNIT))
    return run


def _summed(rows: DataFrame, run, column: str) -> pa.Table:
    return rows.mapInArrow(run, "place int, " + column).groupBy("place").agg(F.sum("n").alias("n")).toArrow().combine_chunks()


def score_rows(model: dict, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """P(grade > 0) and P(grade > 1) per row."""
    row, place, value = design(*features(data, off))
    s = np.bincount(row, weights=value * model["weights"][place], minlength=len(off) - 1)
    return _sigmoid(s[:, None] - model["cuts"])


def rate(docs: DataFrame, model: dict | None, text_col: str = "text", *, clean: float = 0.5, good: float = 0.5) -> DataFrame:
    """``docs`` with ``expected_grade``, ``p_clean``, ``p_good``, ``keep``."""
    names = ["expected_grade", "p_clean", "p_good", "keep"]
    out = docs.drop(*names)
    if model is None:
        return out.withColumns({"expected_grade": F.lit(1.0), "p_clean": F.lit(0.5), "p_good": F.lit(0.5), "keep": F.lit(True)})
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for lo, hi, data, off in tk.pieces(batch, text_col):
                p = score_rows(held.value, data, off)
                cols = [c[lo:hi] for c in batch.columns]
                yield pa.RecordBatch.from_arrays(
                    [*cols, pa.array(p.sum(axis=1)), pa.array(p[:, 0]), pa.array(p[:, 1]), pa.array((p[:, 0] >= clean) & (p[:, 1] >= good))],
                    [*batch.schema.names, *names])

    schema = T.StructType([*out.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names[:3]], T.StructField("keep", T.BooleanType())])
    return out.mapInArrow(run, schema)
