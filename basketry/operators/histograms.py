"""Exact NTILE and RANK from value histograms: no row is sorted or moved.

:func:`ntiles` finds, for several orders at once, the row that ends each tile
(its value and its tie). Every boundary is a selection problem: of the rows in
an interval of values, which value holds the wanted place? One aggregation a
round counts the rows of all open intervals in ``BINS`` equal bins, with the
least and greatest value of each; the bin that holds the place becomes the
interval, until it is one value. Where a value is shared, the same is done for
the tie column among the rows of that value alone. A tile then is the number of
boundaries before a row, plus one: a projection against a few constants.
Only bin counts reach the driver (intervals x ``BINS`` rows at most).

:func:`histogram_rank` ranks the distinct values instead of the rows: counts by
value, added up within equal bins of the value range and over the bins, give the
number of rows before each value; ranks are joined back by value.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .joins import MAX_BROADCAST_BYTES, measured_bytes

BINS = 2048


@dataclass
class Order:
    """One NTILE to find: by ``col`` (numeric, no NaN), NULLs last."""
    col: str
    out: str
    ascending: bool = True

    def value(self) -> Column:
        """Ascending in the order wanted (negated for DESC)."""
        return F.col(self.col) if self.ascending else -F.col(self.col)


@dataclass
class _Search:
    """A place (from 1) looked for among the rows where ``among`` holds, by ``value``."""
    value: Column
    among: Column
    place: int
    low: object
    high: object
    before: int = 0  # rows below the interval
    found: dict = field(default_factory=dict)


def _bin(s: _Search) -> Column:
    """The bin of a value in the search's interval; exact for whole numbers of 64 bits."""
    above = s.value - F.lit(s.low)
    if isinstance(s.low, int):
        step = -(-(s.high - s.low + 1) // BINS)
        return F.round((above - above % step) / step).cast("int")
    return F.least(F.floor(above / F.lit(s.high - s.low) * BINS), F.lit(BINS - 1)).cast("int")


def _select(df: DataFrame, searches: Sequence[_Search]) -> None:
    """Set each search's ``low`` to the value that holds its place, and
    ``before`` to the number of its rows below that value."""
    while True:
        todo = [(i, s) for i, s in enumerate(searches) if s.low != s.high]
        if not todo:
            return
        parts = []
        for i, s in todo:
            inside = s.among & (s.value >= F.lit(s.low)) & (s.value <= F.lit(s.high))
            whole = isinstance(s.low, int)
            parts.append(F.when(inside, F.struct(
                F.lit(i).alias("i"), _bin(s).alias("bin"),
                (s.value if whole else F.lit(None)).cast("long").alias("l"), (F.lit(None) if whole else s.value).cast("double").alias("d"))))
        hit = df.select(F.explode(F.array_compact(F.array(*parts))).alias("h")).select("h.*")
        ends = [f(c).alias(f"{c}{n}") for c in ("l", "d") for n, f in (("low", F.min), ("high", F.max))]
        bins = hit.groupBy("i", "bin").agg(F.count(F.lit(1)).alias("n"), *ends).collect()
        for i, s in todo:
            kind = "l" if isinstance(s.low, int) else "d"
            for b in sorted((b for b in bins if b["i"] == i), key=lambda b: b["bin"]):
                if s.before + b["n"] >= s.place:
                    s.low, s.high = b[f"{kind}low"], b[f"{kind}high"]
                    break
                s.before += b["n"]


def ntiles(df: DataFrame, k: int, orders: Sequence[Order], tie_col: str) -> DataFrame:
    """``df`` with NTILE(k) (int) for each of ``orders``, NULLs last, ties in
    ascending order of ``tie_col`` (a unique whole number). ``df`` should be a
    written table: it is read once a round."""
    if k <= 0:
        raise ValueError("ntile bucket count must be positive")
    tie = F.col(tie_col)
    row = df.agg(F.count(F.lit(1)).alias("n"), *[x for i, o in enumerate(orders) for x in (
        F.count(o.col).alias(f"n{i}"), F.min(o.value()).alias(f"low{i}"), F.max(o.value()).alias(f"high{i}"))],
        *[x for i, o in enumerate(orders) for x in (F.min(F.when(F.col(o.col).isNull(), tie)).alias(f"nulls_low{i}"),
                                                    F.max(F.when(F.col(o.col).isNull(), tie)).alias(f"nulls_high{i}"))]).first()
    n, q, rest = row["n"], row["n"] // k, row["n"] % k
    # the places of the last rows of all tiles but the last; empty tiles have none
    ends = sorted({p for j in range(1, k) if 0 < (p := j * q + min(j, rest)) < n})
    by_value, by_null = {}, {}
    for i, o in enumerate(orders):
        for p in ends:
            if p <= row[f"n{i}"]:
                by_value[i, p] = _Search(o.value(), F.col(o.col).isNotNull(), p, row[f"low{i}"], row[f"high{i}"])
            else:
                by_null[i, p] = _Search(tie, F.col(o.col).isNull(), p - row[f"n{i}"], row[f"nulls_low{i}"], row[f"nulls_high{i}"])
    _select(df, list(by_value.values()))
    shared = {at: _Search(tie, s.among & (s.value == F.lit(s.low)), s.place - s.before, None, None) for at, s in by_value.items()}
    if shared:
        bounds = df.agg(*[x for j, s in enumerate(shared.values()) for x in (
            F.min(F.when(s.among, tie)).alias(f"low{j}"), F.max(F.when(s.among, tie)).alias(f"high{j}"))]).first()
        for j, s in enumerate(shared.values()):
            s.low, s.high = bounds[f"low{j}"], bounds[f"high{j}"]
    _select(df, [*shared.values(), *by_null.values()])
    out = df
    for i, o in enumerate(orders):
        null = F.col(o.col).isNull()
        after = F.lit(1)
        for p in ends:
            if (i, p) in by_value:
                v, t = by_value[i, p].low, int(shared[i, p].low)
                behind = null | (o.value() > F.lit(v)) | ((o.value() == F.lit(v)) & (tie > F.lit(t)))
            else:
                behind = null & (tie > F.lit(int(by_null[i, p].low)))
            after = after + F.when(F.coalesce(behind, F.lit(False)), 1).otherwise(0)
        out = out.withColumn(o.out, after.cast("int"))
    return out


def histogram_rank(df: DataFrame, group_cols: Sequence[str], value_col: str, out: str, ascending: bool = False,
                   nulls_last: bool = False) -> DataFrame:
    """``df`` with RANK() OVER (PARTITION BY group_cols ORDER BY value_col) as
    ``out`` (int): one more than the number of rows of the group before the
    value. Ties and hot values are one row each of the histogram; a group's
    histogram is cut into ``BINS`` bins of the value range, so a hot group is
    spread as well. The ranks join back by value, broadcast if they measure
    at most 64 MB."""
    group_cols = list(group_cols)
    v = F.col(value_col)
    hist = cut_lineage(df.groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias("__n")), "histogram")
    low, high = hist.agg(F.min(v).cast("double"), F.max(v).cast("double")).first()
    width = (high - low) if low is not None and high > low else 1.0
    place = F.least(F.floor((v.cast("double") - F.lit(low or 0.0)) / F.lit(width) * BINS), F.lit(BINS - 1)).cast("int")
    nulls_bin = BINS if nulls_last == ascending else -1  # at the end that NULLs take in this order
    binned = hist.withColumn("__bin", F.when(v.isNull(), F.lit(nulls_bin)).otherwise(place))
    before = lambda w: F.coalesce(F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    direct = (lambda c: F.col(c).asc()) if ascending else (lambda c: F.col(c).desc())
    inside = binned.withColumn("__in", before(Window.partitionBy(*group_cols, "__bin").orderBy(direct(value_col))))
    per_bin = binned.groupBy(*group_cols, "__bin").agg(F.sum("__n").alias("__n"))
    # at most BINS + 1 rows a group; without groups one bounded task
    bins = per_bin.withColumn("__off", before(Window.partitionBy(*group_cols).orderBy(direct("__bin")))).drop("__n")
    keyed = _renamed(bins, [*group_cols, "__bin"], "__b_")
    ranks = inside.join(keyed, _same(inside, keyed, [*group_cols, "__bin"], "__b_"))
    ranks = ranks.select(*group_cols, value_col, (F.col("__off") + F.col("__in") + 1).cast("int").alias(out))
    keys = [*group_cols, value_col]
    ranks = _renamed(cut_lineage(ranks, "ranks"), keys, "__r_")
    small = F.broadcast(ranks) if measured_bytes(ranks) <= MAX_BROADCAST_BYTES else ranks
    return df.join(small, _same(df, ranks, keys, "__r_"), "left").drop(*[f"__r_{c}" for c in keys])


def _renamed(df: DataFrame, cols: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in cols})


def _same(left: DataFrame, right: DataFrame, cols: Sequence[str], prefix: str) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[prefix + c])
    return cond
