"""Exact, distributed ROW_NUMBER / NTILE / RANK.

A window without PARTITION BY (global NTILE, global RANK) moves every row
into one task; a window partitioned by a hot key (one customer, one order or
one department holding a third of all rows) does the same for that key.
These operators avoid both:

1. ``repartitionByRange`` on a *total* order (the sort keys plus a unique
   tie column) spreads rows evenly, ties and hot groups included, and each
   range partition is sorted locally.
2. ``monotonically_increasing_id`` on the sorted partition encodes
   (partition index, position within partition).
3. Per-partition row counts form a table of at most P rows (P = number of
   range partitions, at most ``spark.sql.shuffle.partitions``): the only
   broadcast, with a proven size bound. Its running sum gives each partition's offset, so
   ``row number = offset + position + 1``.

RANK and per-group numbering are derived from global row numbers with
map-side-combined aggregates (``min(rn)`` per peer group / per group) joined
back on the key; Spark's AQE picks broadcast or a skew-split sort-merge join
from measured sizes.

Correctness note: the tagged frame is consumed twice (counts and
positions) and both must see the same range bounds. Catalyst prunes columns
per consumer, so two range exchanges would differ and each would draw its
own sample. The tagged frame is therefore written once as Parquet under the
shared ``spark.checkpoint.dir`` (:func:`basketry.session.cut_lineage`): both
consumers read the same written rows, lineage and plan size are cut, and a
lost executor costs no recomputation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_MID, _PID, _POS = "__bk_mid", "__bk_pid", "__bk_pos"
_N, _OFF, _TOTAL = "__bk_n", "__bk_off", "__bk_total"
_POS_BITS = 33  # monotonically_increasing_id: partition index << 33 | record number


def sort_key(col, ascending: bool = True, nulls_last: bool | None = None) -> Column:
    """Sort expression with explicit NULL placement (default: SQL-standard
    NULLS LAST for ASC, NULLS FIRST for DESC as in PostgreSQL)."""
    c = F.col(col) if isinstance(col, str) else col
    if nulls_last is None:
        nulls_last = ascending
    if ascending:
        return c.asc_nulls_last() if nulls_last else c.asc_nulls_first()
    return c.desc_nulls_last() if nulls_last else c.desc_nulls_first()


def release(spark) -> int:
    """Delete the numbering anchors written so far (see
    :func:`basketry.session.release_anchors`)."""
    from ..session import release_anchors
    return release_anchors(spark)


def global_row_number(df: DataFrame, order: Sequence[Column], out: str = "rn",
                      num_partitions: int | None = None, keep_total: bool = False) -> DataFrame:
    """Append ``out`` = 1-based position of each row in ``order``.

    ``order`` should be a total order (end with a unique column); with ties
    the numbering among tied rows is arbitrary, as for ROW_NUMBER.
    """
    # Without an explicit count AQE may coalesce adjacent range partitions
    # (order is kept); the single written anchor makes any layout consistent.
    ranged = (df.repartitionByRange(int(num_partitions), *order) if num_partitions
              else df.repartitionByRange(*order))
    # Documented contract of monotonically_increasing_id: the partition index
    # in the upper bits, the record number within the partition in the lower
    # 33 bits; evaluated right after the sort, it is the sorted position.
    tagged = (ranged
              .sortWithinPartitions(*order)
              .select("*", F.spark_partition_id().cast("long").alias(_PID),
                      F.monotonically_increasing_id().alias(_MID)))
    tagged = cut_lineage(tagged, "rownum")
    tagged = tagged.select(
        "*", (F.col(_MID) - F.shiftleft(F.col(_PID), _POS_BITS)).alias(_POS)).drop(_MID)

    counts = tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias(_N))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # At most P rows: a single-task window here is bounded by configuration.
    offsets = counts.select(
        _PID,
        F.coalesce(F.sum(_N).over(before), F.lit(0)).alias(_OFF),
        F.sum(_N).over(whole).alias(_TOTAL),
    )
    if not keep_total:
        offsets = offsets.drop(_TOTAL)
    numbered = (tagged.join(F.broadcast(offsets), _PID)
                .withColumn(out, F.col(_OFF) + F.col(_POS) + F.lit(1))
                .drop(_PID, _POS, _OFF))
    return numbered


def global_ntile(df: DataFrame, k: int, order: Sequence[Column], out: str = "ntile",
                 num_partitions: int | None = None) -> DataFrame:
    """NTILE(k) OVER (ORDER BY order): the first ``n mod k`` tiles hold one
    row more than the rest. ``order`` must be total (add a unique tie column)
    for a deterministic result."""
    if k <= 0:
        raise ValueError("ntile bucket count must be positive")
    rn = "__bk_rn"
    numbered = global_row_number(df, order, rn, num_partitions, keep_total=True)
    total, r_ = F.col(_TOTAL), F.col(rn)
    q = F.floor(total / F.lit(k)).cast("long")
    rem = (total % F.lit(k)).cast("long")
    big = q + F.lit(1)
    cut = rem * big
    tile = (F.when(r_ <= cut, F.floor((r_ - 1) / big) + 1)
            .otherwise(rem + F.floor((r_ - 1 - cut) / F.greatest(q, F.lit(1))) + 1))
    return numbered.withColumn(out, tile.cast("int")).drop(rn, _TOTAL)


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` treating NULL = NULL (as window peers and GROUP BY
    do); the right side's key columns are dropped."""
    renamed = right
    cond = None
    for i, k in enumerate(keys):
        alias = f"__bk_key{i}"
        renamed = renamed.withColumnRenamed(k, alias)
        c = left[k].eqNullSafe(F.col(alias))
        cond = c if cond is None else cond & c
    joined = left.join(renamed, cond, how)
    return joined.drop(*[f"__bk_key{i}" for i in range(len(keys))])


def global_rank(df: DataFrame, order_col: str, ascending: bool = True,
                nulls_last: bool | None = None, tie_cols: Sequence[str] = (),
                out: str = "rank", num_partitions: int | None = None) -> DataFrame:
    """RANK() OVER (ORDER BY order_col): 1 + number of rows strictly before,
    equal keys share a rank, gaps follow ties.

    ``tie_cols`` do not change the result; they spread a hot tied value over
    many range partitions.
    """
    rn = "__bk_rn"
    order = [sort_key(order_col, ascending, nulls_last)] + [sort_key(c) for c in tie_cols]
    numbered = global_row_number(df, order, rn, num_partitions)
    firsts = numbered.groupBy(order_col).agg(F.min(rn).alias("__bk_first"))
    ranked = _null_safe_join(numbered, firsts, [order_col])
    return ranked.withColumn(out, F.col("__bk_first").cast("int")).drop(rn, "__bk_first")


def group_rank(df: DataFrame, group_cols: Sequence[str], order_col: str, ascending: bool = True,
               nulls_last: bool | None = None, tie_cols: Sequence[str] = (),
               out: str = "rank", num_partitions: int | None = None) -> DataFrame:
    """RANK() OVER (PARTITION BY group_cols ORDER BY order_col) without
    sending any group to a single task."""
    rn = "__bk_rn"
    group_cols = list(group_cols)
    order = ([sort_key(g) for g in group_cols] + [sort_key(order_col, ascending, nulls_last)]
             + [sort_key(c) for c in tie_cols])
    numbered = global_row_number(df, order, rn, num_partitions)
    peers = numbered.groupBy(*group_cols, order_col).agg(F.min(rn).alias("__bk_pf"))
    starts = peers.groupBy(*group_cols).agg(F.min("__bk_pf").alias("__bk_gf"))
    peer_rank = _null_safe_join(peers, starts, group_cols).select(
        *group_cols, order_col, (F.col("__bk_pf") - F.col("__bk_gf") + 1).cast("int").alias(out))
    return _null_safe_join(numbered, peer_rank, group_cols + [order_col]).drop(rn)


HOT_ROWS = 1_000_000  # rows of a group that a window takes in one task
_CELLS = 1 << 16


def split_hot(df: DataFrame, group_cols: Sequence[str], hot_rows: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """The rows of ``df`` in groups of at most ``hot_rows`` rows, and the others
    (None: there are none). Groups are counted by hash cell, which sends next to
    nothing; only groups of a cell with more rows are counted one by one, so
    that usually ``df`` is scanned once and comes back as it is. NULL is a group."""
    limit = HOT_ROWS if hot_rows is None else hot_rows
    group_cols = list(group_cols)
    cell = F.pmod(F.xxhash64(*group_cols), F.lit(_CELLS)).alias("__bk_cell")
    counted = df.groupBy(cell).agg(F.count(F.lit(1)).alias(_N)).where(F.col(_N) > limit)
    cells = [r["__bk_cell"] for r in counted.collect()]  # at most _CELLS numbers
    if not cells:
        return df, None
    near = df.select(*group_cols).where(F.array_contains(F.lit(cells).cast("array<bigint>"), cell))
    hot = cut_lineage(near.groupBy(*group_cols).agg(F.count(F.lit(1)).alias(_N)).where(F.col(_N) > limit).select(*group_cols), "hot")
    if hot.isEmpty():
        return df, None
    hot = F.broadcast(hot)  # at most one row per ``hot_rows`` rows
    return _null_safe_join(df, hot, group_cols, "left_anti"), _null_safe_join(df, hot, group_cols, "left_semi")


def window_row_number(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column],
                      out: str = "row_number", size_out: str | None = None) -> DataFrame:
    """:func:`group_row_number` by a window: one shuffle by group, a group in one task."""
    group = Window.partitionBy(*group_cols)
    if size_out:
        df = df.withColumn(size_out, F.count(F.lit(1)).over(group))
    return df.withColumn(out, F.row_number().over(group.orderBy(*order)).cast("int"))


def group_row_number(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column],
                     out: str = "row_number", size_out: str | None = None,
                     num_partitions: int | None = None, hot_rows: int | None = None) -> DataFrame:
    """ROW_NUMBER() OVER (PARTITION BY group_cols ORDER BY order), plus the
    group size as ``size_out`` when requested. ``order`` should make the
    order within each group total.

    Groups of at most ``hot_rows`` rows are numbered by a window (one shuffle);
    the rows of larger ones, or with ``num_partitions`` all rows, by
    :func:`range_row_number`."""
    if num_partitions:
        return range_row_number(df, group_cols, order, out, size_out, num_partitions)
    rest, hot = split_hot(df, group_cols, hot_rows)
    numbered = window_row_number(rest, group_cols, order, out, size_out)
    return numbered if hot is None else numbered.unionByName(range_row_number(hot, group_cols, order, out, size_out))


def range_row_number(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column],
                     out: str = "row_number", size_out: str | None = None,
                     num_partitions: int | None = None) -> DataFrame:
    """:func:`group_row_number` from global row numbers: no group is in one task."""
    rn = "__bk_rn"
    group_cols = list(group_cols)
    full = [sort_key(g) for g in group_cols] + list(order)
    numbered = global_row_number(df, full, rn, num_partitions)
    aggs = [F.min(rn).alias("__bk_gf")]
    if size_out:
        aggs.append(F.count(F.lit(1)).alias(size_out))
    starts = numbered.groupBy(*group_cols).agg(*aggs)
    joined = _null_safe_join(numbered, starts, group_cols)
    return (joined.withColumn(out, (F.col(rn) - F.col("__bk_gf") + 1).cast("int"))
            .drop(rn, "__bk_gf"))
