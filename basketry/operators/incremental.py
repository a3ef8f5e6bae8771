"""Incremental and history operators: upsert, load-time watermark, unseen
keys, append-new-columns, SCD type 2 merge and as-of lookup.

All return lazy DataFrames describing the *next version* of a table; writing
it is done by :mod:`basketry.sources.tables`, which never overwrites the
version being read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import surrogate_key


def upsert(target: DataFrame, updates: DataFrame, key: Sequence[str],
           append_new_columns: bool = False, written: bool = False) -> DataFrame:
    """Rows of ``updates`` replace target rows with the same ``key``; other
    target rows stay. Columns new in ``updates`` are appended (NULL for old
    rows) when ``append_new_columns``, otherwise ignored.

    Plan: an anti join of the target against the update keys (AQE
    broadcasts the keys when the batch is small) plus a union; no row of the
    target passes through the driver. Where both are ``written`` (read back at no
    cost), hashes of their keys are met first: without a common one nothing is
    replaced, and no row of the target is moved.
    """
    key = list(key)
    if not append_new_columns:
        updates = updates.select(*[c for c in target.columns if c in updates.columns])
    if written:
        hashes = [df.select(*key).dropna().select(F.xxhash64(*key).alias("__hash")) for df in (target, updates)]
        if hashes[0].join(hashes[1], "__hash", "left_semi").isEmpty():
            return target.unionByName(updates, allowMissingColumns=True)
    keep = target.join(updates.select(*key), key, "left_anti")
    return keep.unionByName(updates, allowMissingColumns=True)


def watermark(target: DataFrame, col: str):
    """``MAX(col)`` of the target (one scalar; NULL for an empty target)."""
    return target.agg(F.max(col).alias("wm")).first()["wm"]


def newer_than(df: DataFrame, target: DataFrame, col: str, null_loads_all: bool = True) -> DataFrame:
    """Rows of ``df`` with ``col`` later than the target's maximum.

    On an empty target the reference's ``col > (SELECT MAX(col) ...)`` is
    ``col > NULL`` and selects nothing; ``null_loads_all`` (default) loads
    everything instead, which is what a first incremental run needs.
    """
    wm = watermark(target, col)
    if wm is None:
        return df if null_loads_all else df.filter(F.lit(False))
    return df.filter(F.col(col) > F.lit(wm))


def unseen(df: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not in the target: ``key NOT IN
    (SELECT DISTINCT key FROM target)`` as a plain anti join (a NOT IN
    subquery plans as a null-aware join that broadcasts the whole target).
    Rows with a NULL key are dropped as NOT IN does; target keys are
    declared NOT NULL."""
    return df.filter(F.col(key).isNotNull()).join(target.select(key), key, "left_anti")


def scd2_merge(dim: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str],
               effective_date, run_ts, surrogate: str = "product_key") -> DataFrame:
    """Merge a source snapshot into a type-2 dimension.

    * unchanged current rows stay;
    * a changed row is closed (``valid_to`` = effective date, not current)
      and a new current version opens at the effective date with key
      md5(key-effective_date);
    * a row changed again on the date its current version opened is replaced
      in place (same key, no empty version); a change effective before that
      date is an error;
    * keys new in the snapshot open a first version;
    * current rows missing from the snapshot stay current;
    * closed history rows pass through.

    One full outer join of current versions and the snapshot; each joined
    row emits one or two output rows through ``explode``, so the join is
    evaluated once.
    """
    eff = F.to_date(F.lit(effective_date)) if isinstance(effective_date, str) else effective_date
    ts = F.to_timestamp(F.lit(run_ts)) if isinstance(run_ts, str) else run_ts
    tracked = list(tracked)
    history = dim.filter(~F.col("is_current"))
    cur = dim.filter(F.col("is_current")).select(
        key, *[F.col(c).alias(f"c_{c}") for c in tracked],
        F.col(surrogate).alias("c_key"), F.col("valid_from").alias("c_from"),
        F.col("valid_to").alias("c_to"), F.col("created_at").alias("c_created"),
        F.lit(True).alias("c_present"))
    snap = snapshot.select(key, *[F.col(c).alias(f"s_{c}") for c in tracked],
                           F.lit(True).alias("s_present"))
    j = cur.join(snap, key, "full_outer")
    same: Column = F.lit(True)
    for c in tracked:
        same = same & F.col(f"c_{c}").eqNullSafe(F.col(f"s_{c}"))
    both = F.col("c_present").isNotNull() & F.col("s_present").isNotNull()
    late = F.raise_error(F.concat(F.lit("change effective before the current version of "), F.col(key).cast("string")))
    actions = (F.when(both & same, F.array(F.lit("keep")))
               .when(both & (F.col("c_from") > eff), late.cast("array<string>"))
               .when(both & (F.col("c_from") == eff), F.array(F.lit("amend")))
               .when(both, F.array(F.lit("close"), F.lit("open")))
               .when(F.col("c_present").isNotNull(), F.array(F.lit("keep")))
               .otherwise(F.array(F.lit("open"))))
    rows = j.withColumn("action", F.explode(actions))
    is_open = F.col("action") == "open"
    is_new = F.col("action").isin("open", "amend")
    out = rows.select(
        F.when(is_open, surrogate_key(key, eff.cast("string"))).otherwise(F.col("c_key")).alias(surrogate),
        key,
        *[F.when(is_new, F.col(f"s_{c}")).otherwise(F.col(f"c_{c}")).alias(c) for c in tracked],
        F.when(is_open, eff).otherwise(F.col("c_from")).alias("valid_from"),
        F.when(F.col("action") == "close", eff).otherwise(F.col("c_to")).alias("valid_to"),
        (F.col("action") != "close").alias("is_current"),
        F.when(is_new, ts).otherwise(F.col("c_created")).alias("created_at"),
    )
    return history.select(*out.columns).unionByName(out)


def scd2_as_of(dim: DataFrame, as_of) -> DataFrame:
    """Versions valid on ``as_of``: valid_from <= d < valid_to (open end)."""
    d = F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of
    return dim.filter((F.col("valid_from") <= d) & (F.col("valid_to").isNull() | (d < F.col("valid_to"))))


AS_OF_ROWS = 1_000_000  # rows of a key that meet its versions in one group


def as_of_join(rows: DataFrame, versions: DataFrame, key: str, at: str, columns: Sequence[str],
               valid_from: str = "valid_from", valid_to: str = "valid_to", group_rows: int = AS_OF_ROWS) -> DataFrame:
    """``rows`` with ``columns`` of the version of ``key`` that is valid at
    ``at`` (valid_from <= at < valid_to, an open end never passes); NULL where
    there is none, or the key or time is NULL.

    Rows and versions of a key are put in one order of time, versions first, and
    the last version seen is carried forward: one shuffle by key, no range
    predicate and no pair of a row with a version that is not its own. A key
    with more than ``group_rows`` rows is dealt to that many groups by a hash
    of the row, each with a copy of the key's versions.
    """
    names = rows.columns
    plain = rows.select(F.col(key).alias("__key"), F.col(at).alias("__at"), F.struct(*names).alias("__row"))
    timed = F.col("__key").isNotNull() & F.col("__at").isNotNull()
    groups = (plain.where(timed).groupBy("__key").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > group_rows)
              .select("__key", F.ceil(F.col("__n") / group_rows).cast("int").alias("__groups")))
    dealt = plain.where(timed).join(groups, "__key", "left").select(
        "__key", "__at", F.coalesce(F.pmod(F.xxhash64("__row"), F.col("__groups")), F.lit(0)).cast("int").alias("__group"), F.lit(1).alias("__kind"),
        "__row", F.lit(None).cast(_payload(versions, columns, valid_to)).alias("__version"))
    held = (versions.where(F.col(key).isNotNull()).select(F.col(key).alias("__key"), F.col(valid_from).cast(plain.schema["__at"].dataType).alias("__at"),
                                                         F.struct(F.col(valid_to).alias("__to"), *columns).alias("__version"))
            .join(groups, "__key", "left")
            .select("__key", "__at", F.explode(F.sequence(F.lit(0), F.coalesce("__groups", F.lit(1)) - 1)).alias("__group"), F.lit(0).alias("__kind"),
                    F.lit(None).cast(plain.schema["__row"].dataType).alias("__row"), "__version"))
    order = Window.partitionBy("__key", "__group").orderBy("__at", "__kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = held.unionByName(dealt).withColumn("__version", F.last("__version", ignorenulls=True).over(order)).where(F.col("__kind") == 1)
    valid = F.col("__version.__to").isNull() | (F.col("__at") < F.col("__version.__to"))
    found = seen.select("__row.*", *[F.when(valid, F.col(f"__version.{c}")).alias(f"__v_{c}") for c in columns])
    untimed = plain.where(~timed).select("__row.*", *[F.lit(None).cast(versions.schema[c].dataType).alias(f"__v_{c}") for c in columns])
    return found.unionByName(untimed).withColumnsRenamed({f"__v_{c}": c for c in columns})


def _payload(versions: DataFrame, columns: Sequence[str], valid_to: str):
    return versions.select(F.struct(F.col(valid_to).alias("__to"), *columns).alias("v")).schema["v"].dataType
