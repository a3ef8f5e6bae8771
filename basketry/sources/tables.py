"""Versioned tables in shared storage (the sink of every model).

Layout of a table ``root/name``::

    data/seg=000001/part-*.parquet   a segment: rows of one load
    data/seg=000003/part-*.parquet
    keys/seg=000003/part-*.parquet   the segment's Bloom filter, one row per word
    _versions/000003                 marker: segments, schema and key bounds of version 3

A commit writes its rows to a new segment folder (Spark's job commit makes
it appear whole) and only then creates the version's marker, listing the
segments that make up the version. Readers take the highest marker, so they
never see a partial version, and a segment being read is never overwritten
or deleted. Nothing is renamed, which also holds on object stores. A crash
between the two steps leaves an unlisted folder that the next commit
overwrites. One writer per table.

* :func:`commit` writes a whole new version (one segment).
* :func:`append` adds rows as one more segment: an incremental load costs
  the size of the batch, not of the table. :func:`compact` rewrites the table
  into one segment, :func:`expire` deletes versions no longer wanted; nothing
  calls them by itself.
* :func:`upsert_commit` adds the updates as a segment. Where update keys are in
  the table already, only the segments that hold them are rewritten, in one
  write with dynamic partition overwrite of the new segments' folders; all
  other files stay.
* The marker keeps the *schema* of its version. Segments written before a column
  was added are read with NULL in it; nothing is rewritten for it.
* With ``prune`` (a column that the key determines) each segment has the bounds
  of that column in the marker and a blocked Bloom filter next to its rows: one
  64-bit word per :data:`KEYS_PER_WORD` keys, made and probed by joins on the
  word, so it grows with the data and never passes through the driver.
  :func:`holding` names the segments that may hold given keys; the others are
  not scanned.

Markers go through the Hadoop FileSystem of the path (HDFS, object store or
local), so bookkeeping costs no Spark job.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import COMPACT, free_shuffles, share, shares_of, write_shares

# Keys per word and bits set per key: one absent key in some 200 passes.
KEYS_PER_WORD, BITS_PER_KEY = 4, 4
_END = "end"  # last line of a whole marker


def _jvm(spark: SparkSession):
    return spark.sparkContext._jvm


def _fs(spark: SparkSession, path: str):
    p = _jvm(spark).org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _base(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def segment_path(root: str, name: str, segment: int) -> str:
    """Folder of one segment of ``root/name``."""
    return f"{_base(root, name)}/data/seg={segment:06d}"


def _numbers(spark: SparkSession, root: str, name: str) -> list[int]:
    """Numbers of all markers, those of a crashed commit included, ascending."""
    fs, p = _fs(spark, f"{_base(root, name)}/_versions")
    if not fs.exists(p):
        return []
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(p) if s.getPath().getName().isdigit())


def _marker(spark: SparkSession, root: str, name: str, version: int) -> dict | None:
    """What a marker says, or None when its writer crashed midway."""
    fs, p = _fs(spark, f"{_base(root, name)}/_versions/{version:06d}")
    stream = fs.open(p)
    try:
        lines = _jvm(spark).org.apache.commons.io.IOUtils.toString(stream, "UTF-8").splitlines()
    finally:
        stream.close()
    return json.loads(lines[0]) if len(lines) == 2 and lines[1] == _END else None


def versions(spark: SparkSession, root: str, name: str) -> list[int]:
    """Committed versions, ascending."""
    return [v for v in _numbers(spark, root, name) if _marker(spark, root, name, v) is not None]


def current_version(spark: SparkSession, root: str, name: str) -> int | None:
    """Highest committed version, or None if the table has none."""
    return next((v for v in reversed(_numbers(spark, root, name))
                 if _marker(spark, root, name, v) is not None), None)


def _next_version(spark: SparkSession, root: str, name: str) -> int:
    """Above every marker and every listed segment (rewritten segments take
    numbers behind their version's own)."""
    numbers = _numbers(spark, root, name)
    current = next((m for v in reversed(numbers) if (m := _marker(spark, root, name, v))), None)
    return max([*numbers, *(s["id"] for s in current["segments"])] if current else numbers, default=0) + 1


def exists(spark: SparkSession, root: str, name: str) -> bool:
    """True when ``root/name`` has a committed version."""
    return current_version(spark, root, name) is not None


def _about(spark: SparkSession, root: str, name: str, version: int | None = None) -> dict:
    """The marker of a version (default: the current one): its ``segments``
    (each with ``id``, ``columns`` and, with pruning, ``keys``), ``schema`` and
    ``properties``."""
    v = version if version is not None else current_version(spark, root, name)
    if v is None:
        raise FileNotFoundError(f"table {name} has no committed version under {root}")
    about = _marker(spark, root, name, v)
    if about is None:
        raise FileNotFoundError(f"version {v} of table {name} under {root} was not committed")
    return about


def segments(spark: SparkSession, root: str, name: str, version: int | None = None) -> list[int]:
    """Segment numbers that make up a version (default: the current one)."""
    return [s["id"] for s in _about(spark, root, name, version)["segments"]]


def columns_by_segment(spark: SparkSession, root: str, name: str) -> tuple[T.StructType, dict[str, list[str]]]:
    """The current schema, and the columns that each segment folder holds."""
    about = _about(spark, root, name)
    return (T.StructType.fromJson(about["schema"]),
            {segment_path(root, name, s["id"]): s["columns"] for s in about["segments"]})


def properties(spark: SparkSession, root: str, name: str) -> dict:
    """What the writer of the current version noted with it."""
    return _about(spark, root, name)["properties"]


def paths(spark: SparkSession, root: str, name: str, version: int | None = None) -> list[str]:
    """Segment folders of a version (default: the current one)."""
    return [segment_path(root, name, s) for s in segments(spark, root, name, version)]


def _mark(spark: SparkSession, root: str, name: str, version: int, segs: Sequence[dict], schema: T.StructType,
          notes: dict | None = None) -> None:
    about = {"segments": list(segs), "schema": schema.jsonValue(), "properties": notes or {}}
    fs, p = _fs(spark, f"{_base(root, name)}/_versions/{version:06d}")
    out = fs.create(p, False)
    try:
        out.write(bytearray((json.dumps(about) + "\n" + _END).encode()))
    finally:
        out.close()


# --- key bounds and Bloom filters ---------------------------------------------
def _word_and_bits(key: Column, words: Column) -> tuple[Column, Column]:
    """The word of a key and the bits it sets there; ``words`` is a power of two."""
    spread = F.xxhash64(key, F.lit(1))
    bits = F.lit(0).cast("long")
    for i in range(BITS_PER_KEY):
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(spread, 6 * i).bitwiseAND(F.lit(63)).cast("int")))
    return F.xxhash64(key).bitwiseAND(words - 1), bits


def _describe(spark: SparkSession, root: str, name: str, segment: int, schema: T.StructType, prune: str | None) -> dict:
    """A written segment's entry in the marker; with ``prune`` its Bloom filter
    is written as well (columns of whole numbers or text; others go unpruned)."""
    entry: dict = {"id": segment, "columns": schema.names}
    if prune and isinstance(schema[prune].dataType, (T.LongType, T.IntegerType, T.StringType)):
        rows = spark.read.schema(schema).parquet(segment_path(root, name, segment)).select(prune).where(F.col(prune).isNotNull())
        low, high, n = rows.agg(F.min(prune), F.max(prune), F.approx_count_distinct(prune)).first()
        words = 1 << max(0, (n // KEYS_PER_WORD).bit_length())
        word, bits = _word_and_bits(F.col(prune), F.lit(words).cast("long"))
        (rows.groupBy(word.alias("word")).agg(F.bit_or(bits).alias("bits"))
         .write.mode("overwrite").options(**COMPACT).parquet(f"{_base(root, name)}/keys/seg={segment:06d}"))
        entry["keys"] = {"column": prune, "low": low, "high": high, "words": words}
    return entry


def holding(keys: DataFrame, root: str, name: str, prune: str) -> list[int]:
    """Segments of ``root/name`` that may hold one of ``keys`` (column
    ``prune``): by their bounds, then by their Bloom filters. Segments without
    either are always named. NULL keys are nowhere."""
    spark = keys.sparkSession
    entries = _about(spark, root, name)["segments"]
    keys = keys.select(prune).where(F.col(prune).isNotNull())
    low, high = keys.agg(F.min(prune), F.max(prune)).first()
    if low is None:
        return []
    unknown = [s["id"] for s in entries if s.get("keys", {}).get("column") != prune]
    near = [s for s in entries if s["id"] not in unknown and s["keys"]["low"] is not None
            and s["keys"]["low"] <= high and s["keys"]["high"] >= low]
    if not near:
        return sorted(unknown)
    # a row per key and segment whose bounds hold the key, met by the one word it needs
    bounds = F.array(*[F.struct(F.lit(s["id"]).alias("seg"), F.lit(s["keys"]["low"]).alias("low"), F.lit(s["keys"]["high"]).alias("high"),
                                F.lit(s["keys"]["words"]).cast("long").alias("words")) for s in near])
    asked = keys.distinct().select(prune, F.explode(F.filter(bounds, lambda b: F.col(prune).between(b["low"], b["high"]))).alias("b"))
    word, bits = _word_and_bits(F.col(prune), F.col("b.words"))
    asked = asked.select(F.col("b.seg").alias("seg"), word.alias("word"), bits.alias("asked"))
    base = f"{_base(root, name)}/keys"
    filters = spark.read.option("basePath", base).parquet(*[f"{base}/seg={s['id']:06d}" for s in near])
    met = asked.join(filters.select(F.col("seg").cast("int").alias("seg"), "word", "bits"), ["seg", "word"])
    hit = met.where(F.col("bits").bitwiseAND(F.col("asked")) == F.col("asked")).select("seg").distinct()
    return sorted([*unknown, *(r["seg"] for r in hit.collect())])  # at most one row per segment


def commit(df: DataFrame, root: str, name: str, prune: str | None = None, notes: dict | None = None, shares: int = 1) -> str:
    """Write ``df`` as the whole next version of ``root/name``, in ``shares``
    of its ``prune`` values; returns the segment path."""
    spark = df.sparkSession
    version = _next_version(spark, root, name)
    path = segment_path(root, name, version)
    write_shares(df, path, prune, shares if prune else 1, COMPACT)
    _mark(spark, root, name, version, [_describe(spark, root, name, version, df.schema, prune)], df.schema, notes)
    return path


def _widened(old: T.StructType, new: T.StructType) -> T.StructType:
    """``old`` with the columns that only ``new`` has behind its own."""
    have = set(old.names)
    return T.StructType([*old.fields, *(f for f in new.fields if f.name not in have)])


def append(df: DataFrame, root: str, name: str, prune: str | None = None, notes: dict | None = None) -> str:
    """Add ``df``'s rows to ``root/name`` as a new segment. Columns that the
    table has not yet join its schema, NULL in earlier rows."""
    return upsert_commit(df, root, name, [], append_new_columns=True, prune=prune, notes=notes)


def compact(spark: SparkSession, root: str, name: str) -> str:
    """Rewrite the current version as one segment (maintenance, on request)."""
    return commit(read(spark, root, name), root, name)


def one_per_key(df: DataFrame, key: Sequence[str], latest: Sequence[str] = ()) -> DataFrame:
    """One row per ``key``: of several the one with the greatest ``latest``
    columns, then the greatest of the others, compared column by column in
    table order (nulls first)."""
    first = [c for c in latest if c not in key]
    rest = [c for c in df.columns if c not in key and c not in first]
    return (df.groupBy(*key).agg(F.max(F.struct(*first, *rest)).alias("__row"))
            .select(*key, "__row.*").select(*df.columns))


def _catalog_name(root: str, name: str, version: int) -> str:
    import hashlib
    tag = hashlib.md5(root.rstrip("/").encode()).hexdigest()[:10]
    return f"{BUCKETED_DB}.{name}_{tag}_v{version:06d}"


BUCKETED_DB = "basketry_bucketed"


def commit_bucketed(df: DataFrame, root: str, name: str, buckets: int, key: str) -> str:
    """Like :func:`commit`, with the version written bucketed and sorted by
    ``key`` and registered in the session catalog, so that readers in this
    session scan it bucketed: aggregations and joins on ``key`` need no
    shuffle. Readers without the catalog entry read the plain files."""
    spark = df.sparkSession
    version = _next_version(spark, root, name)
    path = segment_path(root, name, version)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {BUCKETED_DB}")
    (df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).options(**COMPACT).option("path", path)
     .saveAsTable(_catalog_name(root, name, version)))
    _mark(spark, root, name, version, [_describe(spark, root, name, version, df.schema, None)], df.schema)
    return path


def read(spark: SparkSession, root: str, name: str, version: int | None = None, only: Sequence[int] | None = None) -> DataFrame:
    """The given or latest committed version of ``root/name`` in its schema
    (bucketed when it was committed bucketed in this session); with ``only``
    these segments of it."""
    v = version if version is not None else current_version(spark, root, name)
    about = _about(spark, root, name, v)
    schema = T.StructType.fromJson(about["schema"])
    segs = [s["id"] for s in about["segments"] if only is None or s["id"] in only]
    if segs == [v] and only is None and spark.catalog.tableExists(_catalog_name(root, name, v)):
        return spark.table(_catalog_name(root, name, v))
    if not segs:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[segment_path(root, name, s) for s in segs])


def upsert_commit(updates: DataFrame, root: str, name: str, key: Sequence[str],
                  append_new_columns: bool = False, prune: str | None = None, notes: dict | None = None, shares: int = 1) -> str:
    """Upsert ``updates`` into ``root/name`` on ``key`` (none: append).

    The updates are written once, as a segment of their own, in ``shares`` of
    their ``prune`` values. The segments that
    hold update keys (looked for only in those that :func:`holding` names, when
    the key determines ``prune``) are rewritten without them; all others stay as
    they are. Columns new in the updates are added to the table's schema when
    ``append_new_columns``, otherwise left out. ``notes`` are kept with the
    version; an empty batch makes no version unless they changed."""
    spark = updates.sparkSession
    if not exists(spark, root, name):
        return commit(updates, root, name, prune, notes, shares)
    about = _about(spark, root, name)
    schema = T.StructType.fromJson(about["schema"])
    whole = _widened(schema, updates.schema) if append_new_columns else schema
    present = set(updates.columns)
    version = _next_version(spark, root, name)
    path = segment_path(root, name, version)
    rows = updates.select(*[F.col(f.name).cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
                            for f in whole.fields])
    write_shares(rows, path, prune, shares if prune else 1, COMPACT)
    fresh = spark.read.schema(whole).parquet(path)
    if fresh.isEmpty():
        # Nothing new: the unlisted folder is overwritten by the next commit.
        if notes is not None and notes != about["properties"]:
            _mark(spark, root, name, version, about["segments"], schema, notes)
        return segment_path(root, name, about["segments"][-1]["id"])
    entry = _describe(spark, root, name, version, whole, prune)
    kept = {s["id"]: s for s in about["segments"]}
    if key:
        maybe = holding(fresh, root, name, prune) if prune else list(kept)
        replaced = _rewrite_without(fresh, root, name, list(key), maybe, schema, version, prune)
        kept = {i: replaced.get(i, s) for i, s in kept.items()}
    _mark(spark, root, name, version, [*(s for s in kept.values() if s), entry], whole,
          notes if notes is not None else about["properties"])
    return path


def _rewrite_without(fresh: DataFrame, root: str, name: str, key: list[str], maybe: Sequence[int], schema: T.StructType,
                     version: int, prune: str | None) -> dict[int, dict | None]:
    """Those of the segments ``maybe`` that hold keys of ``fresh``, written anew
    without them: old number to the new entry, None where no row is left."""
    spark = fresh.sparkSession
    data = f"{_base(root, name)}/data"
    if not maybe:
        return {}
    read_with_seg = lambda ids: (spark.read.schema(T.StructType([*schema.fields, T.StructField("seg", T.StringType())]))
                                 .option("basePath", data).parquet(*[segment_path(root, name, i) for i in ids]))
    if prune and key != [prune]:
        # a key determines its ``prune`` value: only segments that share one, NULL included, can share a key
        asked = fresh.select(F.col(prune).alias("__asked")).distinct()
        near = read_with_seg(maybe).select(prune, "seg")
        maybe = [int(r["seg"]) for r in near.join(asked, F.col(prune).eqNullSafe(F.col("__asked")), "left_semi").select("seg").distinct().collect()]
        if not maybe:
            return {}
    keys = fresh.select(*key).distinct()
    hit = sorted(int(r["seg"]) for r in read_with_seg(maybe).select(*key, "seg").join(keys, key, "left_semi").select("seg").distinct().collect())
    if not hit:
        return {}
    new = {old: version + 1 + i for i, old in enumerate(hit)}
    rename = F.create_map(*[F.lit(x) for old, to in new.items() for x in (old, f"{to:06d}")])
    left = read_with_seg(hit).join(keys, key, "left_anti").withColumn("seg", F.element_at(rename, F.col("seg").cast("int")))
    fs, _ = _fs(spark, data)
    folder = lambda to: _jvm(spark).org.apache.hadoop.fs.Path(segment_path(root, name, to))
    for to in new.values():  # what a crashed commit may have left there
        fs.delete(folder(to), True)
    shares = shares_of(read_with_seg(hit).count()) if prune else 1
    for i in range(shares):  # only the folders of the new numbers are written
        (share(left, prune, i, shares).write.mode("append" if i else "overwrite").option("partitionOverwriteMode", "dynamic")
         .options(**COMPACT).partitionBy("seg").parquet(data))
        free_shuffles(spark)
    return {old: _describe(spark, root, name, to, schema, prune) if fs.exists(folder(to)) else None for old, to in new.items()}


def expire(spark: SparkSession, root: str, name: str, keep: int = 1) -> int:
    """Delete all but the newest ``keep`` versions, with the segments that only
    they list (maintenance, on request, while nothing reads or writes the
    table). Returns the number of folders deleted."""
    have = versions(spark, root, name)
    wanted = have[-max(keep, 1):]
    used = {s["id"] for v in wanted for s in _marker(spark, root, name, v)["segments"]}
    for v in have[:-max(keep, 1)]:
        fs, p = _fs(spark, f"{_base(root, name)}/_versions/{v:06d}")
        fs.delete(p, False)
    gone = 0
    for part in ("data", "keys"):
        fs, p = _fs(spark, f"{_base(root, name)}/{part}")
        for s in (fs.listStatus(p) if fs.exists(p) else []):
            number = s.getPath().getName().partition("seg=")[2]
            if number.isdigit() and int(number) not in used:
                fs.delete(s.getPath(), True)
                gone += 1
    return gone
