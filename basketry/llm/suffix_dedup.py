"""Exact substring dedup: sampled suffixes and deep-shallow suffix sorting.

A byte goes when a ``WIDTH``-byte string that covers it also starts earlier
(smaller id, or the same document, earlier start).

1. *Sampling.* Every ``WIDTH``-byte window of a document owns one anchor: the
   leftmost minimum hash among the ``GRAM``-byte strings inside it. Equal
   windows own equal anchors at equal offsets. The windows of one anchor are a
   run of consecutive starts, its region. About one region in 35 bytes is
   shuffled, as packed arrays of hashes, to the task of its anchor's hash.
2. *Regions.* Equal regions of one anchor are copies: all but the earliest go
   whole. An anchor with several different regions is contested: the earliest
   of each is resolved by windows.
3. *Suffix sorting.* The bytes of contested regions meet by anchor. All their
   suffixes that start a window are sorted by deep-shallow sorting
   (:func:`deep_shallow`): multikey quicksort to ``SHALLOW`` bytes, then blind
   tries for the groups that still share their prefix. Runs of suffixes equal
   over ``WIDTH`` bytes are copies: all starts but the earliest go.
4. Removed runs meet their documents once and are cut out.

Texts travel zstd-compressed. Long texts are cut into overlapping sections, so
no array follows the length of a text in step 1.

Defined cases: null text is empty; texts under ``WIDTH`` bytes lose nothing;
ids must be integers, null is ordered last; rows with the same id and text are
one document, same id and different texts are ordered by a hash of the text;
extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import textkit as tk

WIDTH, GRAM, SHALLOW = 100, 32, 24
_SECTION = 1 << 23
_BITS = 24  # positions inside a section
_U = np.uint64
_REGION = np.dtype([("anchor", "<u8"), ("body", "<u8"), ("id", "<i8"), ("text", "<i8"), ("start", "<i8"), ("last", "<i4"), ("at", "<i4")])
_WIRE = np.dtype([("anchor", "<u8"), ("body", "<u8"), ("row", "<u4"), ("start", "<u4"), ("last", "u1"), ("at", "u1")])


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of all GRAM-byte strings, by doubling."""
    h, size = tk.mix(data.astype(_U) + _U(0x1000)), 1
    while size < GRAM:
        h = h[:-size] * _U(0x9FB21C651E98DF25 + 2 * size) + h[size:]
        h ^= h >> _U(29)
        size *= 2
    return tk.mix(h)


def regions(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of rows laid one after the other: row, first start, last start, anchor
    position (all in ``data``), anchor hash and body hash of each region."""
    size = np.diff(off)
    rows = np.flatnonzero(size >= WIDTH)
    if not len(rows):
        z = np.zeros(0, np.int64)
        return z, z, z, z, z.view(_U), z.view(_U)
    step = np.zeros(len(data) + 1, np.int8)
    step[off[rows]] += 1
    step[off[rows] + size[rows] - WIDTH + 1] -= 1
    grams = _gram_hashes(data)
    low = (grams >> _U(_BITS) << _U(_BITS)) | np.arange(len(grams), dtype=_U)
    span, have = WIDTH - GRAM + 1, 1
    while 2 * have <= span:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < span:
        low = np.minimum(low[:have - span], low[span - have:])
    window = np.flatnonzero(np.cumsum(step[:-1], dtype=np.int8) > 0)
    at = (low[window] & _U((1 << _BITS) - 1)).astype(np.int64)
    new = np.ones(len(window), bool)
    new[1:] = (at[1:] != at[:-1]) | (window[1:] != window[:-1] + 1)
    first = np.flatnonzero(new)
    start, last, at = window[first], window[np.append(first[1:], len(window)) - 1], at[first]
    body = tk.mix(tk.run_hashes(data, start, last + WIDTH) + (at - start).astype(_U))
    return np.searchsorted(off, start, "right") - 1, start, last, at, grams[at], body


def _sections(batch):
    """(first row, bytes, offsets, start of the bytes in the row) of pieces; a
    long row comes as overlapping sections."""
    for lo, hi, data, off in tk.pieces(batch, "__t"):
        if hi - lo > 1 or len(data) <= _SECTION:
            yield lo, data, off, 0
        else:
            for a in range(0, len(data) - WIDTH + 1, _SECTION):
                part = data[a:a + _SECTION + WIDTH - 1]
                yield lo, part, np.array([0, len(part)]), a


def _region_batches(buckets: int):
    """Packed regions of a section by bucket; equal regions of a section stay
    one, the others are told as gone."""
    def run(batches):
        for batch in batches:
            ids, texts = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("__d", "__x"))
            for lo, data, off, base in _sections(batch):
                row, start, last, at, anchor, body = regions(data, off)
                if not len(row):
                    continue
                wire = np.zeros(len(row), _WIRE)
                wire["anchor"], wire["body"], wire["row"] = anchor, body, row
                wire["start"], wire["last"], wire["at"] = start - off[row] + base, last - start, at - start
                bucket = (anchor >> _U(20)) % _U(buckets)
                order = np.argsort(bucket, kind="stable")
                wire, bucket = wire[order], bucket[order]
                cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
                ends = np.append(cut[1:], len(wire))
                out = []
                for a, b in zip(cut, ends):
                    part = wire[a:b]
                    used, part_row = np.unique(part["row"], return_inverse=True)
                    part = part.copy()
                    part["row"] = part_row
                    head = np.stack([ids[lo + used], texts[lo + used]], axis=1).astype(np.int64)
                    out.append(len(used).to_bytes(4, "little") + head.tobytes() + part.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[cut].astype(np.int32)), pa.array(out, pa.binary())], ["__b", "__w"])
    return run


def _unpack(packed: bytes) -> np.ndarray:
    n = int.from_bytes(packed[:4], "little")
    head = np.frombuffer(packed, np.int64, 2 * n, 4).reshape(n, 2)
    wire = np.frombuffer(packed, _WIRE, offset=4 + 16 * n)
    out = np.zeros(len(wire), _REGION)
    for c in ("anchor", "body", "start", "last", "at"):
        out[c] = wire[c]
    out["id"], out["text"] = head[wire["row"], 0], head[wire["row"], 1]
    return out


def _settle(batches):
    """Copied regions (``__anchor`` null) and contested ones of a partition."""
    got = [_unpack(x.as_py()) for batch in batches for x in batch.column("__w")]
    if not got:
        return
    r = np.concatenate(got)
    del got
    r = r[np.lexsort((r["start"], r["text"], r["id"], r["body"], r["anchor"]))]
    new_anchor = np.append(True, r["anchor"][1:] != r["anchor"][:-1])
    new_body = new_anchor | np.append(True, r["body"][1:] != r["body"][:-1])
    group = np.cumsum(new_anchor) - 1
    contested = (np.bincount(group, weights=new_body)[group] > 1) & new_body
    # one document's rows may come twice: the same place is not a copy of itself
    head = np.flatnonzero(new_body)[np.cumsum(new_body) - 1]
    same = (r["id"] == r["id"][head]) & (r["text"] == r["text"][head]) & (r["start"] == r["start"][head])
    for keep, anchored in ((~new_body & ~same, False), (contested, True)):
        rows = r[keep]
        for lo in range(0, len(rows), 100_000):
            x = rows[lo:lo + 100_000]
            key = pa.array(x["anchor"].view(np.int64), mask=np.full(len(x), not anchored))
            yield pa.RecordBatch.from_arrays(
                [key, pa.array(x["id"]), pa.array(x["text"]), pa.array(x["start"]), pa.array(x["start"] + x["last"])],
                ["__anchor", "__d", "__x", "__s", "__e"])


def _words(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Big-endian 8-byte words of ``data`` at the positions."""
    return np.lib.stride_tricks.sliding_window_view(data, 8)[at].copy().view(">u8").reshape(-1).astype(_U)


def _common(data: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int, limit: int) -> np.ndarray:
    """Common prefix lengths of suffixes, from ``depth`` on, at most ``limit``."""
    got = np.full(len(a), limit)
    live = np.arange(len(a))
    while depth < limit and len(live):
        diff = _words(data, a[live] + depth) ^ _words(data, b[live] + depth)
        hit = diff != 0
        x = diff[hit]
        lead = np.zeros(len(x), np.int64)
        for shift in (32, 16, 8):
            zero = x < (_U(1) << _U(64 - shift))
            lead += zero * (shift // 8)
            x = np.where(zero, x << _U(shift), x)
        got[live[hit]] = np.minimum(limit, depth + lead)
        live = live[~hit]
        depth += 8
    return got


def deep_shallow(data: np.ndarray, suffixes: np.ndarray, limit: int = WIDTH, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes by their first ``limit`` bytes (each has that
    many), and whether each in that order equals the one before it.

    All groups of one round are handled together. Shallow rounds are multikey
    quicksort on 8-byte characters: a group splits at its pivot into smaller,
    equal and larger, and the equal part moves on by one character. Groups
    equal over ``shallow`` bytes go on as blind tries: a leader is the path, the
    others hang from it by branching position and branching byte."""
    n = len(suffixes)
    data = np.concatenate([data, np.zeros(8, np.uint8)])
    order = np.arange(n)
    start = np.zeros(n, np.int64)  # first place of the group
    depth = np.zeros(n, np.int64)  # bytes known equal in the group
    place = np.arange(n) if n > 1 else np.zeros(0, np.int64)  # places of unfinished groups

    def split(place, key, known):
        """Order the places' groups by ``key``; the places still unfinished."""
        rank = np.lexsort((key, start[place]))
        order[place], depth[place] = order[place[rank]], known[rank]
        key, group = key[rank], start[place]
        new = np.append(True, (group[1:] != group[:-1]) | (key[1:] != key[:-1]))
        start[place] = place[np.flatnonzero(new)][np.cumsum(new) - 1]
        size = np.diff(np.append(np.flatnonzero(new), len(place)))
        return place[np.repeat(size > 1, size)]

    while len(place):
        at = suffixes[order[place]]
        group = start[place]
        known = depth[place]
        new = np.append(True, group[1:] != group[:-1])
        head = np.flatnonzero(new)
        size = np.diff(np.append(head, len(place)))
        shallow_part = known < shallow
        if shallow_part.any():
            live = place[shallow_part]
            word = _words(data, at[shallow_part] + known[shallow_part])
            pivot_place = np.repeat(head + size // 2, size)[shallow_part]
            pivot = _words(data, at[pivot_place] + known[pivot_place])
            side = np.where(word < pivot, 0, np.where(word == pivot, 1, 2))
            rest = split(live, side, known[shallow_part] + 8 * (side == 1))
            place = np.sort(np.concatenate([rest, place[~shallow_part]]))
            continue
        lead = at[np.repeat(head, size)]
        same = _common(data, at, lead, int(known.min()) // 8 * 8, limit)
        full = same >= limit
        mine, its = data[np.minimum(at + same, len(data) - 1)], data[np.minimum(lead + same, len(data) - 1)]
        key = np.where(full, limit * 256, np.where(mine < its, same * 256 + mine, (2 * limit - same + 1) * 256 + mine))
        rest = split(place, key.astype(np.int64), np.where(full, limit, same + 1))
        place = rest[depth[rest] < limit]
    equal = np.zeros(n, bool)
    if n > 1:
        equal[1:] = (start[1:] == start[:-1]) & (depth[1:] >= limit)
    return order, equal


def _bytes_batches(batches):
    """The bytes of contested regions, from their documents."""
    unzip = zstandard.ZstdDecompressor()
    for batch in batches:
        ids, texts = batch.column("__d"), batch.column("__x")
        rows = {k: [] for k in ("__anchor", "__d", "__x", "__s", "__e")}
        body = []
        for i in range(len(batch)):
            text = unzip.decompress(batch.column("__z")[i].as_py())
            for r in batch.column("__rs")[i].as_py():
                for k, v in (("__anchor", r["__anchor"]), ("__d", ids[i].as_py()), ("__x", texts[i].as_py()), ("__s", r["__s"]), ("__e", r["__e"])):
                    rows[k].append(v)
                body.append(text[r["__s"]:r["__e"] + WIDTH])
        yield pa.RecordBatch.from_arrays([*[pa.array(v, pa.int64()) for v in rows.values()], pa.array(body, pa.binary())], [*rows, "__bytes"])


def _windows(batches):
    """Removed runs among the contested regions of a partition, anchors whole."""
    tables = [pa.Table.from_batches([b]) for b in batches]
    if not tables:
        return
    t = pa.concat_tables(tables).combine_chunks()
    if not t.num_rows:
        return
    anchor, ids, texts, s, e = (t.column(c).to_numpy() for c in ("__anchor", "__d", "__x", "__s", "__e"))
    order = np.argsort(anchor, kind="stable")
    cut = np.flatnonzero(np.append(True, anchor[order][1:] != anchor[order][:-1]))
    body = t.column("__bytes")
    # whole anchors, some 100,000 windows at a time
    weight = np.cumsum((e - s + 1)[order])
    ends = np.append(cut[1:], len(order))
    lo = 0
    while lo < len(cut):
        hi = max(lo + 1, int(np.searchsorted(weight[ends - 1], (weight[cut[lo] - 1] if cut[lo] else 0) + 200_000, "right")))
        rows = order[cut[lo]:ends[hi - 1]]
        lo = hi
        raw = [body[int(i)].as_py() for i in rows]
        data = np.frombuffer(b"".join(raw), np.uint8)
        first = np.zeros(len(raw), np.int64)
        np.cumsum([len(x) for x in raw[:-1]], out=first[1:])
        count = (e - s + 1)[rows]
        owner = np.repeat(np.arange(len(rows)), count)
        shift = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        rank, equal = deep_shallow(data, first[owner] + shift)
        run = np.cumsum(~equal) - 1
        own = rows[owner[rank]]
        d, x, p = ids[own], texts[own], s[own] + shift[rank]
        by = np.lexsort((p, x, d, run))
        d, x, p, run = d[by], x[by], p[by], run[by]
        top = np.flatnonzero(np.append(True, run[1:] != run[:-1]))[run]
        gone = (d != d[top]) | (x != x[top]) | (p != p[top])
        d, x, p = d[gone], x[gone], p[gone]
        if not len(d):
            continue
        by = np.lexsort((p, x, d))
        d, x, p = d[by], x[by], p[by]
        new = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (x[1:] != x[:-1]) | (p[1:] > p[:-1] + 1)))
        end = p[np.append(new[1:], len(p)) - 1]
        yield pa.RecordBatch.from_arrays([pa.array(d[new]), pa.array(x[new]), pa.array(p[new]), pa.array(end)], ["__d", "__x", "__s", "__e"])


def _zip(batches):
    zipper = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        data, off = tk.utf8(batch.column("__t"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("__d"), batch.column("__x"), pa.array([zipper.compress(data[a:b].tobytes()) for a, b in zip(off[:-1], off[1:])], pa.binary())],
            ["__d", "__x", "__z"])


def _cut(batches):
    unzip = zstandard.ZstdDecompressor()
    for batch in batches:
        out = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256")}
        kept_texts = []
        for z, rs in zip(batch.column("__z"), batch.column("__rs")):
            text = unzip.decompress(z.as_py())
            kept, end, removed, n = [], 0, 0, 0
            for a, b in sorted((r["__s"], r["__e"] + WIDTH) for r in rs.as_py() or []):
                if a > end or not n:
                    kept.append(text[end:a])
                    n += 1
                    end, removed = b, removed + b - a
                elif b > end:
                    end, removed = b, removed + b - end
            kept.append(text[end:])
            left = b"".join(kept)
            kept_texts.append(left)
            for k, v in (("n_bytes", len(text)), ("n_removed", removed), ("n_spans", n), ("kept_sha256", hashlib.sha256(left).hexdigest())):
                out[k].append(v)
        yield pa.RecordBatch.from_arrays([batch.column("__d"), *[pa.array(v) for v in out.values()], pa.array(kept_texts, pa.binary())],
                                         ["__d", *out, "kept"])


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``n_bytes``, ``n_removed``,
    ``n_spans``, ``kept_sha256`` and ``kept`` (binary, the bytes that stay)."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    top = (1 << 63) - 1
    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(top)).alias("__d"),
                      F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("__x"), F.col(text_col).alias("__t"))
    found = cut_lineage(
        src.mapInArrow(_region_batches(4 * n), "__b int, __w binary").repartition(n, "__b")
        .mapInArrow(_settle, "__anchor bigint, __d bigint, __x bigint, __s bigint, __e bigint"), "op7-regions")
    zipped = src.mapInArrow(_zip, "__d bigint, __x bigint, __z binary")
    wanted = (found.where(F.col("__anchor").isNotNull()).groupBy("__d", "__x")
              .agg(F.collect_set(F.struct("__anchor", "__s", "__e")).alias("__rs")))
    bodies = (zipped.join(wanted.hint("shuffle_hash"), ["__d", "__x"]).mapInArrow(
        _bytes_batches, "__anchor bigint, __d bigint, __x bigint, __s bigint, __e bigint, __bytes binary"))
    windows = bodies.repartition(n, "__anchor").mapInArrow(_windows, "__d bigint, __x bigint, __s bigint, __e bigint")
    gone = found.where(F.col("__anchor").isNull()).select("__d", "__x", "__s", "__e").unionByName(windows)
    gone = cut_lineage(gone.groupBy("__d", "__x").agg(F.collect_set(F.struct("__s", "__e")).alias("__rs")), "op7-gone")
    got = zipped.join(gone.hint("shuffle_hash"), ["__d", "__x"], "left").mapInArrow(
        _cut, "__d bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
    return got.select(F.when(F.col("__d") == top, None).otherwise(F.col("__d")).alias(id_col),
                      "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
