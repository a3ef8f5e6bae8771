"""Numpy helpers over Arrow text columns: small per-batch steps used inside
``mapInArrow`` tasks. Batches are handled in pieces of a few MB of text (a
longer text is a piece of its own), so a task's memory does not follow the
batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 21
_U = np.uint64
_STEP = 0x9E3779B97F4A7C15
_INVERSE = pow(_STEP, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]

#: ASCII upper to lower case, other bytes unchanged
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: bytes of words: 0-9, a-z, and all of non-ASCII characters
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True
#: bytes of tokens: all but ASCII white space
TOKEN = np.ones(256, bool)
TOKEN[[32, 9, 10, 11, 12, 13]] = False


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], np.int64)[col.offset:col.offset + n + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def pieces(batch: pa.RecordBatch, text: str, limit: int = PIECE):
    """(first row, end row, bytes, offsets) of consecutive pieces."""
    data, off = utf8(batch.column(text))
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x = x * _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, PIECE + 1)
        for k, step in enumerate((_STEP, _INVERSE)):
            t = np.full(size, step, _U)
            t[0] = 1
            _powers[k] = np.multiply.accumulate(t)
    return _powers


def spans(keep: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of maximal runs of ``keep``; a run never
    crosses a row border."""
    n = len(keep)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    before = np.zeros(n, bool)
    before[1:] = keep[:-1]
    starts = np.flatnonzero(keep & (~before | edge[:n]))
    after = np.zeros(n, bool)
    after[:-1] = keep[1:]
    ends = np.flatnonzero(keep & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def range_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Position-independent polynomial hashes of ``values[start:end]``."""
    n = len(values)
    power, inverse = _power_tables(n + 1)
    total = np.zeros(n + 1, _U)
    np.cumsum(values * power[:n], out=total[1:])
    return (total[ends] - total[starts]) * inverse[starts]


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[start:end]``."""
    h = range_sums(data.astype(_U) + _U(1), starts, ends)
    return mix(h ^ ((ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93)))


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the ranges one after the other, and their offsets."""
    size = ends - starts
    off = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=off[1:])
    at = np.arange(off[-1]) + np.repeat(starts - off[:-1], size)
    return data[at], off


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    body, off = joined(data, starts, ends)
    return pa.Array.from_buffers(pa.string(), len(starts), [
        None, pa.py_buffer(off.astype(np.int32).tobytes()), pa.py_buffer(body.tobytes())])


def lists(values: np.ndarray, off: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(values))


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64) if x.dtype == _U else x.astype(np.int64)
