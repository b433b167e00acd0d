"""Whole texts as flat arrays: what the operators of this package share inside tasks.

A slice of documents becomes one byte array with offsets. Words, their 64-bit names and
fingerprints of word ranges are computed on the whole slice at once; slices are cut by bytes, so
memory does not depend on the rows of an Arrow batch, and no document is ever cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once in a task.
SLICE_BYTES = 4 << 20

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_STEP = 0xD6E8FEB86659FD93


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(32))
    x *= _M1
    x ^= x >> np.uint64(29)
    x *= _M2
    x ^= x >> np.uint64(32)
    return x


def seeded(x: np.ndarray, seed: int) -> np.ndarray:
    return mix(x + np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))


def chain(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Name of an ordered pair of names."""
    return mix(mix(a) + b * _GOLDEN + np.uint64(1))


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of whole rows of about ``limit`` text bytes; null texts become empty."""
    for batch in batches:
        at = batch.schema.get_field_index(text)
        column = pc.fill_null(batch.column(at), "") if batch.column(at).null_count else batch.column(at)
        batch = batch.set_column(at, pa.field(text, column.type), column)
        ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(ends):
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column (16 zero bytes follow) and the offsets of its rows."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    padded = np.zeros(int(offsets[-1] - offsets[0]) + 16, np.uint8)
    if len(padded) > 16:
        padded[:-16] = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return padded, offsets - offsets[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` of all rows, and the row of each."""
    n = int(offsets[-1])
    inside = np.ones(n + 1, bool)
    body = data[:n]
    inside[:n] = (body != 32) & ((body < 9) | (body > 13))
    inside[n] = False
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.zeros(n + 1, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge))
    ends = np.flatnonzero(before & (~inside | edge))
    per_row = np.searchsorted(starts, offsets)
    return starts, ends, np.repeat(np.arange(len(offsets) - 1), np.diff(per_row))


def names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit name of each byte range, from its content alone (eight bytes at a time)."""
    lanes = np.ndarray((len(data) - 8,), "<u8", data.data, strides=(1,))
    length = ends - starts
    out = seeded(length.astype(np.uint64), seed + 1)
    at, left, todo = starts, length, slice(None)
    while len(at):
        lane = lanes[at]
        lane = np.where(left < 8, lane & ((np.uint64(1) << (np.minimum(left, 7).astype(np.uint64) << np.uint64(3))) - np.uint64(1)), lane)
        out[todo] = mix(out[todo] * _GOLDEN + lane)
        more = np.flatnonzero(left > 8)
        todo = more if isinstance(todo, slice) else todo[more]
        at, left = at[more] + 8, left[more] - 8
    return out


class Ranges:
    """64-bit fingerprints of ranges of a name array by prefix sums of names times powers of an odd number."""

    def __init__(self, values: np.ndarray) -> None:
        n = len(values)
        self._power = np.full(n + 1, _STEP, np.uint64)
        self._power[0] = 1
        np.cumprod(self._power, out=self._power)
        self._back = np.full(n + 1, pow(_STEP, -1, 1 << 64), np.uint64)
        self._back[0] = 1
        np.cumprod(self._back, out=self._back)
        self._sum = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(values) * self._power[:-1], out=self._sum[1:])

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self._sum[stop] - self._sum[start]) * self._back[start] + (stop - start).astype(np.uint64) * _GOLDEN)


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned names as Spark's longs."""
    return x.view(np.int64)
