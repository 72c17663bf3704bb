"""Byte assembly on numpy arrays: many segments copied into one buffer."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLOCK = 1 << 21


def gather(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """The segments ``pool[start : start + length]`` one after another.

    The place of each segment is the running sum of the lengths; an index array over the output
    scatters the pool into one preallocated array, a bounded number of bytes at a time.
    """
    ends = np.cumsum(lengths, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    if out is None:
        out = np.empty(total, pool.dtype)
    shift = starts.astype(np.int64) - (ends - lengths)
    first = 0
    while first < len(ends):
        base = int(ends[first] - lengths[first])
        last = max(first + 1, int(np.searchsorted(ends, base + BLOCK, "right")))
        if last == first + 1:  # one segment, of any length: a plain copy
            at = int(starts[first])
            out[base : int(ends[first])] = pool[at : at + int(lengths[first])]
        else:
            stop = int(ends[last - 1])
            index = np.repeat(shift[first:last], lengths[first:last])
            index += np.arange(base, stop)
            np.take(pool, index, out=out[base:stop])
        first = last
    return out


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column in one array and the n + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    _, offsets, data = column.buffers()
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]
