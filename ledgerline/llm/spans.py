"""Byte spans of many texts at once: cutting, naming and gathering them with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from ledgerline.llm.common import prefix_hashes, span_hash

#: Text bytes gathered from several Arrow batches into one shard.
SHARD_BYTES = 4 << 20


def gathered(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SHARD_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in fewer batches, each closed once its texts reach ``limit`` bytes."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.column(column).nbytes
        if size >= limit:
            yield _joined(held)
            held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0] if any(
        b.num_rows for b in held) else held[0]


def runs(solid: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of marked bytes, none across a text's end.

    The third array holds for each text (plus the end) the index of its first run.
    """
    before = np.zeros(len(solid), bool)
    before[1:] = solid[:-1]
    after = np.zeros(len(solid), bool)
    after[:-1] = solid[1:]
    inner = offs[1:-1]
    before[inner[inner < len(solid)]] = False
    after[inner[inner > 0] - 1] = False
    starts = np.flatnonzero(solid & ~before)
    return starts, np.flatnonzero(solid & ~after) + 1, np.searchsorted(starts, offs)


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte spans as an Arrow string array."""
    size = ends - starts
    offs = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=offs[1:])
    at = np.repeat(starts - offs[:-1], size) + np.arange(offs[-1])
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offs), pa.py_buffer(data[at])).cast(pa.string())


def distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First occurrence, 64-bit hash and, for every span, the number of each distinct span."""
    h = span_hash(prefix_hashes(data), starts, ends)
    hashes, first, number = np.unique(h, return_index=True, return_inverse=True)
    return first, hashes, number.reshape(-1)


def varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers from 0 up in groups of 7 bits, low ones first, the high bit set on all but the last; bytes and end of each number."""
    values = values.astype(np.uint64)
    size = np.ones(len(values), np.int64)
    for bits in range(7, 64, 7):
        more = values >= np.uint64(1 << bits)
        if not more.any():
            break
        size += more
    ends = np.cumsum(size)
    begin = ends - size
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(int(size.max(initial=0))):
        has = np.flatnonzero(size > k) if k else slice(None)
        out[begin[has] + k] = ((values[has] >> np.uint64(7 * k)) & np.uint64(127)).astype(np.uint8) | ((size[has] > k + 1) * np.uint8(128))
    return out, ends


def numbers(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers that ``varints`` wrote, and the end of each."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    last = np.flatnonzero(raw < 128)
    begin = np.concatenate([[0], last[:-1] + 1])
    nth = np.arange(len(raw)) - np.repeat(begin, last - begin + 1)
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * nth), begin), last + 1
