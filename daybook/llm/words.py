"""Words and word shingles as 64-bit integers, computed over whole Arrow columns.

A word is a run of bytes outside ``\\x20 \\x09-\\x0D``; UTF-8 never uses those
bytes inside a longer character, so working on bytes gives the same words as
working on characters. Hashes are fixed functions of the bytes (no process
seed), so every task and every rerun agrees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SHINGLE = 5
#: Texts are hashed in slices of at most this many bytes (a longer text alone).
SLICE_BYTES = 1 << 20

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every input bit over the 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_TAIL = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
POSITION = mix64((np.arange(64, dtype=np.uint64) + np.uint64(1001)) * _GOLDEN) | np.uint64(1)


def text_slices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` slices of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, side="right")) - 1
        last = min(n, max(last, first + 1))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last
    del column, data, offsets
    pa.default_memory_pool().release_unused()  # idle Python workers would keep it


def row_slices(batch: pa.RecordBatch, column: int, most: int = 4 * SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``most`` bytes in a string column (a longer text alone)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(first, last - first)
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True):
    """``(hash, start byte, end byte, first word of each text)`` of the words of some texts.

    ``offsets`` has one more entry than there are texts, and so has the last result.
    """
    n = len(data)
    solid = np.zeros(n + 2, dtype=bool)  # one blank byte before and after
    np.logical_not(_IS_SPACE[data], out=solid[1:-1])
    begins, ends = solid[1:] & ~solid[:-1], solid[:-1] & ~solid[1:]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    begins[cuts] = solid[1:][cuts]
    ends[cuts] = solid[:-1][cuts]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends)
    return hash_spans(data, starts, stops, lower), starts, stops, np.searchsorted(starts, offsets)


def hash_spans(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, lower: bool) -> np.ndarray:
    """Hash of the bytes of each span, eight bytes at a time."""
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[: len(data)] = _LOWER[data] if lower else data
    eights = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    left = stops - starts
    h = left.astype(np.uint64) * _GOLDEN
    rows = np.arange(len(starts))
    at = 0
    while len(rows):
        chunk = eights[starts[rows] + at] & _TAIL[np.minimum(left[rows] - at, 8)]
        h[rows] = mix64((h[rows] ^ chunk) * _GOLDEN + np.uint64(at + 1))
        at += 8
        rows = rows[left[rows] > at]
    return h


def shingles(h: np.ndarray, firsts: np.ndarray, width: int = SHINGLE) -> Iterator[np.ndarray]:
    """Per text, the sorted distinct hashes of its ``width``-word shingles.

    A text with fewer words has its whole word sequence as its one shingle; a
    text without words has none.
    """
    rows = window_hashes(h, width)
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
        if b - a >= width:
            yield np.unique(rows[a : b - width + 1])
        elif b > a:
            yield mix64(np.array([sequence_sum(h[a:b]) + np.uint64(b - a)], dtype=np.uint64))
        else:
            yield np.zeros(0, dtype=np.uint64)


def sequence_sum(h: np.ndarray) -> np.uint64:
    return np.add.reduce(h * POSITION[: len(h)], dtype=np.uint64)


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of words ``i .. i+width-1`` at each ``i`` (windows that run over the end are garbage)."""
    total = np.zeros(len(h), dtype=np.uint64)
    for j in range(min(width, len(h))):
        total[: len(h) - j] += h[j:] * POSITION[j]
    return mix64(total + np.uint64(width))


def column_shingles(column: pa.Array, width: int = SHINGLE) -> Iterator[np.ndarray]:
    """:func:`shingles` of every row of a string column, in row order."""
    for _, data, offsets in text_slices(column):
        h, _, _, firsts = word_hashes(data, offsets)
        yield from shingles(h, firsts, width)
