"""Words of Arrow string columns as numpy arrays, without an object for each word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once, which bounds a worker's memory; a longer text is handled alone.
SLICE = 2 << 20

#: Bytes of one text that are hashed at once, and the base of the hash with its inverse modulo 2 ** 64.
BLOCK, BASE = 1 << 22, 0x9E3779B97F4A7C15
UNDO = pow(BASE, -1, 1 << 64)

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo 2 ** 64."""
    out = np.empty(max(n, 1), np.uint64)
    out[0] = 1
    size = 1
    while size < n:
        take = min(size, n - size)
        out[size : size + take] = out[:take] * np.uint64(pow(base, size, 1 << 64))
        size += take
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits whose every output bit depends on all input bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each row's bytes start and end; a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind, n = (np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32), len(column)
    _, offsets, data = column.buffers()
    if n == 0:
        return np.empty(0, np.uint8), np.zeros((0, 2), np.int64)
    ends = np.frombuffer(offsets, kind, n + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    spans = np.stack([ends[:-1], ends[1:]], 1)
    if column.null_count:
        spans[np.asarray(column.is_null())] = 0
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)), spans


def sliced(batch: pa.RecordBatch, text: str, most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most so many bytes of text, or of one row."""
    _, spans = buffers(batch.column(text))
    start, held = 0, 0
    for k, size in enumerate((spans[:, 1] - spans[:, 0]).tolist()):
        if k > start and held + size > most:
            yield batch.slice(start, k - start)
            start, held = k, 0
        held += size
    if batch.num_rows > start:
        yield batch.slice(start)


def joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The rows' bytes one after the other, each followed by a line feed, and the rows' bounds in that."""
    data, spans = buffers(column)
    sizes = spans[:, 1] - spans[:, 0]
    starts = np.concatenate([[0], np.cumsum(sizes + 1)]).astype(np.int64)
    out = np.full(starts[-1], 10, np.uint8)
    for k, (a, b) in enumerate(spans.tolist()):
        if b > a:
            out[starts[k] : starts[k] + b - a] = data[a:b]
    return out, starts


class Words:
    """The words [^\\x20\\x09-\\x0D]+ of a column's rows: hash of 64 bits, first byte, end, and each row's range of words."""

    def __init__(self, column: pa.Array, lower: bool):
        self.bytes, self.starts = joined(column)
        space = _SPACE[self.bytes]
        edge = np.diff(np.concatenate([[True], space]).view(np.int8))
        self.first = np.flatnonzero(edge == -1)
        self.end = np.flatnonzero(edge == 1)
        self.hash = np.empty(len(self.first), np.uint64)
        table, start = _BYTE[_LOWER] if lower else _BYTE, 0
        while start < len(self.first):  # words that lie in one block of bytes, or one word that is longer
            low = self.first[start]
            stop = max(start + 1, int(np.searchsorted(self.end, low + BLOCK, "right")))
            first, end = self.first[start:stop] - low, self.end[start:stop] - low
            coded = table[self.bytes[low : low + end[-1]]] * powers(BASE, int(end[-1]))
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(coded, dtype=np.uint64)])
            self.hash[start:stop] = mixed((sums[end] - sums[first]) * powers(UNDO, int(first[-1]) + 1)[first])
            start = stop
        self.rows = np.searchsorted(self.first, self.starts)

    def __len__(self) -> int:
        return len(self.first)

    def row_of(self) -> np.ndarray:
        """Each word's row."""
        return np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))


def row_sums(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums modulo 2 ** 64 of each row's range of values."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return sums[rows[1:]] - sums[rows[:-1]]
