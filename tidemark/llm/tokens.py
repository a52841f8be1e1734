"""Words of many texts at once, as numpy arrays over the UTF-8 bytes.

A word is a run of bytes other than space and \\t to \\r; these never occur
inside a multi-byte character, so bytes and code points give the same words.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled in one go; a longer text makes a block of its own.
BLOCK = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RATIO = 0x9E3779B97F4A7C15F39CC0605CEDC835 % (1 << 64) | 1
_INVERSE = pow(_RATIO, -1, 1 << 64)
_powers = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        base = np.full(max(n, BLOCK + 1), _RATIO if kind == "up" else _INVERSE, dtype=np.uint64)
        base[0] = 1
        _powers[kind] = np.multiply.accumulate(base)
    return _powers[kind][:n]


def portions(batches: Iterable[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in portions of so many rows, so that what is made of them stays small.

    When the task ends, freed memory goes back to the system: the Python process stays for other
    tasks, and its executor's memory is shared."""
    try:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield batch.slice(at, rows)
    finally:
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def blocks(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows of about BLOCK bytes; a null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.fill_null("").cast(pa.large_binary())
    if not len(column):
        return
    _, raw, data = column.buffers()
    offsets = np.frombuffer(raw, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + BLOCK, side="right")) - 1)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray, space: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each text the index of its first word
    (one more at the end)."""
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(offsets), dtype=np.int64)
    if space is None:
        space = (data == 32) | ((data - np.uint8(9)) < 5)
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    word = ~space
    start, end = word.copy(), word.copy()
    start[1:] &= space[:-1] | edge[1:-1]
    end[:-1] &= space[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each span's bytes, the same wherever it stands; lower: A-Z as a-z. Starts ascend.

    A long text is gone through in parts of about BLOCK bytes, so it needs no more memory than these."""
    if len(data) <= 2 * BLOCK or not len(starts):
        return _span_hashes(data, starts, ends, lower)
    cuts = np.flatnonzero(np.diff(starts // BLOCK)) + 1
    parts = []
    for i, j in zip([0, *cuts], [*cuts, len(starts)], strict=True):
        a, b = int(starts[i]), int(ends[i:j].max())
        parts.append(_span_hashes(data[a:b], starts[i:j] - a, ends[i:j] - a, lower))
    return np.concatenate(parts)


def _span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[_LOWER[data] if lower else data] * _power("up", len(data)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power("down", len(data) + 1)[starts] + (ends - starts).astype(np.uint64))


_PLACE = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def windows(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of `size` words that lies in one text, and for each text the
    index of its first such run (one more at the end)."""
    n = len(words) - size + 1
    counts = np.maximum(np.diff(first) - size + 1, 0)
    starts = np.concatenate([[0], np.cumsum(counts)])
    if n <= 0 or not starts[-1]:
        return np.zeros(0, dtype=np.uint64), starts
    total = words[:n] * _PLACE[0]
    for i in range(1, size):
        total = total + words[i : n + i] * _PLACE[i]
    inside = np.repeat(first[:-1] - starts[:-1], counts) + np.arange(starts[-1])
    return mix(total[inside]), starts


def few_words(words: np.ndarray) -> np.uint64:
    """Hash of a whole sequence of less than 64 words, told apart from that of any window."""
    return mix(np.array([(words * _PLACE[: len(words)]).sum(dtype=np.uint64) + np.uint64(0xA5A5 * len(words))], dtype=np.uint64))[0]
