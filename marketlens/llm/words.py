"""Words of whole texts as arrays: bounds, 64-bit word identities and identities of word runs.

Texts are handled in slices of about a megabyte taken from the Arrow buffers, so a batch never needs
more than a small multiple of its own size, and one long text is hashed in blocks cut between words.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _table(lower: bool) -> np.ndarray:
    values = np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    if lower:
        values[65:91] = values[97:123]
    return values


TABLES = {flag: _table(flag) for flag in (False, True)}
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for i, base in enumerate((_BASE, inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX2
    return x ^ (x >> np.uint64(31))


def slices(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of the rows within the bytes) of consecutive rows; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
    if not len(texts):
        return
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1)
        end = min(end, len(texts))
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def bounds(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in bytes, and the index of the first word of each row (one more at the end)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~breaks[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def word_ids(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit identity of each word; with ``lower``, A-Z count as a-z."""
    out = np.empty(len(starts), np.uint64)
    at, values = 0, TABLES[lower]
    while at < len(starts):
        end = max(at + 1, int(np.searchsorted(ends, starts[at] + SLICE_BYTES, "right")))
        low = starts[at]
        block = data[low:ends[end - 1]]
        up, down = powers(len(block) + 1)
        total = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(values[block] * up[:len(block)], out=total[1:])
        s, e = starts[at:end] - low, ends[at:end] - low
        out[at:end] = (total[e] - total[s]) * down[s]
        at = end
    return mix(out)


def run_ids(words: np.ndarray, k: int) -> np.ndarray:
    """Identity of each k consecutive words, by the index of the first one."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, k, np.uint64)
    for i in range(k):
        h = (h ^ words[i:i + n]) * _STEP
        h ^= h >> np.uint64(29)
    return mix(h)


def shingle_sets(texts: pa.Array, k: int, lower: bool = True) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sorted distinct k-word shingles of each row); fewer words count as one shingle."""
    for row, end, data, offsets in slices(texts):
        starts, ends, first = bounds(data, offsets)
        ids = word_ids(data, starts, ends, lower)
        runs = run_ids(ids, k)
        sets = []
        for i in range(end - row):
            a, b = first[i], first[i + 1]
            if b - a >= k:
                sets.append(np.unique(runs[a:b - k + 1]))
            else:
                sets.append(run_ids(ids[a:b], int(b - a)) if b > a else runs[:0])
        yield row, sets


def tidy(run: Callable) -> Callable:
    """A batch function that gives memory back to the system when its task ends, as workers are used again."""
    @functools.wraps(run)
    def tidied(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)
    return tidied
