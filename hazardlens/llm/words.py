"""Words of many texts at once, as 64-bit hashes, computed with numpy on Arrow buffers.

A hash is 64 bits wide: two given words share one with a probability of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

IDENTITY = np.arange(256, dtype=np.uint8)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Words between ASCII white space.
BLANK_SEPARATED = np.ones(256, dtype=bool)
BLANK_SEPARATED[[9, 10, 11, 12, 13, 32]] = False

#: Words of ASCII digits, lower-case ASCII letters and all characters beyond ASCII.
LETTERS_DIGITS = np.zeros(256, dtype=bool)
LETTERS_DIGITS[48:58] = LETTERS_DIGITS[97:123] = LETTERS_DIGITS[128:] = True

_BYTE = np.random.default_rng(0x5EED).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_SEGMENT = 1 << 20
_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all bits; one to one."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column end to end, and where each text begins (one more entry: the end); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
    column = column.cast(pa.large_binary() if binary else pa.large_string()).fill_null(b"" if binary else "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of text each; a longer text is a part of its own."""
    _, at = text_bytes(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(at, at[start] + limit, side="right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def _tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < size:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


def find(data: np.ndarray, at: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in lower-cased bytes, and the number of the first word of each text."""
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(at), dtype=np.int64)
    inside = table[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[at] = True
    before = np.empty(len(data), dtype=bool)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty(len(data), dtype=bool)
    after[-1], after[:-1] = False, inside[1:]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, at)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash per span: a polynomial over its bytes, from differences of running sums."""
    out = np.empty(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):
        base = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, base + _SEGMENT, side="right")))
        size = int(ends[last - 1] - base)
        up, down = _tables(max(size + 1, _SEGMENT + 1))
        running = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data[base : base + size]] * up[:size], out=running[1:])
        s, e = starts[first:last] - base, ends[first:last] - base
        out[first:last] = (running[e] - running[s]) * down[s]
        first = last
    lengths = (ends - starts).astype(np.uint64)
    return mix(out ^ (lengths * np.uint64(0xD6E8FEB86659FD93)))


def word_hashes(column: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a text column, with A-Z in lower case, and the number of each text's first word."""
    data, at = text_bytes(column)
    data = LOWER[data]
    starts, ends, first = find(data, at, table)
    return hashes(data, starts, ends), first


def combine(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of ``size`` words from each word on, for all but the last ``size - 1`` words."""
    count = max(0, len(words) - size + 1)
    h = np.full(count, size, dtype=np.uint64)
    for k in range(size):
        h = (h * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (h >> np.uint64(29))
        h += words[k : k + count]
    return mix(h)
