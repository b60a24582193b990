"""Sets of word shingles as 64-bit hashes, a whole Arrow batch at a time.

Words are maximal runs of bytes outside ``\\x20 \\x09-\\x0D`` of the UTF-8 text after lower-casing A-Z. A
text's set holds its distinct runs of five words; a text of one to four words has one shingle, the whole
sequence; a text without words has none. Texts are never cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

WORDS = 5
CHUNK_BYTES = 1 << 20

_rng = np.random.default_rng(20240501)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = _rng.integers(1, 1 << 63, WORDS, dtype=np.uint64) | np.uint64(1)
_powers = np.ones(1, dtype=np.uint64)


def _pow(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 2 * len(_powers)), _BASE, dtype=np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps, dtype=np.uint64)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(column: pa.Array, most: int = CHUNK_BYTES):
    """(first row, bytes, offsets) of consecutive rows with about ``most`` bytes; a longer text stands alone."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=column.offset + n + 1)[column.offset:]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
        at = to


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and for each text the place of its first word (one more entry at the end)."""
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    low = _LOWER[data]
    word = ~_SPACE[low]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty_like(word)
    before[0], before[1:] = False, word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.empty_like(word)
    after[-1], after[:-1] = False, word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.empty(0, np.uint64), first
    lens = ends - starts
    inside = np.flatnonzero(word)
    into = np.cumsum(lens) - lens
    pos = inside - np.repeat(starts, lens)
    value = _BYTE[low[inside]] * _pow(int(lens.max()) + 1)[pos]
    return mix(np.add.reduceat(value, into) + lens.astype(np.uint64)), first


def shingle_sets(column: pa.Array):
    """For each row its sorted distinct shingle hashes, in row order."""
    for _, data, offsets in chunks(column):
        words, first = word_hashes(data, offsets)
        n = len(words)
        runs = np.zeros(max(0, n - WORDS + 1), dtype=np.uint64)
        for k in range(WORDS if len(runs) else 0):
            runs += words[k:n - WORDS + 1 + k] * _PLACE[k]
        runs = mix(runs)
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= WORDS:
                yield np.unique(runs[a:b - WORDS + 1])
            elif b > a:
                some = np.sum(words[a:b] * _PLACE[:b - a], dtype=np.uint64) + np.uint64(b - a)
                yield mix(np.array([some], dtype=np.uint64))
            else:
                yield np.empty(0, dtype=np.uint64)
