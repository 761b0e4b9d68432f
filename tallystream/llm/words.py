"""Words of whole Arrow columns as 64-bit numbers, without a Python object per word.

A word is a maximal run of bytes other than space and 0x09 to 0x0D of the UTF-8 text. Its
number depends on its bytes alone, so equal words agree on every executor.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes worked on at a time: bounds the temporary arrays, whatever the length of a text.
SEGMENT = 1 << 18
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (a bijection)."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LETTERS = mix(np.arange(1, 257, dtype=np.uint64))
_powers = np.ones(1, dtype=np.uint64)


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.full(max(n, 1024), _BASE, dtype=np.uint64))
    return _powers


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows behind each other and the byte offset of each row; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if column.buffers()[2] is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def words(
    column: pa.Array,
    lower: bool = False,
    between: np.ndarray = _SPACE,
    first: int | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words, and for each row the index of its first word (one more at the end).

    ``between`` says for each byte whether it parts words; ``first`` looks at that many bytes
    of each word only.
    """
    data, bounds = text_bytes(column)
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    inside = ~between[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    heads = bounds[:-1][bounds[:-1] < n]
    opens[heads] = inside[heads]
    starts = np.flatnonzero(opens)
    del opens
    rows = np.searchsorted(starts, bounds)
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(starts, starts[at] + SEGMENT)))
        begin, end = starts[at], starts[stop] if stop < len(starts) else n
        keep = inside[begin:end]
        letters = data[begin:end][keep]
        if lower:
            letters = _LOWER[letters]
        # Where each word begins among the bytes that belong to words.
        heads = (np.cumsum(keep, dtype=np.int64) - 1)[starts[at:stop] - begin]
        lengths = np.diff(np.append(heads, len(letters)))
        place = np.arange(len(letters)) - np.repeat(heads, lengths)
        value = _LETTERS[letters] * _power_table(int(lengths.max()))[place]
        if first is not None:
            value *= place < first
            lengths = np.minimum(lengths, first)
        out[at:stop] = mix(np.add.reduceat(value, heads) + lengths.astype(np.uint64) * _GOLDEN)
        at = stop
    return out, rows


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), n, 1 << 64))


def grams(numbers: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """A number for each run of ``n`` consecutive numbers, across row borders too."""
    if len(numbers) < n:
        return np.zeros(0, np.uint64)
    part = mix(numbers + np.uint64(seed)) if seed else numbers
    width = 1
    done, done_width = None, 0
    while True:
        if n & width:
            if done is None:
                done, done_width = part, width
            else:  # the part stands before what is done
                size = len(numbers) - width - done_width + 1
                tail = np.uint64(pow(int(_BASE), done_width, 1 << 64))
                done, done_width = part[:size] * tail + done[width : width + size], done_width + width
        if done_width == n:
            return mix(done)
        part = part[: len(part) - width] * _power(width) + part[width:]
        width *= 2


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
