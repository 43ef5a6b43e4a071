"""Words of whole texts as hashed NumPy arrays, straight from Arrow buffers.

A word is a run of bytes other than space, tab, newline, vertical tab, form feed
and carriage return. UTF-8 keeps those bytes out of longer characters, so words
of bytes are words of code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20  # bytes handled at a time
ROWS = 60_000  # rows handled at a time
ODD = np.uint64(0x9E3779B97F4A7C15)
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers (the splitmix64 finish)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeds(n: int, start: int = 1) -> np.ndarray:
    return mixed(np.arange(start, start + n, dtype=np.uint64) * ODD)


_BYTE = seeds(256, 11)
_BYTE_2 = seeds(256, 7001)


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


_BASE, _BASE_2 = 0x5851F42D4C957F2D, 0x2545F4914F6CDD1D
_UP: dict[int, np.ndarray] = {}


def _table(n: int, base: int) -> np.ndarray:
    if base not in _UP or len(_UP[base]) < n:
        _UP[base] = _powers(max(n, BLOCK + 1), base)
    return _UP[base]


class Texts(NamedTuple):
    """Texts of a column, end to end: row i is data[start[i]:end[i]]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray


def texts_of(column: pa.Array) -> Texts:
    """The column's UTF-8 bytes without copying; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    start, end = offsets[:-1].copy(), offsets[1:].copy()
    if column.null_count:
        gone = column.is_null().to_numpy(zero_copy_only=False)
        end[gone] = start[gone]
    return Texts(data, start, end)


def blocks(texts: Texts, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` bytes; a longer text is a range of its own."""
    length = texts.end - texts.start
    first, total = 0, 0
    for i, n in enumerate(length.tolist()):
        if i > first and (total + n > size or i - first == ROWS):
            yield first, i
            first, total = i, 0
        total += n
    if first < len(length):
        yield first, len(length)


class Words(NamedTuple):
    """Words of rows first..last: place in ``data``, row and hash of each."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray


def _hashes(data, start, end, table, base) -> np.ndarray:
    """Polynomial hash of data[start:end] for ordered words, a block of bytes at a time."""
    out = np.empty(len(start), dtype=np.uint64)
    at = 0
    while at < len(start):
        low = int(start[at])
        stop = max(at + 1, int(np.searchsorted(end, low + BLOCK, side="right")))
        high = int(end[stop - 1])
        up = _table(high - low + 1, base)
        sums = np.empty(high - low + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(table[data[low:high]] * up[: high - low], out=sums[1:])
        s, e = start[at:stop] - low, end[at:stop] - low
        # shifting every word to one common place makes the hash depend on the word alone
        out[at:stop] = (sums[e] - sums[s]) * up[(high - low) - s]
        if high - low != BLOCK:
            out[at:stop] *= _lift(BLOCK - (high - low), base)
        at = stop
    return out


def _lift(n: int, base: int) -> np.uint64:
    """base ** n modulo 2 ** 64, for negative n too (an odd base has an inverse)."""
    return np.uint64(pow(base, n, 1 << 64))


def words_of(texts: Texts, first: int = 0, last: int | None = None, second: bool = False) -> Words:
    """Words of rows first..last with 64-bit hashes (``second``: of another family)."""
    last = len(texts.start) if last is None else last
    none = np.zeros(0, dtype=np.int64)
    if first >= last or texts.end[last - 1] <= texts.start[first]:
        return Words(none, none, none, none.astype(np.uint64))
    low, high = int(texts.start[first]), int(texts.end[last - 1])
    inside = np.empty(high - low + 2, dtype=bool)
    inside[0] = inside[-1] = False
    np.logical_not(SPACE[texts.data[low:high]], out=inside[1:-1])
    edge = np.zeros(high - low + 1, dtype=bool)  # a row's first byte starts a new word
    edge[texts.start[first:last] - low] = True
    edge[texts.end[first:last] - low] = True
    starts = np.flatnonzero(inside[1:] & (edge | ~inside[:-1]))
    ends = np.flatnonzero(inside[:-1] & (edge | ~inside[1:]))
    row = np.searchsorted(texts.start[first:last], starts + low, side="right") - 1 + first
    live = starts + low < texts.end[row]  # bytes under a null row belong to nothing
    start, end, row = starts[live] + low, ends[live] + low, row[live]
    table, base = (_BYTE_2, _BASE_2) if second else (_BYTE, _BASE)
    return Words(row, start, end, mixed(_hashes(texts.data, start, end, table, base)))


def beginnings(texts: Texts, words: Words, n: int) -> Words:
    """The first ``n`` bytes of the words that are longer, hashed apart from whole words."""
    longer = words.end - words.start > n
    start = words.start[longer]
    found = mixed(_hashes(texts.data, start, start + n, _BYTE, _BASE) ^ seeds(1, 900 + n)[0])
    return Words(words.row[longer], start, start + n, found)


def grams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every run of ``n`` words; fewer words make one run of all."""
    count = len(words.row)
    if not count:
        return words.row, words.hash
    coefficient = seeds(n, 5003) | np.uint64(1)
    new = np.empty(count, dtype=bool)
    new[0] = True
    np.not_equal(words.row[1:], words.row[:-1], out=new[1:])
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, count))
    total = words.hash * coefficient[0]
    for k in range(1, min(n, count)):
        total[: count - k] += words.hash[k:] * coefficient[k]
    place = np.arange(count) - np.repeat(begin, size)
    whole = place <= np.repeat(size, size) - n
    row, out = words.row[whole], total[whole]
    short = np.flatnonzero(size < n)
    if len(short):
        rows = words.row[begin[short]]
        sums = np.zeros(len(short), dtype=np.uint64)
        for k in range(n - 1):
            has = size[short] > k
            sums[has] += words.hash[begin[short][has] + k] * coefficient[k]
        sums += size[short].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        order = np.argsort(np.append(row, rows), kind="stable")
        row, out = np.append(row, rows)[order], np.append(out, sums)[order]
    return row, mixed(out)
