"""CRC-32C of many byte ranges at once, and its masked form.

A CRC is linear: leading zeros don't count, and a byte counts by its value and its
distance from the end. So each range is cut from its end into pieces of 64 bytes, one
table lookup per place gives all pieces' values, and 64 values at a time are folded the
same way until every range has one.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

POLYNOMIAL = np.uint32(0x82F63B78)  # reflected Castagnoli
MASK_DELTA = np.uint32(0xA282EAD8)  # fixed value of the record format
PIECE = 64


@lru_cache(maxsize=1)
def _byte_table() -> np.ndarray:
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, (value >> np.uint32(1)) ^ POLYNOMIAL, value >> np.uint32(1))
    return value


def _zero_byte(value: np.ndarray) -> np.ndarray:
    return _byte_table()[value & 0xFF] ^ (value >> np.uint32(8))


def _applied(operator: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The linear map given by its images of the 32 bits, of each value."""
    out = np.zeros_like(value)
    for bit in range(32):
        out ^= np.where((value >> np.uint32(bit)) & 1, operator[bit], np.uint32(0))
    return out


def _lookup(operator: np.ndarray) -> np.ndarray:
    """The same map as four tables of 256, one per byte of the value."""
    each = np.arange(256, dtype=np.uint32)
    return np.stack([_applied(operator, each << np.uint32(8 * k)) for k in range(4)])


@lru_cache(maxsize=8)
def _operators(level: int) -> list[np.ndarray]:
    """Maps for 0..63 steps of 64 ** level zero bytes, and for 64 of them."""
    if level == 0:
        step = _zero_byte(np.uint32(1) << np.arange(32, dtype=np.uint32))
    else:
        step = _operators(level - 1)[PIECE]
    out = [np.uint32(1) << np.arange(32, dtype=np.uint32)]
    for _ in range(PIECE):
        out.append(_applied(step, out[-1]))
    return out


@lru_cache(maxsize=8)
def _tables(level: int) -> np.ndarray:
    """Level 0: place x byte; above: place x byte of the value x 256. Place 63 is the last one."""
    if level == 0:
        first = _byte_table()
        return np.stack([_applied(_operators(0)[PIECE - 1 - i], first) for i in range(PIECE)])
    return np.stack([_lookup(_operators(level)[PIECE - 1 - i]) for i in range(PIECE)])


def _pieces(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of ``values`` filled up with zeros in front to whole pieces: (pieces, pieces per range)."""
    count = np.maximum(1, -(-size // PIECE))
    ends = np.cumsum(count) * PIECE
    out = np.zeros(int(count.sum()) * PIECE, dtype=values.dtype)
    shift = ends - size
    begin = np.cumsum(size) - size
    each = np.arange(int(size.sum()))
    out[each + np.repeat(shift - begin, size)] = values[each + np.repeat(start - begin, size)]
    return out.reshape(-1, PIECE), count


def crc32c(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32C of each ``data[start:end]`` (bytes)."""
    size = np.asarray(end, np.int64) - np.asarray(start, np.int64)
    if not len(size):
        return np.zeros(0, dtype=np.uint32)
    pieces, count = _pieces(data, np.asarray(start, np.int64), size)
    tables = _tables(0)
    value = np.zeros(len(pieces), dtype=np.uint32)
    for i in range(PIECE):
        value ^= tables[i][pieces[:, i]]
    level = 0
    while (count > 1).any():
        level += 1
        pieces, count = _pieces(value, np.cumsum(count) - count, count)
        tables = _tables(level)
        value = np.zeros(len(pieces), dtype=np.uint32)
        for i in range(PIECE):
            for k in range(4):
                value ^= tables[i, k][(pieces[:, i] >> np.uint32(8 * k)) & np.uint32(0xFF)]
    return value ^ _of_ones(size) ^ np.uint32(0xFFFFFFFF)


def _of_ones(size: np.ndarray) -> np.ndarray:
    """What the initial register of ones is after ``size`` zero bytes."""
    out = np.full(len(size), 0xFFFFFFFF, dtype=np.uint32)
    level, rest = 0, size.copy()
    while rest.any():
        digit = rest % PIECE
        for steps in np.unique(digit[digit > 0]):
            at = digit == steps
            out[at] = _applied(_operators(level)[steps], out[at])
        rest //= PIECE
        level += 1
    return out


def masked(crc: np.ndarray) -> np.ndarray:
    """Rotated and shifted, so that a checksum of data with checksums in it isn't degenerate."""
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + MASK_DELTA
