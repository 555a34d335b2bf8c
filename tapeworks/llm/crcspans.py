"""CRC-32 of many spans of one byte array at once.

The checksum of a message is linear in its bits but for a constant of its length: each byte adds a number that only
its value and its distance from the message's end decide. Those numbers are in a table; a span's sum is the exclusive or
over its bytes. Beyond the table's reach bytes are summed block by block, and blocks are folded in pairs.
"""

from __future__ import annotations

import zlib
from functools import cache

import numpy as np

#: Distances from the end that the table covers; a block's length.
REACH = 64
#: Reversed generator polynomial of CRC-32, a fixed value.
POLYNOMIAL = 0xEDB88320


@cache
def table() -> np.ndarray:
    """Contribution of each byte value at each distance from the end, as one flat array: distance times 256 plus byte."""
    out = np.empty((REACH, 256), np.uint32)
    row = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        row = np.where(row & 1, (row >> 1) ^ np.uint32(POLYNOMIAL), row >> 1)
    out[0] = row
    for d in range(1, REACH):
        out[d] = (out[d - 1] >> 8) ^ row[out[d - 1] & 255]
    return out.ravel()


def _apply(moved: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """A linear map, as its values for each of a sum's four bytes, applied to sums."""
    return moved[0][sums & 255] ^ moved[1][(sums >> 8) & 255] ^ moved[2][(sums >> 16) & 255] ^ moved[3][sums >> 24]


@cache
def shift(doublings: int) -> np.ndarray:
    """What ``REACH * 2 ** doublings`` zero bytes at the end make of a sum."""
    if doublings:
        half = shift(doublings - 1)
        return np.stack([_apply(half, x) for x in half])
    byte, out = table()[:256], np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for _ in range(REACH):
        out = (out >> 8) ^ byte[out & 255]
    return out


@cache
def _short_constants() -> np.ndarray:
    return np.array([zlib.crc32(bytes(n)) for n in range(2 * REACH + 1)], np.uint32)


def constants(lengths: np.ndarray) -> np.ndarray:
    """The checksums of messages of zero bytes."""
    short = _short_constants()
    out = short[np.minimum(lengths, len(short) - 1)]
    far = np.flatnonzero(lengths >= len(short))
    if len(far):
        distinct, at = np.unique(lengths[far], return_inverse=True)
        out[far] = np.array([zlib.crc32(bytes(int(n))) for n in distinct], np.uint32)[at]
    return out


def sums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Linear parts of spans that follow one another: bytes ``starts`` to ``ends`` (never empty, in order), seen from message ends ``last`` >= ``ends``."""
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths  # places in the bytes taken together
    if len(data) == int(lengths.sum()):
        taken, shifted = data, (last - 1 - starts + first)
    else:
        taken, shifted = data[np.arange(lengths.sum()) + np.repeat(starts - first, lengths)], (last - 1 - starts + first)
    distance = np.repeat(shifted, lengths)
    distance -= np.arange(len(distance))
    if int((last - starts).max(initial=0)) <= REACH:
        return np.bitwise_xor.reduceat(table()[(distance << 8) + taken], first)
    block = distance // REACH
    each = table()[((distance - block * REACH) << 8) + taken]
    span = np.repeat(np.arange(len(starts)), lengths)
    begin = np.flatnonzero(np.diff(span, prepend=-1) | np.diff(block, prepend=-1))
    found, span, block = np.bitwise_xor.reduceat(each, begin), span[begin], block[begin]
    doublings = 0
    while block.any():
        odd = (block & 1).astype(bool)
        found[odd] = _apply(shift(doublings), found[odd])
        block = block >> 1
        begin = np.flatnonzero(np.diff(span, prepend=-1) | np.diff(block, prepend=-1))
        found, span, block = np.bitwise_xor.reduceat(found, begin), span[begin], block[begin]
        doublings += 1
    return found
