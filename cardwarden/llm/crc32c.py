"""CRC-32C (Castagnoli) of many byte strings at once, with NumPy, and its masked form."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8
BLOCK = 256
_ALL = np.uint32(0xFFFFFFFF)


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


TABLE = _byte_table()


def _zeros_tables() -> np.ndarray:
    """What BLOCK zero bytes make of each byte of a remainder."""
    out = np.empty((4, 256), np.uint32)
    for place in range(4):
        value = np.arange(256, dtype=np.uint32) << np.uint32(8 * place)
        for _ in range(BLOCK):
            value = TABLE[value & 255] ^ (value >> 8)
        out[place] = value
    return out


ZEROS = _zeros_tables()


def crc32c(strings: Sequence[bytes]) -> np.ndarray:
    """Checksums, as uint32. All blocks of all strings advance together, byte by byte.

    Zeros before a string don't change its plain remainder, so strings are filled up in front;
    the usual start value is the same as inverting the first four bytes.
    """
    if not len(strings):
        return np.empty(0, np.uint32)
    size = np.fromiter(map(len, strings), np.int64, len(strings))
    blocks = np.maximum(-(-np.maximum(size, 4) // BLOCK), 1)
    ends = np.cumsum(blocks) * BLOCK
    data = np.zeros(int(ends[-1]), np.uint8)
    for s, n, end in zip(strings, size, ends, strict=True):
        if n:
            data[end - n:end] = np.frombuffer(s, np.uint8)
    starts = ends - size
    for i in range(4):
        data[(starts + i)[size > i]] ^= 0xFF
    lanes = np.ascontiguousarray(data.reshape(-1, BLOCK).T)
    rest = np.zeros(lanes.shape[1], np.uint32)
    for column in lanes:
        rest = TABLE.take((rest ^ column) & 255) ^ (rest >> 8)
    first, out = np.cumsum(blocks) - blocks, np.zeros(len(strings), np.uint32)
    order = np.argsort(-blocks, kind="stable")
    for step in range(int(blocks.max())):
        order = order[: np.searchsorted(-blocks[order], -step)]  # those with a block of this number
        r = out[order]
        for place in range(4):
            moved = ZEROS[place].take((r >> np.uint32(8 * place)) & 255)
            out[order] = moved if place == 0 else out[order] ^ moved
        out[order] ^= rest[first[order] + step]
    out ^= _ALL
    short = np.flatnonzero(size < 4)  # too short for the inverted start
    for i in short:
        r = 0xFFFFFFFF
        for b in strings[i]:
            r = int(TABLE[(r ^ b) & 255]) ^ (r >> 8)
        out[i] = r ^ 0xFFFFFFFF
    return out


def masked(crc: np.ndarray) -> np.ndarray:
    """Rotated and moved, so that a checksum of data that hold checksums stays a good one."""
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK_DELTA)
