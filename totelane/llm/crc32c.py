"""CRC-32C of many byte strings at once, by combining checksums of halves.

Advancing a checksum over n zero bytes is linear in its bits, so four tables of 256 entries
do it for any n, and the tables for 2 n follow from those for n.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

# Fixed values of the checksum and its mask: reversed polynomial, rotation, added constant.
_POLYNOMIAL = 0x82F63B78
_MASK_ROTATION = 15
_MASK_ADDED = 0xA282EAD8


def _advance(tables: np.ndarray, state: np.ndarray) -> np.ndarray:
    return (
        tables[0][state & 0xFF]
        ^ tables[1][(state >> 8) & 0xFF]
        ^ tables[2][(state >> 16) & 0xFF]
        ^ tables[3][state >> 24]
    )


@lru_cache(maxsize=64)
def _tables(log: int) -> np.ndarray:
    """Tables that advance over ``2 ** log`` zero bytes."""
    if log:
        half = _tables(log - 1)
        return np.stack([_advance(half, half[i]) for i in range(4)])
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1)
    one = np.arange(256, dtype=np.uint32)
    return np.stack([table, one, one << 8, one << 16])


def _plain(rows: np.ndarray) -> np.ndarray:
    """Checksums from state zero of equally long rows, whose length is a power of two from 4."""
    state, log = _advance(_tables(2), np.ascontiguousarray(rows).view("<u4")), 2
    while state.shape[1] > 1:
        state = _advance(_tables(log), state[:, 0::2]) ^ state[:, 1::2]
        log += 1
    return state[:, 0]


def crc32c(texts: list[bytes]) -> np.ndarray:
    """The checksum of each byte string."""
    lengths = np.array([len(x) for x in texts], dtype=np.int64)
    found = np.zeros(len(texts), dtype=np.uint32)
    logs = np.maximum(2, np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64))
    for log in np.unique(logs):
        (own,) = np.nonzero(logs == log)
        # Zero bytes in front leave the state zero.
        padded = b"".join(texts[i].rjust(1 << log, b"\0") for i in own)
        found[own] = _plain(np.frombuffer(padded, np.uint8).reshape(len(own), 1 << log))
    start = np.full(len(texts), 0xFFFFFFFF, dtype=np.uint32)
    for log in range(int(lengths.max(initial=0)).bit_length()):
        moved = _advance(_tables(log), start)
        start = np.where((lengths >> log) & 1 == 1, moved, start)
    return found ^ start ^ np.uint32(0xFFFFFFFF)


def masked(checksums: np.ndarray) -> np.ndarray:
    """Checksums as they are stored beside data that may hold checksums itself."""
    turned = (checksums >> _MASK_ROTATION) | (checksums << np.uint32(32 - _MASK_ROTATION))
    return turned + np.uint32(_MASK_ADDED)
