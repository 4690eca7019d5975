"""Elias-Fano coding of a non-decreasing sequence, with select.

Every value is cut into ``low`` lower bits, stored as they are, and a high part, stored in unary: bit
``high + i`` of a bit vector is set for the value of index ``i``. Space is at most about
``2 + log2(bound / count)`` bits a value. ``select`` finds set bits by counts per block of 64 bytes.
"""

from __future__ import annotations

import struct

import numpy as np

BLOCK_BYTES = 64
_ONES = np.array([bin(b).count("1") for b in range(256)], dtype=np.uint8)


def _pack(values: np.ndarray, width: int) -> bytes:
    bits = (values[:, None] >> np.arange(width)) & 1
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


class EliasFano:
    def __init__(self, content: bytes):
        self.count, self.low, self.low_bytes = struct.unpack_from("<QBQ", content)
        start = struct.calcsize("<QBQ")
        self.lower = np.frombuffer(content, dtype=np.uint8, count=self.low_bytes, offset=start)
        upper = np.frombuffer(content, dtype=np.uint8, offset=start + self.low_bytes)
        self.upper = np.concatenate([upper, np.zeros(-len(upper) % BLOCK_BYTES, dtype=np.uint8)]).reshape(-1, BLOCK_BYTES)
        self.before = np.concatenate([[0], np.cumsum(_ONES[self.upper].sum(axis=1, dtype=np.uint32), dtype=np.uint32)])

    @staticmethod
    def encode(values: np.ndarray) -> bytes:
        values = np.asarray(values, dtype=np.int64)
        count, bound = len(values), int(values[-1]) if len(values) else 0
        low = max(0, (bound // max(1, count)).bit_length() - 1)
        lower = _pack(values & ((1 << low) - 1), low) if low else b""
        upper = np.zeros((count + (bound >> low) + 8) // 8, dtype=np.uint8)
        place = (values >> low) + np.arange(count)
        np.bitwise_or.at(upper, place >> 3, (1 << (place & 7)).astype(np.uint8))
        return struct.pack("<QBQ", count, low, len(lower)) + lower + upper.tobytes()

    def select(self, index: np.ndarray) -> np.ndarray:
        """Values of these indices."""
        index = np.asarray(index, dtype=np.int64)
        block = np.searchsorted(self.before, index, side="right") - 1
        bits = np.unpackbits(self.upper[block], axis=1, bitorder="little")
        rest = index - self.before[block]
        inside = np.argmax(np.cumsum(bits, axis=1, dtype=np.int16) == (rest + 1)[:, None], axis=1)
        high = block * BLOCK_BYTES * 8 + inside - index
        values = high << self.low
        for bit in range(self.low):
            place = index * self.low + bit
            values |= ((self.lower[place >> 3] >> (place & 7)) & 1).astype(np.int64) << bit
        return values
