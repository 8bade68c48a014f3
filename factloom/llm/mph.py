"""A minimal perfect hash over 64-bit keys: cascaded bit arrays, with a rank of the set bits."""

from __future__ import annotations

import struct

import numpy as np

_GAMMA = 2
_LEVELS = 64


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift) of the keys, one function for each seed."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 1 << 20) >> np.uint64(32)).astype(np.uint32)


class Mph:
    """slots() sends the n distinct keys that it was built from onto 0..n-1; any other key to any slot, or to -1.

    Level by level each remaining key hashes into a bit array of twice their number; a key alone on its bit stays
    there, the others go on. A key's slot is the rank of its bit, so a lookup takes a constant number of probes.
    """

    def __init__(self, bits: list[np.ndarray]):
        self.bits = bits
        self.ranks, before = [], 0
        for level in bits:
            self.ranks.append(np.cumsum(level, dtype=np.int64) - 1 + before)
            before += int(level.sum())

    @classmethod
    def build(cls, keys: np.ndarray) -> Mph:
        rest, bits = keys.astype(np.uint64), []
        while len(rest):
            if len(bits) >= _LEVELS:
                raise ValueError("keys must be distinct")
            size = -(-_GAMMA * len(rest) // 64) * 64
            at = mix(rest, len(bits)) % np.uint64(size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            bits.append(alone)
            rest = rest[~alone[at]]
        return cls(bits)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, dtype=np.int64)
        rest, left = keys.astype(np.uint64), np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.bits, self.ranks, strict=True)):
            at = mix(rest, level) % np.uint64(len(bits))
            hit = bits[at]
            out[left[hit]] = ranks[at[hit]]
            rest, left = rest[~hit], left[~hit]
        return out

    def dumps(self) -> bytes:
        head = struct.pack(f"<I{len(self.bits)}Q", len(self.bits), *map(len, self.bits))
        return head + b"".join(np.packbits(level, bitorder="little").tobytes() for level in self.bits)

    @classmethod
    def loads(cls, data: bytes, at: int = 0) -> tuple[Mph, int]:
        (levels,) = struct.unpack_from("<I", data, at)
        sizes = struct.unpack_from(f"<{levels}Q", data, at + 4)
        at += 4 + 8 * levels
        bits = []
        for size in sizes:
            bits.append(np.unpackbits(np.frombuffer(data, np.uint8, size // 8, at), bitorder="little").astype(bool))
            at += size // 8
        return cls(bits), at
