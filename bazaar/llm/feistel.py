"""Keyed permutations of 0..n-1: a balanced Feistel network with cycle-walking."""

from __future__ import annotations

import hashlib

import numpy as np

from bazaar.llm import kernels

ROUNDS = 6


def _half(n: int) -> int:
    """Bits of each half of the least even-sized block that holds n values."""
    return max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)


def permute(value: int, n: int, key: bytes, tweak: bytes = b"") -> int:
    """The image of ``value`` under the permutation of 0..n-1 that key and tweak choose (exact integers)."""
    bits = _half(n)
    mask, size = (1 << bits) - 1, (bits + 7) // 8
    while True:
        left, right = value >> bits, value & mask
        for i in range(ROUNDS):
            seed = hashlib.blake2b(bytes([i]) + tweak + b"|" + right.to_bytes(size, "big"), key=key, digest_size=64)
            digest = seed.digest()
            while len(digest) < size:
                digest += hashlib.blake2b(digest, key=key, digest_size=64).digest()
            left, right = right, left ^ int.from_bytes(digest[:size], "big") & mask
        value = left << bits | right
        if value < n:
            return value


def permute_all(values: np.ndarray, n: int, key: int) -> np.ndarray:
    """The same kind of permutation for whole arrays of 64-bit values, with a fast round function."""
    bits = np.uint64(_half(n))
    mask = np.uint64((1 << int(bits)) - 1)
    keys = kernels.mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(key))
    out = values.astype(np.uint64)
    walk = np.arange(len(out))
    while len(walk):
        left, right = out[walk] >> bits, out[walk] & mask
        for k in keys:
            left, right = right, left ^ kernels.mix(right ^ k) & mask
        out[walk] = left << bits | right
        walk = walk[out[walk] >= n]
    return out.astype(np.int64)
