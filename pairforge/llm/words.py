"""Vectorised hashes of the words of a text, for routing and set comparison."""

from __future__ import annotations

import numpy as np

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: A random 64-bit value for each byte at each of 256 positions; further positions scale it.
_TABLE = np.random.Generator(np.random.PCG64(20240229)).integers(0, 2**64, size=256 * 256, dtype=np.uint64)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


_BLOCK, _IN_GRAM = powers(0x100000001B3, 4096), powers(0x9E3779B97F4A7C55, 64)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _M2
    h = (h ^ (h >> np.uint64(29))) * _M1
    return h ^ (h >> np.uint64(32))


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of each word ``[^\\x20\\x09-\\x0D]+``, in order."""
    b = np.frombuffer(raw, np.uint8)
    if not len(b):
        return np.empty(0, np.uint64)
    word = ~((b == 32) | ((b >= 9) & (b <= 13)))
    starts = np.flatnonzero(word & np.concatenate([[True], ~word[:-1]]))
    if not len(starts):
        return np.empty(0, np.uint64)
    b, word = b[starts[0] :], word[starts[0] :]
    starts = starts - starts[0]
    at = np.arange(len(b), dtype=np.int32) - np.repeat(starts.astype(np.int32), np.diff(np.concatenate([starts, [len(b)]])))
    value = _TABLE[(b.astype(np.int32) << 8) | (at & 255)]
    if len(b) > 256:
        far = np.flatnonzero((at > 255) & word)
        if len(far):
            value[far] *= _BLOCK[(at[far] >> 8) & 4095]
    value[~word] = 0
    return mix(np.add.reduceat(value, starts))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each ``k`` consecutive words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    grams = np.full(n, k, np.uint64)
    for j in range(k):
        grams += words[j : n + j] * _IN_GRAM[j]
    return mix(grams)
