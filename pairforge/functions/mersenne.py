"""The standard library's seeded shuffle, vectorised (L6, bit for bit).

``random.Random(seed).shuffle(items)`` for a whole column of seeds: numpy runs the Mersenne Twister's
seeding for all rows of an Arrow batch at once (624 steps over arrays of one word a row), then draws only
the few words that a short shuffle needs.  Seeds are 64-bit integers; a negative one seeds like its
absolute value, as in the standard library.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the generator (MT19937).
WORDS, MIDDLE = 624, 397
FIRST_SEED, FACTOR, ARRAY_FACTOR, LAST_FACTOR = 19650218, 1812433253, 1664525, 1566083941
TWIST, UPPER, LOWER = 0x9908B0DF, 0x80000000, 0x7FFFFFFF
MASK_B, MASK_C = 0x9D2C5680, 0xEFC60000

_U32 = np.uint32


def first_state() -> list[int]:
    """The state after seeding with ``FIRST_SEED``, from which every array seeding starts."""
    state = [FIRST_SEED]
    for i in range(1, WORDS):
        state.append((FACTOR * (state[-1] ^ (state[-1] >> 30)) + i) % 2**32)
    return state


def _seeded(key: list[np.ndarray]) -> np.ndarray:
    """(624, rows): the state after seeding with each row's key words, least significant first."""
    state = np.repeat(np.array(first_state(), _U32)[:, None], len(key[0]), axis=1)

    def mixed(i: int, factor: int) -> np.ndarray:
        before = state[i - 1]
        return state[i] ^ ((before ^ (before >> _U32(30))) * _U32(factor))

    i = 1
    for step in range(WORDS):
        j = step % len(key)
        state[i] = mixed(i, ARRAY_FACTOR) + key[j] + _U32(j)
        i += 1
        if i == WORDS:
            state[0], i = state[WORDS - 1], 1
    for _ in range(WORDS - 1):
        state[i] = mixed(i, LAST_FACTOR) - _U32(i)
        i += 1
        if i == WORDS:
            state[0], i = state[WORDS - 1], 1
    state[0] = UPPER
    return state


def _word(state: np.ndarray, t: int) -> np.ndarray:
    """The ``t``-th output word; before the first WORDS - MIDDLE words no state is needed twice."""
    y = (state[t] & _U32(UPPER)) | (state[t + 1] & _U32(LOWER))
    v = state[t + MIDDLE] ^ (y >> _U32(1)) ^ ((y & _U32(1)) * _U32(TWIST))
    v = v ^ (v >> _U32(11))
    v = v ^ ((v << _U32(7)) & _U32(MASK_B))
    v = v ^ ((v << _U32(15)) & _U32(MASK_C))
    return v ^ (v >> _U32(18))


def _orders(key: list[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows x n item numbers in shuffled order, whether the drawn words sufficed)."""
    state, rows = _seeded(key), len(key[0])
    order = np.tile(np.arange(n), (rows, 1))
    place = np.full(rows, n - 1)  # the place that each row's next accepted draw fills
    for t in range(WORDS - MIDDLE):
        going = np.flatnonzero(place > 0)
        if not len(going):
            break
        choices = place[going] + 1
        bits = np.array([int(c).bit_length() for c in range(n + 1)])[choices]
        draw = (_word(state[:, going], t) >> (32 - bits).astype(_U32)).astype(np.int64)
        ok = draw < choices
        at, j = going[ok], draw[ok]
        i = place[at]
        order[at, i], order[at, j] = order[at, j], order[at, i]
        place[at] -= 1
    return order, place == 0


def shuffled(seeds: np.ndarray, n: int) -> np.ndarray:
    """Rows x n: ``list(range(n))`` after ``random.Random(seed).shuffle``, for each seed."""
    seeds = np.asarray(seeds, np.int64)
    size = np.where(seeds < 0, (~seeds).view(np.uint64) + np.uint64(1), seeds.view(np.uint64))
    low, high = (size & np.uint64(0xFFFFFFFF)).astype(_U32), (size >> np.uint64(32)).astype(_U32)
    out, done = np.empty((len(seeds), n), np.int64), np.ones(len(seeds), bool)
    for rows, words in ((np.flatnonzero(high == 0), 1), (np.flatnonzero(high > 0), 2)):
        if len(rows):
            out[rows], done[rows] = _orders([low[rows], high[rows]][:words], n)
    for row in np.flatnonzero(~done):  # a long run of rejected draws
        items = list(range(n))
        random.Random(int(seeds[row])).shuffle(items)
        out[row] = items
    return out


def shuffle_labels(seed: Column, items: Sequence[str]) -> Column:
    """``items`` as ``random.Random(seed).shuffle`` leaves them; null for a null seed."""
    names = np.array(list(items), dtype=object)

    @F.pandas_udf("array<string>")
    def order(seeds: pd.Series) -> pd.Series:
        known = seeds.notna()
        out = pd.Series([None] * len(seeds), dtype=object)
        if known.any():
            drawn = names[shuffled(seeds[known].to_numpy(np.int64), len(names))]
            out[np.flatnonzero(known)] = pd.Series(list(drawn), index=np.flatnonzero(known))
        return out

    return order(seed.cast("bigint"))
