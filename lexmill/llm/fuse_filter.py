"""Static three-wise binary fuse filters with 8-bit fingerprints, built and probed in numpy.

A filter never misses a key it was built from, and reports a foreign key with a chance of 1 in 256.
"""

from __future__ import annotations

import math
import struct

import numpy as np

from lexmill.llm.peeling import below, mix64

_HEADER = struct.Struct("<IIII")


def _layout(n_keys: int, attempt: int) -> tuple[int, int]:
    """(segment length, start segments) for ``n_keys``; a repeated failure widens the table."""
    segment = 1 << max(2, int(math.log(max(n_keys, 2)) / math.log(3.33) + 2.25))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n_keys, 3))) + 0.1 * (attempt // 8)
    return segment, max(1, math.ceil(n_keys * factor / segment) - 2)


def _slots(keys: np.ndarray, seed: int, segment: int, starts: int) -> tuple[np.ndarray, np.ndarray]:
    """Three slots in consecutive segments and the 8-bit fingerprint of each key."""
    mixed = mix64(keys, seed)
    first = below(mixed, starts * segment)
    low = mixed.astype(np.int64)
    second = first + segment ^ (low >> 18 & segment - 1)
    third = first + 2 * segment ^ (low & segment - 1)
    prints = (mixed ^ mixed >> np.uint64(32)).astype(np.uint8)
    return np.stack([first, second, third]), prints


def build(keys: np.ndarray) -> bytes:
    """The filter over ``keys`` (uint64; repeats count once). Building retries under another seed until it peels."""
    keys = np.unique(np.asarray(keys, np.uint64))
    for attempt in range(1000):
        segment, starts = _layout(len(keys), attempt)
        slots, prints = _slots(keys, attempt, segment, starts)
        order = _peel(slots, (starts + 2) * segment)
        if order is not None:
            break
    else:
        raise RuntimeError("no seed peels these keys")
    table = np.zeros((starts + 2) * segment, np.uint8)
    for members, free in reversed(order):
        table[free] = 0
        table[free] = prints[members] ^ table[slots[0, members]] ^ table[slots[1, members]] ^ table[slots[2, members]]
    return _HEADER.pack(len(keys), attempt, segment, starts) + table.tobytes()


def _peel(slots: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Rounds of (keys, the slot each had for itself), or None if a core of keys is left."""
    n_keys = slots.shape[1]
    degree = np.bincount(slots.ravel(), minlength=size)
    held = np.zeros(size, np.int64)
    for row in slots:
        np.bitwise_xor.at(held, row, np.arange(n_keys))
    rounds, left = [], n_keys
    while left:
        free = np.flatnonzero(degree == 1)
        if not len(free):
            return None
        members, index = np.unique(held[free], return_index=True)
        rounds.append((members, free[index]))
        for row in slots[:, members]:
            np.subtract.at(degree, row, 1)
            np.bitwise_xor.at(held, row, members)
        left -= len(members)
    return rounds


def contains(filter_bytes: bytes, keys: np.ndarray) -> np.ndarray:
    """For each key, whether the filter may hold it."""
    n_keys, seed, segment, starts = _HEADER.unpack_from(filter_bytes)
    if not n_keys:
        return np.zeros(len(keys), bool)
    table = np.frombuffer(filter_bytes, np.uint8, offset=_HEADER.size)
    slots, prints = _slots(np.asarray(keys, np.uint64), seed, segment, starts)
    return (prints ^ table[slots[0]] ^ table[slots[1]] ^ table[slots[2]]) == 0
