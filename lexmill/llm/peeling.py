"""Peeling of hashed cells, for the Bloom lookup sketch and the fuse filter, as numpy rounds."""

from __future__ import annotations

import numpy as np

_MIX_A, _MIX_B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_SHIFT = np.uint64(33)


def mix64(keys: np.ndarray, seed: int) -> np.ndarray:
    """A bijective 64-bit finaliser of ``keys`` under ``seed``."""
    with np.errstate(over="ignore"):
        mixed = keys ^ np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        mixed = (mixed ^ (mixed >> _SHIFT)) * _MIX_A
        mixed = (mixed ^ (mixed >> _SHIFT)) * _MIX_B
    return mixed ^ (mixed >> _SHIFT)


def below(hashes: np.ndarray, bound: np.ndarray | int) -> np.ndarray:
    """The upper 32 bits of each hash, scaled to ``0 .. bound - 1``."""
    return ((hashes >> np.uint64(32)) * np.asarray(bound, np.uint64) >> np.uint64(32)).astype(np.int64)
