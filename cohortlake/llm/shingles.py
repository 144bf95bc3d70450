"""Sets of word shingles in numpy: exact 64-bit ids, minwise sketches, similarity."""

from __future__ import annotations

from zlib import adler32, crc32

import numpy as np

WIDTH = 5  # words of a shingle
COORDINATES = 64  # minwise values of a sketch

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31, _S32 = (np.uint64(s) for s in (30, 27, 31, 32))


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


#: Odd multipliers, one per coordinate, from the rule mixed(1), mixed(2), ...
MULTIPLIERS = mixed(np.arange(1, COORDINATES + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_set(words: list[bytes], width: int = WIDTH) -> np.ndarray:
    """Sorted distinct ids of the shingles; fewer words than ``width`` make one
    shingle of the whole sequence, no words none. A word's id joins two
    checksums, so that ids agree on every machine."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    ids = mixed(np.fromiter((crc32(w) << 32 | adler32(w) for w in words), np.uint64, n))
    span = min(n, width)
    out = np.full(n - span + 1, span, np.uint64)
    for i in range(span):
        out = mixed(out * _M1 + ids[i : n - span + 1 + i])
    return np.unique(out)


def sketch(ids: np.ndarray) -> np.ndarray:
    """Upper halves of the least product with each multiplier, a minwise value for each coordinate."""
    least = np.full(COORDINATES, ~np.uint64(0), np.uint64)
    for at in range(0, len(ids), 1024):
        np.minimum(least, (ids[at : at + 1024, None] * MULTIPLIERS[None, :]).min(axis=0), out=least)
    return (least >> _S32).astype(np.uint32)


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


def links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = shared(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)
