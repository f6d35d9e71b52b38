"""Sets of 5-word shingles as sorted arrays of 64-bit hashes.

Words are runs of bytes other than U+0020 and U+0009 to U+000D, with A-Z
lowered.  A shingle's hash is a polynomial over its bytes (words joined by
one space) with a table of byte values, mixed at the end; prefix sums give
the hash of every window of a text in a few array operations.  Two different
shingles of one comparison share a hash with a chance of about 2^-58."""

from __future__ import annotations

import hashlib

import numpy as np

WIDTH = 5
_P = 0x9E3779B97F4A7C15 | 5  # odd, so it has an inverse modulo 2^64
_Q = pow(_P, -1, 1 << 64)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_P))


def _powers(n: int) -> list[np.ndarray]:
    """Powers of _P and of its inverse, at least n of them."""
    while len(_POWERS[0]) < n:
        size = len(_POWERS[0])
        for k, base in enumerate((_P, _Q)):
            step = np.uint64(pow(base, size, 1 << 64))
            _POWERS[k] = np.concatenate([_POWERS[k], _POWERS[k] * step])
    return _POWERS


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct shingles of a text; with fewer words, all of them as one."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    raw = np.frombuffer(b" ".join(words), np.uint8)
    power, inverse = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTES[raw] * power[:len(raw)], out=sums[1:])
    gaps = np.flatnonzero(raw == 32)
    k = min(WIDTH, len(words))
    starts = np.concatenate([[0], gaps + 1])[:len(words) - k + 1]
    ends = np.concatenate([gaps, [len(raw)]])[k - 1:]
    return np.unique(mix((sums[ends] - sums[starts]) * inverse[starts]))


def digest(shingles: np.ndarray) -> bytes:
    """16 bytes that name a set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
