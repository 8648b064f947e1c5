"""Vectorised hashes of words and byte strings over a buffer that holds many texts.

A string's hash is a polynomial over random byte values modulo 2**64. With running sums of the
whole buffer, any stretch's hash is a difference times a power of the inverse base.
"""

from __future__ import annotations

import functools

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SEED = 20240229


@functools.lru_cache(maxsize=2)
def byte_values(lower: bool = False) -> np.ndarray:
    """A random odd number for each byte; with lower, A to Z have the numbers of a to z."""
    values = np.random.default_rng(_SEED).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    if lower:
        values[65:91] = values[97:123]
    return values


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """The first n powers modulo 2**64; a worker keeps those of its longest buffer so far."""
    if base not in _POWERS or len(_POWERS[base]) < n:
        steps = np.full(1 << max(16, int(n).bit_length()), base, dtype=np.uint64)
        steps[0] = 1
        _POWERS[base] = np.cumprod(steps)
    return _POWERS[base][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all bits, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Stretches:
    """Hashes of stretches of one buffer."""

    def __init__(self, buffer: np.ndarray, lower: bool = False) -> None:
        self.sums = np.zeros(len(buffer) + 1, dtype=np.uint64)
        np.cumsum(byte_values(lower)[buffer] * powers(_BASE, len(buffer)), out=self.sums[1:])
        self.back = powers(_INVERSE, len(buffer) + 1)

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def words(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run without the bytes 0x20 and 0x09 to 0x0D."""
    inside = np.zeros(len(buffer) + 2, dtype=np.int8)
    inside[1:-1] = (buffer != 32) & ((buffer < 9) | (buffer > 13))
    change = np.diff(inside)
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer with a line feed after each text, and where each text starts (and the end)."""
    buffer = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    return buffer, np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
