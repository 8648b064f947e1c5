"""Sharded minimal perfect hashes over 128-bit names, as arrays.

A shard places its keys level by level: each key marks a cell of a bit array, keys that are alone in
their cell stay there, the others go on to a smaller array with another hash. The number of marks
before a cell, over all levels, is the key's index, so n keys have the indices 0 to n - 1. Building
and probing are numpy operations over all keys at once.
"""

from __future__ import annotations

import io

import numpy as np

from .text_hash import mixed

_SPACE = 2  # cells for each key of a level
_STEP = 0x9E3779B97F4A7C15


def _cell(high: np.ndarray, low: np.ndarray, level: int, cells: int) -> np.ndarray:
    return (mixed(high ^ mixed(low + np.uint64(_STEP * (level + 1) % (1 << 64)))) % np.uint64(cells)).astype(np.int64)


class Shard:
    """Index and arrays of one shard's keys: fingerprint (the name's second half), count, keeper."""

    def __init__(self, levels: list[np.ndarray], n: int, arrays: dict[str, np.ndarray]) -> None:
        self.levels, self.n, self.arrays = levels, n, arrays
        marks = [np.unpackbits(bits).astype(bool) for bits in levels]
        before = np.cumsum([0, *(int(m.sum()) for m in marks)])
        # The place of each cell's key; what a cell without a key holds is never read.
        self.marks, self.ranks = marks, [np.cumsum(m) - 1 + b for m, b in zip(marks, before)]

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray, values: dict[str, np.ndarray]) -> Shard:
        """high and low: the halves of distinct names, unsigned 64 bits each."""
        rest, levels = np.arange(len(high)), []
        while len(rest):
            cells = -(-_SPACE * len(rest) // 8) * 8
            at = _cell(high[rest], low[rest], len(levels), cells)
            alone = np.bincount(at, minlength=cells) == 1
            levels.append(np.packbits(alone))
            rest = rest[~alone[at]]
        shard = cls(levels, len(high), {})
        index = shard.index(high, low)
        arrays = {"fingerprint": low, **values}
        for name, value in arrays.items():
            placed = np.empty_like(value)
            placed[index] = value
            shard.arrays[name] = placed
        return shard

    def index(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """A key's index; for other names -1 or any index, which the fingerprint tells."""
        out, rest = np.full(len(high), -1, dtype=np.int64), np.arange(len(high))
        for level, (marks, ranks) in enumerate(zip(self.marks, self.ranks)):
            if not len(rest):
                break
            at = _cell(high[rest], low[rest], level, len(marks))
            found = marks[at]
            out[rest[found]] = ranks[at[found]]
            rest = rest[~found]
        return out

    def probe(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """A key's index, -1 for all other names."""
        index = self.index(high, low)
        hit = index >= 0
        hit[hit] = self.arrays["fingerprint"][index[hit]] == low[hit]
        return np.where(hit, index, -1)

    def packed(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, n=self.n, **{f"level{k}": bits for k, bits in enumerate(self.levels)}, **{f"value_{k}": v for k, v in self.arrays.items()})
        return out.getvalue()

    @classmethod
    def unpacked(cls, data: bytes) -> Shard:
        with np.load(io.BytesIO(data)) as found:
            levels = [found[f"level{k}"] for k in range(sum(name.startswith("level") for name in found.files))]
            return cls(levels, int(found["n"]), {name[6:]: found[name] for name in found.files if name.startswith("value_")})
