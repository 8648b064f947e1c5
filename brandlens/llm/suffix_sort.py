"""Suffix array by two-stage sorting, and common prefixes of neighbours, with numpy."""

from __future__ import annotations

import numpy as np

SEPARATOR = 0xFF  # does not occur in UTF-8


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """For each suffix whether it is smaller than its successor; the last one is not."""
    n = len(text)
    step = np.zeros(n, dtype=np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1])
    # In a run of equal bytes, the next change decides.
    change = np.where(step != 0, np.arange(n), n - 1)
    step = step[np.minimum.accumulate(change[::-1])[::-1]]
    return step > 0


def suffix_array(data: bytes, depth: int) -> np.ndarray:
    """Suffixes in order of their first `depth` bytes.

    Stage one sorts those smaller than their successors. Stage two scans the buckets of first
    bytes from the least: each suffix found there puts its predecessor, if that is larger than its
    successor, at the end of the predecessor's bucket.
    """
    text = np.frombuffer(data, dtype=np.uint8)
    n = len(text)
    smaller = smaller_than_next(text)
    direct = np.flatnonzero(smaller).tolist()
    keys = [data[i:i + depth] for i in direct]
    order = sorted(range(len(direct)), key=keys.__getitem__)
    ranked = np.array(direct, dtype=np.int64)[order]
    first = text[ranked]
    bounds = np.searchsorted(first, np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced[text[-1]].append(np.array([n - 1]))
    out = []

    def scan(found: np.ndarray, byte: int) -> np.ndarray:
        """Deal the predecessors out to their buckets; those of the same bucket come back."""
        before = found[found > 0] - 1
        before = before[~smaller[before]]
        bucket = text[before]
        later = bucket > byte
        rest, at = before[later], bucket[later]
        if len(rest):
            stable = np.argsort(at, kind="stable")
            rest, at = rest[stable], at[stable]
            cuts = np.flatnonzero(np.diff(at)) + 1
            for part, target in zip(np.split(rest, cuts), at[np.concatenate([[0], cuts])]):
                induced[target].append(part)
        return before[bucket == byte]

    for byte in range(256):
        todo = np.concatenate(induced[byte]) if induced[byte] else np.empty(0, dtype=np.int64)
        while len(todo):
            out.append(todo)
            todo = scan(todo, byte)
        own = ranked[bounds[byte]:bounds[byte + 1]]
        if len(own):
            out.append(own)
            scan(own, byte)
    return np.concatenate(out)


def common_prefixes(data: bytes, places: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of each place with the next one, up to `depth`, in whole steps of eight bytes."""
    text = np.frombuffer(data + bytes(depth + 8), dtype=np.uint8)
    word = np.zeros(len(text) - 7, dtype=np.uint64)
    for k in range(8):
        word |= text[k:len(text) - 7 + k].astype(np.uint64) << np.uint64(8 * k)
    length = np.zeros(max(len(places) - 1, 0), dtype=np.int64)
    alive = np.arange(len(length))
    for at in range(0, depth, 8):
        alive = alive[word[places[alive] + at] == word[places[alive + 1] + at]]
        if not len(alive):
            break
        length[alive] += 8
    return length


def repeated_starts(contexts: list[bytes], length: int) -> list[np.ndarray]:
    """For each context, of which windows of `length` bytes (by start) there is an equal one elsewhere
    in the contexts, and whether the window is the first of its kind. length: a multiple of 8."""
    if not contexts:
        return []
    data = bytes([SEPARATOR]).join([*contexts, b""])
    sizes = np.array([len(c) for c in contexts])
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    whole = np.zeros(len(data), dtype=bool)
    for begin, size in zip(begins, sizes):
        whole[begin:begin + max(size - length + 1, 0)] = True
    places = suffix_array(data, length)
    places = places[whole[places]]
    same = common_prefixes(data, places, length) >= length
    again = np.zeros(len(places), dtype=bool)
    again[1:] |= same
    again[:-1] |= same
    group = np.cumsum(np.concatenate([[True], ~same])) - 1 if len(places) else np.empty(0, dtype=np.int64)
    first = np.full(group[-1] + 1 if len(group) else 0, len(data))
    np.minimum.at(first, group, places)
    state = np.zeros(len(data), dtype=np.int8)
    state[places] = again.astype(np.int8) + (again & (first[group] == places))
    return [state[b:b + max(s - length + 1, 0)] for b, s in zip(begins, sizes)]
