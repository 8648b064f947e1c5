"""Exact and fast encoding of whole texts with files of the tokenizers library.

Both vocabularies split a text at white space and between letters and punctuation before any merge.
A text with single spaces and line feeds only is cut at them, and the units of a batch are made
distinct by Arrow. A unit of Latin letters and punctuation is parted once more, so that its word is
met without what stands around it. Each word that the worker has not met is encoded once, and the
ids are gathered by numpy. All other texts go to the tokenizer whole.
"""

from __future__ import annotations

import functools
import itertools
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Other white space, runs of white space, white space at an end, and the opening of special tokens.
_WHOLE = r"[^\S \n]|[ \n]{2}|^[ \n]|[ \n]$|<\||[\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# A unit's line feed, word, and punctuation but the apostrophe (which opens contractions).
_PARTS = r"^(?P<feed>\n?)(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[!-&(-/:-@\[-`{-~]*)$"
# Bounds of a worker's memory of units and of their ids; when it is full, only units that came back stay.
_MOST_UNITS = 400_000
_MOST_IDS = 8 * _MOST_UNITS


def _byte_characters() -> dict[int, str]:
    """The printable character that byte-level vocabularies use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    """Ids of one vocabulary. lower: the vocabulary is in lower case and drops white space."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # A text with an added token of the vocabulary goes whole.
        added = [rf"\Q{t.content}\E" for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = "|".join([_WHOLE, *added])
        self.lower = self.tokenizer.normalizer is not None
        self.byte_characters = _byte_characters()
        self.merges = self.tokenizer.model.tokenize
        self.known: dict[str, int] = {}
        self.pool, self.width, self.back = np.empty(0, dtype="<u4"), np.empty(0, dtype=np.int64), np.empty(0, dtype=bool)

    def _forget(self) -> None:
        """Keep the units that came back in a later batch, if those take less than half of the memory."""
        kept = np.fromiter((k for k in self.known.values() if self.back[k]), dtype=np.int64)
        if 2 * len(kept) > _MOST_UNITS or 2 * self.width[kept].sum() > _MOST_IDS:
            kept = kept[:0]
        place = np.full(len(self.width), -1)
        place[kept] = np.arange(len(kept))
        self.known = {key: n for key, k in self.known.items() if (n := int(place[k])) >= 0}
        self.pool, self.width = _gathered(self.pool, self.width, kept)
        self.back = np.zeros(len(kept), dtype=bool)

    def _plain(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _merged(self, word: str) -> list[int]:
        """Ids of Latin letters, perhaps after a space: they need the merges only."""
        mapped = word.replace(" ", self.byte_characters[32]) if word.isascii() else "".join([self.byte_characters[b] for b in word.encode()])
        return [t.id for t in self.merges(mapped)]

    def _numbers(self, keys: list[str], merged: np.ndarray) -> np.ndarray:
        """The places of some distinct units in the memory; those not met yet are encoded."""
        found = np.fromiter(map(self.known.get, keys, itertools.repeat(-1)), dtype=np.int64, count=len(keys))
        missing = np.flatnonzero(found < 0)
        self.back[found[found >= 0]] = True
        if len(missing):
            fresh, ids, width = [keys[k] for k in missing.tolist()], [], []
            for key, letters in zip(fresh, merged[missing].tolist()):
                own = self._merged(key) if letters else self._plain(key)
                ids += own
                width.append(len(own))
            found[missing] = np.arange(len(self.width), len(self.width) + len(missing))
            self.pool = np.concatenate([self.pool, np.array(ids, dtype="<u4")])
            self.width = np.concatenate([self.width, np.array(width, dtype=np.int64)])
            self.back = np.concatenate([self.back, np.zeros(len(missing), dtype=bool)])
            self.known.update((key, n) for key, n in zip(fresh, found[missing].tolist()) if len(key) <= 64)
        return found

    def _distinct(self, names: pa.Array, spaced: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct units, one after the other, and their numbers; spaced: those with a space before them."""
        if len(self.known) > _MOST_UNITS or len(self.pool) > _MOST_IDS:
            self._forget()
        feed, words, tail = pc.extract_regex(names, _PARTS).flatten()
        letters = np.asarray(words.is_valid())
        fed = letters & np.asarray(pc.equal(feed, "\n").fill_null(False))
        keys = pc.coalesce(pc.utf8_lower(words) if self.lower else words, names)
        if not self.lower:
            # No space stands before a line feed.
            before = spaced & ~fed & ~np.asarray(pc.starts_with(names, "\n"))
            keys = pc.binary_join_element_wise(pc.if_else(pa.array(before), " ", "").cast(keys.type), keys, pa.scalar("", keys.type))
        coded = keys.dictionary_encode()
        at = np.asarray(coded.indices).astype(np.int64)
        merged = np.zeros(len(coded.dictionary), dtype=bool)
        merged[at] = letters
        tails = pc.fill_null(tail, "").dictionary_encode()
        ends = tails.dictionary.to_pylist()
        others = self._numbers(["\n", "", *ends], np.zeros(len(ends) + 2, dtype=bool))
        parts = np.empty((len(names), 3), dtype=np.int64)
        parts[:, 0] = np.where(fed, others[0], others[1])
        parts[:, 1] = self._numbers(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), merged)[at]
        parts[:, 2] = others[2:][np.asarray(tails.indices)]
        ids, n = _gathered(self.pool, self.width, parts.reshape(-1))
        return ids, n.reshape(-1, 3).sum(axis=1)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row and the number of ids of each text; null is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = np.asarray(pc.match_substring_regex(texts, self.whole)) | (np.asarray(pc.binary_length(texts)) == 0)
        cut = texts.filter(pa.array(~whole))
        # Every unit but a text's first begins with its space or line feed.
        units = pc.split_pattern(pc.replace_substring(cut, "\n", " \n"), " ")
        starts = np.asarray(units.offsets).astype(np.int64)
        coded = units.flatten().dictionary_encode()
        code, names = np.asarray(coded.indices).astype(np.int64), coded.dictionary
        spaced = np.ones(len(names), dtype=bool)
        if not self.lower:
            first = np.zeros(len(code), dtype=bool)
            first[starts[:-1]] = True
            # A first word has no space before it, so it is another unit than the same word later.
            opening, code_of = np.unique(code[first], return_inverse=True)
            code[first] = len(names) + code_of
            names = pa.concat_arrays([names, names.take(pa.array(opening))])
            spaced = np.concatenate([spaced, np.zeros(len(opening), dtype=bool)])
        ids, n = _gathered(*self._distinct(names, spaced), code)
        sums = np.concatenate([[0], np.cumsum(n)])
        lengths = np.zeros(len(texts), dtype=np.int64)
        lengths[~whole] = sums[starts[1:]] - sums[starts[:-1]]
        if not whole.any():
            return ids, lengths
        parts, at = [], np.concatenate([[0], np.cumsum(lengths)])
        rows = np.flatnonzero(whole)
        last = 0
        for row, text in zip(rows, texts.filter(pa.array(whole)).to_pylist()):
            own = np.array(self._plain(text), dtype="<u4") if text else np.empty(0, dtype="<u4")
            parts += [ids[last:at[row]], own]
            last, lengths[row] = at[row], len(own)
        return np.concatenate([*parts, ids[last:]]), lengths


def _gathered(pool: np.ndarray, width: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each code, its stretch of the pool, one after the other; and the stretches' lengths."""
    begin = np.cumsum(width) - width
    n = width[code]
    ends = np.cumsum(n)
    place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin[code] - (ends - n), n)
    return pool[place], n


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)
