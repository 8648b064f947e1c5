"""Token counts under a unigram vocabulary, by dynamic programming shared along a trie.

A text's pre-tokens are its words with the vocabulary's word mark in front. The distinct ones of a
batch are put into a trie; a node's forward score is the best log probability of any segmentation
of the path to it, and is computed once however many pre-tokens pass through it. A pre-token's
number of tokens stands at its terminal node. The log probability of a piece is that of its place
in the public vocabulary under Zipf's law. A character outside the vocabulary costs one byte token
for each of its UTF-8 bytes.

Words are maximal runs without the bytes 0x20 and 0x09 to 0x0D.

Cases: a null, empty or blank text has no tokens; a null id stays; repeated rows are counted each;
an empty table gives no rows; further columns are ignored. Words of any length are segmented whole.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import slices, text_column

MARK = "▁"
_MOST_WORDS = 1_000_000
_COUNTED = "doc_id long, n_pretokens long, n_tokens long, n_byte_tokens long, log_probability double"


class Trie:
    """Forward scores of pre-tokens under pieces with log probabilities."""

    def __init__(self, pieces: dict[str, float], byte_score: float) -> None:
        self.pieces, self.byte_score = pieces, byte_score
        self.longest = max(map(len, pieces), default=1)

    def insert(self, pretokens: list[str]) -> dict[str, tuple[int, int, float]]:
        """Tokens, byte tokens and score of each pre-token.

        Sorted pre-tokens are a walk through the trie in depth-first order; the path holds the
        nodes of the last pre-token, and the next one begins where the two part.
        """
        pieces, longest, out = self.pieces, self.longest, {}
        path: list[tuple[float, int, int]] = [(0.0, 0, 0)]
        last = ""
        for word in sorted(set(pretokens)):
            same = 0
            for a, b in zip(last, word):
                if a != b:
                    break
                same += 1
            del path[same + 1:]
            for at in range(same + 1, len(word) + 1):
                score, tokens, spelled = path[at - 1]
                n = len(word[at - 1].encode())
                # Without a piece the character is spelled in bytes; fewer tokens win a tie.
                best = (score + n * self.byte_score, -(tokens + n), -(spelled + n))
                for start in range(max(0, at - longest), at):
                    p = pieces.get(word[start:at])
                    if p is not None:
                        score, tokens, spelled = path[start]
                        best = max(best, (score + p, -(tokens + 1), -spelled))
                path.append((best[0], -best[1], -best[2]))
            out[word] = (path[-1][1], path[-1][2], path[-1][0])
            last = word
        return out


class Counter:
    def __init__(self, model_path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = model.get_piece_size()
        ranked = [model.id_to_piece(i) for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        norm = math.log(sum(1 / r for r in range(1, size + 1)))
        self.trie = Trie({p: -math.log(r) - norm for r, p in enumerate(ranked, start=1)}, -math.log(size) - norm)
        self.known: dict[bytes, tuple[int, int, float]] = {}

    def counts(self, texts: list[str]) -> np.ndarray:
        """For each text: pre-tokens, tokens, byte tokens and log probability."""
        split = [t.encode().split() for t in texts]
        if len(self.known) > _MOST_WORDS:
            self.known.clear()
        known = self.known
        new = {MARK + w.decode(): w for words in split for w in words if w not in known}
        found = {new[p]: v for p, v in self.trie.insert(list(new)).items()}
        table = known | found if any(len(w) > 64 for w in found) else known
        known.update((w, v) for w, v in found.items() if len(w) <= 64)
        out = np.zeros((len(texts), 4))
        for row, words in enumerate(split):
            if words:
                out[row, 0] = len(words)
                out[row, 1:] = np.array([table[w] for w in words]).sum(axis=0)
        return out


@functools.lru_cache(maxsize=2)
def counter(model_path: str) -> Counter:
    return Counter(model_path)


def token_counts(docs: DataFrame, model_path: str) -> DataFrame:
    """Counts of each document (doc_id, text) under the vocabulary at model_path."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = counter(model_path)
        for batch in batches:
            for rows in slices(batch):
                found = tool.counts(text_column(rows))
                whole = [pa.array(found[:, k].astype(np.int64)) for k in range(3)]
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *whole, pa.array(found[:, 3])], names=[f.split()[0] for f in _COUNTED.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(count, _COUNTED)
