"""Quality rules: a base of counting rules, then tokeniser fertility against bands per language.

Two public vocabularies measure each text word by word: characters per token in both, the share of
byte-fallback tokens and the entropy of the tokens. A document that passes the base rules is kept
if every measure lies in its language's band. Bands come from all documents that passed the base.
A mean over n words scatters with 1 / sqrt(n), so a measure's distance from its language's median is
taken times sqrt(n), and the quartiles of that, widened by a multiple of their distance, are the
band: narrow for a long text, wide for a short one. The entropy of few words is low as well, so
its median follows a line in 1 / sqrt(n).

Words are maximal runs without the bytes 0x20 and 0x09 to 0x0D.

Cases: a null, empty or blank text has no words and fails the base; a null language forms a
language of its own; repeated rows are measured alike; an empty table gives no rows; further
columns are ignored. Texts are measured whole, one at a time.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .shared import staged, text_column

SYMBOLS = "#*$%&|<>"
_SPACE = " \t\n\x0b\x0c\r"
_MOST_WORDS = 500_000
MEASURES = ("chars_per_piece", "chars_per_byte_token", "byte_share", "token_entropy")
_MEASURED = ("doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
             + ", ".join(f"{m} double" for m in MEASURES))


class Fertility:
    """Tokens of words in a piece vocabulary with byte fallback and in a byte-level vocabulary."""

    def __init__(self, piece_path: str, rank_path: str, pattern: str) -> None:
        import base64

        import sentencepiece
        import tiktoken

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.pieces.get_piece_size())])
        with open(rank_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.bytes = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[bytes, tuple[bytes, int]] = {}

    def of(self, words: list[bytes]) -> list[tuple[bytes, int]]:
        """For each word its piece ids (32-bit, packed) and its number of byte-level tokens."""
        known = self.known
        if len(known) > _MOST_WORDS:
            known.clear()
        new = [w for w in words if w not in known]
        if new:
            texts = [w.decode() for w in new]
            ids = self.pieces.encode(texts, num_threads=1)
            found = {w: (np.array(i, dtype="<u4").tobytes(), len(self.bytes.encode_ordinary(" " + t))) for w, i, t in zip(new, ids, texts)}
            known.update((w, f) for w, f in found.items() if len(w) <= 64)
            return [known[w] if w in known else found[w] for w in words]
        return [known[w] for w in words]

    def measures(self, words: list[bytes], counts: np.ndarray, chars: int) -> tuple[float | None, ...]:
        """The measures of a text from its distinct words and how often each occurs."""
        if not words:
            return (None,) * 4
        found = self.of(words)
        n_pieces = np.fromiter((len(f[0]) // 4 for f in found), dtype=np.int64, count=len(found))
        ids = np.frombuffer(b"".join([f[0] for f in found]), dtype="<u4")
        seen = np.bincount(ids, weights=np.repeat(counts, n_pieces), minlength=len(self.is_byte))
        total = seen.sum()
        n_bytes = float(np.dot(counts, [f[1] for f in found]))
        share = seen[seen > 0] / total if total else np.ones(1)
        return (chars / max(total, 1.0), chars / max(n_bytes, 1.0), float(seen[self.is_byte].sum() / max(total, 1.0)),
                float(-(share * np.log2(share)).sum()))


@functools.lru_cache(maxsize=2)
def fertility(piece_path: str, rank_path: str, pattern: str) -> Fertility:
    return Fertility(piece_path, rank_path, pattern)


def repeated_words(codes: np.ndarray, distinct: int) -> int:
    """Words that lie in a three-word window found twice or more."""
    if len(codes) < 3:
        return 0
    pairs = codes[:-1] * distinct + codes[1:]
    if distinct >= 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * distinct + codes[2:]
    _, at, n = np.unique(windows, return_inverse=True, return_counts=True)
    again = n[at] > 1
    covered = np.zeros(len(codes), dtype=bool)
    for shift in range(3):
        covered[shift:len(codes) - 2 + shift] |= again
    return int(covered.sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(_SPACE)]
    return len(lines) - len(set(lines))


def measured(docs: DataFrame, piece_path: str, rank_path: str, pattern: str) -> DataFrame:
    """Counts of the base rules and the fertility measures of each document."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = fertility(piece_path, rank_path, pattern)
        for batch in batches:
            rows = []
            for text in text_column(batch):
                words = text.encode().split()
                code: dict[bytes, int] = {}
                codes = np.array([code.setdefault(w, len(code)) for w in words], dtype=np.int64)
                chars = len(text) - sum(map(text.count, _SPACE))
                counts = np.bincount(codes, minlength=len(code)).astype(float)
                rows.append((len(words), chars, sum(map(text.count, SYMBOLS)), repeated_lines(text), repeated_words(codes, len(code)),
                             *tool.measures(list(code), counts, chars)))
            columns = list(zip(*rows)) if rows else [[]] * 9
            kinds = [pa.int64()] * 5 + [pa.float64()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("lang"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=[f.split()[0] for f in _MEASURED.split(", ")])

    lang = F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")
    return docs.select(F.col("doc_id").cast("long"), lang.alias("lang"), F.col("text").cast("string")).mapInArrow(measure, _MEASURED)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _level(measure: str) -> Column:
    """A measure without what the length of the text does to its mean."""
    return F.col(measure) - F.col("slope") / F.sqrt("n_words") if measure == "token_entropy" else F.col(measure)


def _scatter(measure: str) -> Column:
    return (_level(measure) - F.col(f"{measure}_mid")) * F.sqrt("n_words")


def bands(rows: DataFrame, widen: float = 4.0, widen_entropy: float = 5.0) -> DataFrame:
    """Per language the entropy's slope, and per measure its median and the quartiles and the room
    of the distance from it times the root of the words, over all rows given."""
    # Written, so that each join knows its size: a few numbers for each language.
    near = 1 / F.sqrt("n_words")
    thirds = staged(rows.groupBy("lang").agg(F.percentile_approx(near, [1 / 3, 2 / 3], 1000).alias("thirds")), "thirds")
    # A line through the medians of the longest and the shortest third: outliers do not turn it.
    ends = [[F.percentile_approx(F.when(third, x), 0.5, 1000) for x in (near, F.col("token_entropy"))]
            for third in (near <= F.col("thirds")[0], near >= F.col("thirds")[1])]
    slope = F.try_divide(ends[1][1] - ends[0][1], ends[1][0] - ends[0][0])
    slopes = staged(rows.join(thirds, "lang").groupBy("lang").agg(F.coalesce(slope, F.lit(0.0)).alias("slope")), "slopes")
    mids = staged(rows.join(slopes, "lang").groupBy("lang", "slope").agg(
        *[F.percentile_approx(_level(m), 0.5, 1000).alias(f"{m}_mid") for m in MEASURES]), "mids")
    quartiles = rows.join(mids, "lang").groupBy(*mids.columns).agg(
        *[F.percentile_approx(_scatter(m), [0.25, 0.75], 1000).alias(m) for m in MEASURES])
    out = [F.col(c) for c in mids.columns]
    for m in MEASURES:
        low, high = F.col(m)[0], F.col(m)[1]
        out += [low.alias(f"{m}_low"), high.alias(f"{m}_high"), ((widen_entropy if m == "token_entropy" else widen) * (high - low)).alias(f"{m}_room")]
    return staged(quartiles.select(*out), "bands")


def quality_rules(docs: DataFrame, piece_path: str, rank_path: str, pattern: str, widen: float = 4.0,
                  widen_entropy: float = 5.0) -> DataFrame:
    """Counts, measures, base_failed and kept of each document (doc_id, text, lang)."""
    rows = staged(measured(docs, piece_path, rank_path, pattern), "fertility").withColumn("base_failed", base_failed())
    limits = bands(rows.filter(~F.col("base_failed")), widen, widen_entropy)

    def inside(m: str) -> Column:
        # At least 0.02 of the measure itself, where all documents of a language are alike.
        room = F.greatest(F.col(f"{m}_room"), 0.02 * F.sqrt("n_words"))
        return _scatter(m).between(F.col(f"{m}_low") - room, F.col(f"{m}_high") + room)

    # A language has a band as soon as one of its documents passes the base.
    return (rows.join(limits, "lang", "left")
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(functools.reduce(lambda a, b: a & b, map(inside, MEASURES)), F.lit(True)))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lang", *MEASURES))
