"""Source divergence audit: how far the term frequencies of a source lie from those of the other
sources of its language, and which terms it uses more than its language does.

Term strings stay out of the counting shuffles (late materialization):

1. A task hashes the terms of its texts to 64-bit digests and counts occurrences and documents by
   (lang, source, digest) before anything is sent. Only fixed-width rows meet in the shuffle.
2. Digests in enough documents of a language are kept. One more pass sends, once a task, the strings
   whose digests fall in a bit table of kept ones; the smallest and largest string of a digest show
   whether it stands for several terms. Such a digest is split: its terms are counted by string.
3. Smoothed integer frequencies are compared. Only the terms of the report get their text.

Distances between all sources of a language come from tiles: the kept terms are dealt to blocks and
the sources to blocks, and a task adds up absolute differences of two source blocks over a term
block as arrays. Absent terms count with the smoothed frequency of no occurrence.

All arithmetic is in integers: p = 1 + floor(10^9 (count + 5) / (N + 5 V)).

Cases: null text, lang and source are ''; a row is a document, so repeated rows count again and null
ids do not matter; a group without terms has p of no occurrence everywhere; a language without kept
terms has pairs of value 0 and no terms; ties go to the item that is smaller in UTF-8; an empty
table gives no rows; further columns are ignored. Texts may be of any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import slices, staged
from .sketches import marked, occurrence_bits
from .text_hash import Stretches, joined, mixed

MIN_DOCUMENTS = 30
SMOOTHING = 5
SCALE = 1_000_000_000
# A tile has at most so many terms (about) and twice so many sources.
TERM_BLOCK = 2048
SOURCE_BLOCK = 256
_TABLE_BITS = 24
# Rows of a task's running counts at which equal ones are combined, and at which they are sent.
_COMBINE_ROWS = 400_000
_MOST_ROWS = 2_000_000

# Bytes of terms: letters A to Z and a to z, and everything beyond ASCII.
_TERM_BYTES = np.zeros(256, dtype=bool)
_TERM_BYTES[65:91] = _TERM_BYTES[97:123] = _TERM_BYTES[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Terms:
    """The terms of some texts in one buffer: start, end, text and digest of each."""

    def __init__(self, texts: list[bytes], bits: int) -> None:
        self.buffer, begins = joined(texts)
        inside = np.zeros(len(self.buffer) + 2, dtype=np.int8)
        inside[1:-1] = _TERM_BYTES[self.buffer]
        change = np.diff(inside)
        self.start, self.end = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        self.text = np.searchsorted(begins, self.start, side="right") - 1
        digest = Stretches(self.buffer, lower=True).hashes(self.start, self.end)
        # Fewer bits serve tests of digests that several terms share.
        self.digest = digest if bits == 64 else mixed(digest >> np.uint64(64 - bits))

    def only(self, chosen: np.ndarray) -> pa.DictionaryArray:
        """The lower-case strings of some terms, dictionary-encoded."""
        start, length = self.start[chosen], (self.end - self.start)[chosen]
        ends = np.cumsum(length)
        place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - length), length)
        offsets = np.concatenate([[0], ends]).astype(np.int64)
        data = _LOWER[self.buffer[place]].tobytes()
        strings = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])
        return strings.dictionary_encode()


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def _encoded(rows: pa.RecordBatch) -> list[bytes]:
    return [t.encode() for t in rows.column("text").to_pylist()]


class _Codes:
    """Numbers of names, in the order in which they are met."""

    def __init__(self) -> None:
        self.known: dict[tuple[str, ...], int] = {}

    def of(self, *columns: pa.Array) -> np.ndarray:
        return np.fromiter((self.known.setdefault(name, len(self.known)) for name in zip(*(c.to_pylist() for c in columns))), dtype=np.int64)

    def columns(self, codes: np.ndarray) -> list[pa.Array]:
        return [pa.array(names).take(pa.array(codes)) for names in zip(*self.known)]


def _sums(code: np.ndarray, digest: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Values added up over equal (code, digest)."""
    if not len(code):
        return code, digest, *values
    order = np.argsort(digest)
    # Numbers of 16 bits are sorted by radix.
    order = order[np.argsort((code.astype(np.uint16) if code.max() < 1 << 16 else code)[order], kind="stable")]
    code, digest = code[order], digest[order]
    opens = np.flatnonzero(np.concatenate([[True], (np.diff(code) != 0) | (digest[1:] != digest[:-1])]))
    return code[opens], digest[opens], *(np.add.reduceat(v[order], opens) for v in values)


def digest_counts(documents: DataFrame, bits: int = 64) -> DataFrame:
    """(lang, source, digest, n, docs): occurrences and documents, combined in each task."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, held, waiting = _Codes(), [], 0

        def combined() -> tuple[np.ndarray, ...]:
            return _sums(*(np.concatenate(c) for c in zip(*held)))

        def rows(code, digest, n, docs) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*groups.columns(code), pa.array(digest.view(np.int64)), pa.array(n), pa.array(docs)],
                                              names=["lang", "source", "digest", "n", "docs"])

        for batch in batches:
            for part in slices(batch):
                own, group = Terms(_encoded(part), bits), groups.of(part.column("lang"), part.column("source"))
                names, at = np.unique(own.digest, return_inverse=True)
                pairs, n = np.unique(at * part.num_rows + own.text, return_counts=True)
                held.append(_sums(group[pairs % part.num_rows], names[pairs // part.num_rows], n, np.ones(len(n), dtype=np.int64)))
                waiting += len(held[-1][0])
                if waiting > _COMBINE_ROWS:
                    held = [combined()]
                    waiting = len(held[0][0]) // 2
                    if len(held[0][0]) > _MOST_ROWS:
                        yield rows(*held[0])
                        held, waiting = [], 0
        if held:
            code, *others = combined()
            for low in range(0, len(code), 1 << 18):
                yield rows(*(x[low:low + (1 << 18)] for x in (code, *others)))

    sent = documents.mapInArrow(count, "lang string, source string, digest long, n long, docs long")
    return sent.groupBy("lang", "source", "digest").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _digest_strings(documents: DataFrame, kept: DataFrame, bits: int) -> DataFrame:
    """(lang, digest, low, high): the smallest and largest string of each kept digest."""
    table = documents.sparkSession.sparkContext.broadcast(occurrence_bits(kept.select("digest"), _TABLE_BITS))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = _Codes()
        sent: dict[int, set[str]] = {}
        for batch in batches:
            for part in slices(batch):
                own, lang = Terms(_encoded(part), bits), langs.of(part.column("lang"))
                chosen = np.flatnonzero(marked(table.value, own.digest, _TABLE_BITS))
                strings = own.only(chosen)
                # One row for each language and string, not sent before by this task.
                cell = np.asarray(strings.indices).astype(np.int64) * len(langs.known) + lang[own.text[chosen]]
                cells, first = np.unique(cell, return_index=True)
                # By way of numpy: a string at a time costs more than all the rest here.
                words, code = strings.dictionary.to_numpy(zero_copy_only=False)[cells // len(langs.known)], cells % len(langs.known)
                if sum(map(len, sent.values())) > _MOST_ROWS:
                    sent.clear()
                fresh = np.zeros(len(cells), dtype=bool)
                for k in np.unique(code).tolist():
                    known, names = sent.setdefault(k, set()), words[code == k].tolist()
                    fresh[code == k] = [name not in known for name in names]
                    known.update(names)
                if fresh.any():
                    yield pa.RecordBatch.from_arrays(
                        [*langs.columns(code[fresh]), pa.array(own.digest[chosen[first[fresh]]].view(np.int64)), pa.array(words[fresh], pa.string())],
                        names=["lang", "digest", "term"])

    return (documents.select("lang", "text").mapInArrow(emit, "lang string, digest long, term string")
            .groupBy("lang", "digest").agg(F.min("term").alias("low"), F.max("term").alias("high")))


def _string_counts(documents: DataFrame, shared: DataFrame, bits: int) -> DataFrame:
    """(lang, source, digest, term, n, docs) of the terms whose digest several terms share."""
    table = documents.sparkSession.sparkContext.broadcast(occurrence_bits(shared.select("digest"), _TABLE_BITS))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                own = Terms(_encoded(part), bits)
                chosen = np.flatnonzero(marked(table.value, own.digest, _TABLE_BITS))
                strings = own.only(chosen)
                pairs, first, n = np.unique(np.asarray(strings.indices).astype(np.int64) * part.num_rows + own.text[chosen],
                                            return_index=True, return_counts=True)
                text = pa.array(pairs % part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang").take(text), part.column("source").take(text), pa.array(own.digest[chosen[first]].view(np.int64)),
                     strings.dictionary.take(pa.array(pairs // part.num_rows)).cast(pa.string()), pa.array(n)],
                    names=["lang", "source", "digest", "term", "n"])

    rows = documents.mapInArrow(emit, "lang string, source string, digest long, term string, n long")
    return (rows.join(shared.select("lang", "digest"), ["lang", "digest"], "left_semi")
            .groupBy("lang", "source", "digest", "term").agg(F.sum("n").alias("n"), F.count("*").alias("docs")))


def kept_terms(documents: DataFrame, min_documents: int = MIN_DOCUMENTS, bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """The vocabulary (lang, digest, sub, term, lang_n) and the counts (lang, source, digest, sub, n).

    ``sub`` parts the terms of one digest; it is 0 for digests of a single term.
    """
    counts = staged(digest_counts(documents, bits), "term-counts")
    enough = F.col("documents") >= min_documents
    frequent = staged(counts.groupBy("lang", "digest").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("documents")).filter(enough), "frequent")
    strings = staged(_digest_strings(documents, frequent, bits).join(frequent, ["lang", "digest"]), "term-strings")
    single, shared = strings.filter("low = high"), strings.filter("low < high")
    vocabulary = single.select("lang", "digest", F.lit(0).alias("sub"), F.col("low").alias("term"), "lang_n")
    kept = counts.join(single.select("lang", "digest"), ["lang", "digest"], "left_semi").select("lang", "source", "digest", F.lit(0).alias("sub"), "n")
    if not shared.isEmpty():
        by_string = staged(_string_counts(documents, shared, bits), "shared-digests")
        parts = by_string.groupBy("lang", "digest", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("documents"))
        numbered = staged(parts.filter(enough).withColumn("sub", F.row_number().over(Window.partitionBy("lang", "digest").orderBy("term"))), "split-digests")
        vocabulary = vocabulary.unionByName(numbered.select(*vocabulary.columns))
        kept = kept.unionByName(by_string.join(numbered.select("lang", "digest", "term", "sub"), ["lang", "digest", "term"]).select(*kept.columns))
    return vocabulary, staged(kept, "kept-counts")


def _integral(numerator: str, denominator: str) -> Column:
    """p of counts named by SQL expressions, exact."""
    return F.expr(f"1 + (cast(({numerator}) + {SMOOTHING} as decimal(19,0)) * cast({SCALE} as decimal(10,0))) div cast({denominator} as decimal(20,0))")


def _distances(groups: DataFrame, cells: DataFrame, vocabulary: DataFrame, source_block: int) -> DataFrame:
    """(lang, a, b, value) for each two sources numbers a < b of a language: summed |p - p|."""
    block = F.pmod(F.xxhash64("digest", "sub"), "blocks").alias("block")
    by_lang = groups.select("lang", "blocks").distinct()
    sizes = vocabulary.join(by_lang, "lang").groupBy("lang", block).agg(F.count("*").alias("size"))
    # A row for each source and term block, with the number of the block's terms instead of one.
    rest = (groups.select("lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "number", "source_blocks", F.col("p_absent").alias("p"))
            .join(sizes, ["lang", "block"], "left")
            .select("lang", "block", "number", "source_blocks", F.lit(None).cast("long").alias("digest"), F.coalesce("size", F.lit(0)).cast("int").alias("sub"), "p"))
    own = cells.select("lang", block, "number", "source_blocks", "digest", "sub", "p")
    part = F.floor(F.col("number") / source_block)
    tiles = (rest.unionByName(own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("source_blocks") - 1)))
             .withColumns({"i": F.least(part, "other"), "j": F.greatest(part, "other")})
             .select("lang", "block", "i", "j", "number", "digest", "sub", "p"))

    def compare(key, group):
        lang, i, j = key[0].as_py(), key[2].as_py(), key[3].as_py()
        number, digest, sub, p = (np.asarray(group.column(c).combine_chunks().fill_null(0)) for c in ("number", "digest", "sub", "p"))
        absent = np.asarray(group.column("digest").combine_chunks().is_null())
        order = np.argsort(number[absent])
        sources, base, size = number[absent][order], p[absent][order], sub[absent].max()
        names = np.rec.fromarrays([digest[~absent], sub[~absent]])
        terms, column = np.unique(names, return_inverse=True)
        table = np.repeat(base[:, None], len(terms), axis=1)
        table[np.searchsorted(sources, number[~absent]), column] = p[~absent]
        left, right = np.flatnonzero(sources // source_block == i), np.flatnonzero(sources // source_block == j)
        found = []
        for a in left:
            others = right[right > a]
            unseen = np.abs(base[others] - base[a]) * (size - len(terms))  # terms of neither source block
            found.append((np.full(len(others), sources[a]), sources[others], np.abs(table[others] - table[a]).sum(axis=1) + unseen))
        a, b, value = (np.concatenate(c).astype(np.int64) for c in zip(*found)) if found else [np.empty(0, dtype=np.int64)] * 3
        return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": a, "b": b, "value": value})

    # Each source block pair once: a block meets itself in one tile, and rows of it are not sent twice.
    sums = tiles.groupBy("lang", "block", "i", "j").applyInArrow(compare, "lang string, a long, b long, value long")
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, most_terms: int = 50, bits: int = 64,
               term_block: int = TERM_BLOCK, source_block: int = SOURCE_BLOCK) -> DataFrame:
    """(lang, source, part, item, value, rank) of the audit over documents (lang, source, text)."""
    documents = _documents(docs)
    vocabulary, counts = kept_terms(documents, min_documents, bits)
    by_lang = vocabulary.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    by_group = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("terms", "lang_total", "total")}
    # A row for each group of the table, with or without terms.
    groups = (documents.select("lang", "source").distinct().join(by_lang, "lang", "left").join(by_group, ["lang", "source"], "left").withColumns(zero)
              .withColumn("number", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1)
              .withColumn("sources", F.count("*").over(Window.partitionBy("lang"))))
    weight = f"total + {SMOOTHING} * terms"
    groups = staged(groups.withColumns({
        "p_absent": F.when(F.col("terms") > 0, _integral("0", weight)).otherwise(0),
        "blocks": F.greatest(F.ceil(F.col("terms") / term_block), F.lit(1)), "source_blocks": F.ceil(F.col("sources") / source_block)}), "groups")
    cells = counts.join(groups, ["lang", "source"]).withColumn("p", _integral("n", weight))

    distances = _distances(groups, cells, vocabulary, source_block)
    names = groups.select("lang", F.col("number").alias("a"), "source")
    both = distances.unionByName(distances.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    pairs = (both.join(names, ["lang", "a"]).join(names.select("lang", F.col("a").alias("b"), F.col("source").alias("item")), ["lang", "b"])
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))

    own = Window.partitionBy("lang", "source")
    above = (cells.join(vocabulary.select("lang", "digest", "sub", "lang_n"), ["lang", "digest", "sub"])
             .withColumn("value", F.col("p") - _integral("lang_n", f"lang_total + {SMOOTHING} * terms")).filter("value > 0")
             .select("lang", "source", "digest", "sub", "value"))
    # All ties at the last rank go on; their texts decide.
    first = staged(above.withColumn("tied", F.rank().over(own.orderBy(F.desc("value")))).filter(F.col("tied") <= most_terms).drop("tied"), "first-terms")
    terms = (first.join(vocabulary.select("lang", "digest", "sub", F.col("term").alias("item")), ["lang", "digest", "sub"])
             .select("lang", "source", F.lit("term").alias("part"), "item", "value")
             .withColumn("rank", F.row_number().over(own.orderBy(F.desc("value"), "item"))).filter(F.col("rank") <= most_terms))
    ranked = pairs.withColumn("rank", F.row_number().over(own.orderBy(F.desc("value"), "item")))
    return ranked.unionByName(terms)
