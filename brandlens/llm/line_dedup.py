"""Line deduplication: lines that stand in several documents go, but for one document.

1. Each task names the long lines of its documents by 128-bit hashes and counts documents by name
   before anything is sent; the shuffle adds the counts up and finds the largest doc_id of a name.
2. The names found in enough documents are dealt to shards by hash. A shard builds a minimal perfect
   hash over its names and fills arrays of fingerprint (the second half of the name), count and
   doc_id that keeps the line.
3. Documents probe the arrays; a line of another name is told by the fingerprint. No line is joined.

The names in most documents come first: as many as fit into a bound of bytes are broadcast, so that
a line in every document costs no shuffle at all. Further names, if any, stay with their shards:
lines whose hash falls into a bit table of them are sent to the shards as fixed-width names, spread
over salts, and the lines to drop come back by document. Results do not depend on the bound.

Cases: a row is a document; a null or empty text is one empty line; rows with one doc_id are
documents each, and all of them keep the lines of that doc_id; a null doc_id is smaller than every
other; an empty table gives no rows; columns of docs named like an added one are replaced. Texts
may be of any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .perfect_hash import Shard
from .shared import partitions, slices, staged
from .sketches import marked, occurrence_bits

MIN_LENGTH = 20
MIN_DOCUMENTS = 3
_SPACE = " \t\n\v\f\r"
_SHARD_KEYS = 1 << 16
# Bytes of the arrays that are broadcast at most, and of one name in them.
BROADCAST_BYTES = 64 << 20
_NAME_BYTES = 28
_TABLE_BITS = 24
_SALTS = 16
_COMBINE_ROWS = 400_000
_NO_ID = np.iinfo(np.int64).min


class Lines:
    """All lines of some texts: their text's number, and the long ones' names."""

    def __init__(self, texts: pa.Array, min_length: int) -> None:
        lists = pc.split_pattern(pc.fill_null(texts.cast(pa.large_string()), ""), "\n")
        self.lines = lists.flatten()
        self.count = np.diff(np.asarray(lists.offsets).astype(np.int64))
        self.text = np.repeat(np.arange(len(texts)), self.count)
        keys = pc.ascii_lower(pc.ascii_trim(self.lines, characters=_SPACE))
        self.long = np.flatnonzero(np.asarray(pc.greater_equal(pc.utf8_length(keys), min_length)))
        coded = keys.take(pa.array(self.long)).dictionary_encode()
        digests = b"".join(hashlib.blake2b(k.encode(), digest_size=16).digest() for k in coded.dictionary.to_pylist())
        names = np.frombuffer(digests, dtype="<u8").reshape(-1, 2)[np.asarray(coded.indices).astype(np.int64)]
        self.high, self.low = names[:, 0].copy(), names[:, 1].copy()


def _columns(docs: DataFrame) -> list[Column]:
    return [F.coalesce(docs["doc_id"].cast("long"), F.lit(_NO_ID)).alias("doc_id"), docs["text"].cast("string").alias("text")]


def _combined(rows: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Documents added up and largest doc_id over equal names."""
    high, low, n, keeper = (np.concatenate(c) for c in zip(*rows))
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    opens = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])])) if len(high) else order
    if not len(opens):
        return high, low, n, keeper
    return high[opens], low[opens], np.add.reduceat(n[order], opens), np.maximum.reduceat(keeper[order], opens)


def line_counts(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(high, low, n, keeper): documents that hold a line's name, and the largest doc_id of them."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = [], 0

        def rows() -> pa.RecordBatch:
            high, low, n, keeper = _combined(held)
            return pa.RecordBatch.from_arrays([pa.array(high.view(np.int64)), pa.array(low.view(np.int64)), pa.array(n), pa.array(keeper)],
                                              names=["high", "low", "n", "keeper"])

        for batch in batches:
            for part in slices(batch):
                own = Lines(part.column("text"), min_length)
                # A document counts once, however often it repeats a line.
                text, ids = own.text[own.long], np.asarray(part.column("doc_id"))
                order = np.lexsort((text, own.low, own.high))
                again = np.zeros(len(order), dtype=bool)
                for values in (own.high, own.low, text):
                    again[1:] |= values[order][1:] != values[order][:-1]
                again[:1] = True
                first = order[again]
                held.append(_combined([(own.high[first], own.low[first], np.ones(len(first), dtype=np.int64), ids[text[first]])]))
                waiting += len(held[-1][0])
                if waiting > _COMBINE_ROWS:
                    yield rows()
                    held, waiting = [], 0
        if held:
            yield rows()

    sent = docs.select(_columns(docs)).mapInArrow(count, "high long, low long, n long, keeper long")
    return sent.groupBy("high", "low").agg(F.sum("n").alias("n"), F.max("keeper").alias("keeper"))


def shards(names: DataFrame) -> DataFrame:
    """(shards, shard, arrays) of names (high, low, n, keeper): one row for each shard.

    Every shard has about _SHARD_KEYS names; their number follows the table of names.
    """
    count = -(-names.count() // _SHARD_KEYS)
    if not count:
        return names.sparkSession.createDataFrame([], "shards int, shard int, arrays binary")

    def build(key, group):
        high, low, n, keeper = (np.asarray(group.column(c).combine_chunks()) for c in ("high", "low", "n", "keeper"))
        shard = Shard.build(high.view(np.uint64), low.view(np.uint64), {"count": n.clip(max=np.iinfo(np.uint32).max).astype(np.uint32), "keeper": keeper})
        return pa.table({"shards": pa.array([count], pa.int32()), "shard": pa.array([key[0].as_py()], pa.int32()), "arrays": pa.array([shard.packed()], pa.binary())})

    dealt = names.withColumn("shard", F.pmod("high", F.lit(count)).cast("int"))
    return staged(dealt.groupBy("shard").applyInArrow(build, "shards int, shard int, arrays binary"), "line-shards", "none")


def _probed(found: list[Shard], high: np.ndarray, low: np.ndarray, doc_id: np.ndarray) -> np.ndarray:
    """Whether each line goes: its name is indexed and another doc_id keeps it."""
    gone = np.zeros(len(high), dtype=bool)
    shard = (high.view(np.int64) % len(found)) if found else np.zeros(len(high), dtype=np.int64)
    for k in np.unique(shard) if found else ():
        own = np.flatnonzero(shard == k)
        index = found[k].probe(high[own], low[own])
        gone[own] = (index >= 0) & (found[k].arrays["keeper"][index] != doc_id[own])
    return gone


def _split_by_frequency(names: DataFrame, broadcast_bytes: int) -> tuple[DataFrame, DataFrame]:
    """The names in most documents, as many as the bound allows, and the others."""
    size = F.floor(F.log2("n")).cast("int")
    # A row for each power of two.
    counts = {r["size"]: r["names"] for r in names.groupBy(size.alias("size")).agg(F.count("*").alias("names")).collect()}
    least, total = 64, 0
    for k in sorted(counts, reverse=True):
        total += counts[k]
        if total * _NAME_BYTES > broadcast_bytes:
            break
        least = k
    return names.filter(size >= least), names.filter(size < least)


def _sent_lines(docs: DataFrame, names: DataFrame, min_length: int) -> DataFrame:
    """(key, key2, doc_id, dropped): places of lines that the shards of further names drop."""
    table = docs.sparkSession.sparkContext.broadcast(occurrence_bits(names.select("high"), _TABLE_BITS))
    built = shards(names)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                own = Lines(part.column("text"), min_length)
                chosen = np.flatnonzero(marked(table.value, own.high, _TABLE_BITS))
                text = own.text[own.long[chosen]]
                starts = np.cumsum(own.count) - own.count
                columns = [part.column(c).take(pa.array(text)) for c in ("key", "key2", "doc_id")]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array((own.long[chosen] - starts[text]).astype(np.int32)), pa.array(own.high[chosen].view(np.int64)),
                     pa.array(own.low[chosen].view(np.int64))], names=["key", "key2", "doc_id", "place", "high", "low"])

    # Rows with one doc_id and text have one result and are asked about once.
    asked = (docs.mapInArrow(emit, "key long, key2 long, doc_id long, place int, high long, low long")
             .withColumn("salt", F.pmod(F.xxhash64("key", "doc_id"), F.lit(_SALTS)).cast("int")).withColumn("asked", F.lit(True)))
    # The first row of a task's shard holds its arrays, the lines follow.
    n_shards = F.lit(built.first()["shards"])
    lines = asked.select("key", "key2", "doc_id", "place", "high", "low", F.pmod("high", n_shards).cast("int").alias("shard"), "salt", "asked",
                         F.lit(None).cast("binary").alias("arrays"))
    arrays = built.select(*[F.lit(None).cast(t).alias(c) for c, t in (("key", "long"), ("key2", "long"), ("doc_id", "long"), ("place", "int"), ("high", "long"), ("low", "long"))],
                          "shard", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"), F.lit(False).alias("asked"), "arrays")
    dealt = (lines.unionByName(arrays).repartition(partitions(docs.sparkSession), "shard", "salt").sortWithinPartitions("shard", "salt", "asked"))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            headers = [k for k, asked in enumerate(batch.column("asked").to_pylist()) if not asked]
            for low, high in zip([0, *headers], [*headers, batch.num_rows]):
                rows = batch.slice(low, high - low)
                if low in headers and rows.num_rows:
                    shard, rows = Shard.unpacked(rows.column("arrays")[0].as_py()), rows.slice(1)
                if rows.num_rows:
                    names = [np.asarray(rows.column(c)).view(np.uint64) for c in ("high", "low")]
                    gone = pa.array(_probed([shard], *names, np.asarray(rows.column("doc_id"))))
                    yield rows.select(["key", "key2", "doc_id", "place"]).filter(gone)

    found = dealt.mapInArrow(answer, "key long, key2 long, doc_id long, place int")
    # At most the lines of one text.
    return found.groupBy("key", "key2", "doc_id").agg(F.collect_set("place").alias("dropped"))


def without_repeated_lines(docs: DataFrame, min_length: int = MIN_LENGTH, min_documents: int = MIN_DOCUMENTS,
                           broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """docs with n_lines, n_dropped and kept_text (the lines that stay)."""
    added = [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("kept_text", T.StringType())]
    docs = docs.drop(*[f.name for f in added])
    names = staged(line_counts(docs, min_length).filter(F.col("n") >= min_documents), "line-names")
    frequent, further = _split_by_frequency(names, broadcast_bytes)
    # Bounded by broadcast_bytes.
    arrays = [r["arrays"] for r in shards(frequent).orderBy("shard").collect()]
    table = docs.sparkSession.sparkContext.broadcast(arrays)
    rows = docs.select(F.struct(*docs.columns).alias("row"), *_columns(docs))
    if further.isEmpty():
        rows = rows.withColumn("dropped", F.lit(None).cast("array<int>"))
    else:
        bytes_ = F.coalesce("text", F.lit(""))
        rows = rows.withColumns({"key": F.xxhash64(bytes_), "key2": F.xxhash64(F.lit(MIN_LENGTH), bytes_)})
        places = _sent_lines(rows.select("key", "key2", "doc_id", "text"), further, min_length)
        rows = rows.join(places, ["key", "key2", "doc_id"], "left").select("row", "doc_id", "text", "dropped")
    schema = T.StructType([*docs.schema, *added])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [Shard.unpacked(a) for a in table.value]
        for batch in batches:
            for part in slices(batch):
                own = Lines(part.column("text"), min_length)
                gone = np.zeros(len(own.text), dtype=bool)
                gone[own.long] = _probed(found, own.high, own.low, np.asarray(part.column("doc_id"))[own.text[own.long]])
                starts = np.cumsum(own.count) - own.count
                lists = part.column("dropped")
                further_lines = pc.list_parent_indices(lists)
                gone[starts[np.asarray(further_lines)] + np.asarray(lists.flatten())] = True
                stays = np.flatnonzero(~gone)
                kept = np.bincount(own.text[stays], minlength=part.num_rows)
                offsets = pa.array(np.concatenate([[0], np.cumsum(kept)]), pa.int64())
                texts = pc.binary_join(pa.LargeListArray.from_arrays(offsets, own.lines.take(pa.array(stays))), pa.scalar("\n", pa.large_string()))
                yield pa.RecordBatch.from_arrays([*part.column("row").flatten(), pa.array(own.count), pa.array(own.count - kept), texts.cast(pa.string())],
                                                 names=[f.name for f in schema])

    return rows.mapInArrow(cut, schema)
