"""Suffix-array deduplication: remove every byte that lies in a string of `length` bytes (400, if
nothing else is asked for) which also starts elsewhere in the corpus.

A suffix array of everything would have to be one sort of all suffixes. Here anchors bring equal
strings together: of all strings of 2/25 of the length (32 bytes) in a window of the length, the one
with the smallest hash is the window's anchor, so equal windows have equal anchors at the same place.

1. Windows of 2/5 of the length (160 bytes) have anchors as well. The stretches between neighbouring
   ones of these are counted by hash over all texts; a window whose own short windows span a stretch
   that occurs once cannot repeat.
2. The remaining windows of an anchor form a context of less than twice the length. Equal contexts are
   one, with a count; all windows of a context that occurs twice repeat.
3. Different contexts of one anchor are sorted: a suffix array by two-stage sorting over blocks of
   contexts, and common prefixes of its neighbours. Anchors with many contexts are dealt over
   several blocks; windows that are new in such a block meet the other blocks by their hash.
4. Neighbouring contexts inside a stretch of windows that may repeat form a chain, cut where a
   context's hash says so; equal passages have equal chains, so a chain is sent and joined as one. Only
   the outer contexts of a stretch, which depend on what stands around it, are chains of their own.
   A chain that occurs twice repeats as a whole; one that occurs once knows its text and meets no join.
5. Spans go back to the texts, which are cut in one pass.

All rows with one text have one result, so a text is named by two hashes of its bytes.

Cases: a null text is empty; texts shorter than the length are never cut; a repeated row repeats all
windows of its text, so they go in every copy; null ids and further columns do not matter; an
empty table gives no rows. A very long text is read in slices that overlap by one byte less than the
length, so that each of its windows lies in exactly one of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .shared import slices, staged
from .sketches import marked, occurrence_bits
from .suffix_sort import repeated_starts
from .text_hash import Stretches, joined, mixed

LENGTH = 400
_PLACE_BITS = 28
_LIVE_BITS = 26
_BLOCK_CONTEXTS = 512
_BUNDLE_BYTES = 256 << 10
# Windows that a slice of a very long text begins; about a hundred bytes of memory for each.
SLICE_WINDOWS = 4 << 20
# Bytes of short texts that are hashed at once; a worker holds about a hundred times as many.
_SLICE_BYTES = 256 << 10
_WINDOWS = "array<struct<low:int,high:int>>"
# Contexts of a chain on average, where nothing else ends it.
_CHAIN = 16
_MEMBERS = "array<struct<anchor:long,c1:long,c2:long,at:int,context:binary>>"


class Buffer:
    """Texts in one buffer, with the hashes of all their strings of anchor size."""

    def __init__(self, texts: list[bytes], length: int) -> None:
        self.length, self.gram, self.short = length, 2 * length // 25, 2 * length // 5
        self.bytes, self.begins = joined(texts)
        self.owner = np.repeat(np.arange(len(texts)), np.diff(self.begins))
        self.stretches = Stretches(self.bytes)
        s, m = self.stretches, max(len(self.bytes) - self.gram + 1, 0)
        self.grams = mixed((s.sums[self.gram:] - s.sums[:m]) * s.back[:m])

    def anchors(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """All windows of a length inside a text (by start), and each one's anchor."""
        if len(self.bytes) < length:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        # Smaller hash first, then the place further left: one number for both.
        keys = (self.grams >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | np.arange(len(self.grams), dtype=np.uint64)
        nearest = (_sliding_least(keys, length - self.gram + 1) & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
        window = np.flatnonzero(np.arange(len(nearest)) + length <= self.begins[self.owner[:len(nearest)] + 1] - 1)
        return window, nearest[window]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Where the anchor of the short windows changes (the later window's start), and the hash of
        the stretch from the anchor before over the one after."""
        window, anchor = self.anchors(self.short)
        moves = np.flatnonzero((np.diff(anchor) != 0) & (np.diff(window) == 1)) + 1
        return window[moves], self.stretches.hashes(anchor[moves - 1], anchor[moves] + self.gram)

    def contexts(self, live: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, first and last start of each run of windows that may repeat."""
        window, anchor = self.anchors(self.length)
        move, link = self.links()
        dead = move[~marked(live, link, _LIVE_BITS)]
        # A window with a dead stretch between two of its own short windows' anchors cannot repeat.
        edge = np.zeros(len(self.bytes) + 1, dtype=np.int64)
        np.add.at(edge, np.maximum(dead - (self.length - self.short), 0), 1)
        np.add.at(edge, dead, -1)
        alive = np.cumsum(edge)[window] == 0
        window, anchor = window[alive], anchor[alive]
        if not len(window):
            return anchor, window, window
        opens = np.flatnonzero(np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(window) != 1)]))
        return anchor[opens], window[opens], window[np.concatenate([opens[1:], [len(window)]]) - 1]


def _buffers(rows: pa.RecordBatch, length: int, slice_windows: int) -> Iterator[tuple[Buffer, np.ndarray, np.ndarray]]:
    """The texts of some rows in buffers, with the row of each text in a buffer and its first byte's place.

    A stretch in the overlap of two slices counts twice, which only keeps windows that might have
    been passed over.
    """
    texts = rows.column("_bytes").to_pylist()
    if max(map(len, texts), default=0) < slice_windows + length:
        yield Buffer(texts, length), np.arange(len(texts)), np.zeros(len(texts), dtype=np.int64)
        return
    for row, text in enumerate(texts):
        for base in range(0, max(len(text) - length + 1, 1), slice_windows):
            yield Buffer([text[base:base + slice_windows + length - 1]], length), np.array([row]), np.array([base])


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each stretch of `width` values, by running minima from both ends of blocks."""
    n = len(values)
    blocks = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    blocks[:n] = values
    grid = blocks.reshape(-1, width)
    left = np.minimum.accumulate(grid, axis=1).reshape(-1)
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(right[:n - width + 1], left[width - 1:n])


def _keyed(docs: DataFrame) -> DataFrame:
    """A row's columns as one, its text's bytes, and two hashes that name the text."""
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("_bytes")
    rows = docs.select(F.struct(*docs.columns).alias("_row"), raw)
    return rows.withColumn("_key", F.xxhash64("_bytes")).withColumn("_key2", F.xxhash64(F.lit(1), "_bytes"))


def _live_hashes(texts: DataFrame, length: int, slice_windows: int) -> np.ndarray:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "_bytes", _SLICE_BYTES):
                for buffer, _, _ in _buffers(rows, length, slice_windows):
                    yield pa.RecordBatch.from_arrays([pa.array(buffer.links()[1].view(np.int64))], names=["hash"])

    hashes = texts.select("_bytes").mapInArrow(emit, "hash long")
    return occurrence_bits(hashes.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash"), _LIVE_BITS)


def _chains(low: np.ndarray, high: np.ndarray, second: np.ndarray, short: int) -> np.ndarray:
    """Which contexts begin a chain: the first one of a stretch, the first ones further than a short
    window from its begin and nearer than that to its end, and those between whose hash says so.

    Windows that may repeat reach beyond a passage by less than a short window, so what stands
    around a passage is in its outer contexts only.
    """
    first = np.concatenate([[True], low[1:] != high[:-1] + 1])
    opens = np.flatnonzero(first)
    sizes = np.diff(np.concatenate([opens, [len(low)]]))
    begin, end = np.repeat(low[opens], sizes), np.repeat(high[opens + sizes - 1], sizes)
    zone = np.where(low - begin < short, 0, np.where(end - high < short, 2, 1))
    return first | np.concatenate([[True], zone[1:] != zone[:-1]]) | ((zone == 1) & (second % np.uint64(_CHAIN) == 0))


def _occurrences(texts: DataFrame, length: int, slice_windows: int) -> DataFrame:
    """Chains where they occur: two hashes of the chain, text, first and last start, number of rows, the
    contexts of the chain with their bytes. A task sends the contexts of a chain once.
    """
    table = texts.sparkSession.sparkContext.broadcast(_live_hashes(texts, length, slice_windows))
    names = ["h1", "h2", "_key", "_key2", "start", "last", "members"]
    member = pa.struct([("anchor", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("at", pa.int32()), ("context", pa.binary())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            for rows in slices(batch, "_bytes", _SLICE_BYTES):
                for buffer, row, base in _buffers(rows, length, slice_windows):
                    anchor, low, high = buffer.contexts(table.value)
                    if not len(low):
                        continue
                    # The anchor's place in the context is part of its name.
                    first = buffer.stretches.hashes(low, high + length)
                    second = mixed(first * np.uint64(3) + buffer.stretches.hashes(low, anchor + buffer.gram))
                    opens = np.flatnonzero(_chains(low, high, second, buffer.short))
                    ends = np.concatenate([opens[1:], [len(low)]])
                    # So are the places of a chain's contexts: their names are summed, each after its place.
                    h1 = buffer.stretches.hashes(low[opens], high[ends - 1] + length)
                    h2 = np.add.reduceat(mixed(second + (low - np.repeat(low[opens], ends - opens)).astype(np.uint64)), opens)
                    fresh = np.ones(len(opens), dtype=bool)
                    for k, name in enumerate(h2.tolist()):
                        if len(sent) >= 50_000:
                            sent.clear()
                        fresh[k] = name not in sent
                        sent.add(name)
                    own, data = np.repeat(fresh, ends - opens), buffer.bytes.tobytes()
                    contexts = pa.array([data[a:b] for a, b in zip(low[own].tolist(), (high[own] + length).tolist())], pa.binary())
                    members = _lists(np.where(fresh, ends - opens, 0), member, [
                        buffer.grams[anchor[own]].view(np.int64), first[own].view(np.int64), second[own].view(np.int64),
                        (low - np.repeat(low[opens], ends - opens))[own], contexts], ~fresh)
                    text = buffer.owner[low[opens]]
                    keys = [rows.column(k).take(pa.array(row[text])) for k in ("_key", "_key2")]
                    moved = base[text] - buffer.begins[text]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), *keys, pa.array(low[opens] + moved), pa.array(high[ends - 1] + moved), members], names=names)

    rows = texts.select("_bytes", "_key", "_key2").mapInArrow(emit, f"h1 long, h2 long, _key long, _key2 long, start long, last long, members {_MEMBERS}")
    return staged(rows.groupBy(*names[:-1]).agg(F.count("*").alias("n"), F.first("members", ignorenulls=True).alias("members")), "occurrences")


def _lists(sizes: np.ndarray, kind: pa.StructType, columns: list, none: np.ndarray | None = None) -> pa.ListArray:
    """Lists of so many structs each, from the structs' columns; none: which lists are null."""
    values = pa.StructArray.from_arrays([pa.array(c).cast(f.type) for c, f in zip(columns, kind)], fields=list(kind))
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=None if none is None else pa.array(none))


def _runs(flags: list[np.ndarray]) -> pa.ListArray:
    """Runs of true flags in each array as first and last place."""
    sizes, low, high = [], [], []
    for one in flags:
        change = np.diff(np.concatenate([[0], one.astype(np.int8), [0]]))
        low.append(np.flatnonzero(change == 1))
        high.append(np.flatnonzero(change == -1) - 1)
        sizes.append(len(low[-1]))
    return _lists(np.array(sizes), pa.struct([("low", pa.int32()), ("high", pa.int32())]), [np.concatenate(low), np.concatenate(high)])


def _sorted_blocks(contexts: DataFrame, length: int) -> DataFrame:
    """Per context its windows that repeat in its block, and the others' (and first ones') hashes if
    the anchor has several blocks."""
    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            states = repeated_starts([x[2] for x in held], length)
            # In arrays: every window of a common passage's contexts may be here.
            hashes, places, sizes = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)], []
            news = [np.empty(0, dtype=bool)]
            for (_, _, context, blocks, _), state in zip(held, states):
                own = np.flatnonzero(state != 1) if blocks > 1 else places[0]
                sizes.append(len(own))
                if len(own):
                    places.append(own)
                    hashes.append(Stretches(np.frombuffer(context, dtype=np.uint8)).hashes(own, own + length).view(np.int64))
                    news.append(state[own] == 0)
            other = pa.struct([("hash", pa.int64()), ("at", pa.int32()), ("new", pa.bool_())])
            return pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in held]), pa.array([x[1] for x in held]), _runs([state > 0 for state in states]),
                 _lists(np.array(sizes), other, [np.concatenate(x) for x in (hashes, places, news)])],
                names=["c1", "c2", "windows", "others"])

        last = None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("c1", "c2", "context", "blocks", "block"))):
                # A bundle ends between blocks.
                if size > _BUNDLE_BYTES and row[4] != last:
                    yield flush()
                    held, size = [], 0
                held.append(row)
                size, last = size + len(row[2]), row[4]
        if held:
            yield flush()

    dealt = contexts.withColumn("block", F.xxhash64("anchor", F.pmod("c2", "blocks"))).repartition("block").sortWithinPartitions("block", "c1")
    return dealt.select("c1", "c2", "context", "blocks", "block").mapInArrow(
        sort, f"c1 long, c2 long, windows {_WINDOWS}, others array<struct<hash:long,at:int,new:boolean>>")


def _repeated_windows(contexts: DataFrame, length: int) -> DataFrame:
    """(c1, c2, windows): which windows of each distinct context repeat, as runs of starts."""
    distinct = staged(contexts.groupBy("anchor", "c1", "c2").agg(
        F.sum("n").alias("n"), F.max("context").alias("context")).withColumn("last", F.length("context") - length), "contexts")
    kinds = distinct.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    several = (distinct.join(kinds, "anchor").withColumn("blocks", F.ceil(F.col("kinds") / _BLOCK_CONTEXTS)))
    blocks = staged(_sorted_blocks(several, length), "blocks")
    within = blocks.select("c1", "c2", F.explode("windows").alias("w")).select("c1", "c2", "w.low", "w.high")
    # Only of anchors with several blocks; equal windows meet by hash, and spread over all tasks.
    apart = blocks.select("c1", "c2", F.explode("others").alias("o")).select("c1", "c2", "o.hash", "o.at", "o.new")
    met = apart.groupBy("hash").agg(F.count("*").alias("k")).filter("k > 1").select("hash")
    across = apart.filter("new").join(met, "hash", "left_semi").select("c1", "c2", F.col("at").alias("low"), F.col("at").alias("high"))
    twice = distinct.filter("n > 1").select("c1", "c2", F.lit(0).alias("low"), F.col("last").alias("high"))
    runs = within.unionByName(across).unionByName(twice)
    return runs.groupBy("c1", "c2").agg(F.collect_list(F.struct("low", "high")).alias("windows"))


def removed_spans(texts: DataFrame, length: int = LENGTH, slice_windows: int = SLICE_WINDOWS) -> DataFrame:
    """(_key, _key2, starts): runs of windows that repeat in each text, as (low, high) starts."""
    occurrences = _occurrences(texts, length, slice_windows)
    # A chain that occurs once carries its place, so its windows go to the text without meeting the chain again.
    place = F.first(F.struct("_key", "_key2", "start")).alias("place")
    chains = occurrences.groupBy("h1", "h2").agg(F.sum("n").alias("n"), place, F.first("members", ignorenulls=True).alias("members"))
    members = staged(chains.select("n", "place", F.explode("members").alias("m")).select("n", "place", "m.*"), "members")
    # Written, as below: a context may lie in very many chains.
    of_context = staged(_repeated_windows(members, length), "context-windows")
    once = members.filter("n = 1").select("place._key", "place._key2", (F.col("place.start") + F.col("at")).alias("start"), "c1", "c2").join(of_context, ["c1", "c2"])
    moved = F.transform("windows", lambda w: F.struct((w["low"] + F.col("start")).alias("low"), (w["high"] + F.col("start")).alias("high")))
    # All windows of any other chain repeat. Written, so that the join is free to split a chain that occurs very often.
    often = staged(occurrences.groupBy("h1", "h2").agg(F.sum("n").alias("n")).filter("n > 1").select("h1", "h2"), "chains")
    whole = F.array(F.struct(F.col("start").alias("low"), F.col("last").alias("high")))
    found = once.select("_key", "_key2", moved.alias("windows")).unionByName(
        occurrences.select("h1", "h2", "_key", "_key2", "start", "last").join(often, ["h1", "h2"]).select("_key", "_key2", whole.alias("windows")))
    # The chains of one text: less than its own length.
    return found.groupBy("_key", "_key2").agg(F.flatten(F.collect_list("windows")).alias("starts"))


def _merged(windows: list[dict[str, int]], length: int) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each maximal stretch that runs of windows cover."""
    low, high = (np.array([w[k] for w in windows], dtype=np.int64) for k in ("low", "high"))
    order = np.argsort(low)
    low, end = low[order], np.maximum.accumulate(high[order] + length)
    opens = np.flatnonzero(np.concatenate([[True], low[1:] > end[:-1]]))
    return low[opens], end[np.concatenate([opens[1:], [len(low)]]) - 1]


def cut(docs: DataFrame, length: int = LENGTH, slice_windows: int = SLICE_WINDOWS) -> DataFrame:
    """docs with n_bytes, n_removed, n_spans, kept_sha256 and kept_text (what remains, without parts
    of characters); columns of these names are replaced."""
    added = [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")] + [T.StructField(n, T.StringType()) for n in ("kept_sha256", "kept_text")]
    docs = docs.drop(*[f.name for f in added])
    texts = _keyed(docs)
    schema = T.StructType([*docs.schema, *added])
    joined_rows = texts.join(removed_spans(texts, length, slice_windows), ["_key", "_key2"], "left").select("_row", "starts")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, own = [], batch.column("_row").field("text").cast(pa.string())
            for text, windows in zip(own, batch.column("starts")):
                text, windows = (text.as_py() or "").encode(), windows.as_py()
                kept, n_spans = text, 0
                if windows:
                    low, end = _merged(windows, length)
                    n_spans = len(low)
                    kept = b"".join(text[a:b] for a, b in zip([0, *end], [*low, len(text)]))
                rows.append((len(text), len(text) - len(kept), n_spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")))
            columns = zip(*rows) if rows else [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([*batch.column("_row").flatten(), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                                             names=[f.name for f in schema])

    return joined_rows.mapInArrow(apply, schema)


def deduplicated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs with the repeated strings cut out of their texts.

    A cut may part a character's bytes; the rest of such a character goes as well. All rows stay.
    """
    rows = cut(docs.select(F.struct(*docs.columns).alias("row"), "text"), length)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("row.text")).alias("text")
    return rows.select(*[text if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
