"""Packing: concatenate all documents' ids and cut them into fixed windows.

Pass one encodes every document where it lies and keeps each part's running offsets and token
total. Prefix sums over the parts' totals then place every document in one long stream, and pass
two cuts it at multiples of the window; a window that spans parts is a boundary record. No text
and no id is shuffled, and only the last window is padded.

Cases: a null or empty text has the end id alone; a null doc_id stays null; repeated rows are
packed once each; an empty table gives no rows; further columns are ignored. A text of any length
is cut into as many pieces as it needs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .shared import slices, staged
from .tokens import encoder

END_ID = 2
_ENCODED = "part int, doc_id long, part_start long, n_tokens long, ids binary"
_PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids_crc32 long"


def encoded_parts(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """Each document's ids (little-endian, unsigned, 32 bits), its part and its offset in the part.

    The part is the task that encoded the row. The result is written to the shared folder, so
    that a task which is run again cannot change the order that later steps rely on.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at, tokens = TaskContext.get().partitionId(), 0, encoder(path)
        for batch in batches:
            for rows in slices(batch, most_bytes=8 << 20):
                ids, n = tokens.encode(rows.column("text"))
                ends = np.cumsum(n)
                starts = ends - n
                packed = [ids[a:b].tobytes() + np.uint32(end_id).tobytes() for a, b in zip(starts, ends)]
                total = n + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part), pa.int32()), rows.column("doc_id"),
                     pa.array(at + np.cumsum(total) - total), pa.array(total), pa.array(packed, pa.binary())],
                    names=["part", "doc_id", "part_start", "n_tokens", "ids"])
                at += int(total.sum())

    return staged(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(encode, _ENCODED), "encoded")


def part_offsets(encoded: DataFrame) -> DataFrame:
    """Prefix sums over the parts' totals: one row for each task of the first pass."""
    totals = encoded.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("part_offset"))


def pieces(encoded: DataFrame, window: int = 4096, with_ids: bool = False) -> DataFrame:
    """The documents' pieces: document, place in it, sequence and place in the sequence."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, at, n, ids in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "at", "n_tokens", "ids"))):
                start = 0
                while start < n:
                    sequence, offset = divmod(at + start, window)
                    length = min(window - offset, n - start)
                    part = ids[4 * start:4 * (start + length)]
                    row = (doc, start, length, n, sequence, offset, zlib.crc32(part))
                    out.append((*row, part) if with_ids else row)
                    start += length
            kinds = [pa.int64()] * 7 + [pa.binary()] * with_ids
            names = [f.split()[0] for f in schema.split(", ")]
            columns = zip(*out) if out else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    schema = _PIECES + ", ids binary" * with_ids
    # One row for each task of the first pass: 16 bytes for each input split.
    placed = encoded.join(F.broadcast(part_offsets(encoded)), "part")
    return placed.select("doc_id", (F.col("part_offset") + F.col("part_start")).alias("at"), "n_tokens", "ids").mapInArrow(cut, schema)


def sequences(cut: DataFrame, window: int = 4096, pad_id: int = 0) -> DataFrame:
    """The filled windows: sequence_id, n_tokens, ids of `window` length, padded at the very end.

    A group holds one window, so it has at most `window` ids.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    joined = cut.groupBy("sequence_id").agg(parts.alias("parts"), F.sum("length").alias("n_tokens"))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for ps in batch.column("parts").to_pylist():
                ids = np.frombuffer(b"".join(p["ids"] for p in ps), dtype="<u4").astype(np.int32)
                rows.append(np.concatenate([ids, np.full(window - len(ids), pad_id, dtype=np.int32)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("sequence_id"), batch.column("n_tokens"), pa.array(rows, pa.list_(pa.int32()))],
                names=["sequence_id", "n_tokens", "ids"])

    return joined.mapInArrow(fill, "sequence_id long, n_tokens long, ids array<int>")


def pack(docs: DataFrame, path: str, window: int = 4096, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pack documents (doc_id, text) into windows of ids of the vocabulary at path."""
    return pieces(encoded_parts(docs, path, end_id), window, with_ids)
