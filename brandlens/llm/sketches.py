"""Tables of fixed size over hashes: which may have occurred, and how often at most.

They have 2**bits cells whatever the input, are added up on the executors piece by piece, and only
thin out later work: a false positive costs a row, never a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import partitions

_CHUNK_BITS = 14


def count_chunks(counts: np.ndarray) -> pa.RecordBatch:
    """Rows (chunk, counts) of a task's counters, to be summed by total_counts()."""
    rows = counts.astype("<u4").reshape(-1, 1 << _CHUNK_BITS)
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(rows)), pa.int32()), pa.array([r.tobytes() for r in rows], pa.binary())],
                                      names=["chunk", "counts"])


def total_counts(chunks: DataFrame, bits: int) -> np.ndarray:
    """Sum the tasks' rows; a task holds each of its chunks once, and the driver 2**bits numbers."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
                sums[chunk] = sums.get(chunk, 0) + np.frombuffer(counts, dtype="<u4").astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())],
                                         names=["chunk", "counts"])

    out = np.zeros((max(1, 1 << (bits - _CHUNK_BITS)), 1 << _CHUNK_BITS), dtype=np.int64)
    # Spread each chunk over salts first, so that no task reads a row of every task before it.
    salted = chunks.withColumn("salt", F.monotonically_increasing_id() % 8)
    for row in salted.repartition(partitions(chunks.sparkSession), "chunk", "salt").select("chunk", "counts").mapInArrow(add, "chunk int, counts binary").collect():
        out[row["chunk"]] += np.frombuffer(row["counts"], dtype=np.int64)
    return out.reshape(-1)


def occurrence_bits(hashes: DataFrame, bits: int = 24) -> np.ndarray:
    """Packed bits of the cells in which a hash (first column, long) falls: its top `bits` bits."""
    cell = F.shiftrightunsigned(F.col(hashes.columns[0]), 64 - bits)
    cells = hashes.select(cell.alias("cell")).repartition(partitions(hashes.sparkSession), F.shiftright("cell", 17))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks: dict[int, np.ndarray] = {}
        for batch in batches:
            cell = np.unique(np.asarray(batch.column("cell")))
            for chunk in np.unique(cell >> 17):
                own = marks.setdefault(int(chunk), np.zeros(1 << 17, dtype=bool))
                own[cell[cell >> 17 == chunk] & ((1 << 17) - 1)] = True
        yield pa.RecordBatch.from_arrays([pa.array(list(marks), pa.int64()), pa.array([np.packbits(m).tobytes() for m in marks.values()], pa.binary())],
                                         names=["chunk", "marks"])

    out = np.zeros((max(1, 1 << (bits - 17)), 1 << 14), dtype=np.uint8)
    for row in cells.mapInArrow(mark, "chunk long, marks binary").collect():
        out[row["chunk"]] = np.frombuffer(row["marks"], dtype=np.uint8)
    return out.reshape(-1)


def marked(table: np.ndarray, hashes: np.ndarray, bits: int = 24) -> np.ndarray:
    """Whether the cells of unsigned 64-bit hashes are marked."""
    cell = hashes >> np.uint64(64 - bits)
    return (table[(cell >> np.uint64(3)).astype(np.int64)] >> (7 - (cell & np.uint64(7)).astype(np.uint8))) & 1 == 1
