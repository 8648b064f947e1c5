"""Token files: ids ranked by frequency in a byte-aligned code with separate control bytes.

An id becomes its rank by corpus frequency, so that frequent ids take one byte. A rank takes one
to four bytes, smallest first; two control bits give its number of bytes less one, and four ranks
share a control byte. Control bytes lie apart from the data bytes, so that a block is read by two
table lookups in numpy and no loop over ids.

A file is a folder: `ranks` holds (rank, id), `blocks` holds one row for each document with
doc_id, shard, row, n_tokens, control and data. Rows lie in ascending doc_id order: shards
by range, rows within a shard in order. The folder must be reachable by all executors.

Cases: null doc_ids come first; a null or empty text has the end id alone; rows with one doc_id
are ordered by length and checksum; an empty table gives an empty file; further columns are
ignored. A document of any length is one block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .packing import END_ID, encoded_parts
from .shared import drop_staged, partitions, staged

_BLOCKS = "doc_id long, n_tokens long, control binary, data binary"

# Of a control byte: the lengths of its four codes, and their sum.
_LENGTHS = (np.arange(256)[:, None] >> np.arange(0, 8, 2)) % 4 + 1


def squeeze(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    ranks = ranks.astype("<u4")
    extra = (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    quads = np.zeros(-(-len(ranks) // 4) * 4, dtype=np.uint8)
    quads[:len(ranks)] = extra
    control = (quads.reshape(-1, 4) << np.arange(0, 8, 2, dtype=np.uint8)).sum(axis=1).astype(np.uint8)
    kept = np.arange(4) <= extra[:, None]
    return control.tobytes(), ranks.view(np.uint8).reshape(-1, 4)[kept].tobytes()


def unsqueeze(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The numbers of a block: lengths by table from the control bytes, then a gather of the data."""
    width = _LENGTHS[np.frombuffer(control, dtype=np.uint8)].reshape(-1)[:n]
    raw = np.zeros((n, 4), dtype=np.uint8)
    raw[np.arange(4) < width[:, None]] = np.frombuffer(data, dtype=np.uint8)
    return raw.view("<u4").reshape(-1)


def frequency_ranks(encoded: DataFrame) -> DataFrame:
    """(rank, id) by falling frequency, ties by id: one row for each id that occurs.

    A task counts before the shuffle; the table has at most as many rows as the vocabulary.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            own = np.bincount(np.frombuffer(b"".join(batch.column("ids").to_pylist()), dtype="<u4"))
            wide, narrow = (own, total) if len(own) > len(total) else (total, own)
            wide[:len(narrow)] += narrow
            total = wide
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], names=["id", "n"])

    counts = encoded.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return counts.select((F.row_number().over(Window.orderBy(F.desc("n"), "id")) - 1).alias("rank"), "id")


def write_token_file(docs: DataFrame, vocabulary: str, path: str, end_id: int = END_ID) -> None:
    """Encode documents (doc_id, text) and write the file."""
    spark = docs.sparkSession
    encoded = encoded_parts(docs, vocabulary, end_id)
    frequency_ranks(encoded).write.parquet(f"{path}/ranks")
    rank_of = _table(spark, path, "id", "rank")

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = [squeeze(rank_of.value[np.frombuffer(ids, dtype="<u4")]) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_tokens"), pa.array([b[0] for b in blocks], pa.binary()),
                 pa.array([b[1] for b in blocks], pa.binary()), pa.array([zlib.crc32(b[1]) for b in blocks], pa.int64())],
                names=["doc_id", "n_tokens", "control", "data", "crc"])

    # Written once, so that finding the ranges reads the order's columns only.
    blocks = staged(encoded.select("doc_id", "n_tokens", "ids").mapInArrow(shrink, f"{_BLOCKS}, crc long"), "blocks", "none")
    drop_staged(encoded)
    # The bytes' sum parts rows with one doc_id, so that even such a group is dealt over several tasks.
    order = [F.col("doc_id").asc_nulls_first(), "n_tokens", "crc"]
    dealt = blocks.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).drop("crc")
    # An identifier's upper bits are the partition, its lower 33 the row in it.
    at = F.monotonically_increasing_id()
    placed = dealt.withColumns({"shard": F.shiftright(at, 33).cast("int"), "row": at.bitwiseAND(F.lit((1 << 33) - 1))})
    placed.write.option("compression", "none").parquet(f"{path}/blocks")
    drop_staged(blocks)


def _table(spark: SparkSession, path: str, key: str, value: str):
    """A broadcast lookup array over ids or ranks, bounded by the vocabulary."""
    rows = spark.read.parquet(f"{path}/ranks").select(key, value).toPandas()
    table = np.zeros(int(rows[key].max()) + 1 if len(rows) else 1, dtype="<u4")
    table[rows[key].to_numpy()] = rows[value].to_numpy()
    return spark.sparkContext.broadcast(table)


def read_token_file(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if wanted, ids."""
    id_of = _table(spark, path, "rank", "id")
    blocks = spark.read.parquet(f"{path}/blocks")
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n_tokens").to_pylist()
            found = [id_of.value[unsqueeze(c, d, k)] for c, d, k in zip(batch.column("control").to_pylist(), batch.column("data").to_pylist(), n)]
            names = ["doc_id", "shard", "row", "n_tokens", "ids_crc32"]
            columns = [*(batch.column(c) for c in names[:4]), pa.array([zlib.crc32(x.tobytes()) for x in found], pa.int64())]
            if with_ids:
                columns.append(pa.array([x.astype(np.int32) for x in found], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=names + ["ids"] * with_ids)

    schema = "doc_id long, shard int, row long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    read = blocks.select("doc_id", "shard", "row", "n_tokens", "control", "data").mapInArrow(decode, schema)
    totals = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    # One row for each shard that was written.
    offsets = totals.select("shard", F.coalesce(F.sum("total").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("offset") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))
    return read.join(F.broadcast(offsets), "shard").select("doc_id", start.alias("start"), *[c for c in read.columns if c not in ("doc_id", "shard", "row")])
