"""Small helpers of the training-data operators: shared folder, staging, text batches."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir.

    A local session without that setting gets a temporary one; a cluster session must set it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that the driver and all executors share.")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-stage-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write once to the shared folder and read back: no recomputation, no loss with an executor."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Remove the files of a frame made by staged(), when no later step reads it."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(os.path.dirname(file))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_column(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """Texts of a batch; null counts as empty."""
    return ["" if t is None else t for t in batch.column(name).to_pylist()]


def slices(batch: pa.RecordBatch, name: str = "text", most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch where its texts pass a number of bytes; a longer single text stays whole."""
    if not batch.num_rows:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(name)), 0)).astype(np.int64)
    groups = (np.cumsum(sizes) - sizes) // most_bytes
    cuts = np.flatnonzero(np.diff(groups)) + 1
    for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield batch.slice(int(low), int(high - low))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once, for sessions whose workers cannot import it."""
    context = spark.sparkContext
    if getattr(context, "_brandlens_sent", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(prefix="brandlens-"), "brandlens.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(archive)
    context._brandlens_sent = True
