"""Cutting lineage with written tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("Set spark.checkpoint.dir to a folder that the driver and all executors share.")
    return folder.rstrip("/")


def staged(df: DataFrame) -> DataFrame:
    """Write once to the shared folder and read back.

    Later steps neither recompute the frame nor lose it with an executor, and Catalyst knows
    its real size.
    """
    path = f"{shared_folder(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Write a table in sorted buckets of a key and read it back.

    Tables of the same key and number of buckets are joined on the key without moving their rows.
    Choose the number so that a bucket fits in a task. Without ``path`` the table lies in the
    session's warehouse.
    """
    # One task writes one bucket, so a bucket is one file.
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)
