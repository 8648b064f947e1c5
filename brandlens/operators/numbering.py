"""Numbers in a global order without a global window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from brandlens.operators.literal import literal_rows
from brandlens.sources.staging import staged

_ROW_BITS = 33  # of a monotonically increasing id


def numbered(df: DataFrame, order: Sequence[str | Column], name: str = "number") -> DataFrame:
    """Rows with their zero-based place in the given order, which must have no ties.

    Ranges are sorted apart and numbered in their tasks; the rows before each range come from one
    count for each range. Written once, so that a range keeps its rows.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = staged(dealt.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", _ROW_BITS)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("rows")).orderBy("_part").collect()  # one row for each range
    before, starts = 0, []
    for r in counts:
        starts.append((r["_part"], before))
        before += r["rows"]
    if not starts:
        return placed.select(*df.columns, F.lit(0).cast("bigint").alias(name))
    offsets = F.broadcast(literal_rows(df.sparkSession, ["_part", "_before"], starts))
    inside = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return placed.withColumn("_part", part).join(offsets, "_part").select(*df.columns, (F.col("_before") + inside).cast("bigint").alias(name))


def code_table(df: DataFrame, column: str, code: str = "code") -> DataFrame:
    """Staged (column, code): the distinct non-null values, numbered from 0 in sorted order."""
    return staged(numbered(df.select(column).filter(F.col(column).isNotNull()).distinct(), [column], code))


def encode(df: DataFrame, codes: DataFrame, column: str, code: str = "code") -> DataFrame:
    """Rows with the code of their value; null for values outside the table.

    The table is staged, so adaptive execution broadcasts it below the session's limit and splits
    hot values beyond it.
    """
    return df.join(codes.select(column, code), column, "left")


def decode(df: DataFrame, codes: DataFrame, column: str, code: str = "code") -> DataFrame:
    """Rows with the value of their code."""
    return df.join(codes.select(column, code), code, "left")
