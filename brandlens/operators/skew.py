"""Joins on keys of which a few may hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brandlens.sources.staging import staged


def join_group_sizes(rows: DataFrame, sizes: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join rows with one-row-per-key ``sizes`` (how: inner or left_semi).

    The sizes are staged, so adaptive execution knows their bytes: below the session's limit they
    are broadcast and the rows are not shuffled, beyond it partitions of hot keys are split.
    """
    return rows.join(staged(sizes), key, how)


def semi_join_classes(rows: DataFrame, key: str, min_rows: int) -> DataFrame:
    """Rows whose key occurs at least ``min_rows`` times."""
    sizes = (rows.groupBy(key).agg(F.count(F.lit(1)).alias("class_rows"))
             .filter(F.col("class_rows") >= min_rows))
    return join_group_sizes(rows, sizes, key, "left_semi")
