"""Duplicates, ambiguous names and conflicting values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from brandlens.operators.skew import join_group_sizes
from brandlens.sources.staging import staged


def repeated(df: DataFrame, column: str) -> DataFrame:
    """Values on more than one row; null is no value, empty text is."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
            .filter("rows > 1").orderBy(F.desc("rows"), column))


def variants(df: DataFrame, keys: Sequence[str], value: Column, name: str) -> DataFrame:
    """Key groups with several different non-null values; groups with a null key are left out.

    Spark counts distinct values in two steps, by (keys, value) and then by keys, so a hot key
    is spread over its values.
    """
    complete = df.select(*keys, value.alias("_value")).dropna(subset=list(keys))
    return (complete.groupBy(*keys).agg(F.countDistinct("_value").alias(name))
            .filter(F.col(name) > 1).orderBy(F.desc(name), *keys))


def collision_groups(mapping: DataFrame, raw: str, norm: str) -> DataFrame:
    """Normalized values that several raw values of a mapping table fall on."""
    return (mapping.groupBy(norm).agg(F.count(raw).alias("n_raw_variants"))
            .filter("n_raw_variants > 1").orderBy(F.desc("n_raw_variants"), norm))


def name_variants(df: DataFrame, clean: Column, raw: Column) -> DataFrame:
    """(name_clean_candidate, original): each original spelling once."""
    return (df.select(clean.alias("name_clean_candidate"), raw.alias("original"))
            .filter("original is not null").distinct())


def ambiguous_names(pairs: DataFrame) -> DataFrame:
    return (pairs.groupBy("name_clean_candidate").agg(F.count(F.lit(1)).alias("n_original_variants"))
            .filter("n_original_variants > 1"))


def variant_examples(pairs: DataFrame) -> DataFrame:
    """All original spellings of every ambiguous clean name, one row each."""
    pairs = staged(pairs)
    return (join_group_sizes(pairs, ambiguous_names(pairs), "name_clean_candidate")
            .orderBy(F.desc("n_original_variants"), "name_clean_candidate", "original"))
