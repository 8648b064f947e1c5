"""Schema repair, checks and projections. All decisions use column names only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from brandlens.contract import (
    CANONICAL_COLUMNS, CATEGORICAL_FEATURES, MISSPELLED_COUNTRY, REQUIRED_COLUMNS, SAFE_FEATURES,
    TEXT_FEATURES, UNKNOWN_COUNTRY, check_feature_contract,
)
from brandlens.functions.numbers import to_number


def harmonize(df: DataFrame) -> DataFrame:
    """Rename the misspelled country column, or drop it where the right one exists too."""
    if "country_origin" in df.columns:
        return df.drop(MISSPELLED_COUNTRY)
    return df.withColumnRenamed(MISSPELLED_COUNTRY, "country_origin")


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")


def required_columns_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, present, non_null) of each named column; an absent one has no rows filled."""
    counts = df.agg(*[F.count(c).alias(c) for c in columns if c in df.columns] or [F.count(F.lit(1)).alias("_rows")])
    lines = [F.struct(F.lit(c).alias("column"), F.lit(int(c in df.columns)).alias("present"),
                      (F.col(c) if c in df.columns else F.lit(0)).cast("bigint").alias("non_null")) for c in columns]
    return counts.select(F.inline(F.array(*lines)))


def fill_feature_columns(df: DataFrame, columns: Sequence[str] = SAFE_FEATURES) -> DataFrame:
    """Add absent feature columns: empty text, unknown country, null number."""
    def default(column: str):
        if column in TEXT_FEATURES:
            return F.lit("")
        if column in CATEGORICAL_FEATURES:
            return F.lit(UNKNOWN_COUNTRY)
        return F.lit(None).cast("double")

    return df.withColumns({c: default(c) for c in columns if c not in df.columns})


def model_input(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the safe features, without nulls in text and categories.

    ``keep`` names pass-through columns (row id, target, fold) that no model reads.
    """
    check_feature_contract(SAFE_FEATURES)
    df = fill_feature_columns(df)

    def feature(column: str):
        if column in TEXT_FEATURES:
            return F.coalesce(F.col(column), F.lit("")).alias(column)
        if column in CATEGORICAL_FEATURES:
            return F.coalesce(F.col(column), F.lit(UNKNOWN_COUNTRY)).alias(column)
        return to_number(F.col(column)).alias(column)

    return df.select(*keep, *[feature(c) for c in SAFE_FEATURES])


def schema_report(raw: DataFrame, prepared: DataFrame) -> DataFrame:
    """One row: column lists, what is missing or extra, column and row counts.

    Lists are joined with ', '. Row counts come from one aggregate over the prepared frame.
    """
    def listed(names: Sequence[str]):
        return F.lit(", ".join(names))

    raw_columns, columns = raw.columns, prepared.columns
    return prepared.agg(
        listed(raw_columns).alias("raw_columns"),
        listed(columns).alias("prepared_columns"),
        listed([c for c in REQUIRED_COLUMNS if c not in columns]).alias("missing_required_columns"),
        listed([c for c in CANONICAL_COLUMNS if c not in columns]).alias("missing_canonical_columns"),
        listed([c for c in columns if c not in CANONICAL_COLUMNS]).alias("extra_columns"),
        F.lit(len(raw_columns)).alias("raw_n_columns"),
        F.lit(len(columns)).alias("prepared_n_columns"),
        F.count(F.lit(1)).alias("n_rows"),
    )
