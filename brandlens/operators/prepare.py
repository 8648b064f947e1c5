"""Feature preparation and the row filters of the three training tasks."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from brandlens.contract import (
    KNOWN_PRICE_LABELS, MAX_FOUNDED_YEAR, MIN_CLASS_ROWS, MIN_FOUNDED_YEAR, NUMERIC_SOURCE_COLUMNS,
    UNKNOWN_DOMAIN,
)
from brandlens.functions import labels, numbers, text
from brandlens.operators.schema import harmonize
from brandlens.operators.skew import semi_join_classes
from brandlens.sources.staging import shared_folder


def prepare_features(df: DataFrame) -> DataFrame:
    """Clean every known source column and derive the features, in one projection.

    Steps whose source column is absent are skipped; no row is added or lost.
    """
    df = harmonize(df)
    have = set(df.columns)
    out = {}
    if "name" in have:
        out["name_clean"] = text.clean_name(F.col("name"))
    if "country_origin" in have:
        out["country_origin"] = text.country(F.col("country_origin"))
    if "domain" in have:
        out["domain"] = text.domain(F.col("domain"))
    if "price_category" in have:
        out["price_category"] = labels.normal_labels(F.col("price_category"))
    for column in NUMERIC_SOURCE_COLUMNS:
        if column in have:
            out[column] = numbers.to_number(F.col(column))
    if "presence_russia" in have:
        pair = numbers.presence_pair(F.col("presence_russia"))
        out["presence_own"] = pair["own"]
        out["presence_franchise"] = pair["franchise"]
    if "presence_regions" in have:
        out["n_regions"] = labels.item_count(F.col("presence_regions"))
    if "description" in have:
        out["desc_len"] = text.char_count(F.col("description"))
        out["desc_has_digits"] = text.has_digit(F.col("description"))
        out["desc_year_mentions"] = text.year_mentions(F.col("description"))
    if "total_rented_area" in have:
        out["has_total_rented_area"] = numbers.known_flag(numbers.to_number(F.col("total_rented_area")))
    return df.withColumns(out)


def features_without(df: DataFrame, target: str = "") -> DataFrame:
    """Prepared features, without the target column if one is named."""
    prepared = prepare_features(df)
    return prepared.drop(target) if target else prepared


def known_domain_rows(prepared: DataFrame) -> DataFrame:
    """Rows with a domain that is neither empty nor unknown."""
    value = text.strip(F.col("domain"))
    return prepared.filter(~value.isin("", UNKNOWN_DOMAIN)).withColumn("domain", value)


def domain_rows(prepared: DataFrame, min_rows: int = MIN_CLASS_ROWS) -> DataFrame:
    """Rows of the domain task: known domains whose class has at least ``min_rows`` rows."""
    known = known_domain_rows(prepared)
    return semi_join_classes(known, "domain", min_rows)


def founded_rows(prepared: DataFrame) -> DataFrame:
    return prepared.filter(F.col("founded").between(MIN_FOUNDED_YEAR, MAX_FOUNDED_YEAR))


def unexpected_label_counts(prepared: DataFrame) -> DataFrame:
    """Labels outside the contract, with the rows that hold them."""
    return (prepared.select(F.explode(labels.unexpected_labels(F.col("price_category"))).alias("label"))
            .groupBy("label").agg(F.count(F.lit(1)).alias("rows")))


def price_rows(prepared: DataFrame, known: Sequence[str] = KNOWN_PRICE_LABELS) -> DataFrame:
    """Rows of the price task, with their known labels in ``labels``."""
    return (prepared.withColumn("labels", labels.known_labels(F.col("price_category"), list(known)))
            .filter(F.size("labels") > 0))


def price_row_counts(prepared: DataFrame) -> DataFrame:
    """One row: rows before the label filter, dropped by it and left after it."""
    usable = F.size(labels.known_labels(F.col("price_category"))) > 0
    return prepared.agg(
        F.count(F.lit(1)).alias("rows_before_target_filter"),
        F.count_if(~usable).alias("rows_unknown_only_dropped"),
        F.count_if(usable).alias("rows_after_target_filter"),
    )


def refuse_unexpected_labels(prepared: DataFrame) -> None:
    """Raise if there are unexpected labels; all of them are written, and the error names the place."""
    found = unexpected_label_counts(prepared).orderBy("label")
    if not found.isEmpty():
        path = f"{shared_folder(prepared.sparkSession)}/unexpected-labels-{uuid.uuid4().hex}"
        found.write.parquet(path)
        number = prepared.sparkSession.read.parquet(path).count()
        raise ValueError(f"Unexpected price_category labels found: {number}, listed in {path}")


def founded_out_of_range(df: DataFrame) -> DataFrame:
    """Rows whose year lies outside the valid range, ordered by year."""
    year = numbers.to_number(F.col("founded"))
    columns = [c for c in ["row_id", "name", "country_origin", "domain", "price_category", "founded"]
               if c in df.columns]
    return (df.select(*columns, year.alias("founded_num"))
            .filter((F.col("founded_num") < MIN_FOUNDED_YEAR) | (F.col("founded_num") > MAX_FOUNDED_YEAR))
            .orderBy("founded_num", *columns[:1]))


def label_support(price: DataFrame, known: Sequence[str] = KNOWN_PRICE_LABELS,
                  min_rows: int = MIN_CLASS_ROWS) -> DataFrame:
    """Rows per known label and whether that is enough; every label appears."""
    flags = labels.indicators(F.col("labels"), list(known))
    counts = price.agg(*[F.coalesce(F.sum(flags[i]), F.lit(0)).alias(f"n{i}") for i in range(len(known))])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("label_idx"), F.lit(label).alias("label"), F.col(f"n{i}").alias("support"))
        for i, label in enumerate(known)
    ]))).withColumn("enough", (F.col("support") >= min_rows).cast("int"))
