"""Training readiness, the data-quality gate and the QA summary."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brandlens.contract import (
    CANONICAL_COLUMNS, KNOWN_PRICE_LABELS, MAX_FOUNDED_YEAR, MIN_CLASS_ROWS, MIN_FOUNDED_YEAR,
    REQUIRED_COLUMNS, UNKNOWN_DOMAIN, UNKNOWN_PRICE_LABEL,
)
from brandlens.functions import labels
from brandlens.functions.text import strip
from brandlens.operators.literal import literal_rows, measure, passes
from brandlens.operators.prepare import known_domain_rows, unexpected_label_counts
from brandlens.operators.profile import anomaly_aggregates

# Rule, severity, section, metric, operator, limit.
GATE_RULES = [
    ("required_columns", "blocking", "schema", "missing_required_columns", "<=", 0.0),
    ("canonical_columns", "blocking", "schema", "missing_canonical_columns", "<=", 0.0),
    ("raw_not_empty", "blocking", "dataset", "rows_raw", ">=", 1.0),
    ("prepared_not_empty", "blocking", "dataset", "rows_prepared", ">=", 1.0),
    ("row_count_kept", "blocking", "dataset", "rows_gained_or_lost", "<=", 0.0),
    ("domain_rows", "blocking", "domain_task", "rows_after_drop_rare_classes", ">=", 1.0),
    ("domain_classes", "blocking", "domain_task", "n_classes_ge_5", ">=", 2.0),
    ("founded_rows", "blocking", "founded_task", "rows_in_valid_range_1850_2025", ">=", 2.0),
    ("price_rows", "blocking", "price_category_task", "rows_after_drop_unknown_only", ">=", 1.0),
    ("unexpected_labels", "blocking", "price_category_task", "n_unexpected_labels", "<=", 0.0),
    ("label_support", "blocking", "price_category_task", "min_known_label_support", ">=", 5.0),
    ("founded_below_range", "warning", "anomaly", "founded_lt_1850", "<=", 0.0),
    ("founded_missing", "warning", "anomaly", "founded_missing", "<=", 0.0),
    ("description_empty", "warning", "anomaly", "description_empty", "<=", 0.0),
]


def readiness_aggregates(columns: Sequence[str]) -> dict[tuple[str, str], Column]:
    """What one pass over the prepared rows tells about the three tasks.

    After preparation domain and price_category are never null, so their non-null counts are
    all rows.
    """
    out: dict[tuple[str, str], Column] = {("dataset", "rows_total"): F.count(F.lit(1))}
    if "domain" in columns:
        out["domain_task", "rows_non_null_target"] = F.count("domain")
    if "founded" in columns:
        year = F.col("founded")
        out["founded_task", "rows_non_null_target"] = F.count(year)
        out["founded_task", "rows_in_valid_range_1850_2025"] = F.count_if(
            year.between(MIN_FOUNDED_YEAR, MAX_FOUNDED_YEAR))
    if "price_category" in columns:
        task = "price_category_task"
        known = labels.known_labels(F.col("price_category"))
        supports = {label: F.count_if(F.array_contains(known, label)) for label in KNOWN_PRICE_LABELS}
        out[task, "rows_non_null_target"] = F.count("price_category")
        out[task, "rows_unknown_only"] = F.count_if(F.size(known) == 0)
        out[task, "rows_after_drop_unknown_only"] = F.count_if(F.size(known) > 0)
        out[task, "n_known_labels"] = F.lit(len(KNOWN_PRICE_LABELS))
        out[task, "n_unique_combinations"] = F.countDistinct(F.when(F.size(known) > 0, F.array_join(known, ";")))
        for label, support in supports.items():
            out[task, f"known_label_support:{label}"] = support
        out[task, "min_known_label_support"] = F.least(*supports.values())
    return out


def group_readiness(prepared: DataFrame) -> list[DataFrame]:
    """The measures that need a grouping first: domain classes and unexpected labels."""
    parts = []
    if "domain" in prepared.columns:
        sizes = known_domain_rows(prepared).groupBy("domain").agg(F.count(F.lit(1)).alias("n"))
        frequent = F.col("n") >= MIN_CLASS_ROWS
        parts.append(measure(sizes, {
            ("domain_task", "rows_after_drop_unknown"): F.coalesce(F.sum("n"), F.lit(0)),
            ("domain_task", "n_classes_all"): F.count("n"),
            ("domain_task", "n_classes_ge_5"): F.count_if(frequent),
            ("domain_task", "rows_after_drop_rare_classes"): F.coalesce(F.sum(F.when(frequent, F.col("n"))), F.lit(0)),
        }))
    if "price_category" in prepared.columns:
        parts.append(measure(unexpected_label_counts(prepared),
                             {("price_category_task", "n_unexpected_labels"): F.count(F.lit(1))}))
    return parts


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, others, first)


def training_readiness(prepared: DataFrame) -> DataFrame:
    """(section, metric, value) under the same row rules as training. Unexpected labels are
    listed by ``unexpected_label_counts``."""
    return union_all(measure(prepared, readiness_aggregates(prepared.columns)), *group_readiness(prepared))


def readiness_raw_values(df: DataFrame) -> DataFrame:
    """Older rule on raw values: unknown domains count as a class, null prices as unknown."""
    sizes = (df.filter("domain is not null").groupBy(strip(F.col("domain")).alias("domain"))
             .agg(F.count(F.lit(1)).alias("n")))
    frequent = F.col("n") >= MIN_CLASS_ROWS
    price = F.coalesce("price_category", F.lit(UNKNOWN_PRICE_LABEL))
    return union_all(
        measure(df, {
            ("dataset", "rows_total"): F.count(F.lit(1)),
            ("price_category_task", "rows_non_null_target"): F.count_if(price != ""),
            ("price_category_task", "n_unique_combinations"): F.countDistinct(price),
        }),
        measure(sizes, {
            ("domain_task", "rows_non_null_target"): F.coalesce(F.sum("n"), F.lit(0)),
            ("domain_task", "n_classes_all"): F.count("n"),
            ("domain_task", "n_classes_ge_5"): F.count_if(frequent),
            ("domain_task", "rows_after_drop_rare_classes"): F.coalesce(F.sum(F.when(frequent, F.col("n"))), F.lit(0)),
        }))


def qa_metrics(raw: DataFrame, prepared: DataFrame) -> DataFrame:
    """(section, metric, value): everything the data gate decides on.

    One pass over the prepared rows, one row count of the raw ones, and one grouping each for
    classes and unexpected labels.
    """
    columns = prepared.columns
    rows_raw = F.lit(raw.agg(F.count(F.lit(1))).scalar())
    rows = F.count(F.lit(1))
    fixed = {
        ("dataset", "columns_raw"): F.lit(len(raw.columns)),
        ("dataset", "columns_prepared"): F.lit(len(columns)),
        ("schema", "missing_required_columns"): F.lit(len([c for c in REQUIRED_COLUMNS if c not in columns])),
        ("schema", "missing_canonical_columns"): F.lit(len([c for c in CANONICAL_COLUMNS if c not in columns])),
    }
    counted = {
        ("dataset", "rows_raw"): rows_raw,
        ("dataset", "rows_prepared"): rows,
        ("dataset", "rows_gained_or_lost"): F.abs(rows_raw - rows),
    }
    measured = measure(prepared, fixed | counted | anomaly_aggregates(columns) | readiness_aggregates(columns))
    return union_all(measured, *group_readiness(prepared))


def data_gate(metrics: DataFrame) -> DataFrame:
    """Every rule with its value and whether it passed; an absent metric counts as zero."""
    rules = literal_rows(metrics.sparkSession, ["rule", "severity", "section", "metric", "operator", "limit"],
                         GATE_RULES)
    value = F.coalesce(F.col("value"), F.lit(0.0))
    return (rules.join(metrics, ["section", "metric"], "left")
            .select("rule", "severity", value.alias("value"), "operator", "limit",
                    passes(value, F.col("operator"), F.col("limit")).alias("passed")))


def require_data_gate(metrics: DataFrame) -> None:
    """Raise if a blocking rule failed."""
    failed = data_gate(metrics).filter("severity = 'blocking' and passed = 0").orderBy("rule").collect()
    if failed:
        raise RuntimeError("Data gate failed: " + ", ".join(f"{r.rule}={r.value:g}" for r in failed))


def qa_summary(raw: DataFrame, prepared: DataFrame) -> DataFrame:
    """(section, key, value) as text: all metrics, column lists, target contract, the unexpected
    labels one per row, and the required-column status."""
    spark: SparkSession = prepared.sparkSession
    missing = [c for c in REQUIRED_COLUMNS if c not in prepared.columns]
    facts = [
        ("schema", "raw_columns", ", ".join(raw.columns)),
        ("schema", "prepared_columns", ", ".join(prepared.columns)),
        ("schema", "required_columns_check", "FAILED: " + ", ".join(missing) if missing else "OK"),
        ("target_contract", "unknown_domain_value", UNKNOWN_DOMAIN),
        ("target_contract", "unknown_price_label", UNKNOWN_PRICE_LABEL),
        ("target_contract", "known_price_labels", "; ".join(KNOWN_PRICE_LABELS)),
    ]
    whole = F.col("value") == F.floor("value")
    shown = F.when(whole, F.col("value").cast("bigint").cast("string")).otherwise(F.round("value", 6).cast("string"))
    measured = qa_metrics(raw, prepared).select("section", F.col("metric").alias("key"), shown.alias("value"))
    unexpected = unexpected_label_counts(prepared).select(
        F.lit("unexpected_label").alias("section"), F.col("label").alias("key"),
        F.col("rows").cast("string").alias("value"))
    return (literal_rows(spark, ["section", "key", "value"], facts)
            .unionByName(measured).unionByName(unexpected))
