"""Checks on prediction tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brandlens.contract import KNOWN_PRICE_LABELS, MAX_FOUNDED_YEAR, MIN_FOUNDED_YEAR, label_column
from brandlens.functions.text import is_blank, missing_text, strip
from brandlens.operators.literal import literal_rows, unpivot_row
from brandlens.sources.staging import staged

PREDICTION_COLUMNS = ["pred_domain", "pred_founded", "pred_founded_rounded", "pred_price_category"]
PROBABILITY_COLUMNS = [f"pred_price_prob__{label_column(x)}" for x in KNOWN_PRICE_LABELS]
FLAG_COLUMNS = [f"pred_price_label__{label_column(x)}" for x in KNOWN_PRICE_LABELS]


def unexpected_values(result: DataFrame, column: str, known: DataFrame) -> DataFrame:
    """Distinct non-null values that are not among the known ones, sorted."""
    return (result.select(F.col(column).alias("value")).filter("value is not null").distinct()
            .join(known.select(F.col(known.columns[0]).alias("value")), "value", "left_anti").orderBy("value"))


def _holds(condition: Column) -> Column:
    """Rows that break a condition; null breaks it."""
    return F.count_if(~F.coalesce(condition, F.lit(False)))


def in_years(c: Column) -> Column:
    return ~F.isnan(c) & c.between(MIN_FOUNDED_YEAR, MAX_FOUNDED_YEAR)


def prediction_violations(result: DataFrame) -> dict[str, Column]:
    """Check name to the count of rows that break it."""
    probabilities_ok = F.forall(F.array(*PROBABILITY_COLUMNS),
                                lambda p: F.coalesce(~F.isnan(p) & p.between(0.0, 1.0), F.lit(False)))
    flags = F.array(*FLAG_COLUMNS)
    flags_ok = F.forall(flags, lambda x: F.coalesce(x.isin(0, 1), F.lit(False)))
    shown = F.filter(F.transform(F.split(F.coalesce("pred_price_category", F.lit("")), ";"), strip), lambda x: x != "")
    active = F.filter(F.array(*[F.when(F.col(c) == 1, F.lit(label)) for c, label in
                                zip(FLAG_COLUMNS, KNOWN_PRICE_LABELS)]), lambda x: x.isNotNull())
    rounded = F.col("pred_founded_rounded")
    same_labels = F.array_sort(F.array_distinct(shown)) == F.array_sort(active)
    return {
        "domain_non_null": _holds(F.col("pred_domain").isNotNull()),
        "domain_non_empty": _holds(~is_blank(F.col("pred_domain"))),
        "founded_finite": _holds(~F.isnan("pred_founded") & (F.abs("pred_founded") < float("inf"))),
        "founded_valid_range": _holds(in_years(F.col("pred_founded"))),
        "founded_rounded_valid": _holds(in_years(rounded.cast("double")) & (rounded == F.rint(rounded))),
        "price_non_empty": _holds(F.size(shown) > 0),
        "price_known_labels_only": _holds(F.forall(shown, lambda x: x.isin(KNOWN_PRICE_LABELS))),
        "price_probabilities_valid": _holds(probabilities_ok),
        "price_binary_outputs_valid": _holds(flags_ok),
        "price_at_least_one_label_per_row": _holds(F.array_contains(flags, 1)),
        "price_text_binary_consistency": _holds(same_labels),
    }


def result_differences(left: DataFrame, right: DataFrame, row_id: str = "row_id") -> DataFrame:
    """One row of difference counts between two scorings of the same rows.

    Text must be equal, numbers equal within 1e-10, and a missing number equals nothing.
    """
    columns = PREDICTION_COLUMNS + PROBABILITY_COLUMNS
    a = left.select(row_id, *[F.col(c).alias(f"a_{c}") for c in columns])
    b = right.select(row_id, *[F.col(c).alias(f"b_{c}") for c in columns])
    both = a.join(b, row_id, "full")

    def same_text(c: str) -> Column:
        return F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))

    def same_number(c: str) -> Column:
        return F.abs(F.col(f"a_{c}") - F.col(f"b_{c}")) <= 1e-10

    price = same_text("pred_price_category")
    for c in PROBABILITY_COLUMNS:
        price = price & F.coalesce(same_number(c), F.lit(False))
    return both.agg(_holds(same_text("pred_domain")).alias("target_independence_domain"),
                    _holds(same_number("pred_founded")).alias("target_independence_founded"),
                    _holds(price).alias("target_independence_price"))


def smoke_checks(result: DataFrame, source: DataFrame, classes: DataFrame,
                 second_result: DataFrame | None = None, row_id: str = "row_id") -> DataFrame:
    """(name, violations, passed) for all prediction checks.

    ``second_result`` scores the same rows with the target columns present.
    """
    missing = [c for c in PREDICTION_COLUMNS if c not in result.columns]
    if missing:
        one = source.agg(F.lit(len(missing)).alias("required_prediction_columns"))
        return _verdicts(one, ["required_prediction_columns"])
    # Scored once; the checks read the written predictions.
    result = staged(result.select(row_id, *PREDICTION_COLUMNS, *PROBABILITY_COLUMNS, *FLAG_COLUMNS))
    violations = prediction_violations(result)
    counts = result.agg(F.count(F.lit(1)).alias("rows_out"), *[c.alias(n) for n, c in violations.items()])
    counts = counts.withColumns({
        "row_count_preserved": F.abs(F.col("rows_out") - source.agg(F.count(F.lit(1))).scalar()),
        "required_prediction_columns": F.lit(0),
        "domain_known_classes_only": F.lit(
            unexpected_values(result, "pred_domain", classes).agg(F.count(F.lit(1))).scalar()),
    })
    names = ["row_count_preserved", "required_prediction_columns", "domain_known_classes_only", *violations]
    checks = _verdicts(counts, names)
    if second_result is not None:
        differences = result_differences(result, second_result, row_id)
        checks = checks.unionByName(_verdicts(differences, differences.columns))
    return checks


def column_sets(left: DataFrame, right: DataFrame) -> DataFrame:
    """(side, column): the columns of both frames, of the left one alone and of the right one alone."""
    a, b = left.columns, right.columns
    sides = {"both": [c for c in a if c in b], "left_only": [c for c in a if c not in b], "right_only": [c for c in b if c not in a]}
    rows = [(side, c) for side, columns in sides.items() for c in columns]
    return literal_rows(left.sparkSession, ["side", "column"], rows or [("both", "")]).filter(F.lit(bool(rows)))


def _verdicts(counts: DataFrame, names: list[str]) -> DataFrame:
    return (unpivot_row(counts, names, name="name", value="violations")
            .select("name", F.col("violations").cast("bigint").alias("violations"))
            .withColumn("passed", (F.col("violations") == 0).cast("int")))


def require_smoke(checks: DataFrame) -> None:
    failed = [r.name for r in checks.filter("passed = 0").orderBy("name").collect()]
    if failed:
        raise RuntimeError("Smoke inference failed: " + ", ".join(failed))


# --- result view ------------------------------------------------------------

def year_column(df: DataFrame) -> str:
    return "pred_founded_rounded" if "pred_founded_rounded" in df.columns else "pred_founded"


def check_result(result: DataFrame, source: DataFrame) -> DataFrame:
    """Refuse a result the view cannot show (columns), and count rows on both sides."""
    repeated = sorted({c for c in result.columns if result.columns.count(c) > 1})
    if repeated:
        raise ValueError(f"Result column names repeat: {repeated}")
    absent = sorted({"pred_domain", "pred_price_category"} - set(result.columns))
    if absent:
        raise ValueError(f"Result columns are missing: {absent}")
    if not {"pred_founded", "pred_founded_rounded"} & set(result.columns):
        raise ValueError("The result holds neither pred_founded nor pred_founded_rounded.")
    counts = result.agg(F.count(F.lit(1)).alias("rows_out")).withColumn(
        "rows_in", F.lit(source.agg(F.count(F.lit(1))).scalar()))
    return counts.withColumn("valid", (F.col("rows_in") == F.col("rows_out")).cast("int"))


def alignment_check(source: DataFrame, result: DataFrame, key: str = "name") -> DataFrame:
    """Whether a key proves row identity: filled, unique on both sides, and the same set."""
    sides = source.select(F.col(key).alias("k"), F.lit(1).alias("s")).unionAll(result.select(F.col(key).alias("k"), F.lit(0).alias("s")))
    by_key = sides.groupBy("k").agg(F.sum("s").alias("a"), F.sum(1 - F.col("s")).alias("b"))
    empty, known = missing_text(F.col("k").cast("string")), F.col("k").isNotNull()

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0))

    out = by_key.agg(
        total(F.col("a")).alias("source_rows"), total(F.when(empty, F.col("a"))).alias("source_missing"), F.count_if(known & (F.col("a") > 0)).alias("source_distinct"),
        total(F.col("b")).alias("result_rows"), total(F.when(empty, F.col("b"))).alias("result_missing"), F.count_if(known & (F.col("b") > 0)).alias("result_distinct"),
        F.count_if((F.col("a") > 0) & ((F.col("b") == 0) | ~known)).alias("only_in_source"),
        F.count_if((F.col("b") > 0) & ((F.col("a") == 0) | ~known)).alias("only_in_result"))
    provable = ((F.col("source_missing") == 0) & (F.col("result_missing") == 0)
                & (F.col("source_rows") == F.col("source_distinct"))
                & (F.col("result_rows") == F.col("result_distinct"))
                & (F.col("only_in_source") == 0) & (F.col("only_in_result") == 0))
    return out.withColumn("provable", provable.cast("int"))


def align_original(source: DataFrame, result: DataFrame, column: str = "domain",
                   row_id: str = "row_id") -> DataFrame:
    """Result rows with the source's original value, by row id where both have it, else by name;
    refuses a key that does not prove row identity."""
    if column not in source.columns:
        return result.withColumn(f"original_{column}", F.lit(None).cast("string"))
    key = row_id if row_id in source.columns and row_id in result.columns else "name"
    if alignment_check(source, result, key).first().provable == 0:
        raise ValueError("Source and result rows cannot be matched without doubt.")
    return result.join(source.select(key, F.col(column).alias(f"original_{column}")), key, "left")


def filled_gaps(aligned: DataFrame, original: str = "original_domain", predicted: str = "pred_domain") -> DataFrame:
    """Rows whose original value is missing and whose prediction is not."""
    return aligned.filter(missing_text(F.col(original)) & ~missing_text(F.col(predicted)))


def gap_counts(aligned: DataFrame, original: str = "original_domain", predicted: str = "pred_domain") -> DataFrame:
    empty = missing_text(F.col(original))
    return aligned.agg(F.count_if(empty).alias("rows_without_original"),
                       F.count_if(empty & ~missing_text(F.col(predicted))).alias("rows_filled"))
