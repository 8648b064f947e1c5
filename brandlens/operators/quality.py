"""Run metrics, leaderboard, quality gate and publication checks.

Runs are described by two long tables: metrics (run_id, model, metric, value) and attributes
(run_id, model, key, value). A run has a few dozen entries, so they may be gathered per run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from brandlens.contract import (
    FEATURE_CONTRACT_VERSION, FORBIDDEN_FEATURES, MODELS, POLICY,
)
from brandlens.functions.numbers import hash32
from brandlens.functions.text import is_blank
from brandlens.operators.literal import passes

# What a training report must hold; a value of None accepts anything filled.
REQUIRED_REPORT_KEYS = [
    ("domain", "target", "domain"), ("domain", "selection_metric", "cv_best_macro_f1"),
    ("domain", "winner_name", None), ("domain", "dataset_fingerprint", None),
    ("domain", "feature_contract_version", FEATURE_CONTRACT_VERSION), ("domain", "feature_columns", None),
    ("founded", "target", "founded"), ("founded", "selection_metric", "cv_best_mae"),
    ("founded", "winner_name", None), ("founded", "dataset_fingerprint", None),
    ("founded", "feature_contract_version", FEATURE_CONTRACT_VERSION), ("founded", "feature_columns", None),
    ("price_category", "target", "price_category"), ("price_category", "selection_metric", "cv_best_macro_f1"),
    ("price_category", "threshold_calibration", "development_oof_cv"), ("price_category", "winner_name", None),
    ("price_category", "dataset_fingerprint", None),
    ("price_category", "feature_contract_version", FEATURE_CONTRACT_VERSION), ("price_category", "feature_columns", None),
]
REQUIRED_REPORT_METRICS = [
    *[("domain", m) for m in ["cv_best_macro_f1", "cv_std_macro_f1", "holdout_macro_f1", "holdout_balanced_accuracy"]],
    *[("founded", m) for m in ["cv_best_mae", "cv_std_mae", "holdout_mae", "holdout_rmse", "holdout_r2"]],
    *[("price_category", m) for m in ["cv_best_macro_f1", "cv_std_macro_f1", "oof_selected_macro_f1",
                                      "holdout_serving_macro_f1", "holdout_serving_micro_f1"]],
]
# Scores equal to this many digits are a tie.
TIE_DIGITS = 12
WINNER_KEYS = ["winner_name", "winner_model", "winner", "selected_model", "best_model", "model_name"]


def fingerprint(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Order-free content fingerprint: row count and the sum of 32-bit row digests, as text.

    Each field stands with its length, so that fields cannot run together.
    """
    fields = [F.col(c).cast("string") for c in columns]
    line = F.concat_ws("|", *[F.coalesce(F.concat(F.length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in fields])
    digest = F.sum(hash32(line).cast("decimal(38,0)")).cast("string")
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), digest.alias("digest"))


def fingerprint_text(df: DataFrame, columns: Sequence[str]) -> str:
    row = fingerprint(df, columns).first()
    return f"{row.n_rows}-{row.digest or 0}"


# --- model selection --------------------------------------------------------

def leaderboard(fold_scores: DataFrame, score: str, higher_is_better: bool = True) -> DataFrame:
    """From (seq, name, family, fold, score): mean and spread, place and winner.

    Best mean first, then the smaller spread, then the earlier candidate. A baseline is listed
    but never wins. A handful of candidates, so one window is enough.
    """
    means = fold_scores.groupBy("seq", "name", "family").agg(
        F.avg(score).alias("cv_best"), F.stddev_pop(score).alias("cv_std"))
    return rank_candidates(means, higher_is_better)


def rank_candidates(means: DataFrame, higher_is_better: bool = True) -> DataFrame:
    # Sums of doubles differ in the last digits from run to run; equal scores must stay equal.
    mean, spread = F.round("cv_best", TIE_DIGITS), F.round("cv_std", TIE_DIGITS)
    order = Window.orderBy(mean.desc() if higher_is_better else mean.asc(), spread, "seq")
    baseline = (F.col("family") == "baseline").cast("int")
    placed = means.withColumn("place", F.row_number().over(order))
    runners = Window.orderBy(baseline, "place")
    return placed.withColumn("winner", ((F.row_number().over(runners) == 1) & (baseline == 0)).cast("int"))


def improvement(score: Column, baseline: Column) -> Column:
    """Relative gain of a lower error over the baseline; null without a positive baseline."""
    return F.when(baseline > 0, (baseline - score) / baseline)


# --- quality gate -----------------------------------------------------------

def run_maps(metrics: DataFrame) -> DataFrame:
    """One row per run with a map 'model.metric' -> value."""
    entry = F.struct(F.concat_ws(".", "model", "metric"), "value")
    return metrics.groupBy("run_id").agg(F.map_from_entries(F.collect_list(entry)).alias("m"))


def quality_checks(metrics: DataFrame, policy: Sequence[tuple] = POLICY) -> DataFrame:
    """Every policy line for every run. ``valid`` is 0 for a missing or non-finite metric."""
    direct = F.try_element_at("m", F.lit("price_category.holdout_direct_macro_f1"))
    serving = F.try_element_at("m", F.lit("price_category.holdout_serving_macro_f1"))

    def measured(model: str, metric: str) -> Column:
        if metric == "serving_macro_drop_vs_direct":
            return direct - serving
        return F.try_element_at("m", F.lit(f"{model}.{metric}"))

    lines = F.array(*[
        F.struct(F.lit(model).alias("model"), F.lit(metric).alias("metric"), F.lit(op).alias("operator"),
                 F.lit(float(limit)).alias("threshold"), measured(model, metric).alias("value"))
        for model, metric, op, limit in policy])
    value = F.col("value")
    valid = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    return (run_maps(metrics).select("run_id", F.inline(lines))
            .withColumn("valid", F.coalesce(valid, F.lit(False)).cast("int"))
            .withColumn("passed", F.when(F.col("valid") == 1, passes(value, F.col("operator"), F.col("threshold")))
                        .otherwise(0)))


def quality_summary(checks: DataFrame) -> DataFrame:
    """Per run: PASSED, FAILED, or ERROR if a metric was missing; and the counts."""
    total = F.count(F.lit(1))
    return checks.groupBy("run_id").agg(
        F.when(F.min("valid") == 0, "ERROR").when(F.min("passed") == 0, "FAILED").otherwise("PASSED").alias("status"),
        total.alias("checks_total"), F.sum("passed").alias("checks_passed"),
        (total - F.sum("passed")).alias("checks_failed"))


def require_quality(checks: DataFrame) -> None:
    bad = checks.filter("passed = 0").orderBy("run_id", "model", "metric").collect()
    if bad:
        raise RuntimeError("Model quality gate failed: " + ", ".join(f"{r.model}.{r.metric}" for r in bad))


def metrics_by_model(checks: DataFrame) -> DataFrame:
    """Map metric -> value per run and model; values that are no numbers are skipped."""
    return checks.filter("valid = 1").groupBy("run_id", "model").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "value")))).alias("metrics"))


# --- run attributes ---------------------------------------------------------

def consistent_attributes(attributes: DataFrame,
                          keys: Sequence[str] = ("feature_contract_version", "dataset_fingerprint")) -> DataFrame:
    """Per run and key: whether all models carry the same non-empty value."""
    missing = F.count_if(is_blank(F.col("value")))
    return (attributes.filter(F.col("key").isin(list(keys)) & F.col("model").isin(MODELS))
            .groupBy("run_id", "key")
            .agg(F.countDistinct("value").alias("n_values"), missing.alias("n_missing"),
                 F.countDistinct("model").alias("n_models"))
            .withColumn("consistent", ((F.col("n_values") == 1) & (F.col("n_missing") == 0)
                                       & (F.col("n_models") == len(MODELS))).cast("int")))


def first_of(attributes: DataFrame, keys: Sequence[str] = WINNER_KEYS, name: str = "winner") -> DataFrame:
    """Per run and model the value of the first key that is present."""
    rank = F.array_position(F.array(*[F.lit(k) for k in keys]), F.col("key"))
    return (attributes.filter(F.col("key").isin(list(keys))).groupBy("run_id", "model")
            .agg(F.min_by("value", rank).alias(name)))


def report_gaps(attributes: DataFrame, metrics: DataFrame) -> DataFrame:
    """(run_id, model, item, problem): required attributes and metrics that are missing or wrong,
    and forbidden feature columns."""
    runs = attributes.select("run_id").distinct()
    wanted = runs.select("run_id", F.inline(F.array(*[
        F.struct(F.lit(m).alias("model"), F.lit(k).alias("key"), F.lit(v).cast("string").alias("expected"))
        for m, k, v in REQUIRED_REPORT_KEYS])))
    held = wanted.join(attributes, ["run_id", "model", "key"], "left")
    problem = (F.when(is_blank(F.col("value")), "missing")
               .when(F.col("expected").isNotNull() & (F.col("value") != F.col("expected")), "unexpected value"))
    wrong = (held.withColumn("problem", problem).filter("problem is not null")
             .select("run_id", "model", F.col("key").alias("item"), "problem"))
    needed = runs.select("run_id", F.inline(F.array(*[
        F.struct(F.lit(m).alias("model"), F.lit(k).alias("metric")) for m, k in REQUIRED_REPORT_METRICS])))
    absent = (needed.join(metrics.filter("value is not null"), ["run_id", "model", "metric"], "left_anti")
              .select("run_id", "model", F.col("metric").alias("item"), F.lit("missing").alias("problem")))
    forbidden = F.arrays_overlap(F.split("value", ","), F.array(*[F.lit(c) for c in FORBIDDEN_FEATURES]))
    unsafe = (attributes.filter((F.col("key") == "feature_columns") & forbidden)
              .select("run_id", "model", F.col("key").alias("item"), F.lit("forbidden feature").alias("problem")))
    return wrong.unionByName(absent).unionByName(unsafe)


def publishable_runs(ledger: DataFrame, attributes: DataFrame) -> DataFrame:
    """Runs that may serve, newest first.

    ``ledger`` holds (run_id, published_at, policy_version, quality_status, smoke_status). A run
    qualifies with both statuses PASSED, filled ids, the current feature contract on all three
    models, one dataset, and a winner for each model.
    """
    same = (consistent_attributes(attributes).groupBy("run_id")
            .agg(F.min("consistent").alias("consistent"), F.count(F.lit(1)).alias("n_keys")))
    current = (attributes.filter("key = 'feature_contract_version'").groupBy("run_id")
               .agg(F.min(F.coalesce(F.col("value") == FEATURE_CONTRACT_VERSION, F.lit(False)).cast("int"))
                    .alias("current")))
    winners = (first_of(attributes).filter(~is_blank(F.col("winner")) & F.col("model").isin(MODELS))
               .groupBy("run_id").agg(F.countDistinct("model").alias("n_winners")))
    filled = ~is_blank(F.col("published_at")) & ~is_blank(F.col("policy_version"))
    return (ledger.filter((F.upper("quality_status") == "PASSED") & (F.upper("smoke_status") == "PASSED") & filled)
            .join(same, "run_id").join(current, "run_id").join(winners, "run_id")
            .filter((F.col("consistent") == 1) & (F.col("n_keys") == 2) & (F.col("current") == 1)
                    & (F.col("n_winners") == len(MODELS)))
            .select(*ledger.columns).orderBy(F.desc("published_at"), F.desc("run_id")))


def current_run(ledger: DataFrame, attributes: DataFrame) -> str:
    """Id of the newest publishable run; raises if there is none."""
    row = publishable_runs(ledger, attributes).first()
    if row is None:
        raise RuntimeError("No run passed all checks; nothing may be published or served.")
    return row.run_id
