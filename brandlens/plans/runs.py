"""The three jobs: data audit, training run and batch scoring.

Run tables live under one folder of the shared storage: ``metrics`` (run_id, model, metric,
value), ``attributes`` (run_id, model, key, value) and ``ledger`` (run_id, published_at,
policy_version, quality_status, smoke_status). Models lie under ``models/<run_id>/<model>``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from brandlens.contract import (
    CANONICAL_COLUMNS, FEATURE_CONTRACT_VERSION, KNOWN_PRICE_LABELS, MODELS, POLICY, POLICY_VERSION, SEED,
    TARGET_COLUMNS,
)
from brandlens.functions import text
from brandlens.functions.numbers import to_number
from brandlens.models import candidates as K, training as T
from brandlens.models.scoring import score, write_scored
from brandlens.operators import checks, duplicates as D, profile as P, quality as QA, readiness as R
from brandlens.operators.literal import literal_rows
from brandlens.operators.prepare import prepare_features
from brandlens.operators.schema import harmonize, schema_report
from brandlens.operators.split import seeded_sample
from brandlens.sources.csv_files import require_rows, write_table
from brandlens.sources.staging import staged

NUMERIC_REPORT = ["founded", "presence_world", "plans", "total_rented_area", "presence_own", "presence_franchise",
                  "n_regions", "desc_len", "desc_has_digits", "desc_year_mentions", "has_total_rented_area"]
TEXT_REPORT = ["name", "name_clean", "description", "country_origin", "domain", "price_category"]


# --- audit ------------------------------------------------------------------

def audit_reports(raw: DataFrame, prepared: DataFrame) -> dict[str, DataFrame]:
    """All audit and QA reports as lazy tables, over staged inputs."""
    df = harmonize(raw)
    have = set(df.columns)
    out: dict[str, DataFrame] = {
        "schema_report": schema_report(raw, prepared),
        "missing_report_raw": P.missing_report(df), "missing_report": P.missing_report(prepared),
        "text_quality_report": P.text_quality(prepared, [c for c in TEXT_REPORT if c in prepared.columns]),
        "numeric_summary": P.numeric_summary(prepared, {c: F.col(c) for c in NUMERIC_REPORT if c in prepared.columns}),
        "qa_summary": R.qa_summary(raw, prepared),
        "data_gate": R.data_gate(R.qa_metrics(raw, prepared)),
    }
    if "name" in have:
        pairs = D.name_variants(df, text.clean_name(F.col("name")), F.col("name"))
        out |= {
            "name_raw_counts": P.value_counts(df, F.col("name"), "name"),
            "name_clean_counts": P.value_counts(df, text.clean_name(F.col("name")), "name_clean_candidate"),
            "name_ambiguous_groups": D.ambiguous_names(pairs), "name_ambiguous_examples": D.variant_examples(pairs),
            "exact_name_duplicates": D.repeated(prepared, "name"),
            "clean_name_duplicates": D.repeated(prepared, "name_clean"),
        }
    for column, key in [("country_origin", text.country_key), ("domain", text.domain_key)]:
        if column in have:
            mapping = P.mapping_counts(df, F.col(column), key(F.col(column)), f"{column}_raw", f"{column}_norm")
            out[f"{column}_raw_counts"] = P.value_counts(df, F.col(column), f"{column}_raw")
            out[f"{column}_norm_counts"] = P.value_counts(df, key(F.col(column)), f"{column}_norm")
            out[f"{column}_mapping"] = mapping
            out[f"{column}_collisions"] = D.collision_groups(mapping, f"{column}_raw", f"{column}_norm")
    if "domain" in have:
        out["domain_distribution"] = P.distribution(prepared, "domain")
    if "price_category" in have:
        out["price_category_distribution"] = P.distribution(prepared, "price_category")
        out["price_category_label_counts"] = P.audit_labels(df)
        out["price_category_label_distribution"] = P.label_distribution(prepared)
    if "founded" in have:
        out["founded_summary"] = P.founded_summary(df, to_number(F.col("founded")))
        out["founded_decade_distribution"] = P.decade_distribution(prepared, F.col("founded"))
    if "description" in have:
        c = F.col("description")
        out["description_summary"] = P.description_summary(df, c)
        out["description_length_distribution"] = P.length_histogram(df, c)
        out["description_year_mentions"] = P.year_mention_histogram(df, c)
    if "presence_russia" in have:
        out["presence_summary"] = P.presence_summary(df, F.col("presence_russia"))
    if "presence_regions" in have:
        out["regions_summary"] = P.region_summary(df, F.col("presence_regions"))
    counts = {c: to_number(F.col(c)) for c in ["presence_world", "plans"] if c in have}
    if counts:
        out["count_summary"] = P.count_summary(df, counts)
    if "total_rented_area" in have:
        area = to_number(F.col("total_rented_area"))
        out["area_summary"] = P.area_summary(df, area)
        out["area_distribution"] = P.area_histogram(df, area)
        if "domain" in have:
            out["area_known_rate_by_domain"] = P.known_rate_by(df, F.col("domain"), area)
    keys = ["name", "country_origin", "domain", "price_category"]
    if {*keys, "founded"} <= have:
        out["founded_conflicts_raw"] = D.variants(df, keys, to_number(F.col("founded")), "n_founded_variants")
        out["founded_conflicts"] = D.variants(prepared, keys, F.col("founded"), "n_founded_variants")
    if {"name", "domain"} <= have:
        out["name_domain_conflicts"] = D.variants(prepared, ["name_clean"], F.col("domain"), "n_domain_variants")
    if {"name", "country_origin"} <= have:
        out["name_country_conflicts"] = D.variants(prepared, ["name_clean"], F.col("country_origin"), "n_country_variants")
    return out


def run_audit(raw: DataFrame, folder: str, fmt: str = "parquet") -> list[str]:
    """Write every report; returns their names. The prepared rows are computed once."""
    raw = staged(require_rows(raw))
    prepared = staged(prepare_features(raw))
    reports = audit_reports(raw, prepared)
    for name, report in reports.items():
        write_table(report, f"{folder}/{name}", fmt)
    return list(reports)


# --- training ---------------------------------------------------------------

def default_candidates() -> dict[str, list[dict]]:
    return {"domain": K.domain_candidates(), "founded": K.founded_candidates(), "price_category": K.price_candidates()}


def train_run(raw: DataFrame, folder: str, run_id: str, candidates: Mapping[str, Sequence[dict]] | None = None,
              folds: int = 5, parallelism: int = 2, policy: Sequence[tuple] = POLICY,
              smoke_rows: int = 20) -> dict[str, str]:
    """Gate the data, train all targets, check quality and predictions, and enter the run in the
    ledger. Returns the statuses; a failed run is recorded but never published.

    ``raw`` needs a unique ``row_id``.
    """
    spark = raw.sparkSession
    candidates = candidates or default_candidates()
    raw = staged(require_rows(raw))
    prepared = staged(prepare_features(raw))
    R.require_data_gate(staged(R.qa_metrics(raw, prepared)))
    columns = [c for c in CANONICAL_COLUMNS if c in harmonize(raw).columns]
    fingerprint = QA.fingerprint_text(harmonize(raw), columns)

    jobs = {"domain": (T.domain_training_rows, T.train_domain), "founded": (T.founded_training_rows, T.train_founded),
            "price_category": (T.price_training_rows, T.train_price)}
    results = {}
    for model, (rows, train) in jobs.items():
        result = train(rows(prepared, folds), candidates[model], folds, parallelism)
        result["attributes"] |= {"feature_contract_version": FEATURE_CONTRACT_VERSION, "dataset_fingerprint": fingerprint}
        result["pipeline"].write().overwrite().save(f"{folder}/models/{run_id}/{model}")
        write_table(result["leaderboard"], f"{folder}/reports/{run_id}/{model}/leaderboard")
        for name, report in result["reports"].items():
            write_table(report, f"{folder}/reports/{run_id}/{model}/{name}")
        results[model] = result

    metrics = literal_rows(spark, ["run_id", "model", "metric", "value"], [
        (run_id, m, k, None if v is None else float(v)) for m, r in results.items() for k, v in r["metrics"].items()])
    attributes = literal_rows(spark, ["run_id", "model", "key", "value"], [
        (run_id, m, k, str(v)) for m, r in results.items() for k, v in r["attributes"].items()])
    classes = spark.createDataFrame([(run_id, c) for c in results["domain"]["classes"]], "run_id string, domain string")
    gaps = QA.report_gaps(attributes, metrics).orderBy("model", "item").collect()  # a run has few entries
    if gaps:
        raise RuntimeError("Training reports are incomplete: " + ", ".join(f"{g.model}.{g.item} {g.problem}" for g in gaps))
    quality = staged(QA.quality_checks(metrics, policy))
    write_table(quality, f"{folder}/reports/{run_id}/quality_checks")
    models = {m: r["pipeline"] for m, r in results.items()}
    smoke = staged(smoke_test(raw, models, results["price_category"]["thresholds"], classes.select("domain"), smoke_rows))
    write_table(smoke, f"{folder}/reports/{run_id}/smoke_checks")
    statuses = {
        "quality_status": QA.quality_summary(quality).first().status,
        "smoke_status": "PASSED" if smoke.filter("passed = 0").isEmpty() else "FAILED",
    }
    entry = (run_id, datetime.now(timezone.utc).isoformat(), POLICY_VERSION, *statuses.values())
    ledger = literal_rows(spark, ["run_id", "published_at", "policy_version", "quality_status", "smoke_status"], [entry])
    # The ledger comes last: a run that is not in it is never read.
    for name, rows in (("metrics", metrics), ("attributes", attributes), ("classes", classes), ("ledger", ledger)):
        replace_run(rows, f"{folder}/{name}")
    return statuses


def replace_run(rows: DataFrame, path: str) -> None:
    """Write the rows of a run in place of its earlier ones; other runs stay.

    Folders are named by a copy of run_id, since readers guess the types of folder names.
    """
    rows.withColumn("_run", F.col("run_id")).write.partitionBy("_run").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def smoke_test(raw: DataFrame, models: Mapping[str, PipelineModel], thresholds: Mapping[str, float],
               classes: DataFrame, rows: int = 20, seed: int = SEED) -> DataFrame:
    """Score a seeded sample with and without its target columns and check the predictions."""
    sample = staged(seeded_sample(harmonize(require_rows(raw)), rows, seed=seed))
    without = staged(score(sample.drop(*TARGET_COLUMNS), models, thresholds))
    with_targets = staged(score(sample, models, thresholds))
    return checks.smoke_checks(without, sample, classes, with_targets)


# --- scoring ----------------------------------------------------------------

def load_models(spark: SparkSession, folder: str, run_id: str) -> tuple[dict[str, PipelineModel], dict[str, float]]:
    models = {m: PipelineModel.load(f"{folder}/models/{run_id}/{m}") for m in MODELS}
    found = (spark.read.parquet(f"{folder}/metrics")
             .filter((F.col("run_id") == run_id) & F.col("metric").startswith("threshold:")).collect())  # five rows
    thresholds = {r.metric.split(":", 1)[1]: r.value for r in found}
    return models, {label: thresholds[label] for label in KNOWN_PRICE_LABELS}


def current_models(spark: SparkSession, folder: str) -> tuple[dict[str, PipelineModel], dict[str, float]]:
    """Models and thresholds of the newest run that passed all checks; refuses if there is none."""
    return load_models(spark, folder, QA.current_run(spark.read.parquet(f"{folder}/ledger"), spark.read.parquet(f"{folder}/attributes")))


def score_current(raw: DataFrame, folder: str) -> DataFrame:
    """Score with the newest run that passed all checks."""
    return score(raw, *current_models(raw.sparkSession, folder))


def run_scoring(raw: DataFrame, folder: str, out: str, fmt: str = "parquet") -> DataFrame:
    """Write predictions and a one-row summary; returns the summary."""
    models, thresholds = current_models(raw.sparkSession, folder)
    return write_scored(score(raw, models, thresholds), models, out, fmt)
