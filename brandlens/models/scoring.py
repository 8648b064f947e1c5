"""Batch scoring: one pass, no shuffle, no target read."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Observation, functions as F

from brandlens.contract import FEATURE_CONTRACT_VERSION, KNOWN_PRICE_LABELS, MODELS, UNKNOWN_DOMAIN
from brandlens.functions.labels import indicators_text
from brandlens.functions.numbers import clip, round_half_even
from brandlens.operators.checks import FLAG_COLUMNS, PREDICTION_COLUMNS, PROBABILITY_COLUMNS
from brandlens.operators.literal import literal_rows
from brandlens.operators.prepare import prepare_features
from brandlens.operators.schema import model_input
from brandlens.operators.thresholds import check_thresholds, decide
from brandlens.sources.csv_files import write_table

N = len(KNOWN_PRICE_LABELS)


def score(raw: DataFrame, models: Mapping[str, PipelineModel], thresholds: Mapping[str, float] | None = None) -> DataFrame:
    """The raw columns plus the predictions of all three targets.

    Each model sees exactly the safe features; no prediction feeds another model. A missing model
    leaves its columns null.
    """
    kept = raw.select("*", F.struct(*[F.col(f"`{c}`") for c in raw.columns]).alias("_raw"))
    df = model_input(prepare_features(kept), keep=["_raw"])
    df = add_domain(df, models.get("domain"))
    df = add_founded(df, models.get("founded"))
    df = add_price(df, models.get("price_category"), thresholds)
    return finish(df)


def finish(df: DataFrame) -> DataFrame:
    outputs = [c for c in [*PREDICTION_COLUMNS, *PROBABILITY_COLUMNS, *FLAG_COLUMNS] if c in df.columns]
    return df.select("_raw.*", *outputs)


def _null(kind: str):
    return F.lit(None).cast(kind)


def add_domain(df: DataFrame, model: PipelineModel | None) -> DataFrame:
    if model is None:
        return df.withColumn("pred_domain", _null("string"))
    return model.transform(df).select(*df.columns, "pred_domain")


def add_founded(df: DataFrame, model: PipelineModel | None, clipped: bool = True) -> DataFrame:
    """Year clipped to the valid range (or, as an older rule, only to zero) and its rounding."""
    if model is None:
        return df.withColumns({"pred_founded": _null("double"), "pred_founded_rounded": _null("int")})
    year = F.col("pred_year")
    year = clip(year) if clipped else F.greatest(year, F.lit(0.0))
    scored = model.transform(df).select(*df.columns, year.alias("pred_founded"))
    return scored.withColumn("pred_founded_rounded", round_half_even(F.col("pred_founded")))


def add_price(df: DataFrame, model: PipelineModel | None, thresholds: Mapping[str, float] | None) -> DataFrame:
    """Label text, five probabilities and five 0/1 columns."""
    if model is None or thresholds is None:
        return df.withColumn("pred_price_category", _null("string"))
    check_thresholds(list(KNOWN_PRICE_LABELS), dict(thresholds))
    prob = F.array(*[vector_to_array(f"prob{i}")[1] for i in range(N)])
    scored = model.transform(df).select(*df.columns, prob.alias("_prob"))
    flags = decide(F.col("_prob"), [thresholds[label] for label in KNOWN_PRICE_LABELS])
    scored = scored.withColumn("_flags", flags)
    return scored.select(
        *df.columns, indicators_text(F.col("_flags")).alias("pred_price_category"),
        *[F.col("_prob")[i].alias(c) for i, c in enumerate(PROBABILITY_COLUMNS)],
        *[F.col("_flags")[i].alias(c) for i, c in enumerate(FLAG_COLUMNS)])


def score_cascaded(raw: DataFrame, models: Mapping[str, PipelineModel], thresholds: Mapping[str, float] | None = None) -> DataFrame:
    """Superseded experiment: the predicted domain feeds the year model, and both feed the price
    model. The models must have been fitted with those columns; never used by default."""
    kept = raw.select("*", F.struct(*[F.col(f"`{c}`") for c in raw.columns]).alias("_raw"))
    prepared = prepare_features(kept)
    extra = ["domain", "founded", "price_category"]
    for column, kind in zip(extra, ["string", "double", "string"]):
        if column not in prepared.columns:
            prepared = prepared.withColumn(column, _null(kind))
    df = model_input(prepared, keep=["_raw", *extra])
    df = add_domain(df, models.get("domain"))
    df = df.withColumn("domain", F.coalesce("pred_domain", "domain", F.lit(UNKNOWN_DOMAIN)))
    df = add_founded(df, models.get("founded"), clipped=False)
    df = df.withColumn("founded", F.coalesce("pred_founded", "founded"))
    return finish(add_price(df, models.get("price_category"), thresholds))


def write_scored(result: DataFrame, models: Mapping[str, PipelineModel], path: str, fmt: str = "parquet") -> DataFrame:
    """Write a scoring and return its one-row summary: rows, feature contract, models that took part.

    Rows are counted by the pass that writes them, so nothing is scored or read twice.
    """
    seen = Observation()
    write_table(result.observe(seen, F.count(F.lit(1)).alias("rows_scored")), path, fmt)
    flags = {f"{m}_model_used": int(models.get(m) is not None) for m in MODELS}
    return literal_rows(result.sparkSession, ["rows_scored", "feature_contract_version", *flags],
                        [(seen.get["rows_scored"], FEATURE_CONTRACT_VERSION, *flags.values())]).withColumn("rows_scored", F.col("rows_scored").cast("bigint"))
