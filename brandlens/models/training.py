"""Model selection and training of the three targets.

The protocol: a holdout is set aside; candidates and parameters are chosen by cross-validation
on the development rows; thresholds come from out-of-fold probabilities; the holdout is scored
once, by the winner.

Feature vectors are fitted once per fold and shared by all grid points. The out-of-fold
predictions of all grid points are written to the shared folder; scores, the choice and the
threshold calibration read that table, so nothing is fitted twice.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml import Model, PipelineModel
from pyspark.ml.feature import IndexToString, SQLTransformer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from brandlens.contract import CV_FOLDS, KNOWN_PRICE_LABELS, MIN_CLASS_ROWS, SAFE_FEATURES, SEED
from brandlens.functions import labels
from brandlens.models.features import fit_features, vectors
from brandlens.operators import baselines, metrics, quality, thresholds
from brandlens.operators.literal import literal_rows
from brandlens.operators.prepare import domain_rows, founded_rows, price_rows, refuse_unexpected_labels
from brandlens.operators.readiness import union_all
from brandlens.operators.schema import model_input, require_columns
from brandlens.operators.skew import join_group_sizes
from brandlens.operators.split import add_folds, add_holdout
from brandlens.sources.staging import staged

N = len(KNOWN_PRICE_LABELS)
BINARY = {"ml_attr": {"type": "nominal", "vals": ["0", "1"], "name": "label"}}


# --- rows -------------------------------------------------------------------

def domain_training_rows(prepared: DataFrame, folds: int = CV_FOLDS, share: float = 0.2, seed: int = SEED) -> DataFrame:
    """Staged model input with ``domain``, ``split`` and, for development rows, ``fold``."""
    require_columns(prepared, ["domain", *SAFE_FEATURES])
    rows = staged(model_input(domain_rows(prepared), keep=["row_id", "domain"]))
    if rows.select("domain").distinct().limit(2).count() < 2:
        raise ValueError(f"Domain training needs two classes with {MIN_CLASS_ROWS} rows.")
    return _split_and_fold(rows, ["domain"], ["domain"], folds, share, seed)


def founded_training_rows(prepared: DataFrame, folds: int = CV_FOLDS, share: float = 0.2, seed: int = SEED) -> DataFrame:
    require_columns(prepared, ["founded", *SAFE_FEATURES])
    rows = staged(model_input(founded_rows(prepared), keep=["row_id", "founded"]))
    if rows.limit(2).count() < 2:
        raise ValueError("Not enough valid rows for founded regression.")
    return _split_and_fold(rows, [], [], folds, share, seed)


def price_training_rows(prepared: DataFrame, folds: int = CV_FOLDS, share: float = 0.2, seed: int = SEED) -> DataFrame:
    """Stratified by the number of labels; ``y`` is the indicator array."""
    require_columns(prepared, ["price_category", *SAFE_FEATURES])
    refuse_unexpected_labels(prepared)
    known = price_rows(prepared).withColumn("y", labels.indicators(F.col("labels"))).withColumn("n_labels", F.size("labels"))
    rows = staged(model_input(known, keep=["row_id", "y", "n_labels"]))
    if rows.isEmpty():
        raise ValueError("No rows with known price labels remain.")
    found = _split_and_fold(rows, ["n_labels"], [], folds, share, seed)
    support = metrics.label_supports(found.filter("split = 'development'"), [])
    rare = support.filter(F.col("support") < MIN_CLASS_ROWS).collect()  # one row per label
    if rare:
        raise ValueError("Some price labels have too few rows: " + ", ".join(f"{r.label}={r.support}" for r in rare))
    return found


def _split_and_fold(rows: DataFrame, strata: Sequence[str], fold_strata: Sequence[str], folds: int, share: float,
                    seed: int) -> DataFrame:
    split = staged(add_holdout(rows, strata, share=share, seed=seed))
    development = add_folds(split.filter("split = 'development'"), fold_strata, folds=folds, seed=seed)
    holdout = split.filter("split = 'holdout'").withColumn("fold", F.lit(None).cast("int"))
    return staged(development.unionByName(holdout))


# --- fitting ----------------------------------------------------------------

def balanced(rows: DataFrame, label: str) -> DataFrame:
    """Weight n / (classes * class rows)."""
    sizes = rows.groupBy(label).agg(F.count(F.lit(1)).alias("class_rows"))
    total, classes = sizes.agg(F.sum("class_rows"), F.count(F.lit(1))).first()
    weighted = join_group_sizes(rows, sizes, label)
    return weighted.withColumn("weight", F.lit(total) / (F.lit(classes) * F.col("class_rows"))).drop("class_rows")


def fit_domain(rows: DataFrame, build: Callable, params: Sequence[dict], parallelism: int) -> list[Model]:
    return _fit_all(balanced(rows, "label"), build, params, parallelism)


def fit_founded(rows: DataFrame, build: Callable, params: Sequence[dict], parallelism: int, fit_all: Callable | None = None) -> list[Model]:
    return _fit_all(rows.withColumn("label", F.log1p("founded")), build, params, parallelism, fit_all)


def _fit_all(rows: DataFrame, build: Callable, params: Sequence[dict], parallelism: int, fit_all: Callable | None = None) -> list[Model]:
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if fit_all is not None:
            return fit_all(rows, params)
        n = rows.count()
        with ThreadPool(parallelism) as pool:
            return pool.map(lambda p: build(p, n).fit(rows), params)
    finally:
        rows.unpersist()


def fit_price(rows: DataFrame, build: Callable, params: Sequence[dict], parallelism: int) -> list[list[Model]]:
    """Per parameter set one binary model per label, all on the same vectors."""
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = rows.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("y")[i]).alias(f"p{i}") for i in range(N)]).first()

        def fit(job: tuple[dict, int]) -> Model:
            p, i = job
            positive = counts[f"p{i}"]
            weight = (F.when(F.col("y")[i] == 1, F.lit(counts.n / (2 * max(positive, 1))))
                      .otherwise(F.lit(counts.n / (2 * max(counts.n - positive, 1)))))
            one = rows.select("features", F.col("y")[i].cast("double").alias("label", metadata=BINARY),
                              weight.alias("weight"))
            model = build(p, counts.n).fit(one)
            return model.setProbabilityCol(f"prob{i}").setRawPredictionCol(f"raw{i}").setPredictionCol(f"pred{i}")

        jobs = [(p, i) for p in params for i in range(N)]
        with ThreadPool(parallelism) as pool:
            models = pool.map(fit, jobs)
        return [models[k:k + N] for k in range(0, len(models), N)]
    finally:
        rows.unpersist()


def price_probabilities(df: DataFrame, models: Sequence[Model]) -> DataFrame:
    """Adds ``prob``: the positive-class probability of every label, in label order."""
    for model in models:
        df = model.transform(df)
    prob = F.array(*[vector_to_array(f"prob{i}")[1] for i in range(N)])
    return df.withColumn("prob", prob).drop(*[f"{c}{i}" for c in ("prob", "raw", "pred") for i in range(N)])


# --- cross-validation -------------------------------------------------------

def cross_predict(development: DataFrame, candidates: Sequence[dict], keep: Sequence[str], predict: Callable,
                  folds: int = CV_FOLDS, features: Callable = fit_features, parallelism: int = 2) -> DataFrame:
    """Out-of-fold predictions of every candidate and grid point.

    ``predict(candidate, train, valid)`` yields (grid position, predictions of valid). The result
    has (seq, grid, fold, row_id, ...) and is read from the shared folder. ``parallelism`` folds
    are worked on at a time; their vectors are cached for that long.
    """
    def one_fold(fold: int) -> list[DataFrame]:
        train, valid = development.filter(F.col("fold") != fold), development.filter(F.col("fold") == fold)
        fitted = features(train)
        train_v = vectors(fitted, train, keep).persist(StorageLevel.MEMORY_AND_DISK)
        valid_v = vectors(fitted, valid, keep).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            parts = []
            for seq, candidate in enumerate(candidates):
                scored = [df.withColumn("grid", F.lit(i)) for i, df in predict(candidate, train_v, valid_v)]
                parts.append(staged(union_all(*scored).withColumns({"seq": F.lit(seq), "fold": F.lit(fold)})))
            return parts
        finally:
            train_v.unpersist()
            valid_v.unpersist()

    with ThreadPool(parallelism) as pool:
        return union_all(*[part for parts in pool.map(one_fold, range(folds)) for part in parts])


def best_grid_points(scores: DataFrame, score: str, higher: bool = True) -> DataFrame:
    """(seq, grid, cv_best, cv_std): per candidate the best grid point, the first one on ties."""
    means = scores.groupBy("seq", "grid").agg(F.avg(score).alias("cv_best"), F.stddev_pop(score).alias("cv_std"))
    mean = F.round("cv_best", quality.TIE_DIGITS)
    order = F.struct(mean if higher else -mean, -F.col("grid"))
    best = means.groupBy("seq").agg(F.max_by(F.struct("grid", "cv_best", "cv_std"), order).alias("b"))
    return best.select("seq", "b.*")


def make_leaderboard(best: DataFrame, candidates: Sequence[dict], baseline: tuple[str, DataFrame], higher: bool) -> DataFrame:
    """(name, family, cv_best, cv_std, best_params, place, winner), baseline included."""
    spark = best.sparkSession
    points = literal_rows(spark, ["seq", "grid", "name", "family", "best_params"], [
        (seq, i, c["name"], c["family"], json.dumps(p, sort_keys=True, ensure_ascii=False))
        for seq, c in enumerate(candidates) for i, p in enumerate(c["grid"])])
    listed = best.join(points, ["seq", "grid"]).select("seq", "grid", "name", "family", "best_params", "cv_best", "cv_std")
    name, scores = baseline
    base = scores.select(F.lit(-1).alias("seq"), F.lit(-1).alias("grid"), F.lit(name).alias("name"),
                         F.lit("baseline").alias("family"), F.lit("{}").alias("best_params"),
                         F.col("cv_mean").alias("cv_best"), "cv_std")
    return staged(quality.rank_candidates(listed.unionByName(base), higher))


def winner_of(board: DataFrame) -> dict:
    return board.filter("winner = 1").first().asDict()


def baseline_of(board: DataFrame) -> dict:
    return board.filter("family = 'baseline'").first().asDict()


# --- the three targets ------------------------------------------------------

def train_domain(rows: DataFrame, candidates: Sequence[dict], folds: int = CV_FOLDS, parallelism: int = 2,
                 features: Callable = fit_features) -> dict:
    """Multiclass training; returns pipeline, leaderboard, metrics, attributes and reports."""
    indexer = StringIndexer(inputCol="domain", outputCol="label", stringOrderType="alphabetAsc").fit(rows)
    classes = list(indexer.labels)
    indexed = indexer.transform(rows)
    development, holdout = _parts(indexed)
    keep = ["row_id", "domain", "label"]
    back = IndexToString(inputCol="prediction", outputCol="pred_domain", labels=classes)

    def predict(candidate, train, valid):
        for i, model in enumerate(fit_domain(train, candidate["build"], candidate["grid"], parallelism)):
            yield i, back.transform(model.transform(valid)).select(
                "row_id", F.col("domain").alias("y_true"), F.col("pred_domain").alias("y_pred"))

    oof = cross_predict(development, candidates, keep, predict, folds, features, parallelism)
    scores = metrics.multiclass_metrics(oof, ["seq", "grid", "fold"])
    base = baselines.fold_scores(baselines.mode_baseline(development, "domain", folds), "macro_f1")
    board = make_leaderboard(best_grid_points(scores, "macro_f1"), candidates, ("DummyMostFrequent", base), True)
    won, dummy = winner_of(board), baseline_of(board)

    fitted = features(development)
    build, params = candidates[won["seq"]]["build"], candidates[won["seq"]]["grid"][won["grid"]]
    model = fit_domain(_all_vectors(fitted, development, keep), build, [params], 1)[0]
    pipeline = PipelineModel([*fitted.stages, model, back])
    tested = staged(pipeline.transform(holdout).select("row_id", F.col("domain").alias("y_true"),
                                                       F.col("pred_domain").alias("y_pred")))
    held = metrics.multiclass_metrics(tested).first()
    values = {
        "cv_best_macro_f1": won["cv_best"], "cv_std_macro_f1": won["cv_std"], "baseline_cv_macro_f1": dummy["cv_best"],
        "cv_uplift_over_baseline": won["cv_best"] - dummy["cv_best"],
        "holdout_accuracy": held.accuracy, "holdout_balanced_accuracy": held.balanced_accuracy,
        "holdout_macro_precision": held.macro_precision, "holdout_macro_recall": held.macro_recall,
        "holdout_macro_f1": held.macro_f1, "holdout_weighted_f1": held.weighted_f1,
        "generalization_gap_macro_f1": held.macro_f1 - won["cv_best"], "n_classes": len(classes),
        **_row_counts(rows),
    }
    return {"model": "domain", "pipeline": pipeline, "leaderboard": board, "metrics": values, "classes": classes,
            "attributes": _attributes("domain", "cv_best_macro_f1", won, dummy),
            "reports": {"classification_report": metrics.class_report(tested),
                        "confusion_counts": metrics.confusion_counts(tested)}}


def train_founded(rows: DataFrame, candidates: Sequence[dict], folds: int = CV_FOLDS, parallelism: int = 2,
                  features: Callable = fit_features) -> dict:
    """Regression on log1p(year). Selection uses unclipped years, the holdout clipped ones."""
    development, holdout = _parts(rows)
    keep = ["row_id", "founded"]

    def predict(candidate, train, valid):
        for i, model in enumerate(fit_founded(train, candidate["build"], candidate["grid"], parallelism, candidate.get("fit_all"))):
            yield i, model.transform(valid).select("row_id", F.col("founded").alias("y_true"),
                                                   F.expm1("prediction").alias("y_pred"))

    oof = cross_predict(development, candidates, keep, predict, folds, features, parallelism)
    scores = oof.groupBy("seq", "grid", "fold").agg(F.avg(F.abs(F.col("y_true") - F.col("y_pred"))).alias("mae"))
    base = baselines.fold_scores(baselines.median_baseline(development, "founded", folds), "mae")
    board = make_leaderboard(best_grid_points(scores, "mae", higher=False), candidates, ("DummyMedian", base), False)
    won, dummy = winner_of(board), baseline_of(board)

    fitted = features(development)
    winner = candidates[won["seq"]]
    model = fit_founded(_all_vectors(fitted, development, keep), winner["build"], [winner["grid"][won["grid"]]], 1, winner.get("fit_all"))[0]
    pipeline = founded_pipeline(fitted, model)
    tested = staged(pipeline.transform(holdout).select("row_id", F.col("founded").alias("y_true"),
                                                       F.col("pred_year").alias("y_pred")))
    held = metrics.regression_metrics(tested).first()
    gain = dummy["cv_best"] - won["cv_best"]
    values = {
        "cv_best_mae": won["cv_best"], "cv_std_mae": won["cv_std"], "baseline_cv_mae": dummy["cv_best"],
        "cv_mae_improvement_over_baseline_abs": gain,
        "cv_mae_improvement_over_baseline_pct": gain / dummy["cv_best"] if dummy["cv_best"] > 0 else None,
        "holdout_mae": held.mae, "holdout_rmse": held.rmse, "holdout_r2": held.r2,
        "holdout_median_absolute_error": held.median_absolute_error,
        "holdout_p90_absolute_error": held.p90_absolute_error,
        "generalization_gap_mae": held.mae - won["cv_best"], **_row_counts(rows),
    }
    return {"model": "founded", "pipeline": pipeline, "leaderboard": board, "metrics": values,
            "attributes": _attributes("founded", "cv_best_mae", won, dummy), "oof": oof,
            "reports": {"predictions_preview": metrics.worst_predictions(tested)}}


def train_price(rows: DataFrame, candidates: Sequence[dict], folds: int = CV_FOLDS, parallelism: int = 2,
                features: Callable = fit_features, in_sample_thresholds: bool = False) -> dict:
    """Five binary models with thresholds from out-of-fold probabilities.

    ``in_sample_thresholds`` is the older rule that fitted them on training probabilities.
    """
    development, holdout = _parts(rows)
    keep = ["row_id", "y"]

    def predict(candidate, train, valid):
        for i, models in enumerate(fit_price(train, candidate["build"], candidate["grid"], parallelism)):
            yield i, price_probabilities(valid, models).select("row_id", "y", "prob")

    oof = cross_predict(development, candidates, keep, predict, folds, features, parallelism)
    decided = oof.withColumn("p", thresholds.decide_direct(F.col("prob")))
    scores = metrics.multilabel_metrics(decided, keys=["seq", "grid", "fold"])
    base = baselines.fold_scores(baselines.label_baseline(development), "macro_f1")
    board = make_leaderboard(best_grid_points(scores, "macro_f1"), candidates, ("DummyMostFrequent", base), True)
    won, dummy = winner_of(board), baseline_of(board)

    fitted = features(development)
    build, params = candidates[won["seq"]]["build"], candidates[won["seq"]]["grid"][won["grid"]]
    models = fit_price(_all_vectors(fitted, development, keep), build, [params], 1)[0]
    pipeline = PipelineModel([*fitted.stages, *models])

    def probabilities(df: DataFrame) -> DataFrame:
        return price_probabilities(fitted.transform(df), models).select("row_id", "y", "prob")

    out_of_fold = oof.filter((F.col("seq") == won["seq"]) & (F.col("grid") == won["grid"]))
    calibration = staged(probabilities(development)) if in_sample_thresholds else out_of_fold
    chosen = staged(thresholds.best_thresholds(thresholds.threshold_scores(calibration)))
    strategies = {r.strategy: r for r in thresholds.choose_strategy(out_of_fold, chosen).collect()}  # two rows
    selected = next(r for r in strategies.values() if r.selected == 1)
    if selected.strategy == "default_0.5":
        limits = {label: 0.5 for label in KNOWN_PRICE_LABELS}
    else:
        limits = {r.label: r.threshold for r in chosen.orderBy("label_idx").collect()}  # one row per label
    order = [limits[label] for label in KNOWN_PRICE_LABELS]

    tested = staged(probabilities(holdout))
    direct = metrics.multilabel_metrics(tested.withColumn("p", thresholds.decide_direct(F.col("prob")))).first()
    served_rows = tested.withColumn("p", thresholds.decide(F.col("prob"), order))
    served = metrics.multilabel_metrics(served_rows).first()
    dummy_held = metrics.multilabel_metrics(baselines.holdout_label_baseline(rows)).first()
    values = {
        "cv_best_macro_f1": won["cv_best"], "cv_std_macro_f1": won["cv_std"],
        "baseline_cv_macro_f1": dummy["cv_best"], "baseline_cv_std_macro_f1": dummy["cv_std"],
        "cv_uplift_over_baseline": won["cv_best"] - dummy["cv_best"],
        "oof_default_macro_f1": strategies["default_0.5"].macro_f1, "oof_selected_macro_f1": selected.macro_f1,
        "oof_selected_micro_f1": selected.micro_f1,
        "holdout_direct_macro_f1": direct.macro_f1, "holdout_direct_micro_f1": direct.micro_f1,
        "holdout_serving_macro_f1": served.macro_f1, "holdout_serving_micro_f1": served.micro_f1,
        "holdout_serving_weighted_f1": served.weighted_f1, "holdout_serving_samples_f1": served.samples_f1,
        "holdout_dummy_macro_f1": dummy_held.macro_f1,
        "generalization_gap_macro_f1": served.macro_f1 - selected.macro_f1,
        # Second names under which older readers look for the serving scores.
        "threshold_macro_f1": served.macro_f1, "threshold_micro_f1": served.micro_f1,
        "threshold_weighted_f1": served.weighted_f1, "threshold_samples_f1": served.samples_f1,
        **{f"threshold:{label}": t for label, t in limits.items()}, **_row_counts(rows),
    }
    attributes = _attributes("price_category", "cv_best_macro_f1", won, dummy)
    attributes["threshold_calibration"] = "in_sample" if in_sample_thresholds else "development_oof_cv"
    attributes["threshold_strategy"] = selected.strategy
    return {"model": "price_category", "pipeline": pipeline, "leaderboard": board, "metrics": values,
            "attributes": attributes, "thresholds": limits, "oof": out_of_fold,
            "reports": {"classification_report": metrics.multilabel_report(served_rows),
                        "label_support": metrics.label_supports(rows, ["split"])}}


def founded_pipeline(fitted: PipelineModel, model: Model) -> PipelineModel:
    """Features, model on log1p of the year, and the year it means."""
    return PipelineModel([*fitted.stages, model, SQLTransformer(statement="SELECT *, expm1(prediction) AS pred_year FROM __THIS__")])


def _all_vectors(fitted: PipelineModel, development: DataFrame, keep: Sequence[str]) -> DataFrame:
    return vectors(fitted, development, keep)


def _parts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return rows.filter("split = 'development'"), rows.filter("split = 'holdout'")


def _row_counts(rows: DataFrame) -> dict[str, float]:
    n = rows.agg(F.count(F.lit(1)), F.count_if(F.col("split") == "holdout")).first()
    return {"rows_used": n[0], "holdout_rows": n[1], "development_rows": n[0] - n[1]}


def _attributes(model: str, metric: str, won: dict, dummy: dict) -> dict[str, str]:
    return {
        "target": model, "selection_metric": metric, "winner_name": won["name"], "winner_family": won["family"],
        "best_params": won["best_params"], "baseline_name": dummy["name"], "feature_columns": ",".join(SAFE_FEATURES),
        "selection_protocol": "cross-validation on development rows; holdout scored once", "random_state": str(SEED),
    }
