"""A training run from raw rows to scored ones, with small candidates."""

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from brandlens.contract import KNOWN_PRICE_LABELS, POLICY
from brandlens.models import features as X, scoring
from brandlens.operators import checks
from brandlens.operators.prepare import prepare_features
from brandlens.operators.schema import harmonize, model_input
from brandlens.plans import runs
from brandlens.sources.brands import raw_brands
from brandlens.sources.staging import staged
from brand_data import SF
from small_candidates import light_candidates

LENIENT = [(m, k, op, -1e9 if op == ">=" else 1e9) for m, k, op, _ in POLICY]


@pytest.fixture(scope="module")
def raw(spark):
    return staged(raw_brands(spark, SF))


@pytest.fixture(scope="module")
def folder(spark, raw, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("runs"))
    light = {m: c[:1] for m, c in light_candidates(max_iter=4).items()}
    statuses = runs.train_run(raw, folder, "run-1", light, folds=3, parallelism=3, policy=LENIENT)
    assert statuses == {"quality_status": "PASSED", "smoke_status": "PASSED"}
    return folder


def test_run_tables(spark, folder):
    board = spark.read.parquet(f"{folder}/reports/run-1/domain/leaderboard")
    assert board.filter("winner = 1").first().name == "LogisticRegression"
    assert board.filter("family = 'baseline' and winner = 1").isEmpty()
    smoke = spark.read.parquet(f"{folder}/reports/run-1/smoke_checks")
    assert smoke.count() == 17 and smoke.filter("passed = 0").isEmpty()
    assert spark.read.parquet(f"{folder}/reports/run-1/quality_checks").count() == 17
    metrics = {(r.model, r.metric): r.value for r in spark.read.parquet(f"{folder}/metrics").collect()}
    for model in ("domain", "founded", "price_category"):
        used, held = metrics[model, "rows_used"], metrics[model, "holdout_rows"]
        assert held == -(-used // 5) and metrics[model, "development_rows"] == used - held
    assert metrics["price_category", "generalization_gap_macro_f1"] == pytest.approx(
        metrics["price_category", "holdout_serving_macro_f1"] - metrics["price_category", "oof_selected_macro_f1"])


def test_scoring(spark, raw, folder, tmp_path):
    result = staged(runs.score_current(raw, folder))
    assert result.count() == raw.count() and result.columns[:len(raw.columns)] == raw.columns
    assert result.filter(~F.col("pred_founded").between(1850, 2025)).isEmpty()
    flags = F.array(*checks.FLAG_COLUMNS)
    assert result.filter(~F.array_contains(flags, 1)).isEmpty()
    assert result.filter("pred_domain is null").isEmpty()
    # Scoring is one pass without a shuffle of its own: the plan over a file has no exchange.
    plan = runs.score_current(raw, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    summary = runs.run_scoring(raw, folder, str(tmp_path / "out")).first()
    assert summary.rows_scored == raw.count() and summary.domain_model_used == 1


def test_targets_do_not_influence_predictions(spark, raw, folder):
    bare = raw.drop("domain", "founded", "price_category", "total_rented_area")
    differences = checks.result_differences(runs.score_current(raw, folder), runs.score_current(bare, folder)).first()
    assert list(differences) == [0, 0, 0]


def test_missing_models_leave_nulls(spark, raw):
    result = scoring.score(raw, {})
    assert result.filter("pred_domain is not null or pred_founded is not null or pred_price_category is not null").isEmpty()


def test_cascaded_scoring_reads_predicted_columns(spark, raw, folder):
    models, limits = runs.load_models(spark, folder, "run-1")
    # Models on safe features give the same result either way, apart from the year's clip.
    plain = scoring.score(raw, models, limits).select("row_id", "pred_domain", "pred_price_category")
    cascaded = scoring.score_cascaded(raw, models, limits).select("row_id", "pred_domain", "pred_price_category")
    assert plain.exceptAll(cascaded).isEmpty()


def test_features_outside_the_contract_need_a_flag(spark, raw):
    rows = prepare_features(raw)
    with pytest.raises(ValueError, match="contract"):
        X.fit_features(rows, numeric=["plans", "founded"])
    fitted = X.fit_features(rows, numeric=["plans", "founded"], categorical=["domain"], text=[("name_clean", 50)], check=False)
    assert fitted.transform(rows).first().features.size > 2


def test_unseen_categories_give_no_slot(spark, raw):
    rows = model_input(prepare_features(raw))
    stages = X.fit_category(rows, "country_origin")
    new = rows.limit(1).withColumn("country_origin", F.lit("Атлантида"))
    assert X.run(stages, new).first().o_country_origin.numNonzeros() == 0


def test_tfidf_by_hand(spark):
    df = spark.createDataFrame([("aa bb",), ("aa cc",), ("x",)], "t string")
    stages = X.fit_text(df, "t", 10, 3, "p_")
    assert stages[2].vocabulary == ["aa"]  # bb, cc and the pairs occur once, x is too short
    assert [r.p_tfidf for r in X.run(stages, df).collect()] == [Vectors.sparse(1, [0], [1.0])] * 2 + [Vectors.sparse(1, [], [])]


def test_failed_run_is_not_served(spark, raw, folder, tmp_path):
    ledger = spark.read.parquet(f"{folder}/ledger").withColumn("quality_status", F.lit("FAILED"))
    with pytest.raises(RuntimeError, match="No run passed"):
        runs.QA.current_run(ledger, spark.read.parquet(f"{folder}/attributes"))


def test_audit(spark, raw, tmp_path):
    names = runs.run_audit(raw.select("row_id", "name", "domain", "founded", "price_category", "description"), str(tmp_path))
    assert "missing_report" in names and "area_summary" not in names
    gate = spark.read.parquet(f"{tmp_path}/data_gate")
    assert gate.filter("rule = 'canonical_columns'").first().passed == 0
    assert harmonize(raw).columns.count("country_origin") == 1
    assert len(KNOWN_PRICE_LABELS) == 5


def test_default_candidates_hold_boosted_trees():
    found = runs.default_candidates()
    assert set(found) == {"domain", "founded", "price_category"}
    assert all("GradientBoosting" in [c["name"] for c in lists] for lists in found.values())


@pytest.mark.parametrize("target", [runs.K.domain_candidates, runs.K.founded_candidates, runs.K.price_candidates])
def test_boosted_trees_fit(spark, target):
    rows = spark.createDataFrame([(Vectors.dense(float(i % 2), float(i % 5)), float(i % 2)) for i in range(40)], ["features", "label"])
    boosted = next(c for c in target(rounds=2) if c["family"] == "boosting")
    predicted = boosted["build"](boosted["grid"][0], 40).fit(rows).transform(rows).collect()
    assert max(abs(r.prediction - r.label) for r in predicted) < 0.5
