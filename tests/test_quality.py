import pytest
from pyspark.sql import functions as F

from brandlens.contract import FEATURE_CONTRACT_VERSION, MODELS, POLICY
from brandlens.operators import checks, quality, readiness

GOOD = {(m, k): (limit + 0.001 if op == ">=" else limit - 0.001) for m, k, op, limit in POLICY
        if k != "serving_macro_drop_vs_direct"}
GOOD["price_category", "holdout_direct_macro_f1"] = GOOD["price_category", "holdout_serving_macro_f1"] + 0.01


def metrics(spark, changes=None, run="r"):
    values = {**GOOD, **(changes or {})}
    return spark.createDataFrame([(run, m, k, v) for (m, k), v in values.items()], "run_id string, model string, metric string, value double")


def status(spark, changes=None):
    return quality.quality_summary(quality.quality_checks(metrics(spark, changes))).first()


def test_quality_gate(spark):
    good = status(spark)
    assert (good.status, good.checks_total, good.checks_failed) == ("PASSED", 17, 0)
    assert status(spark, {("founded", "holdout_mae"): 10.5}).status == "PASSED"  # limits are inclusive
    assert status(spark, {("founded", "holdout_mae"): 10.6}).status == "FAILED"
    assert status(spark, {("domain", "holdout_macro_f1"): None}).status == "ERROR"
    assert status(spark, {("domain", "holdout_macro_f1"): float("nan")}).status == "ERROR"
    assert status(spark, {("price_category", "holdout_direct_macro_f1"): 0.9}).checks_failed == 1
    with pytest.raises(RuntimeError, match="founded.holdout_mae"):
        quality.require_quality(quality.quality_checks(metrics(spark, {("founded", "holdout_mae"): 11.0})))


def attribute_rows(run="r", **changes):
    rows = {(m, k): v for m in MODELS for k, v in [
        ("winner_name", "Ridge"), ("feature_contract_version", FEATURE_CONTRACT_VERSION), ("dataset_fingerprint", "7-1")]}
    rows |= {tuple(k.split("__")): v for k, v in changes.items()}
    return [(run, m, k, v) for (m, k), v in rows.items()]


def ledger_row(run="r", quality_status="PASSED", smoke="PASSED", at="2026-01-01", policy="p"):
    return (run, at, policy, quality_status, smoke)


def frames(spark, ledger, attributes):
    return (spark.createDataFrame(ledger, "run_id string, published_at string, policy_version string, quality_status string, smoke_status string"),
            spark.createDataFrame(attributes, "run_id string, model string, key string, value string"))


def test_newest_passed_run_is_served(spark):
    ledger, attributes = frames(spark, [ledger_row("a"), ledger_row("b", at="2026-02-01"), ledger_row("c", "FAILED", at="2026-03-01")],
                                [x for r in "abc" for x in attribute_rows(r)])
    assert quality.current_run(ledger, attributes) == "b"


@pytest.mark.parametrize("ledger, changes", [
    (ledger_row(quality_status="FAILED"), {}), (ledger_row(smoke="FAILED"), {}), (ledger_row(at=""), {}), (ledger_row(policy=None), {}),
    (ledger_row(), {"domain__feature_contract_version": "other"}), (ledger_row(), {"founded__dataset_fingerprint": "8-2"}),
    (ledger_row(), {"founded__dataset_fingerprint": ""}), (ledger_row(), {"price_category__winner_name": " "}),
])
def test_unfit_runs_are_refused(spark, ledger, changes):
    with pytest.raises(RuntimeError, match="No run passed"):
        quality.current_run(*frames(spark, [ledger], attribute_rows(**changes)))


def test_leaderboard(spark):
    rows = [(0, "base", "baseline", 0.9), (1, "x", "linear", 0.5), (2, "y", "bagging", 0.5), (3, "z", "boosting", 0.4)]
    scores = spark.createDataFrame([(*r[:3], f, r[3]) for r in rows for f in range(5)], "seq int, name string, family string, fold int, s double")
    board = {r.name: r for r in quality.leaderboard(scores, "s").collect()}
    assert board["base"].place == 1 and board["base"].winner == 0 and board["x"].winner == 1
    low = {r.name: r.winner for r in quality.leaderboard(scores, "s", higher_is_better=False).collect()}
    assert low["z"] == 1


def test_fingerprint_is_order_free(spark):
    df = spark.createDataFrame([("a", None), ("b", "x"), ("b", "x")], "k string, v string")
    one = quality.fingerprint_text(df, ["k", "v"])
    assert one == quality.fingerprint_text(df.orderBy(F.desc("k")).repartition(3), ["k", "v"])
    assert one != quality.fingerprint_text(df.fillna("x"), ["k", "v"])


GATE_GOOD = {("dataset", "rows_raw"): 10, ("dataset", "rows_prepared"): 10, ("domain_task", "rows_after_drop_rare_classes"): 10,
             ("domain_task", "n_classes_ge_5"): 2, ("founded_task", "rows_in_valid_range_1850_2025"): 2,
             ("price_category_task", "rows_after_drop_unknown_only"): 9, ("price_category_task", "min_known_label_support"): 5}


@pytest.mark.parametrize("key, value, rule", [
    (("schema", "missing_required_columns"), 1, "required_columns"), (("schema", "missing_canonical_columns"), 1, "canonical_columns"),
    (("dataset", "rows_raw"), 0, "raw_not_empty"), (("dataset", "rows_prepared"), 0, "prepared_not_empty"),
    (("dataset", "rows_gained_or_lost"), 1, "row_count_kept"), (("domain_task", "rows_after_drop_rare_classes"), 0, "domain_rows"),
    (("domain_task", "n_classes_ge_5"), 1, "domain_classes"), (("founded_task", "rows_in_valid_range_1850_2025"), 1, "founded_rows"),
    (("price_category_task", "rows_after_drop_unknown_only"), 0, "price_rows"),
    (("price_category_task", "n_unexpected_labels"), 2, "unexpected_labels"),
    (("price_category_task", "min_known_label_support"), 4, "label_support"), (None, None, None),
])
def test_data_gate_rules(spark, key, value, rule):
    values = {**GATE_GOOD, ("anomaly", "founded_missing"): 3}
    if key:
        values[key] = value
    df = spark.createDataFrame([(s, m, float(v)) for (s, m), v in values.items()], "section string, metric string, value double")
    failed = {r.rule for r in readiness.data_gate(df).filter("passed = 0 and severity = 'blocking'").collect()}
    assert failed == ({rule} if rule else set())
    if rule:
        with pytest.raises(RuntimeError, match=rule):
            readiness.require_data_gate(df)
    else:
        readiness.require_data_gate(df)  # the missing year is only a warning


def test_result_checks(spark):
    result = spark.createDataFrame([(1, "a", "d", 1900.0, "дисконт")], "row_id long, name string, pred_domain string, pred_founded double, pred_price_category string")
    source = spark.createDataFrame([(1, "a", None)], "row_id long, name string, domain string")
    assert checks.check_result(result, source).first().valid == 1
    with pytest.raises(ValueError, match="pred_domain"):
        checks.check_result(result.drop("pred_domain"), source)
    with pytest.raises(ValueError, match="pred_founded"):
        checks.check_result(result.drop("pred_founded"), source)
    by_name = checks.align_original(source.drop("row_id"), result.drop("row_id"))
    assert checks.filled_gaps(by_name).count() == 1
    twice = source.drop("row_id").union(source.drop("row_id"))
    with pytest.raises(ValueError, match="without doubt"):
        checks.align_original(twice, result.drop("row_id"))
