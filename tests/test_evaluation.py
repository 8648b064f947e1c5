import pytest
from pyspark.sql import functions as F

from brandlens.contract import KNOWN_PRICE_LABELS
from brandlens.operators import baselines, metrics, thresholds


def close(a, b):
    return a == pytest.approx(b, abs=1e-9)


def test_multiclass_by_hand(spark):
    pairs = [("a", "a"), ("a", "b"), ("b", "b"), ("c", "d")]
    m = metrics.multiclass_metrics(spark.createDataFrame(pairs, "y_true string, y_pred string")).first()
    # a: P 1 R .5 F 2/3; b: P .5 R 1 F 2/3; c: 0 0 0; d (predicted only): 0 0 0
    assert close(m.accuracy, 0.5) and close(m.balanced_accuracy, 0.5) and close(m.macro_f1, 1 / 3)
    assert close(m.macro_precision, 1.5 / 4) and close(m.weighted_f1, (2 * 2 / 3 + 2 / 3) / 4)


def test_confusion_cells_and_rows(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "c"), ("b", "c"), ("b", "a")], "y_true string, y_pred string")
    cells = {(r.y_true, r.y_pred): r.n for r in metrics.confusion_matrix(df).collect()}
    assert cells == {("a", "a"): 1, ("b", "c"): 2, ("b", "a"): 1}
    assert [tuple(r) for r in metrics.confusion_rows(df).collect()] == [("a", 1, 1, "a=1"), ("b", 3, 0, "a=1; c=2")]


def test_regression_by_hand(spark):
    df = spark.createDataFrame([(1900.0, 1800.0), (2000.0, 2010.0), (1950.0, 1950.0)], "y_true double, y_pred double")
    m = metrics.regression_metrics(df).first()  # 1800 is clipped to 1850: errors 50, 10, 0
    assert close(m.mae, 20) and close(m.rmse, (2600 / 3) ** 0.5) and close(m.median_absolute_error, 10)
    assert close(m.p90_absolute_error, 42) and close(m.r2, 1 - 2600 / 5000)


def flags(spark, rows):
    return spark.createDataFrame(rows, "y array<int>, p array<int>")


def test_multilabel_by_hand(spark):
    df = flags(spark, [([1, 0], [1, 1]), ([0, 1], [0, 0]), ([0, 0], [0, 0])])
    m = metrics.multilabel_metrics(df, 2).first()
    assert close(m.macro_f1, 0.5) and close(m.micro_f1, 0.5) and close(m.weighted_f1, 0.5)
    assert close(m.samples_f1, (2 / 3 + 0 + 0) / 3)


def test_thresholds_ties_and_constant_labels(spark):
    # Label 0: every threshold up to 0.6 separates; nearest to .5 wins. Label 1: one class only.
    rows = [([1, 0, 1, 0, 0], [0.62, 0.9, 0.1, 0.0, 0.0]), ([0, 0, 0, 1, 1], [0.1, 0.8, 0.9, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "y array<int>, prob array<double>")
    scores = thresholds.threshold_scores(df)
    best = {r.label_idx: r.threshold for r in thresholds.best_thresholds(scores).collect()}
    assert best[0] == 0.5 and best[1] == 0.5
    assert {r.label_idx: r.threshold for r in thresholds.first_best_thresholds(scores).collect()}[0] == 0.2
    # Label 3 never reaches a threshold: all scores are zero, so 0.5 is the nearest.
    assert best[3] == 0.5


def test_raw_grid_decides(spark):
    rows = [([1, 0, 0, 0, 0], [0.45, 0, 0, 0, 0]), ([0, 0, 0, 0, 0], [0.44999999999999990, 0, 0, 0, 0])]
    df = spark.createDataFrame([(y, [float(v) for v in p]) for y, p in rows], "y array<int>, prob array<double>")
    at = {r.threshold: r.f1 for r in thresholds.threshold_scores(df).filter("label_idx = 0").collect()}
    assert at[0.45] == 1.0 and at[0.4] == pytest.approx(2 / 3)


def test_fallback_takes_first_maximum(spark):
    df = spark.createDataFrame([([0.2, 0.3, 0.3],), ([0.6, 0.7, 0.1],)], "prob array<double>")
    got = [r.p for r in df.select(thresholds.decide(F.col("prob"), [0.5] * 3).alias("p")).collect()]
    assert got == [[0, 1, 0], [1, 1, 0]]


def test_threshold_contract():
    good = {x: 0.5 for x in KNOWN_PRICE_LABELS}
    thresholds.check_thresholds(KNOWN_PRICE_LABELS, good)
    for labels, limits in [(KNOWN_PRICE_LABELS[::-1], good), (KNOWN_PRICE_LABELS, {**good, "x": 0.1}),
                           (KNOWN_PRICE_LABELS, {**good, "средний": 1.5}), (KNOWN_PRICE_LABELS, {**good, "средний": "a"})]:
        with pytest.raises(ValueError):
            thresholds.check_thresholds(labels, limits)


def test_mode_baseline_ignores_its_own_fold(spark):
    rows = [(0, "a")] * 6 + [(0, "b")] + [(1, "b")] * 2 + [(2, "c")] * 2
    got = {r.fold: r for r in baselines.mode_baseline(spark.createDataFrame(rows, "fold int, y_true string")).collect()}
    assert got[0].predicted == "b" and got[0].macro_f1 == pytest.approx(2 / 8 / 2)  # labels a and b
    assert got[1].predicted == "a" and got[1].macro_f1 == 0


def test_median_baseline(spark):
    rows = [(0, 1900.0), (0, 1910.0), (1, 2000.0), (2, 1950.0)]
    got = {r.fold: (r.median, r.mae) for r in baselines.median_baseline(spark.createDataFrame(rows, "fold int, y_true double")).collect()}
    assert got[0] == (1975.0, 70.0) and got[1] == (1910.0, 90.0)


def test_label_baseline(spark):
    rows = [(0, [1, 0, 0, 0, 0]), (1, [0, 1, 0, 0, 0]), (1, [0, 1, 0, 0, 0]), (2, [1, 0, 0, 0, 0])]
    got = {r.fold: r.label_idx for r in baselines.label_baseline(spark.createDataFrame(rows, "fold int, y array<int>")).collect()}
    assert got == {0: 1, 1: 0, 2: 1}
