"""Evaluation metrics as aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from brandlens.contract import KNOWN_PRICE_LABELS
from brandlens.functions.numbers import clip
from brandlens.operators import quantiles as Q


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 for 0 / 0."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


# --- multiclass -------------------------------------------------------------

def confusion_counts(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(y_true, y_pred, n) for the pairs that occur."""
    return scored.groupBy(*keys, "y_true", "y_pred").agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """The cells of the matrix that are not zero, in order."""
    return confusion_counts(scored).orderBy("y_true", "y_pred")


def confusion_rows(scored: DataFrame) -> DataFrame:
    """One row per true class: its rows and hits, and all its predicted classes with their numbers.

    A row's list has at most as many entries as there are classes.
    """
    cell = F.concat_ws("=", F.col("y_pred"), F.col("n").cast("string"))
    return (confusion_counts(scored).groupBy("y_true")
            .agg(F.sum("n").alias("n_rows"), F.sum(F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0)).alias("n_hits"),
                 F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("y_pred", cell.alias("cell")))), lambda x: x["cell"]), "; ").alias("predicted"))
            .orderBy("y_true"))


def class_scores(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per label precision, recall, F1 and support from confusion counts."""
    hit = F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(F.lit(0))
    none = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("y_true").alias("label"), hit.cast("bigint").alias("tp"),
                 F.col("n").alias("support"), none.alias("predicted")),
        F.struct(F.col("y_pred").alias("label"), none.alias("tp"),
                 none.alias("support"), F.col("n").alias("predicted")),
    )
    per = counts.select(*keys, F.inline(sides)).groupBy(*keys, "label").agg(
        *[F.sum(c).alias(c) for c in ["tp", "support", "predicted"]])
    return per.select(
        *keys, "label", "tp", "support", "predicted",
        ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        ratio(F.col("tp"), F.col("support")).alias("recall"),
        ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"),
    )


def multiclass_summary(per_class: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Accuracy, balanced accuracy (classes in truth only), macro and weighted scores."""
    total = F.sum("support")
    return per_class.groupBy(*keys).agg(
        ratio(F.sum("tp"), total).alias("accuracy"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
        ratio(F.sum(F.col("precision") * F.col("support")), total).alias("weighted_precision"),
        ratio(F.sum(F.col("recall") * F.col("support")), total).alias("weighted_recall"),
        ratio(F.sum(F.col("f1") * F.col("support")), total).alias("weighted_f1"),
        total.alias("rows"),
    )


def multiclass_metrics(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return multiclass_summary(class_scores(confusion_counts(scored, keys), keys), keys)


def class_report(scored: DataFrame) -> DataFrame:
    """The per-class table followed by its accuracy, macro and weighted rows."""
    per = class_scores(confusion_counts(scored))
    whole = multiclass_summary(per)
    rows = F.col("rows").cast("double")
    acc = F.col("accuracy")

    def line(label: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(F.lit(label).alias("label"), precision.alias("precision"), recall.alias("recall"),
                        f1.alias("f1"), support.alias("support"))

    averages = whole.select(F.inline(F.array(
        line("accuracy", acc, acc, acc, acc),
        line("macro avg", F.col("macro_precision"), F.col("macro_recall"), F.col("macro_f1"), rows),
        line("weighted avg", F.col("weighted_precision"), F.col("weighted_recall"), F.col("weighted_f1"), rows),
    )))
    classes = per.select("label", "precision", "recall", "f1", F.col("support").cast("double").alias("support"))
    return classes.unionByName(averages)


# --- regression -------------------------------------------------------------

def regression_errors(scored: DataFrame) -> DataFrame:
    """Clipped prediction with absolute and signed error."""
    return (scored.withColumn("y_pred", clip(F.col("y_pred")))
            .withColumn("signed_error", F.col("y_pred") - F.col("y_true"))
            .withColumn("abs_error", F.abs("signed_error")))


def regression_metrics(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE, R2, median and 90th percentile of the absolute error."""
    keys = list(keys)
    errors = regression_errors(scored)
    squared = F.sum(F.col("signed_error") * F.col("signed_error"))
    spread = F.count(F.lit(1)) * F.var_pop("y_true")
    r2 = F.when(spread > 0, 1 - squared / spread).otherwise(F.when(squared == 0, 1.0).otherwise(0.0))
    base = errors.withColumn("column", F.lit("abs_error")).groupBy(*keys, "column").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("abs_error").alias("mae"),
        F.sqrt(squared / F.count(F.lit(1))).alias("rmse"), r2.alias("r2"))
    freq = Q.value_frequencies(errors, {"abs_error": F.col("abs_error")}, keys)
    q = Q.exact_quantiles(freq, [0.5, 0.9], [*keys, "column"])
    return base.join(q, [*keys, "column"]).select(
        *keys, "rows", "mae", "rmse", "r2", F.col("q")[0].alias("median_absolute_error"),
        F.col("q")[1].alias("p90_absolute_error"))


def worst_predictions(scored: DataFrame, row_id: str = "row_id", n: int = 200) -> DataFrame:
    return (regression_errors(scored).select(row_id, "y_true", "y_pred", "abs_error", "signed_error")
            .orderBy(F.desc("abs_error"), row_id).limit(n))


# --- multilabel -------------------------------------------------------------

def _per_label(i: int) -> dict[str, Column]:
    y, p = F.col("y")[i], F.col("p")[i]
    return {f"tp{i}": F.sum(y * p), f"fp{i}": F.sum((1 - y) * p), f"fn{i}": F.sum(y * (1 - p))}


def _label_counts(flags: DataFrame, n: int, keys: Sequence[str]) -> DataFrame:
    """All label counts and the row-wise F1 in one pass over the 0/1 arrays y and p."""
    sums = {name: c for i in range(n) for name, c in _per_label(i).items()}
    both = F.aggregate(F.zip_with("y", "p", lambda a, b: a * b), F.lit(0), lambda s, x: s + x)
    either = (F.aggregate("y", F.lit(0), lambda s, x: s + x) + F.aggregate("p", F.lit(0), lambda s, x: s + x))
    return flags.groupBy(*keys).agg(*[c.alias(name) for name, c in sums.items()],
                                    F.avg(ratio(2 * both, either)).alias("samples_f1"),
                                    F.count(F.lit(1)).alias("rows"))


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return ratio(2 * tp, 2 * tp + fp + fn)


def multilabel_metrics(flags: DataFrame, n: int = len(KNOWN_PRICE_LABELS), keys: Sequence[str] = ()) -> DataFrame:
    """Macro, micro, weighted and samples F1 of 0/1 arrays ``y`` (truth) and ``p`` (prediction)."""
    def c(kind: str, i: int) -> Column:
        return F.col(f"{kind}{i}")

    def total(kind: str) -> Column:
        return sum((c(kind, i) for i in range(1, n)), c(kind, 0))

    f1 = [_f1(c("tp", i), c("fp", i), c("fn", i)) for i in range(n)]
    support = [c("tp", i) + c("fn", i) for i in range(n)]
    weighted = sum((f1[i] * support[i] for i in range(1, n)), f1[0] * support[0])
    return _label_counts(flags, n, keys).select(
        *keys,
        (sum(f1[1:], f1[0]) / n).alias("macro_f1"),
        _f1(total("tp"), total("fp"), total("fn")).alias("micro_f1"),
        ratio(weighted, sum(support[1:], support[0])).alias("weighted_f1"),
        "samples_f1", "rows",
    )


def multilabel_report(flags: DataFrame, names: Sequence[str] = KNOWN_PRICE_LABELS) -> DataFrame:
    """Precision, recall, F1 and support per label."""
    lines = []
    for i, label in enumerate(names):
        tp, fp, fn = F.col(f"tp{i}"), F.col(f"fp{i}"), F.col(f"fn{i}")
        lines.append(F.struct(
            F.lit(i).alias("label_idx"), F.lit(label).alias("label"), ratio(tp, tp + fp).alias("precision"),
            ratio(tp, tp + fn).alias("recall"), _f1(tp, fp, fn).alias("f1"), (tp + fn).alias("support")))
    return _label_counts(flags, len(names), ()).select(F.inline(F.array(*lines)))


def label_supports(flags: DataFrame, keys: Sequence[str], names: Sequence[str] = KNOWN_PRICE_LABELS) -> DataFrame:
    """Positive rows per key (split) and label."""
    sums = flags.groupBy(*keys).agg(*[F.sum(F.col("y")[i]).alias(f"s{i}") for i in range(len(names))])
    return sums.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(i).alias("label_idx"), F.lit(label).alias("label"), F.col(f"s{i}").alias("support"))
        for i, label in enumerate(names)])))
