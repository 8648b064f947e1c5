"""Baselines fitted on the training folds only, from small per-fold counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from brandlens.contract import CV_FOLDS, KNOWN_PRICE_LABELS
from brandlens.operators import quantiles as Q
from brandlens.operators.metrics import ratio
from brandlens.sources.staging import staged


def mode_baseline(rows: DataFrame, target: str = "y_true", n_folds: int = CV_FOLDS) -> DataFrame:
    """(fold, predicted, macro_f1): most frequent class of the other folds, scored on the fold.

    Only counts per (fold, class) are used. A constant prediction has an F1 for its own class
    and zero for every other class of the fold.
    """
    counts = rows.groupBy("fold", F.col(target).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("label").agg(
        F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("fold", "n"))).alias("by_fold"))
    folds = F.array(*[F.lit(f) for f in range(n_folds)])
    outside = totals.select("label", "total", "by_fold", F.explode(folds).alias("fold")).withColumn(
        "inside", F.coalesce(F.try_element_at("by_fold", F.col("fold")), F.lit(0))
    ).withColumn("rest", F.col("total") - F.col("inside"))
    # First label in sorted order wins a tie: the largest count, then the smallest label.
    winners = outside.groupBy("fold").agg(
        F.max("rest").alias("best"), F.sum("inside").alias("rows"), F.count_if(F.col("inside") > 0).alias("classes"))
    chosen = (outside.join(winners, "fold").filter(F.col("rest") == F.col("best"))
              .groupBy("fold", "rows", "classes")
              .agg(F.min_by(F.struct("label", "inside"), "label").alias("top")))
    own_f1 = 2 * F.col("top.inside") / (F.col("rows") + F.col("top.inside"))
    n_labels = F.col("classes") + F.when(F.col("top.inside") == 0, 1).otherwise(0)
    return (chosen.filter("rows > 0")
            .select("fold", F.col("top.label").alias("predicted"), (own_f1 / n_labels).alias("macro_f1")))


def median_baseline(rows: DataFrame, target: str = "y_true", n_folds: int = CV_FOLDS) -> DataFrame:
    """(fold, median, mae): median of the other folds, mean absolute error on the fold."""
    freq = Q.value_frequencies(rows, {target: F.col(target)}, ["fold"])
    others = F.filter(F.array(*[F.lit(f) for f in range(n_folds)]), lambda f: f != F.col("fold"))
    # Every distinct value goes to the folds it trains for.
    training = (freq.withColumn("held", F.explode(others)).groupBy("held", "column", "value")
                .agg(F.sum("n").alias("n")))
    medians = Q.exact_quantiles(staged(training), [0.5], ["held"]).select(
        F.col("held").alias("fold"), F.col("q")[0].alias("median"))
    # One median per fold.
    scored = freq.join(F.broadcast(medians), "fold")
    return scored.groupBy("fold", "median").agg(
        (F.sum(F.abs(F.col("value") - F.col("median")) * F.col("n")) / F.sum("n")).alias("mae"))


def label_baseline(flags: DataFrame, names: Sequence[str] = KNOWN_PRICE_LABELS) -> DataFrame:
    """(fold, label_idx, macro_f1): the most frequent label of the other folds for every row."""
    n = len(names)
    sums = flags.groupBy("fold").agg(
        F.count(F.lit(1)).alias("rows"), F.array(*[F.sum(F.col("y")[i]) for i in range(n)]).alias("inside"))
    totals = sums.agg(F.array(*[F.sum(F.col("inside")[i]) for i in range(n)])).scalar()
    rest = F.zip_with(F.col("totals"), F.col("inside"), lambda t, x: t - x)
    return (sums.withColumn("totals", F.lit(totals)).withColumn("rest", rest)
            .withColumn("label_idx", (F.array_position("rest", F.array_max("rest")) - 1).cast("int"))
            .withColumn("hit", F.element_at("inside", F.col("label_idx") + 1))
            .select("fold", "label_idx", (ratio(2 * F.col("hit"), F.col("hit") + F.col("rows")) / n).alias("macro_f1")))


def holdout_label_baseline(flags: DataFrame, names: Sequence[str] = KNOWN_PRICE_LABELS) -> DataFrame:
    """Rows of the holdout with the most frequent development label predicted, as ``p``."""
    n = len(names)
    sums = flags.filter("split = 'development'").agg(F.array(*[F.sum(F.col("y")[i]) for i in range(n)]).alias("s"))
    top = sums.select(F.array_position("s", F.array_max("s")) - 1).scalar()
    one_hot = F.array(*[(F.col("_top") == i).cast("int") for i in range(n)])
    return (flags.filter("split = 'holdout'").withColumn("_top", F.lit(top))
            .withColumn("p", one_hot).drop("_top"))


def label_frequencies(flags: DataFrame, names: Sequence[str] = KNOWN_PRICE_LABELS) -> DataFrame:
    """Share of rows per label: the constant probabilities of the older baseline."""
    shares = flags.agg(*[F.avg(F.col("y")[i]).alias(f"p{i}") for i in range(len(names))])
    return shares.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("label_idx"), F.lit(label).alias("label"), F.col(f"p{i}").alias("probability"))
        for i, label in enumerate(names)])))


def fold_scores(per_fold: DataFrame, score: str) -> DataFrame:
    """Mean and population standard deviation of a score over the folds."""
    return per_fold.agg(F.avg(score).alias("cv_mean"), F.stddev_pop(score).alias("cv_std"))
