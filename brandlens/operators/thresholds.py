"""Per-label decision thresholds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from brandlens.contract import KNOWN_PRICE_LABELS, THRESHOLD_GRID
from brandlens.operators.literal import unpivot_row
from brandlens.operators.metrics import multilabel_metrics, ratio


def threshold_scores(scored: DataFrame, names: Sequence[str] = KNOWN_PRICE_LABELS,
                     grid: Sequence[float] = THRESHOLD_GRID, keys: Sequence[str] = ()) -> DataFrame:
    """F1 of every label at every grid threshold, from arrays ``y`` and ``prob``.

    A probability counts only by how many thresholds it reaches, so one aggregate by (label,
    number reached) replaces a join with the grid.
    """
    keys = list(keys)
    reached = sum(((F.col("prob") >= F.lit(t)).cast("int") for t in grid[1:]),
                  (F.col("prob") >= F.lit(grid[0])).cast("int"))
    cells = F.array(*[F.struct(F.lit(i).alias("label_idx"), F.col("y")[i].alias("y"),
                               F.col("prob")[i].alias("prob")) for i in range(len(names))])
    counted = (scored.select(*keys, F.inline(cells))
               .groupBy(*keys, "label_idx", reached.alias("reached"))
               .agg(F.sum("y").alias("pos"), F.count(F.lit(1)).alias("n")))
    # At most len(grid) + 1 entries per label.
    per_label = counted.groupBy(*keys, "label_idx").agg(
        F.sum("pos").alias("positives"), F.sum("n").alias("rows"),
        F.collect_list(F.struct("reached", "pos", "n")).alias("steps"))

    def at_least(i: int, field: str) -> Column:
        return F.aggregate(F.filter("steps", lambda s: s["reached"] > i), F.lit(0).cast("bigint"),
                           lambda acc, s: acc + s[field])

    options = F.array(*[
        F.struct(F.lit(t).alias("threshold_raw"), F.lit(round(t, 2)).alias("threshold"),
                 at_least(i, "pos").alias("tp"), at_least(i, "n").alias("predicted"))
        for i, t in enumerate(grid)])
    label = F.array(*[F.lit(x) for x in names])[F.col("label_idx")]
    return (per_label.select(*keys, "label_idx", label.alias("label"), "positives", "rows", F.inline(options))
            .withColumn("f1", ratio(2 * F.col("tp"), F.col("predicted") + F.col("positives"))))


def best_thresholds(scores: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The threshold with the best F1; ties go to the one nearer 0.5, then to the larger one.
    A label without both classes gets 0.5."""
    order = F.struct("f1", -F.abs(F.col("threshold_raw") - 0.5), "threshold")
    return (scores.groupBy(*keys, "label_idx", "label")
            .agg(F.max_by("threshold", order).alias("best"), F.max("f1").alias("f1"),
                 F.max("positives").alias("positives"), F.max("rows").alias("rows"))
            .select(*keys, "label_idx", "label",
                    F.when((F.col("positives") == 0) | (F.col("positives") == F.col("rows")), 0.5)
                    .otherwise(F.col("best")).alias("threshold"), "f1"))


def first_best_thresholds(scores: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Older rule: the smallest threshold among the best."""
    return (scores.groupBy(*keys, "label_idx", "label")
            .agg(F.max_by("threshold", F.struct("f1", -F.col("threshold_raw"))).alias("threshold"),
                 F.max("f1").alias("f1")))


def check_thresholds(labels: Sequence[str], thresholds: dict[str, float]) -> None:
    """Labels are the contract's, in order; keys match; values lie in [0, 1]."""
    if list(labels) != KNOWN_PRICE_LABELS:
        raise ValueError(f"Price labels do not match the contract: {list(labels)}")
    if set(labels) != set(thresholds):
        raise ValueError("Price labels and threshold keys do not match.")
    for label, value in thresholds.items():
        if isinstance(value, bool) or not isinstance(value, (int, float)):
            raise ValueError(f"Threshold for {label!r} is not numeric.")
        if not 0.0 <= value <= 1.0:
            raise ValueError(f"Threshold for {label!r} is outside [0, 1]: {value}")


def threshold_contract(chosen: DataFrame) -> DataFrame:
    """(name, violations, passed) for a table (label_idx, label, threshold): the labels are the
    contract's, each once and at its place, and every threshold is a number in [0, 1]."""
    n = len(KNOWN_PRICE_LABELS)
    place = F.array_position(F.array(*[F.lit(x) for x in KNOWN_PRICE_LABELS]), F.col("label")) - 1
    value = F.col("threshold").cast("double")
    distinct = F.countDistinct(F.when(place >= 0, F.col("label")))
    violations = {
        "labels_known": F.count_if(~F.coalesce(place >= 0, F.lit(False))), "labels_complete": F.lit(n) - distinct,
        "labels_once": F.count_if(place >= 0) - distinct,
        "labels_in_order": F.count_if(~F.coalesce(place == F.col("label_idx"), F.lit(False))),
        "thresholds_in_range": F.count_if(~F.coalesce(~F.isnan(value) & value.between(0.0, 1.0), F.lit(False)))}
    counts = chosen.agg(*[c.alias(name) for name, c in violations.items()])
    return (unpivot_row(counts, list(violations), name="name", value="violations").withColumn("violations", F.col("violations").cast("bigint"))
            .withColumn("passed", (F.col("violations") == 0).cast("int")))


def argmax(probabilities: Column) -> Column:
    """Zero-based position of the first maximum."""
    return (F.array_position(probabilities, F.array_max(probabilities)) - 1).cast("int")


def decide(probabilities: Column, thresholds: Sequence[float]) -> Column:
    """0/1 array: probability >= threshold; a row without any label gets its most likely one."""
    flags = F.array(*[(probabilities[i] >= F.lit(float(t))).cast("int") for i, t in enumerate(thresholds)])
    top = argmax(probabilities)
    only_top = F.array(*[(top == i).cast("int") for i in range(len(thresholds))])
    return F.when(F.array_contains(flags, 1), flags).otherwise(only_top)


def decide_by_table(scored: DataFrame, chosen: DataFrame, n: int = len(KNOWN_PRICE_LABELS),
                    keys: Sequence[str] = ()) -> DataFrame:
    """Apply thresholds held in a table (keys, label_idx, threshold); adds ``p``.

    The table has one row per label (and fold). Without keys its ordered array is one subquery
    value, with keys it is broadcast.
    """
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("label_idx", "threshold"))), lambda x: x["threshold"])
    limits = chosen.groupBy(*keys).agg(ordered.alias("_limits"))
    with_limits = (scored.join(F.broadcast(limits), list(keys)) if keys
                   else scored.withColumn("_limits", F.lit(limits.scalar())))
    flags = F.array(*[(F.col("prob")[i] >= F.col("_limits")[i]).cast("int") for i in range(n)])
    top = F.array(*[(argmax(F.col("prob")) == i).cast("int") for i in range(n)])
    return (with_limits.withColumn("p", F.when(F.array_contains(flags, 1), flags).otherwise(top))
            .drop("_limits"))


def decide_direct(probabilities: Column, n: int = len(KNOWN_PRICE_LABELS)) -> Column:
    """The model's own decision: probability above one half, no fallback."""
    return F.array(*[(probabilities[i] > 0.5).cast("int") for i in range(n)])


def choose_strategy(scored: DataFrame, chosen: DataFrame) -> DataFrame:
    """One row per strategy with its metrics and which is selected: the optimized thresholds if
    their macro F1 is at least that of 0.5 everywhere."""
    n = len(KNOWN_PRICE_LABELS)
    optimized = multilabel_metrics(decide_by_table(scored, chosen)).withColumn("strategy", F.lit("oof_per_label_optimized"))
    default = multilabel_metrics(scored.withColumn("p", decide(F.col("prob"), [0.5] * n))).withColumn(
        "strategy", F.lit("default_0.5"))
    both = optimized.unionByName(default)
    # Two rows: the larger macro F1 wins, the optimized one on a tie.
    best = both.agg(F.max_by("strategy", F.struct("macro_f1", "strategy"))).scalar()
    return both.withColumn("selected", (F.col("strategy") == best).cast("int"))


def probability_shape(scored: DataFrame) -> DataFrame:
    """Per label position: rows, probabilities outside 0 to 1 (null included), least and greatest."""
    p = F.col("p")
    return (scored.select(F.posexplode("prob").alias("label_idx", "p")).groupBy("label_idx")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(p.isNull() | ~p.between(0, 1)).alias("n_outside"),
                 F.min("p").alias("least"), F.max("p").alias("most")))
