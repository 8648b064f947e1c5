"""Scored tables derived from the brand table: what the evaluation operators work on.

Predictions are the truth with hash-driven errors, so they grow with the data and are the same
on every engine. Folds and runs are row_id modulo 5.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brandlens.contract import (
    CV_FOLDS, FEATURE_CONTRACT_VERSION, KNOWN_PRICE_LABELS, MODELS, POLICY_VERSION, SAFE_FEATURES, CANONICAL_COLUMNS,
)
from brandlens.functions import labels
from brandlens.functions.numbers import clip, round_half_even, unit_hash
from brandlens.operators import baselines as B, metrics as M, quality as QA
from brandlens.operators.checks import FLAG_COLUMNS, PROBABILITY_COLUMNS
from brandlens.operators.prepare import domain_rows, founded_rows, price_rows
from brandlens.operators.readiness import union_all
from brandlens.operators.thresholds import decide, decide_direct
from brandlens.plans import oracle as O
from brandlens.plans.registry import brands, prepared, table
from brandlens.sources.staging import staged

N = len(KNOWN_PRICE_LABELS)


def fold_of_row() -> Column:
    return (F.col("row_id") % CV_FOLDS).cast("int")


def u(tag: str) -> Column:
    return unit_hash(F.concat_ws("|", F.col("row_id"), F.lit(tag)))


def noisy_class(noise: Column) -> Column:
    x = u("class")
    other = F.concat(F.lit("Brand#"), (F.col("row_id") % 25 + 1).cast("string"))
    return F.when(x < noise, other).when(x < noise + 0.05, F.lit("Brand#99")).otherwise(F.col("domain"))


def scored_class(spark: SparkSession, sf: str) -> DataFrame:
    rows = domain_rows(prepared(spark, sf).select("row_id", "domain"))
    return rows.select("row_id", fold_of_row().alias("fold"), F.col("domain").alias("y_true"),
                       noisy_class(F.lit(0.3)).alias("y_pred"))


def scored_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Four candidates with different noise, the first a baseline with one constant class."""
    rows = domain_rows(prepared(spark, sf).select("row_id", "domain"))
    options = F.array(*[
        F.struct(F.lit(i).alias("seq"), F.lit(name).alias("name"), F.lit(family).alias("family"),
                 (F.lit("Brand#1") if noise is None else noisy_class(F.lit(noise))).alias("y_pred"))
        for i, (name, family, noise) in enumerate(CANDIDATES)])
    return rows.select("row_id", fold_of_row().alias("fold"), F.col("domain").alias("y_true"), F.inline(options))


CANDIDATES = [("constant", "baseline", None), ("noise_40", "linear", 0.4), ("noise_20", "bagging", 0.2),
              ("noise_20_again", "boosting", 0.2)]


def scored_reg(spark: SparkSession, sf: str) -> DataFrame:
    rows = founded_rows(prepared(spark, sf).select("row_id", "founded"))
    return rows.select("row_id", fold_of_row().alias("fold"), F.col("founded").alias("y_true"),
                       (F.col("founded") + (u("year") - 0.5) * 40).alias("y_pred"))


def scored_multi(spark: SparkSession, sf: str) -> DataFrame:
    """Arrays ``y`` and ``prob`` in label order."""
    rows = price_rows(prepared(spark, sf).select("row_id", "price_category"))
    flags = rows.select("row_id", fold_of_row().alias("fold"), labels.indicators(F.col("labels")).alias("y"))
    prob = F.array(*[F.col("y")[i] * F.lit(0.35) + u(f"price{i}") * F.lit(0.65) for i in range(N)])
    return flags.withColumn("prob", prob)


def serving(multi: DataFrame) -> DataFrame:
    return multi.withColumn("p", decide(F.col("prob"), [0.5] * N))


def direct(multi: DataFrame) -> DataFrame:
    return multi.withColumn("p", decide_direct(F.col("prob")))


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """A scoring result with gaps and faults in it."""
    k = F.col("row_id")
    base = brands(spark, sf).select("row_id", "name", "domain").withColumns({
        "pred_domain": F.when(k % 50 == 0, F.lit(None)).when(k % 50 == 1, F.lit("nan"))
        .otherwise(F.concat(F.lit("Brand#"), (k % 25 + 1).cast("string"))),
        "pred_founded": F.when(k % 40 != 0, u("founded") * 180 + 1850),
        "prob": F.array(*[u(f"prob{i}") for i in range(N)]),
    })
    base = base.withColumn("p", decide(F.col("prob"), [0.5] * N)).withColumns({
        "pred_founded_rounded": round_half_even(clip(F.col("pred_founded"))),
        "pred_price_category": F.when(k % 60 != 0, labels.indicators_text(F.col("p"))),
        **{c: F.col("prob")[i] for i, c in enumerate(PROBABILITY_COLUMNS)},
    }).withColumns({c: F.col("p")[i] for i, c in enumerate(FLAG_COLUMNS)})
    return base.drop("prob", "p")


def predictions_again(spark: SparkSession, sf: str) -> DataFrame:
    """The same result with a few years moved."""
    moved = F.when(F.col("row_id") % 100 == 3, F.col("pred_founded") + 0.5).otherwise(F.col("pred_founded"))
    return predictions(spark, sf).withColumn("pred_founded", moved)


# --- run tables -------------------------------------------------------------

def _rest(per_fold: DataFrame, columns: list[str]) -> DataFrame:
    """Per run the mean and spread of fold scores over the other folds; five rows."""
    others = F.filter(F.array(*[F.lit(f) for f in range(CV_FOLDS)]), lambda f: f != F.col("fold"))
    return (per_fold.select(F.explode(others).alias("run_id"), *columns).groupBy("run_id")
            .agg(*[F.avg(c).alias(f"cv_{c}") for c in columns], *[F.stddev_pop(c).alias(f"std_{c}") for c in columns]))


def _long(df: DataFrame, model: str, metrics: dict[str, Column]) -> DataFrame:
    return df.select(F.col("run_id").cast("string").alias("run_id"), F.inline(F.array(*[
        F.struct(F.lit(model).alias("model"), F.lit(name).alias("metric"), c.cast("double").alias("value"))
        for name, c in metrics.items()])))


def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """(run_id, model, metric, value): each fold once as holdout, the others as validation."""
    c = F.col
    # Each scored table is read several times, so it is written once.
    classes, years, multi = (staged(f(spark, sf)) for f in (scored_class, scored_reg, scored_multi))
    base = B.mode_baseline(classes).select("fold", c("macro_f1").alias("base"))
    domain = M.multiclass_metrics(classes, ["fold"]).join(base, "fold")
    domain = staged(domain)
    domain = domain.withColumn("run_id", c("fold")).join(_rest(domain, ["macro_f1", "base"]), "run_id")
    out = [_long(domain, "domain", {
        "cv_best_macro_f1": c("cv_macro_f1"), "cv_std_macro_f1": c("std_macro_f1"), "baseline_cv_macro_f1": c("cv_base"),
        "cv_uplift_over_baseline": c("cv_macro_f1") - c("cv_base"), "holdout_accuracy": c("accuracy"),
        "holdout_balanced_accuracy": c("balanced_accuracy"), "holdout_macro_f1": c("macro_f1"),
        "holdout_weighted_f1": c("weighted_f1"), "generalization_gap_macro_f1": c("macro_f1") - c("cv_macro_f1")})]

    base = B.median_baseline(years).select("fold", c("mae").alias("base"))
    reg = M.regression_metrics(years, ["fold"]).join(base, "fold")
    reg = staged(reg)
    reg = reg.withColumn("run_id", c("fold")).join(_rest(reg, ["mae", "base"]), "run_id")
    out.append(_long(reg, "founded", {
        "cv_best_mae": c("cv_mae"), "cv_std_mae": c("std_mae"), "baseline_cv_mae": c("cv_base"),
        "cv_mae_improvement_over_baseline_abs": c("cv_base") - c("cv_mae"),
        "cv_mae_improvement_over_baseline_pct": QA.improvement(c("cv_mae"), c("cv_base")),
        "holdout_mae": c("mae"), "holdout_rmse": c("rmse"), "holdout_r2": c("r2"),
        "holdout_median_absolute_error": c("median_absolute_error"),
        "holdout_p90_absolute_error": c("p90_absolute_error"), "generalization_gap_mae": c("mae") - c("cv_mae")}))

    names = ["macro_f1", "micro_f1", "weighted_f1", "samples_f1"]
    serve = M.multilabel_metrics(serving(multi), keys=["fold"]).select("fold", *names)
    plain = M.multilabel_metrics(direct(multi), keys=["fold"]).select(
        "fold", c("macro_f1").alias("direct_macro"), c("micro_f1").alias("direct_micro"))
    base = B.label_baseline(multi).select("fold", c("macro_f1").alias("base"))
    price = serve.join(plain, "fold").join(base, "fold")
    price = staged(price)
    price = price.withColumn("run_id", c("fold")).join(_rest(price, ["macro_f1", "micro_f1", "direct_macro", "base"]), "run_id")
    out.append(_long(price, "price_category", {
        "cv_best_macro_f1": c("cv_direct_macro"), "cv_std_macro_f1": c("std_direct_macro"),
        "cv_uplift_over_baseline": c("cv_direct_macro") - c("cv_base"),
        "oof_selected_macro_f1": c("cv_macro_f1"), "oof_selected_micro_f1": c("cv_micro_f1"),
        "holdout_direct_macro_f1": c("direct_macro"), "holdout_direct_micro_f1": c("direct_micro"),
        "holdout_serving_macro_f1": c("macro_f1"), "holdout_serving_micro_f1": c("micro_f1"),
        "holdout_serving_weighted_f1": c("weighted_f1"), "holdout_serving_samples_f1": c("samples_f1"),
        # The price gap compares with the out-of-fold score of the chosen thresholds.
        "generalization_gap_macro_f1": c("macro_f1") - c("cv_macro_f1")}))
    return union_all(*out)


def _attribute_values() -> list[tuple[str, str, str]]:
    """(model, key, SQL value); null drops the line. Single runs carry faults on purpose."""
    metric = {"domain": "cv_best_macro_f1", "founded": "cv_best_mae", "price_category": "cv_best_macro_f1"}
    columns = ",".join(SAFE_FEATURES)
    lines = []
    for model in MODELS:
        digest = "concat(n_rows, '-', digest)"
        version = f"'{FEATURE_CONTRACT_VERSION}'"
        lines += [
            (model, "target", f"'{model}'"), (model, "selection_metric", f"'{metric[model]}'"),
            (model, "winner_name", "case when run <> 3 then 'Ridge' end" if model == "domain" else "'Forest'"),
            (model, "winner", "'Linear'"),
            (model, "dataset_fingerprint", f"case when run = 1 then '' else {digest} end" if model == "founded" else digest),
            (model, "feature_contract_version", f"case when run = 2 then 'old' else {version} end" if model == "price_category" else version),
            (model, "feature_columns", f"case when run = 4 then '{columns},founded' else '{columns}' end" if model == "domain" else f"'{columns}'"),
        ]
    lines.append(("price_category", "threshold_calibration", "case when run <> 4 then 'development_oof_cv' else 'in_sample' end"))
    return lines


ATTRIBUTES = _attribute_values()


def attributes(spark: SparkSession, sf: str) -> DataFrame:
    rows = brands(spark, sf).withColumn("run", fold_of_row())
    prints = QA.fingerprint(rows, CANONICAL_COLUMNS, ["run"])
    return prints.select(F.col("run").cast("string").alias("run_id"), F.inline(F.array(*[
        F.struct(F.lit(m).alias("model"), F.lit(k).alias("key"), F.expr(v).cast("string").alias("value"))
        for m, k, v in ATTRIBUTES]))).filter("value is not null")


_LEDGER = ("cast({run} as varchar(20)) as run_id, cast(cast(max(o_orderdate) as date) as varchar(20)) as published_at, "
           f"'{POLICY_VERSION}' as policy_version, case when {{run}} = 1 then 'FAILED' else 'PASSED' end as quality_status, "
           "case when {run} = 3 then 'passed' else 'PASSED' end as smoke_status")


def ledger(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql("select " + _LEDGER.format(run="run") + " from (select *, cast(o_orderkey % 5 as int) as run from {orders}) "
                     "group by run", orders=table(spark, sf, "orders"))


# --- the same tables in oracle SQL ------------------------------------------

def _noisy(noise: str) -> str:
    return (f"case when {O.unit(O.keyed('row_id', 'class'))} < {noise} then concat('Brand#', row_id % 25 + 1) "
            f"when {O.unit(O.keyed('row_id', 'class'))} < {noise} + 0.05::double then 'Brand#99' else domain end")


def _probs(tag: str) -> str:
    return "[" + ", ".join(O.unit(O.keyed("row_id", f"{tag}{i}")) for i in range(N)) + "]"


def sql_decide(probs: str, limits: str) -> str:
    flags = f"list_transform({probs}, lambda q, i: (q >= {limits}[i])::int)"
    top = f"list_transform({probs}, lambda q, i: (i = list_position({probs}, list_max({probs})))::int)"
    return f"case when list_contains({flags}, 1) then {flags} else {top} end"


_HALF = "[0.5::double, 0.5::double, 0.5::double, 0.5::double, 0.5::double]"
_LABELS = "[" + O.texts(KNOWN_PRICE_LABELS) + "]"
_MULTI_STATS = """
select {keys} label_idx, sum(y * p) as tp, sum((1 - y) * p) as fp, sum(y * (1 - p)) as fn
from (select {keys} row_id, unnest(range(0, 5)) as label_idx, unnest(y) as y, unnest(p) as p from {src}) group by all"""
_MULTI_ROWS = "list_sum(list_transform(y, lambda a, i: a * p[i])) as both_n, list_sum(y) + list_sum(p) as either_n"


def sql_multi(src: str, keys: str = "") -> str:
    """Multilabel metrics of a table with lists y and p."""
    k = keys + ", " if keys else ""
    stats = _MULTI_STATS.format(keys=k, src=src)
    f1 = "case when 2 * tp + fp + fn = 0 then 0.0::double else 2 * tp / (2 * tp + fp + fn)::double end"
    labels_part = (f"select {k} sum({f1}) / 5 as macro_f1, coalesce(2 * sum(tp) / nullif(2 * sum(tp) + sum(fp) + sum(fn), 0)::double, 0) as micro_f1, "
                   f"coalesce(sum({f1} * (tp + fn)) / nullif(sum(tp + fn), 0)::double, 0) as weighted_f1 from ({stats}) {'group by all' if keys else ''}")
    rows_part = (f"select {k} avg(case when either_n = 0 then 0.0::double else 2 * both_n / either_n::double end) as samples_f1, count(*) as rows "
                 f"from (select {k} {_MULTI_ROWS} from {src}) {'group by all' if keys else ''}")
    join = f"join ({rows_part}) using ({keys})" if keys else f"cross join ({rows_part})"
    return f"select {k} macro_f1, micro_f1, weighted_f1, samples_f1, rows from ({labels_part}) {join}"


def sql_class(src: str, keys: str = "") -> str:
    """Multiclass metrics per key of a table with y_true and y_pred."""
    k = keys + ", " if keys else ""
    sides = (f"select {k} y_true as label, (y_true = y_pred)::int as tp, 1 as support, 0 as predicted from {src} union all "
             f"select {k} y_pred, 0, 0, 1 from {src}")
    per = (f"select {k} label, sum(tp) as tp, sum(support) as support, sum(predicted) as predicted from ({sides}) group by all")
    scored = (f"select *, coalesce(tp / nullif(predicted, 0)::double, 0) as prec, coalesce(tp / nullif(support, 0)::double, 0) as rec, "
              f"coalesce(2 * tp / nullif(support + predicted, 0)::double, 0) as f1 from ({per})")
    return (f"select {k} sum(tp) / sum(support)::double as accuracy, avg(rec) filter (support > 0) as balanced_accuracy, "
            f"avg(prec) as macro_precision, avg(rec) as macro_recall, avg(f1) as macro_f1, "
            f"sum(prec * support) / sum(support)::double as weighted_precision, sum(rec * support) / sum(support)::double as weighted_recall, "
            f"sum(f1 * support) / sum(support)::double as weighted_f1, sum(support)::bigint as rows from ({scored}) {'group by all' if keys else ''}")


def sql_reg(src: str, keys: str = "") -> str:
    k = keys + ", " if keys else ""
    error = f"({O.inside('y_pred', 1850, 2025)} - y_true)"
    return (f"select {k} count(*) as rows, avg(abs(e)) as mae, sqrt(avg(e * e)) as rmse, 1 - sum(e * e) / (count(*) * var_pop(y_true)) as r2, "
            f"quantile_cont(abs(e), 0.5) as median_absolute_error, quantile_cont(abs(e), 0.9) as p90_absolute_error "
            f"from (select {k} y_true, {error} as e from {src}) {'group by all' if keys else ''}")


_PRED_WIDE = ", ".join([*(f"prob[{i + 1}] as \"{c}\"" for i, c in enumerate(PROBABILITY_COLUMNS)),
                        *(f"p[{i + 1}] as \"{c}\"" for i, c in enumerate(FLAG_COLUMNS))])

O.CTES.update({
    "scored_class": f"select row_id, (row_id % 5)::int as fold, domain as y_true, {_noisy('0.3::double')} as y_pred from domain_rows",
    "scored_candidates": " union all ".join(
        f"select row_id, (row_id % 5)::int as fold, domain as y_true, {i} as seq, '{name}' as name, '{family}' as family, "
        + ("'Brand#1'" if noise is None else _noisy(f"{noise}::double")) + " as y_pred from domain_rows"
        for i, (name, family, noise) in enumerate(CANDIDATES)),
    "scored_reg": f"select row_id, (row_id % 5)::int as fold, founded as y_true, founded + ({O.unit(O.keyed('row_id', 'year'))} - 0.5::double) * 40 as y_pred from founded_rows",
    "multi_y": f"select row_id, (row_id % 5)::int as fold, list_transform({_LABELS}, lambda l: list_contains(labels, l)::int) as y from price_rows",
    "multi_u": f"select row_id, fold, y, {_probs('price')} as us from multi_y",
    "scored_multi": "select row_id, fold, y, list_transform(us, lambda x, i: y[i] * 0.35::double + x * 0.65::double) as prob from multi_u",
    "multi_serving": f"select row_id, fold, y, {sql_decide('prob', _HALF)} as p from scored_multi",
    "multi_direct": "select row_id, fold, y, list_transform(prob, lambda q: (q > 0.5)::int) as p from scored_multi",
    "pred_base": f"select row_id, name, domain, case when row_id % 50 = 0 then null when row_id % 50 = 1 then 'nan' else concat('Brand#', row_id % 25 + 1) end as pred_domain, "
                 f"case when row_id % 40 <> 0 then {O.unit(O.keyed('row_id', 'founded'))} * 180 + 1850 end as pred_founded, {_probs('prob')} as prob from brands",
    "pred_decided": f"select *, {sql_decide('prob', _HALF)} as p from pred_base",
    "predictions": f"select row_id, name, domain, pred_domain, pred_founded, case when pred_founded is not null then round_even({O.inside('pred_founded', 1850, 2025)}, 0)::int end as pred_founded_rounded, "
                   f"case when row_id % 60 <> 0 then array_to_string(list_filter({_LABELS}, lambda l, i: p[i] = 1), '; ') end as pred_price_category, {_PRED_WIDE} from pred_decided",
})
