"""Queries for splits, metrics, baselines, thresholds and model selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from brandlens.contract import KNOWN_PRICE_LABELS, OLD_THRESHOLD_GRID, THRESHOLD_GRID
from brandlens.functions import labels
from brandlens.operators import baselines as B, metrics as M, quality as QA, split, thresholds as H
from brandlens.operators.prepare import domain_rows, founded_rows, price_rows
from brandlens.plans import oracle as O, scored as S
from brandlens.plans.registry import prepared, query, rounded, table
from brandlens.sources.staging import staged

N = len(KNOWN_PRICE_LABELS)


def col(name):
    return F.col(name)


def r6(names):
    return ", ".join(f"round({n}, 6) as {n}" for n in names)


O.CTES["label_sizes"] = "select row_id, len(labels)::int as n_labels from price_rows"


# --- splits -----------------------------------------------------------------

def _order(tag):
    return f"{O.hash32(O.keyed('row_id', tag))}, row_id"


@query("w1_stratum_rank", O.sql(
    f"select row_id, domain, row_number() over (partition by domain order by {_order(42)}) as rank from prep"))
def stratum_rank(spark, sf):
    return split.stratum_rank(prepared(spark, sf).select("row_id", "domain"), ["domain"], "row_id")


_HOLDOUT = """
select row_id, {stratum} as stratum, case when rank <= holdout then 'holdout' else 'development' end as split
from (select *, row_number() over (partition by {stratum} order by {order}) as rank from {src}) join (
  select {stratum}, n - base - (row_number() over (order by rest desc, {stratum}) <= train - sum(base) over ())::int as holdout
  from (select *, (n * train) // total as base, (n * train) % total as rest from (
    select {stratum}, count(*) as n, (select count(*) from {src}) as total,
           (select count(*) - ceil(count(*) * 0.2::double)::bigint from {src}) as train from {src} group by 1))
) using ({stratum})"""


@query("m5_stratified_holdout", O.sql(_HOLDOUT.format(stratum="domain", src="domain_rows", order=_order(42))))
def stratified_holdout(spark, sf):
    rows = staged(domain_rows(prepared(spark, sf).select("row_id", "domain")))
    return split.add_holdout(rows, ["domain"]).select("row_id", col("domain").alias("stratum"), "split")


@query("m6_plain_holdout", O.sql(
    f"select row_id, case when row_number() over (order by {_order(42)}) <= ceil(count(*) over () * 0.2::double) then 'holdout' "
    f"else 'development' end as split from founded_rows"))
def plain_holdout(spark, sf):
    return split.add_holdout(staged(founded_rows(prepared(spark, sf).select("row_id", "founded")))).select("row_id", "split")


@query("m7_holdout_by_label_count", O.sql(_HOLDOUT.format(stratum="n_labels", src="label_sizes", order=_order(42))))
def holdout_by_size(spark, sf):
    rows = price_rows(prepared(spark, sf).select("row_id", "price_category")).withColumn("n_labels", F.size("labels"))
    return split.add_holdout(staged(rows), ["n_labels"]).select("row_id", col("n_labels").alias("stratum"), "split")


_FOLDS = ("(least(4, case when r < (n % 5) * (n // 5 + 1) then r // (n // 5 + 1) "
          "else (n % 5) + (r - (n % 5) * (n // 5 + 1)) // greatest(n // 5, 1) end))::int as fold")


@query("m8_stratified_folds", O.sql(
    f"select row_id, domain, {_FOLDS} from (select row_id, domain, row_number() over (partition by domain order by {_order('42|fold')}) - 1 as r, "
    f"count(*) over (partition by domain) as n from domain_rows)"))
def stratified_folds(spark, sf):
    rows = staged(domain_rows(prepared(spark, sf).select("row_id", "domain")))
    return split.add_folds(rows, ["domain"]).select("row_id", "domain", "fold")


@query("m8_plain_folds", O.sql(
    f"select row_id, {_FOLDS} from (select row_id, row_number() over (order by {_order('42|fold')}) - 1 as r, count(*) over () as n from founded_rows)"))
def plain_folds(spark, sf):
    return split.add_folds(staged(founded_rows(prepared(spark, sf).select("row_id", "founded")))).select("row_id", "fold")


@query("m8_folds_lineitem", (
    f"select row_id, l_returnflag, {_FOLDS} from (select row_id, l_returnflag, row_number() over (partition by l_returnflag order by {_order('42|fold')}) - 1 as r, "
    f"count(*) over (partition by l_returnflag) as n from (select l_orderkey * 10 + l_linenumber as row_id, l_returnflag from lineitem))"))
def lineitem_folds(spark, sf):
    """Three strata, each a third of all rows."""
    rows = table(spark, sf, "lineitem").select((col("l_orderkey") * 10 + col("l_linenumber")).alias("row_id"), "l_returnflag")
    return split.add_folds(rows, ["l_returnflag"])


@query("m12_multilabel_target", O.sql("select row_id, " + ", ".join(f"y[{i + 1}] as y{i}" for i in range(N)) + " from multi_y"))
def multilabel_target(spark, sf):
    rows = price_rows(prepared(spark, sf).select("row_id", "price_category"))
    y = labels.indicators(col("labels"))
    return rows.select("row_id", *[y[i].alias(f"y{i}") for i in range(N)])


_SIX = [*KNOWN_PRICE_LABELS, "неизвестно"]


@query("n5_six_label_target", O.sql("select row_id, " + ", ".join(
    f"list_contains(string_split(price_category, ';'), '{x}')::int as y{i}" for i, x in enumerate(_SIX)) + " from prep"))
def six_labels(spark, sf):
    y = labels.indicators(F.split("price_category", ";"), _SIX)
    return prepared(spark, sf).select("row_id", *[y[i].alias(f"y{i}") for i in range(6)])


# --- multiclass metrics -----------------------------------------------------

@query("e1_confusion_matrix", O.sql(
    "select y_true, y_pred, count(*) as n from scored_class group by 1, 2"))
def confusion_matrix(spark, sf):
    return M.confusion_matrix(S.scored_class(spark, sf))


@query("e1_confusion_wide", O.sql(
    "select y_true, sum(n)::bigint as n_rows, (coalesce(sum(n) filter (y_true = y_pred), 0))::bigint as n_hits, "
    "string_agg(y_pred || '=' || n, '; ' order by y_pred) as predicted "
    "from (select y_true, y_pred, count(*) as n from scored_class group by 1, 2) group by 1"))
def confusion_wide(spark, sf):
    """A row of the matrix for each true class, over all predicted classes."""
    return M.confusion_rows(S.scored_class(spark, sf))


@query("h6_probability_shape", O.sql(
    "select label_idx::int as label_idx, count(*) as n_rows, count(*) filter (p is null or not (p between 0 and 1)) as n_outside, "
    "round(min(p), 6) as least, round(max(p), 6) as most from (select unnest(range(0, 5)) as label_idx, unnest(prob) as p from scored_multi) group by 1"))
def probability_shape(spark, sf):
    """One probability between 0 and 1 for each label of each row."""
    return rounded(H.probability_shape(S.scored_multi(spark, sf)))



_DOC = "(select doc_id, quality::varchar as y_true, toxic::varchar as y_pred from labels)"


@query("e1_quality_against_toxic", f"select y_true, y_pred, count(*) as n from {_DOC} where y_true is not null group by 1, 2")
def quality_toxic(spark, sf):
    rows = table(spark, sf, "labels").select(col("quality").cast("string").alias("y_true"), col("toxic").cast("string").alias("y_pred"))
    return M.confusion_counts(rows.filter("y_true is not null"))


_PER = ("select label, coalesce(tp / nullif(predicted, 0)::double, 0) as precision, coalesce(tp / nullif(support, 0)::double, 0) as recall, "
        "coalesce(2 * tp / nullif(support + predicted, 0)::double, 0) as f1, support::double as support from ("
        "select label, sum(tp) as tp, sum(s) as support, sum(p) as predicted from (select y_true as label, (y_true = y_pred)::int as tp, 1 as s, 0 as p from scored_class "
        "union all select y_pred, 0, 0, 1 from scored_class) group by 1)")


@query("e2_class_report", O.sql(
    f"select label, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, round(support, 6) as support from ({_PER} union all "
    f"select 'accuracy', accuracy, accuracy, accuracy, accuracy from ({S.sql_class('scored_class')}) union all "
    f"select 'macro avg', macro_precision, macro_recall, macro_f1, rows from ({S.sql_class('scored_class')}) union all "
    f"select 'weighted avg', weighted_precision, weighted_recall, weighted_f1, rows from ({S.sql_class('scored_class')}))"))
def class_report(spark, sf):
    return rounded(M.class_report(S.scored_class(spark, sf)))


_CLASS = ["accuracy", "balanced_accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_precision", "weighted_recall", "weighted_f1"]


@query("e3_e4_multiclass_metrics", O.sql(f"select {r6(_CLASS)}, rows from ({S.sql_class('scored_class')})"))
def multiclass(spark, sf):
    return rounded(M.multiclass_metrics(S.scored_class(spark, sf)))


@query("e3_e4_multiclass_by_fold", O.sql(f"select fold, {r6(_CLASS)}, rows from ({S.sql_class('scored_class', 'fold')})"))
def multiclass_by_fold(spark, sf):
    return rounded(M.multiclass_metrics(S.scored_class(spark, sf), ["fold"]))


# --- regression metrics -----------------------------------------------------

_REG = ["mae", "rmse", "r2", "median_absolute_error", "p90_absolute_error"]


@query("e5_regression_metrics", O.sql(f"select rows, {r6(_REG)} from ({S.sql_reg('scored_reg')})"))
def regression(spark, sf):
    return rounded(M.regression_metrics(S.scored_reg(spark, sf)))


@query("e5_regression_by_fold", O.sql(f"select fold, rows, {r6(_REG)} from ({S.sql_reg('scored_reg', 'fold')})"))
def regression_by_fold(spark, sf):
    return rounded(M.regression_metrics(S.scored_reg(spark, sf), ["fold"]))


@query("o4_worst_predictions", O.sql(
    f"select row_id, y_true, round(p, 6) as y_pred, round(abs(p - y_true), 6) as abs_error, round(p - y_true, 6) as signed_error "
    f"from (select row_id, y_true, {O.inside('y_pred', 1850, 2025)} as p from scored_reg) order by abs(p - y_true) desc, row_id limit 200"))
def worst(spark, sf):
    return rounded(M.worst_predictions(S.scored_reg(spark, sf)))


# --- multilabel metrics -----------------------------------------------------

_MULTI = ["macro_f1", "micro_f1", "weighted_f1", "samples_f1"]


def _multi(src, keys=""):
    k = keys + ", " if keys else ""
    return f"select {k}{r6(_MULTI)}, rows from ({S.sql_multi(src, keys)})"


@query("e6_multilabel_metrics", O.sql(_multi("multi_serving")))
def multilabel(spark, sf):
    return rounded(M.multilabel_metrics(S.serving(S.scored_multi(spark, sf))))


@query("e2_multilabel_report", O.sql(
    "select label_idx::int as label_idx, " + S._LABELS + "[label_idx + 1] as label, "
    "round(coalesce(tp / nullif(tp + fp, 0)::double, 0), 6) as precision, round(coalesce(tp / nullif(tp + fn, 0)::double, 0), 6) as recall, "
    "round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::double, 0), 6) as f1, (tp + fn)::bigint as support from ("
    + S._MULTI_STATS.format(keys="", src="multi_serving") + ")"))
def multilabel_report(spark, sf):
    return rounded(M.multilabel_report(S.serving(S.scored_multi(spark, sf))))


@query("h5_direct_and_serving", O.sql(
    f"select 'direct' as decision, * from ({_multi('multi_direct')}) union all select 'serving', * from ({_multi('multi_serving')})"))
def direct_and_serving(spark, sf):
    multi = S.scored_multi(spark, sf)
    direct = M.multilabel_metrics(S.direct(multi)).withColumn("decision", F.lit("direct"))
    return rounded(direct.unionByName(M.multilabel_metrics(S.serving(multi)).withColumn("decision", F.lit("serving"))))


def _split(df):
    return df.withColumn("split", F.when(col("fold") == 0, "holdout").otherwise("development"))


@query("e9_label_support", O.sql(
    "select split, i::int as label_idx, " + S._LABELS + "[i + 1] as label, sum(y)::bigint as support from ("
    "select case when fold = 0 then 'holdout' else 'development' end as split, unnest(range(0, 5)) as i, unnest(y) as y from multi_y) group by split, i"))
def supports(spark, sf):
    return M.label_supports(_split(S.scored_multi(spark, sf)), ["split"])


_TOP_DEV = "(select list_position(s, list_max(s)) from (select [" + ", ".join(f"sum(y[{i + 1}])" for i in range(N)) + "] as s from multi_y where fold <> 0))"


@query("e8_holdout_baseline", O.sql(_multi(
    f"(select row_id, y, list_transform(y, lambda a, i: (i = t.top)::int) as p from multi_y, (select {_TOP_DEV} as top) t where fold = 0)")))
def holdout_baseline(spark, sf):
    return rounded(M.multilabel_metrics(B.holdout_label_baseline(_split(S.scored_multi(spark, sf)))))


# --- baselines --------------------------------------------------------------

O.CTES.update({
    "fold_list": "select unnest(range(0, 5))::int as fold",
    "class_mode": "select f.fold, arg_min(label, (-n, label)) as predicted from (select f.fold, s.y_true as label, count(*) as n "
                  "from fold_list f join scored_class s on s.fold <> f.fold group by 1, 2) f group by 1",
    "class_mode_scored": "select s.row_id, s.fold, s.y_true, m.predicted as y_pred from scored_class s join class_mode m using (fold)",
    "reg_median": "select f.fold, quantile_cont(s.y_true, 0.5) as median from fold_list f join scored_reg s on s.fold <> f.fold group by 1",
    "reg_baseline": "select s.fold, m.median, avg(abs(s.y_true - m.median)) as mae from scored_reg s join reg_median m using (fold) group by 1, 2",
    "label_mode": "select fold, list_position(s, list_max(s)) as top from (select f.fold, [" + ", ".join(f"sum(y[{i + 1}])" for i in range(N))
                  + "] as s from fold_list f join multi_y m on m.fold <> f.fold group by 1)",
    "label_mode_scored": "select row_id, fold, y, list_transform(y, lambda a, i: (i = top)::int) as p from multi_y join label_mode using (fold)",
})


@query("m14_mode_baseline", O.sql(
    f"select fold, predicted, round(macro_f1, 6) as macro_f1 from ({S.sql_class('class_mode_scored', 'fold')}) join class_mode using (fold)"))
def mode_baseline(spark, sf):
    return rounded(B.mode_baseline(S.scored_class(spark, sf)))


@query("m14_median_baseline", O.sql("select fold, median, round(mae, 6) as mae from reg_baseline"))
def median_baseline(spark, sf):
    return rounded(B.median_baseline(S.scored_reg(spark, sf)))


@query("m14_label_baseline", O.sql(
    f"select fold, (top - 1)::int as label_idx, round(macro_f1, 6) as macro_f1 from ({S.sql_multi('label_mode_scored', 'fold')}) join label_mode using (fold)"))
def label_baseline(spark, sf):
    return rounded(B.label_baseline(S.scored_multi(spark, sf)))


@query("m14_fold_scores", O.sql(
    f"select round(avg(macro_f1), 6) as cv_mean, round(stddev_pop(macro_f1), 6) as cv_std from ({S.sql_class('class_mode_scored', 'fold')})"))
def fold_scores(spark, sf):
    return rounded(B.fold_scores(B.mode_baseline(S.scored_class(spark, sf)), "macro_f1"))


@query("n7_label_frequencies", O.sql(
    "select i::int as label_idx, " + S._LABELS + "[i + 1] as label, round(avg(y), 6) as probability from ("
    "select unnest(range(0, 5)) as i, unnest(y) as y from multi_y) group by i"))
def frequencies(spark, sf):
    return rounded(B.label_frequencies(S.scored_multi(spark, sf)))


# --- model selection --------------------------------------------------------

@query("m15_leaderboard", O.sql(
    "select seq, name, family, round(cv_best, 6) as cv_best, round(cv_std, 6) as cv_std, "
    "(row_number() over (order by round(cv_best, 9) desc, round(cv_std, 9), seq))::int as place, "
    "(row_number() over (order by family = 'baseline', round(cv_best, 9) desc, round(cv_std, 9), seq) = 1)::int as winner "
    f"from (select seq, name, family, avg(macro_f1) as cv_best, stddev_pop(macro_f1) as cv_std from ({S.sql_class('scored_candidates', 'seq, name, family, fold')}) group by 1, 2, 3)"))
def leaderboard(spark, sf):
    scores = M.multiclass_metrics(S.scored_candidates(spark, sf), ["seq", "name", "family", "fold"])
    return rounded(QA.leaderboard(scores, "macro_f1"))


@query("n4_winner_by_holdout", O.sql(
    "select name, round(cv_best, 6) as cv_best, (row_number() over (order by family = 'baseline', round(cv_best, 9) desc, seq) = 1)::int as winner "
    f"from (select seq, name, family, macro_f1 as cv_best from ({S.sql_class('scored_candidates', 'seq, name, family, fold')}) where fold = 0)"))
def winner_by_holdout(spark, sf):
    """Older rule: the place is decided on the holdout itself, here fold 0."""
    scores = M.multiclass_metrics(S.scored_candidates(spark, sf).filter("fold = 0"), ["seq", "name", "family"])
    means = scores.select("seq", "name", "family", F.col("macro_f1").alias("cv_best"), F.lit(0.0).alias("cv_std"))
    return rounded(QA.rank_candidates(means).select("name", "cv_best", "winner"))


# --- thresholds -------------------------------------------------------------

def _grid(grid):
    return "[" + ", ".join(f"{t!r}::double" for t in grid) + "]"


_LONG = "(select {keys} row_id, unnest(range(0, 5)) as label_idx, unnest(y) as y, unnest(prob) as prob from scored_multi)"
_GRID_F1 = ("select {keys} label_idx::int as label_idx, t.raw, round(t.raw, 2) as threshold, "
            "coalesce(2 * sum(case when prob >= t.raw then y else 0 end) / nullif(sum((prob >= t.raw)::int) + sum(y), 0)::double, 0) as f1, "
            "sum(y) as pos, count(*) as n from {src} cross join (select unnest({grid}) as raw) t group by all")
O.CTES.update({
    "grid_f1": _GRID_F1.format(keys="", src=_LONG.format(keys=""), grid=_grid(THRESHOLD_GRID)),
    "old_grid_f1": _GRID_F1.format(keys="", src=_LONG.format(keys=""), grid=_grid(OLD_THRESHOLD_GRID)),
    "fold_grid_f1": _GRID_F1.format(keys="fold,", src=_LONG.format(keys="fold,"), grid=_grid(OLD_THRESHOLD_GRID)),
    "best_limits": "select label_idx, case when max(pos) = 0 or max(pos) = max(n) then 0.5::double else "
                   "arg_max(threshold, (f1, -abs(raw - 0.5::double), threshold)) end as threshold, max(f1) as f1 from grid_f1 group by 1",
    "limit_list": "select list(threshold order by label_idx) as limits from best_limits",
    "multi_optimized": f"select row_id, fold, y, {S.sql_decide('prob', 'limits')} as p from scored_multi, limit_list",
    "fold_limits": "select fold, list(threshold order by label_idx) as limits from (select fold, label_idx, arg_max(threshold, (f1, -raw)) as threshold "
                   "from fold_grid_f1 group by 1, 2) group by 1",
    "multi_fold_optimized": f"select row_id, fold, y, {S.sql_decide('prob', 'limits')} as p from scored_multi join fold_limits using (fold)",
})


@query("h2_threshold_scores_j8", O.sql("select label_idx, threshold, round(f1, 6) as f1 from grid_f1"))
def threshold_scores(spark, sf):
    return rounded(H.threshold_scores(S.scored_multi(spark, sf)).select("label_idx", "threshold", "f1"))


def _best(spark, sf):
    return H.best_thresholds(H.threshold_scores(S.scored_multi(spark, sf)))


@query("h2_best_thresholds", O.sql(f"select label_idx, {S._LABELS}[label_idx + 1] as label, threshold, round(f1, 6) as f1 from best_limits"))
def best_thresholds(spark, sf):
    return rounded(_best(spark, sf))


@query("n1_first_best_thresholds", O.sql(
    f"select label_idx, {S._LABELS}[label_idx + 1] as label, arg_max(threshold, (f1, -raw)) as threshold, round(max(f1), 6) as f1 from old_grid_f1 group by 1"))
def first_best(spark, sf):
    return rounded(H.first_best_thresholds(H.threshold_scores(S.scored_multi(spark, sf), grid=OLD_THRESHOLD_GRID)))


_IN_SAMPLE = "multi_in_sample"
O.CTES[_IN_SAMPLE] = "select * from scored_multi where fold <> 0"
O.CTES["in_sample_grid_f1"] = O.CTES["grid_f1"].replace("scored_multi", _IN_SAMPLE)
O.CTES["in_sample_limits"] = O.CTES["best_limits"].replace("grid_f1", "in_sample_grid_f1")


@query("n2_in_sample_thresholds", O.sql(f"select label_idx, {S._LABELS}[label_idx + 1] as label, threshold, round(f1, 6) as f1 from in_sample_limits"))
def in_sample_thresholds(spark, sf):
    """Older rule: thresholds from the probabilities of the rows a fold's model was trained on."""
    return rounded(H.best_thresholds(H.threshold_scores(S.scored_multi(spark, sf).filter("fold <> 0"))))


_CONTRACT = {"labels_known": (0, 1), "labels_complete": (0, 1), "labels_once": (0, 0), "labels_in_order": (0, 1), "thresholds_in_range": (0, 2)}


@query("h7_threshold_contract", " union all ".join(
    f"select '{t}' as chosen, '{name}' as name, {v[i]}::bigint as violations, {int(v[i] == 0)} as passed" for i, t in enumerate(("calibrated", "broken")) for name, v in _CONTRACT.items()))
def threshold_contract(spark, sf):
    """The calibrated thresholds, and a copy with a wrong label and two wrong values."""
    chosen = staged(_best(spark, sf))
    i = col("label_idx")
    broken = chosen.withColumns({"label": F.when(i == 0, F.lit("?")).otherwise(col("label")),
                                 "threshold": F.when(i == 1, F.lit(None)).when(i == 2, F.lit(1.5)).otherwise(col("threshold"))})
    both = [H.threshold_contract(df).withColumn("chosen", F.lit(name)) for name, df in (("calibrated", chosen), ("broken", broken))]
    return both[0].unionByName(both[1])


@query("h3_applied_thresholds_w5", O.sql(
    "select row_id, " + ", ".join(f"p[{i + 1}] as p{i}" for i in range(N))
    + ", (list_position(prob, list_max(prob)) - 1)::int as top from multi_optimized join (select row_id, prob from scored_multi) using (row_id)"))
def applied(spark, sf):
    decided = H.decide_by_table(S.scored_multi(spark, sf), _best(spark, sf))
    return decided.select("row_id", *[col("p")[i].alias(f"p{i}") for i in range(N)], H.argmax(col("prob")).alias("top"))


@query("h4_threshold_strategy", O.sql(
    f"with pair as (select 'oof_per_label_optimized' as strategy, * from ({S.sql_multi('multi_optimized')}) union all "
    f"select 'default_0.5', * from ({S.sql_multi('multi_serving')})) "
    f"select strategy, {r6(_MULTI)}, rows, (strategy = (select arg_max(strategy, (macro_f1, strategy)) from pair))::int as selected from pair")
    .replace("\nwith pair as", ",\npair as"))
def strategy(spark, sf):
    return rounded(H.choose_strategy(S.scored_multi(spark, sf), _best(spark, sf)))


@query("n3_fold_thresholds", O.sql(_multi("multi_fold_optimized", "fold")))
def fold_thresholds(spark, sf):
    """Older diagnostic: thresholds fitted on each fold and scored on the same fold."""
    multi = S.scored_multi(spark, sf)
    scores = H.threshold_scores(multi, grid=OLD_THRESHOLD_GRID, keys=["fold"])
    return rounded(M.multilabel_metrics(H.decide_by_table(multi, H.first_best_thresholds(scores, ["fold"]), keys=["fold"]),
                                        keys=["fold"]))
