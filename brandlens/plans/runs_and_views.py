"""Queries for run metrics, quality gate, publication, prediction checks and dashboard views."""

from __future__ import annotations

from pyspark.sql import functions as F

from brandlens.contract import CANONICAL_COLUMNS, DOMAIN_ALIASES, FEATURE_CONTRACT_VERSION, FORBIDDEN_FEATURES, KNOWN_PRICE_LABELS, POLICY
from brandlens.operators import checks as C, dashboard as V, profile as P, quality as QA
from brandlens.operators.prepare import domain_rows
from brandlens.plans import oracle as O, scored as S
from brandlens.plans.registry import brands, prepared, query, rounded, table


def col(name):
    return F.col(name)


def union(parts):
    return " union all ".join(parts)


# --- oracle tables of the runs ----------------------------------------------

def _rest(src, columns):
    return (f"select f.fold as run_id, " + ", ".join(f"avg(m.{c}) as cv_{c}, stddev_pop(m.{c}) as std_{c}" for c in columns)
            + f" from fold_list f join {src} m on m.fold <> f.fold group by 1")


def _long(src, model, metrics):
    return union(f"select run_id::varchar as run_id, '{model}' as model, '{m}' as metric, ({x})::double as value from {src}"
                 for m, x in metrics)


O.CTES.update({
    "class_by_fold": f"select a.*, b.base from ({S.sql_class('scored_class', 'fold')}) a join (select fold, macro_f1 as base from ({S.sql_class('class_mode_scored', 'fold')})) b using (fold)",
    "reg_by_fold": f"select a.*, b.mae as base from ({S.sql_reg('scored_reg', 'fold')}) a join reg_baseline b using (fold)",
    "multi_by_fold": f"select a.*, d.macro_f1 as direct_macro, d.micro_f1 as direct_micro, b.macro_f1 as base from ({S.sql_multi('multi_serving', 'fold')}) a "
                     f"join ({S.sql_multi('multi_direct', 'fold')}) d using (fold) join ({S.sql_multi('label_mode_scored', 'fold')}) b using (fold)",
    "class_runs": "select * from class_by_fold join (" + _rest("class_by_fold", ["macro_f1", "base"]) + ") r on r.run_id = fold",
    "reg_runs": "select * from reg_by_fold join (" + _rest("reg_by_fold", ["mae", "base"]) + ") r on r.run_id = fold",
    "multi_runs": "select * from multi_by_fold join (" + _rest("multi_by_fold", ["macro_f1", "micro_f1", "direct_macro", "base"]) + ") r on r.run_id = fold",
    "run_metrics": union([
        _long("class_runs", "domain", [
            ("cv_best_macro_f1", "cv_macro_f1"), ("cv_std_macro_f1", "std_macro_f1"), ("baseline_cv_macro_f1", "cv_base"),
            ("cv_uplift_over_baseline", "cv_macro_f1 - cv_base"), ("holdout_accuracy", "accuracy"),
            ("holdout_balanced_accuracy", "balanced_accuracy"), ("holdout_macro_f1", "macro_f1"),
            ("holdout_weighted_f1", "weighted_f1"), ("generalization_gap_macro_f1", "macro_f1 - cv_macro_f1")]),
        _long("reg_runs", "founded", [
            ("cv_best_mae", "cv_mae"), ("cv_std_mae", "std_mae"), ("baseline_cv_mae", "cv_base"),
            ("cv_mae_improvement_over_baseline_abs", "cv_base - cv_mae"),
            ("cv_mae_improvement_over_baseline_pct", "case when cv_base > 0 then (cv_base - cv_mae) / cv_base end"),
            ("holdout_mae", "mae"), ("holdout_rmse", "rmse"), ("holdout_r2", "r2"),
            ("holdout_median_absolute_error", "median_absolute_error"), ("holdout_p90_absolute_error", "p90_absolute_error"),
            ("generalization_gap_mae", "mae - cv_mae")]),
        _long("multi_runs", "price_category", [
            ("cv_best_macro_f1", "cv_direct_macro"), ("cv_std_macro_f1", "std_direct_macro"),
            ("cv_uplift_over_baseline", "cv_direct_macro - cv_base"), ("oof_selected_macro_f1", "cv_macro_f1"),
            ("oof_selected_micro_f1", "cv_micro_f1"), ("holdout_direct_macro_f1", "direct_macro"),
            ("holdout_direct_micro_f1", "direct_micro"), ("holdout_serving_macro_f1", "macro_f1"),
            ("holdout_serving_micro_f1", "micro_f1"), ("holdout_serving_weighted_f1", "weighted_f1"),
            ("holdout_serving_samples_f1", "samples_f1"), ("generalization_gap_macro_f1", "macro_f1 - cv_macro_f1")]),
    ]),
    "run_prints": "select (row_id % 5)::int as run, count(*) as n_rows, sum(" + O.hash32(
        "concat_ws('|', " + ", ".join(f"coalesce({c}, '<null>')" for c in CANONICAL_COLUMNS) + ")") + ")::bigint as digest from brands group by 1",
    "attributes": "select * from (" + union(
        f"select run::varchar as run_id, '{m}' as model, '{k}' as key, {v} as value from run_prints" for m, k, v in S.ATTRIBUTES)
        + ") where value is not null",
    "ledger": "select " + S._LEDGER.format(run="run") + " from (select *, (o_orderkey % 5)::int as run from orders) group by run",
})
_DROP = "(select a.run_id, a.value - b.value as value from run_metrics a join run_metrics b using (run_id, model) " \
        "where a.metric = 'holdout_direct_macro_f1' and b.metric = 'holdout_serving_macro_f1')"
O.CTES["quality_checks"] = (
    "select run_id, model, metric, operator, threshold, value, (value is not null and isfinite(value))::int as valid, "
    "(case operator when '>=' then value >= threshold else value <= threshold end)::int as passed from ("
    + union(f"select r.run_id, '{m}' as model, '{k}' as metric, '{o}' as operator, {float(x)}::double as threshold, v.value from "
            f"(select distinct run_id from run_metrics) r left join "
            + (_DROP if k == "serving_macro_drop_vs_direct" else f"(select run_id, value from run_metrics where model = '{m}' and metric = '{k}')")
            + " v using (run_id)" for m, k, o, x in POLICY) + ")")


# --- run metrics, gate, publication -----------------------------------------

@query("e7_e10_run_metrics", O.sql("select run_id, model, metric, round(value, 6) as value from run_metrics"))
def run_metrics(spark, sf):
    return rounded(S.run_metrics(spark, sf))


@query("g2_quality_checks", O.sql("select run_id, model, metric, operator, threshold, round(value, 6) as value, valid, passed from quality_checks"))
def quality_checks(spark, sf):
    return rounded(QA.quality_checks(S.run_metrics(spark, sf)))


@query("g2_quality_summary", O.sql(
    "select run_id, case when min(valid) = 0 then 'ERROR' when min(passed) = 0 then 'FAILED' else 'PASSED' end as status, count(*) as checks_total, "
    "sum(passed)::bigint as checks_passed, (count(*) - sum(passed))::bigint as checks_failed from quality_checks group by 1"))
def quality_summary(spark, sf):
    return QA.quality_summary(QA.quality_checks(S.run_metrics(spark, sf)))


@query("g4_consistent_attributes", O.sql(
    f"select *, (n_values = 1 and n_missing = 0 and n_models = 3)::int as consistent from (select run_id, key, count(distinct value) as n_values, "
    f"count(*) filter ({O.blank('value')}) as n_missing, count(distinct model) as n_models from attributes "
    f"where key in ('feature_contract_version', 'dataset_fingerprint') group by 1, 2)"))
def consistent(spark, sf):
    return QA.consistent_attributes(S.attributes(spark, sf))


_WANTED = union(f"select '{m}' as model, '{k}' as key, {'null' if v is None else chr(39) + v + chr(39)}::varchar as expected" for m, k, v in QA.REQUIRED_REPORT_KEYS)
_NEEDED = union(f"select '{m}' as model, '{k}' as metric" for m, k in QA.REQUIRED_REPORT_METRICS)
_FORBIDDEN = " or ".join(f"list_contains(string_split(value, ','), '{c}')" for c in FORBIDDEN_FEATURES)


@query("g5_report_gaps", O.sql(
    f"select run_id, model, key as item, case when {O.blank('value')} then 'missing' else 'unexpected value' end as problem from "
    f"(select distinct run_id from attributes) cross join ({_WANTED}) left join attributes using (run_id, model, key) "
    f"where {O.blank('value')} or value <> expected union all "
    f"select run_id, model, metric, 'missing' from (select distinct run_id from attributes) cross join ({_NEEDED}) "
    f"anti join run_metrics using (run_id, model, metric) union all "
    f"select run_id, model, key, 'forbidden feature' from attributes where key = 'feature_columns' and ({_FORBIDDEN})"))
def report_gaps(spark, sf):
    return QA.report_gaps(S.attributes(spark, sf), S.run_metrics(spark, sf))


@query("g6_metrics_by_model", O.sql(
    "select run_id, model, string_agg(concat(metric, '=', round(value * 1000000)::bigint), ';' order by metric) as metrics from quality_checks "
    "where valid = 1 group by 1, 2"))
def by_model(spark, sf):
    maps = QA.metrics_by_model(QA.quality_checks(S.run_metrics(spark, sf)))
    entry = F.transform(F.map_entries("metrics"), lambda e: F.concat(
        e["key"], F.lit("="), F.round(e["value"] * 1000000).cast("bigint").cast("string")))
    return maps.select("run_id", "model", F.array_join(entry, ";").alias("metrics"))


_WINNER = ("select run_id, model, arg_min(value, list_position([" + O.texts(QA.WINNER_KEYS) + "], key)) as winner from attributes "
           "where key in (" + O.texts(QA.WINNER_KEYS) + ") group by 1, 2")


@query("g6_winner_names", O.sql(_WINNER))
def winners(spark, sf):
    return QA.first_of(S.attributes(spark, sf))


@query("g7_publishable_runs", O.sql(
    f"select l.* from ledger l where upper(quality_status) = 'PASSED' and upper(smoke_status) = 'PASSED' and "
    f"(select count(distinct value) = 1 and count(*) = 3 and count(*) filter ({O.blank('value')}) = 0 from attributes a where a.run_id = l.run_id and key = 'dataset_fingerprint') and "
    f"(select count(*) = 3 and min((value = '{FEATURE_CONTRACT_VERSION}')::int) = 1 from attributes a where a.run_id = l.run_id and key = 'feature_contract_version') and "
    f"(select count(*) = 3 from ({_WINNER}) w where w.run_id = l.run_id)"))
def publishable(spark, sf):
    return QA.publishable_runs(S.ledger(spark, sf), S.attributes(spark, sf))


# --- prediction checks ------------------------------------------------------

_SHOWN = f"list_distinct(list_filter(list_transform(string_split(coalesce(pred_price_category, ''), ';'), lambda x: {O.strip('x')}), lambda x: x <> ''))"
_FLAGS = ", ".join(f'"{c}"' for c in C.FLAG_COLUMNS)
_PROBS = ", ".join(f'"{c}"' for c in C.PROBABILITY_COLUMNS)
_ACTIVE = f"list_filter({S._LABELS}, lambda l, i: fl[i] = 1)"


def _bad(condition):
    return f"count(*) filter (not coalesce({condition}, false))"


_VIOLATIONS = [
    ("row_count_preserved", "abs(count(*) - (select count(*) from brands))"),
    ("required_prediction_columns", "count(*) * 0"),
    ("domain_known_classes_only", "(select count(distinct pred_domain) from predictions where pred_domain not in (select domain from domain_rows)) + count(*) * 0"),
    ("domain_non_null", _bad("pred_domain is not null")), ("domain_non_empty", _bad(f"not {O.blank('pred_domain')}")),
    ("founded_finite", _bad("isfinite(pred_founded)")), ("founded_valid_range", _bad("pred_founded between 1850 and 2025")),
    ("founded_rounded_valid", _bad("pred_founded_rounded between 1850 and 2025")),
    ("price_non_empty", _bad("len(shown) > 0")),
    ("price_known_labels_only", _bad(f"len(list_filter(shown, lambda x: x not in ({O.texts(KNOWN_PRICE_LABELS)}))) = 0")),
    ("price_probabilities_valid", _bad("list_min(pr) >= 0 and list_max(pr) <= 1 and len(list_filter(pr, lambda x: x is null)) = 0")),
    ("price_binary_outputs_valid", _bad("len(list_filter(fl, lambda x: x in (0, 1))) = 5")),
    ("price_at_least_one_label_per_row", _bad("list_contains(fl, 1)")),
    ("price_text_binary_consistency", _bad(f"list_sort(shown) = list_sort({_ACTIVE})")),
]
_P = f"(select *, {_SHOWN} as shown, [{_FLAGS}] as fl, [{_PROBS}] as pr from predictions)"
_J6 = [("target_independence_domain", "count(*) * 0"), ("target_independence_founded", "count(*) filter (pred_founded is null or row_id % 100 = 3)"),
       ("target_independence_price", "count(*) * 0")]
_SMOKE = union(f"select '{n}' as name, ({x})::bigint as violations from {_P}" for n, x in [*_VIOLATIONS, *_J6])


@query("g3_smoke_checks", O.sql(f"select name, violations, (violations = 0)::int as passed from ({_SMOKE})"))
def smoke(spark, sf):
    classes = domain_rows(prepared(spark, sf).select("domain")).select("domain").distinct()
    return C.smoke_checks(S.predictions(spark, sf), brands(spark, sf), classes, S.predictions_again(spark, sf))


@query("j6_result_differences", O.sql(
    "select 0::bigint as target_independence_domain, count(*) filter (pred_founded is null or row_id % 100 = 3) as target_independence_founded, "
    "0::bigint as target_independence_price from predictions"))
def differences(spark, sf):
    return C.result_differences(S.predictions(spark, sf), S.predictions_again(spark, sf))


@query("j3_unexpected_classes", O.sql(
    "select distinct pred_domain as value from predictions where pred_domain is not null except select domain from domain_rows"))
def unexpected_classes(spark, sf):
    classes = domain_rows(prepared(spark, sf).select("domain")).select("domain").distinct()
    return C.unexpected_values(S.predictions(spark, sf), "pred_domain", classes)


@query("j2_m18_classes", O.sql("select distinct domain from domain_rows"))
def classes(spark, sf):
    return domain_rows(prepared(spark, sf).select("domain")).distinct().orderBy("domain")


@query("j4_country_lookup", O.sql("select country_origin, count(*) as rows from prep group by 1"))
def country_lookup(spark, sf):
    """The synonym map applied inside the projection, then counted."""
    return prepared(spark, sf).groupBy("country_origin").agg(F.count(F.lit(1)).alias("rows"))


@query("j5_alignment_check", O.sql(
    f"select *, (source_missing = 0 and result_missing = 0 and source_rows = source_distinct and result_rows = result_distinct "
    f"and only_in_source = 0 and only_in_result = 0)::int as provable from (select "
    f"(select count(*) from brands) as source_rows, (select count(*) from brands where {O.missing('name')}) as source_missing, "
    f"(select count(distinct name) from brands) as source_distinct, (select count(*) from predictions) as result_rows, "
    f"(select count(*) from predictions where {O.missing('name')}) as result_missing, (select count(distinct name) from predictions) as result_distinct, "
    f"(select count(*) from (select distinct name from brands) b where not exists (select 1 from predictions p where p.name = b.name)) as only_in_source, "
    f"(select count(*) from (select distinct name from predictions) p where not exists (select 1 from brands b where p.name = b.name)) as only_in_result)"))
def alignment(spark, sf):
    return C.alignment_check(brands(spark, sf), S.predictions(spark, sf))


@query("j5_aligned_domain", O.sql("select p.row_id, p.pred_domain, b.domain as original_domain from predictions p join brands b using (row_id)"))
def aligned(spark, sf):
    return C.align_original(brands(spark, sf), S.predictions(spark, sf)).select("row_id", "pred_domain", "original_domain")


@query("p9o_filled_gaps", O.sql(
    f"select row_id, pred_domain from predictions where {O.missing('domain')} and not {O.missing('pred_domain')}"))
def filled_gaps(spark, sf):
    return C.filled_gaps(C.align_original(brands(spark, sf), S.predictions(spark, sf))).select("row_id", "pred_domain")


@query("p9o_gap_counts", O.sql(
    f"select count(*) filter ({O.missing('domain')}) as rows_without_original, "
    f"count(*) filter ({O.missing('domain')} and not {O.missing('pred_domain')}) as rows_filled from predictions"))
def gap_counts(spark, sf):
    return C.gap_counts(C.align_original(brands(spark, sf), S.predictions(spark, sf)))


@query("g8_result_contract", O.sql(
    "select count(*) as rows_out, (select count(*) from brands) as rows_in, (count(*) = (select count(*) from brands))::int as valid from predictions"))
def result_contract(spark, sf):
    return C.check_result(S.predictions(spark, sf), brands(spark, sf))


@query("a25_summary_cards", O.sql(
    f"select count(*) as rows, count(distinct case when not {O.missing('pred_domain')} then pred_domain end) as distinct_domains, "
    f"count(distinct case when not {O.missing('pred_price_category')} then pred_price_category end) as distinct_price_categories, "
    f"quantile_cont(pred_founded_rounded::double, 0.5) as median_year from predictions"))
def cards(spark, sf):
    return V.summary_cards(S.predictions(spark, sf))


def _top_values(column):
    @query(f"a26_top_values_{column}", O.sql(
        f"select case when {O.missing(column)} then 'неизвестно' else {O.strip(column)} end as {column}, count(*) as count from predictions "
        f"group by 1 order by count(*) desc, 1 limit 10"))
    def run(spark, sf):
        return V.top_values(S.predictions(spark, sf), column)
    return run


_top_values("pred_domain")
_top_values("pred_price_category")


# --- dashboard views --------------------------------------------------------

def _alias_sql(names, c="domain"):
    return "case " + c + " " + " ".join(f"when '{k}' then '{v}'" for k, v in names.items()) + f" else {c} end"


_BRAND_ALIASES = {" Brand#1 ": "First", " Brand#2 ": "Second"}


@query("v1_domain_view", O.sql(
    f"select domain, {_alias_sql(DOMAIN_ALIASES)} as domain_label, count(*) as count from brands where domain is not null "
    f"group by 1 order by count(*) desc, domain limit 10"))
def domain_view(spark, sf):
    return V.domain_view(brands(spark, sf))


@query("f24_aliases", O.sql(f"select row_id, {_alias_sql(_BRAND_ALIASES)} as domain_label from brands"))
def aliases(spark, sf):
    return brands(spark, sf).select("row_id", V.alias(col("domain"), _BRAND_ALIASES).alias("domain_label"))


def _bins(where):
    return (f"with bins as (select (floor(y / 10) * 10)::bigint as bin, count(*) as count from (select {O.number('founded')} as y, domain from brands) "
            f"where y between 1850 and 2020 {where} group by 1) "
            f"select bin, count, round((select quantile_cont(count::double, 0.25) from bins), 6) as lower_quartile, "
            f"round((select quantile_cont(count::double, 0.5) from bins), 6) as median, "
            f"round((select quantile_cont(count::double, 0.75) from bins), 6) as upper_quartile from bins")


def _with(select):
    """A SELECT that brings its own CTE, after the shared ones."""
    return O.sql(select).replace("\nwith bins as", ",\nbins as", 1)


@query("v2_founded_view_w3", _with(_bins("")))
def founded_view(spark, sf):
    return rounded(V.founded_view(brands(spark, sf)))


@query("v5_founded_view_filtered_p11o", _with(_bins("and domain = ' Brand#1 '")))
def founded_view_filtered(spark, sf):
    return rounded(V.founded_view(brands(spark, sf), " Brand#1 "))


_POINTS = (f"select row_id, name, domain, {O.number('presence_world')} as presence_world, {O.number('plans')} as plans from brands "
           "where domain in (select domain from brands where domain is not null <extra> group by 1 order by count(country_origin) desc, domain limit 10) <extra>")


def _points(extra=""):
    return (f"select *, case when presence_world >= 2000 or plans >= 100 then 'Top players' else 'Other brands' end as top_brand_flag, "
            f"case when presence_world >= 2000 then 'Etam — high presence, low expansion' end as top_label, "
            f"case when name = 'blue bolt  Brand#4' then 'picked' end as highlight_flag, "
            f"case when name = 'blue bolt  Brand#4' then presence_world * 3 else presence_world end as highlight_size "
            f"from ({_POINTS.replace('<extra>', extra)}) where plans between 1 and 1000 and presence_world between 1 and 10000")


@query("v3_presence_points_o5_f23", O.sql(_points()))
def presence_points(spark, sf):
    return V.presence_points(brands(spark, sf), highlight="blue bolt  Brand#4", highlight_label="picked")


@query("v5_presence_points_filtered", O.sql(_points("and domain = ' Brand#1 '")))
def presence_points_filtered(spark, sf):
    return V.presence_points(brands(spark, sf), " Brand#1 ", highlight="blue bolt  Brand#4", highlight_label="picked")


@query("v3_presence_lines_w4", O.sql(
    f"select count(*) as points, round(avg(presence_world), 6) as mean_presence, round(avg(plans), 6) as mean_plans, "
    f"round(regr_slope(plans, presence_world), 6) as slope, round(regr_intercept(plans, presence_world), 6) as intercept, "
    f"quantile_cont(presence_world, 0.5) as median_presence, quantile_cont(plans, 0.5) as median_plans from ({_points()})"))
def presence_lines(spark, sf):
    return rounded(V.presence_lines(V.presence_points(brands(spark, sf))))


@query("v4_price_view_w2", O.sql(
    f"select label, count(*) as count, round(count(*)::double / sum(count(*)) over (), 6) as share from "
    f"(select unnest({O.known_labels('price_category')}) as label from prep) group by 1"))
def price_view(spark, sf):
    return rounded(V.price_view(P.label_distribution(prepared(spark, sf))))


@query("w3_reference_lines_lineitem",
       "select l_returnflag, round(avg(l_quantity), 6) as mean, quantile_cont(l_quantity, 0.25) as lower_quartile, "
       "quantile_cont(l_quantity, 0.5) as median, quantile_cont(l_quantity, 0.75) as upper_quartile from lineitem group by 1")
def reference_lines(spark, sf):
    freq = P.Q.value_frequencies(table(spark, sf, "lineitem"), {"l_quantity": col("l_quantity")}, ["l_returnflag"])
    return rounded(P.Q.summarize(freq, [P.Q.mean().alias("mean")], [0.25, 0.5, 0.75],
                                 ["lower_quartile", "median", "upper_quartile"], ["l_returnflag"]))
