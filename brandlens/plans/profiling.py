"""Queries for profiling reports, duplicates, conflicts, readiness and the data gate."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from brandlens.contract import CANONICAL_COLUMNS, KNOWN_PRICE_LABELS
from brandlens.functions import labels, text
from brandlens.functions.numbers import to_number
from brandlens.operators import duplicates as D, profile as P, quantiles as Q, readiness as R
from brandlens.operators.prepare import prepare_features
from brandlens.plans import oracle as O
from brandlens.plans.registry import brands, prepared, query, rounded, table
from brandlens.plans.tables_and_functions import _MIXED
from brandlens.sources.brands import documents, raw_brands
from brandlens.sources.staging import staged


def col(name):
    return F.col(name)


def union(parts):
    return " union all ".join(parts)


# --- missing values and distributions ---------------------------------------

def _missing_sql(source, columns):
    return union(
        f"select '{c}' as \"column\", count(*) - count({c}) as missing_count, "
        f"round((count(*) - count({c}))::double / count(*), 6) as missing_rate, '{t}' as dtype from {source}"
        for c, t in columns)


_PREP_TYPES = [(c, "double" if c in ("founded", "presence_world", "plans", "total_rented_area", "presence_own",
                                     "presence_franchise") else
                "int" if c in ("n_regions", "desc_len", "desc_has_digits", "desc_year_mentions", "has_total_rented_area")
                else "string")
               for c in [*CANONICAL_COLUMNS, "name_clean", "presence_own", "presence_franchise", "n_regions", "desc_len",
                         "desc_has_digits", "desc_year_mentions", "has_total_rented_area"]]
_ORDERS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double")]


@query("a1_missing_raw", O.sql(_missing_sql("brands", [(c, "string") for c in CANONICAL_COLUMNS])))
def missing_raw(spark, sf):
    return rounded(P.missing_report(brands(spark, sf), CANONICAL_COLUMNS))


@query("a1_missing_prepared", O.sql(_missing_sql("prep", _PREP_TYPES)))
def missing_prepared(spark, sf):
    return rounded(P.missing_report(prepared(spark, sf).drop("row_id")))


@query("a1_missing_orders", _missing_sql("orders", _ORDERS))
def missing_orders(spark, sf):
    return rounded(P.missing_report(table(spark, sf, "orders"), [c for c, _ in _ORDERS]))


def _raw_counts(column, name):
    @query(f"a2_value_counts_{column}", O.sql(
        f"select coalesce({column}, 'MISSING') as {name}, count(*) as count from brands group by all"))
    def run(spark, sf):
        return P.value_counts(brands(spark, sf), col(column), name)
    return run


for _c in ["name", "country_origin", "domain", "price_category"]:
    _raw_counts(_c, f"{_c}_raw")


@query("a2_value_counts_event_type", "select coalesce(event_type, 'MISSING') as event_type, count(*) as count from events group by all")
def event_types(spark, sf):
    return P.value_counts(table(spark, sf, "events"), col("event_type"), "event_type")


def _norm_counts(column, expression, oracle_expression):
    @query(f"a3_normalized_counts_{column}", O.sql(
        f"select {oracle_expression} as {column}_norm, count(*) as count from brands group by all"))
    def run(spark, sf):
        return P.value_counts(brands(spark, sf), expression(), f"{column}_norm")
    return run


_norm_counts("name", lambda: text.clean_name(col("name")), O.clean_name("name"))
_norm_counts("country_origin", lambda: text.country_key(col("country_origin")), O.country_key("country_origin"))
_norm_counts("domain", lambda: text.domain_key(col("domain")), O.domain_key("domain"))
_norm_counts("price_category", lambda: labels.normal_labels(col("price_category")), O.normal_labels("price_category"))


def _mapping(column, expression, oracle_expression):
    @query(f"a4_mapping_{column}", O.sql(
        f"select coalesce({column}, 'MISSING') as raw_value, {oracle_expression} as norm_value, count(*) as count "
        f"from brands group by all"))
    def run(spark, sf):
        return P.mapping_counts(brands(spark, sf), col(column), expression(), "raw_value", "norm_value")
    return run


_mapping("country_origin", lambda: text.country_key(col("country_origin")), O.country_key("country_origin"))
_mapping("domain", lambda: text.domain_key(col("domain")), O.domain_key("domain"))


@query("a5_country_collisions", O.sql(
    f"select norm_value, count(*) as n_raw_variants from (select distinct coalesce(country_origin, 'MISSING') as raw_value, "
    f"{O.country_key('country_origin')} as norm_value from brands) group by norm_value having count(*) > 1"))
def country_collisions(spark, sf):
    mapping = P.mapping_counts(brands(spark, sf), col("country_origin"), text.country_key(col("country_origin")),
                               "raw_value", "norm_value")
    return D.collision_groups(mapping, "raw_value", "norm_value")


_PAIRS = f"(select distinct {O.clean_name('name')} as name_clean_candidate, name as original from brands where name is not null)"


def _name_pairs(spark, sf):
    return D.name_variants(brands(spark, sf), text.clean_name(col("name")), col("name"))


@query("a5_ambiguous_names", O.sql(
    f"select name_clean_candidate, count(*) as n_original_variants from {_PAIRS} group by 1 having count(*) > 1"))
def ambiguous_names(spark, sf):
    return D.ambiguous_names(_name_pairs(spark, sf))


@query("a6_variant_examples_j1", O.sql(
    f"select * from (select name_clean_candidate, original, count(*) over (partition by name_clean_candidate) as n_original_variants from {_PAIRS}) "
    f"where n_original_variants > 1"))
def variant_examples(spark, sf):
    return D.variant_examples(_name_pairs(spark, sf))


@query("a7_audit_labels", O.sql(
    f"select price_label, count(*) as count from (select unnest(string_split({O.normal_labels('price_category')}, ';')) as price_label "
    f"from brands) group by 1"))
def audit_labels(spark, sf):
    return P.audit_labels(brands(spark, sf))


_LABELS = ("select label, count(*) as count, round(count(*)::double / (select count(*) from {src}), 6) as rate "
           "from (select unnest(list_concat({known}, {unexpected})) as label from {src}) group by 1")


@query("a7_label_distribution", O.sql(_LABELS.format(
    src="prep", known=O.known_labels("price_category"), unexpected=O.unexpected_labels("price_category"))))
def label_distribution(spark, sf):
    return rounded(P.label_distribution(prepared(spark, sf)))


@query("a7_label_distribution_unexpected", O.sql(_LABELS.format(
    src="brands", known=O.known_labels(_MIXED), unexpected=O.unexpected_labels(_MIXED))))
def label_distribution_unexpected(spark, sf):
    return rounded(P.label_distribution(brands(spark, sf).withColumn("price_category", F.expr(_MIXED))))


def _distribution(column):
    @query(f"a8_distribution_{column}", O.sql(
        f"select {column}, count(*) as count, round(count(*)::double / (select count(*) from prep), 6) as rate "
        f"from prep group by {column}"))
    def run(spark, sf):
        return rounded(P.distribution(prepared(spark, sf), column))
    return run


_distribution("domain")
_distribution("price_category")


@query("a8_distribution_returnflag",
       "select l_returnflag, count(*) as count, round(count(*)::double / (select count(*) from lineitem), 6) as rate "
       "from lineitem group by 1")
def returnflags(spark, sf):
    return rounded(P.distribution(table(spark, sf, "lineitem"), "l_returnflag"))


@query("a9_decades", O.sql(
    "select (floor(founded / 10) * 10)::bigint as decade, count(*) as count, round(count(*)::double / "
    "(select greatest(1, count(founded)) from prep), 6) as rate from prep where founded is not null group by 1"))
def decades(spark, sf):
    return rounded(P.decade_distribution(prepared(spark, sf), col("founded")))


# --- numbers ----------------------------------------------------------------

_NUMERIC = ["founded", "presence_world", "plans", "total_rented_area", "presence_own", "presence_franchise", "n_regions",
            "desc_len", "desc_has_digits", "desc_year_mentions", "has_total_rented_area"]


def _numeric_sql(source, columns):
    return union(
        f"select '{c}' as \"column\", count({c}) as count_non_null, min({c})::double as min, "
        f"round(quantile_cont({c}::double, 0.25), 6) as p25, round(quantile_cont({c}::double, 0.5), 6) as median, "
        f"round(quantile_cont({c}::double, 0.75), 6) as p75, max({c})::double as max, round(avg({c}), 6) as mean from {source}"
        for c in columns)


@query("a10_numeric_summary", O.sql(_numeric_sql("prep", _NUMERIC)))
def numeric_summary(spark, sf):
    return rounded(P.numeric_summary(prepared(spark, sf), {c: col(c) for c in _NUMERIC}))


_LINE = ["l_quantity", "l_extendedprice", "l_discount"]


@query("a10_numeric_summary_lineitem", _numeric_sql("lineitem", _LINE))
def numeric_lineitem(spark, sf):
    return rounded(P.numeric_summary(table(spark, sf, "lineitem"), {c: col(c) for c in _LINE}))


@query("a10_range_quantiles_lineitem",
       union(f"select '{c}' as \"column\", round(quantile_cont({c}, 0.1), 6) as p10, round(quantile_cont({c}, 0.5), 6) as p50, "
             f"round(quantile_cont({c}, 0.99), 6) as p99 from lineitem" for c in _LINE))
def range_quantiles(spark, sf):
    """Many ranges: few distinct values to a range, and every probability."""
    freq = Q.value_frequencies(table(spark, sf, "lineitem"), {c: col(c) for c in _LINE})
    q = Q.exact_quantiles(freq, [0.1, 0.5, 0.99], range_rows=50)
    return rounded(q.select("column", *[col("q")[i].alias(n) for i, n in enumerate(["p10", "p50", "p99"])]))


_TEXT = ["name", "name_clean", "description", "country_origin", "domain", "price_category"]


def _text_sql(source, columns):
    return union(
        f"select '{c}' as \"column\", count(*) filter ({O.blank(c)}) as empty_count, "
        f"round(count(*) filter ({O.blank(c)})::double / count(*), 6) as empty_rate, "
        f"round(avg(length(coalesce({c}, ''))), 6) as avg_length, "
        f"round(quantile_cont(length(coalesce({c}, ''))::double, 0.5), 6) as median_length, "
        f"count(distinct coalesce({c}, '')) as n_unique from {source}" for c in columns)


@query("a11_text_quality", O.sql(_text_sql("prep", _TEXT)))
def text_quality(spark, sf):
    return rounded(P.text_quality(prepared(spark, sf), _TEXT))


@query("a11_text_quality_documents", _text_sql("documents", ["text", "lang", "source"]))
def text_quality_documents(spark, sf):
    return rounded(P.text_quality(documents(spark, sf), ["text", "lang", "source"]))


@query("a12_founded_summary", O.sql(
    "select count(*) as rows_total, count(founded) as rows_non_null, count(*) filter (founded < 1850) as rows_lt_1850, "
    "count(*) filter (founded > 2025) as rows_gt_2025, min(founded) as min, quantile_cont(founded, 0.5) as median, "
    "max(founded) as max from prep"))
def founded_summary(spark, sf):
    return P.founded_summary(brands(spark, sf), to_number(col("founded")))


def _description_sql(source, c):
    s = f"coalesce({O.strip(c)}, '')"
    return (f"select count(*) as rows_total, count(*) filter (d = '') as rows_empty, "
            f"round(count(*) filter (d = '')::double / count(*), 6) as empty_rate, round(avg(length(d)), 6) as mean_len, "
            f"quantile_cont(length(d)::double, 0.5) as median_len, max(length(d)) as max_len, "
            f"round(avg({O.word_count('d')}), 6) as mean_word_count, quantile_cont({O.word_count('d')}::double, 0.5) as median_word_count, "
            f"sum({O.has_digit('d')})::bigint as rows_with_digits, count(*) filter ({O.year_mentions('d')} > 0) as rows_with_year_mentions "
            f"from (select {s} as d from {source})")


@query("a13_description_summary", O.sql(_description_sql("brands", "description")))
def description_summary(spark, sf):
    return rounded(P.description_summary(brands(spark, sf), col("description")))


@query("a13_description_summary_documents", _description_sql("documents", "text"))
def description_summary_documents(spark, sf):
    return rounded(P.description_summary(documents(spark, sf), col("text")))


def _buckets_sql(source, value, buckets):
    return union(f"select '{name}' as bucket, count(*) filter ({condition}) as count from (select {value} as v from {source})"
                 for name, condition in buckets)


_LENGTHS = [("0", "v = 0"), ("1_50", "v between 1 and 50"), ("51_150", "v between 51 and 150"),
            ("151_300", "v between 151 and 300"), ("301_600", "v between 301 and 600"), ("600_plus", "v > 600")]


@query("a14_length_histogram", O.sql(_buckets_sql("brands", f"length(coalesce({O.strip('description')}, ''))", _LENGTHS)))
def length_histogram(spark, sf):
    return P.length_histogram(brands(spark, sf), col("description"))


@query("a14_length_histogram_documents", _buckets_sql("documents", f"length(coalesce({O.strip('text')}, ''))", _LENGTHS))
def length_histogram_documents(spark, sf):
    return P.length_histogram(documents(spark, sf), col("text"))


_AREAS = [("0_1000", "v >= 0 and v <= 1000"), ("1000_5000", "v > 1000 and v <= 5000"),
          ("5000_10000", "v > 5000 and v <= 10000"), ("10000_50000", "v > 10000 and v <= 50000"),
          ("50000_100000", "v > 50000 and v <= 100000"), ("100000_plus", "v > 100000")]


@query("a15_area_histogram", O.sql(_buckets_sql("prep", "total_rented_area", _AREAS)))
def area_histogram(spark, sf):
    return P.area_histogram(brands(spark, sf), to_number(col("total_rented_area")))


@query("n10_area_histogram_whole", O.sql(_buckets_sql("prep", "total_rented_area + 0.5", [
    ("0_1000", "v between 0 and 1000"), ("1001_5000", "v between 1001 and 5000"), ("5001_10000", "v between 5001 and 10000"),
    ("10001_50000", "v between 10001 and 50000"), ("50001_100000", "v between 50001 and 100000"), ("100000_plus", "v > 100000")])))
def area_histogram_whole(spark, sf):
    return P.area_histogram_whole(brands(spark, sf), to_number(col("total_rented_area")) + 0.5)


@query("a15_area_summary", O.sql(
    "select count(*) as rows_total, count(total_rented_area) as rows_known, "
    "round(count(total_rented_area)::double / count(*), 6) as known_rate, count(*) - count(total_rented_area) as rows_missing, "
    "count(*) filter (total_rented_area = 0) as rows_zero, count(*) filter (total_rented_area < 0) as rows_negative, "
    "min(total_rented_area) as min, round(quantile_cont(total_rented_area, 0.25), 6) as p25, "
    "round(quantile_cont(total_rented_area, 0.5), 6) as median, round(quantile_cont(total_rented_area, 0.75), 6) as p75, "
    "max(total_rented_area) as max, round(avg(total_rented_area), 6) as mean from prep"))
def area_summary(spark, sf):
    return rounded(P.area_summary(brands(spark, sf), to_number(col("total_rented_area"))))


@query("a16_year_mentions", O.sql(
    f"select {O.year_mentions('description')} as year_mentions_count, count(*) as rows from brands group by 1"))
def year_mention_histogram(spark, sf):
    return P.year_mention_histogram(brands(spark, sf), col("description"))


@query("a17_presence_summary", O.sql(
    "select count(*) as rows_total, count(presence_russia) as rows_non_null_raw, count(presence_own) as presence_own_non_null, "
    "count(presence_franchise) as presence_franchise_non_null from prep"))
def presence_summary(spark, sf):
    return P.presence_summary(brands(spark, sf), col("presence_russia"))


@query("a17_region_summary", O.sql(
    "select count(*) as rows_total, count(presence_regions) as rows_non_null_raw, round(avg(n_regions), 6) as mean_n_regions, "
    "quantile_cont(n_regions::double, 0.5) as median_n_regions, max(n_regions)::bigint as max_n_regions from prep"))
def region_summary(spark, sf):
    return rounded(P.region_summary(brands(spark, sf), col("presence_regions")))


@query("a17_count_summaries", O.sql(union(
    f"select '{c}' as \"column\", count(*) as rows_total, count({c}) as rows_non_null, count(*) filter ({c} < 0) as negative_count, "
    f"min({c}) as min, quantile_cont({c}, 0.5) as median, max({c}) as max from prep" for c in ["presence_world", "plans"])))
def count_summaries(spark, sf):
    return P.count_summary(brands(spark, sf), {c: to_number(col(c)) for c in ["presence_world", "plans"]})


@query("a18_known_rate_by_domain", O.sql(
    f"select coalesce(domain, 'MISSING') as domain, count(*) as rows_total, count({O.number('total_rented_area')}) as rows_known, "
    f"round(count({O.number('total_rented_area')})::double / count(*), 6) as known_rate from brands group by 1"))
def known_rate(spark, sf):
    return rounded(P.known_rate_by(brands(spark, sf), col("domain"), to_number(col("total_rented_area"))))


def _anomalies(last_year, price):
    lines = [("founded_lt_1850", "count(*) filter (founded < 1850)"),
             (f"founded_gt_{last_year}", f"count(*) filter (founded > {last_year})"),
             ("founded_missing", "count(*) - count(founded)"),
             ("presence_world_negative", "count(*) filter (presence_world < 0)"),
             ("plans_negative", "count(*) filter (plans < 0)"),
             ("total_rented_area_negative", "count(*) filter (total_rented_area < 0)"),
             ("total_rented_area_known_count", "count(total_rented_area)"),
             ("total_rented_area_known_rate", "count(total_rented_area)::double / count(*)"),
             ("description_empty", f"count(*) filter ({O.blank('description')})")]
    if price:
        lines.append(("price_category_unknown_only", "count(*) filter (len(labels) = 0)"))
    return union(f"select '{m}' as metric, round(({x})::double, 6) as value from price_all" for m, x in lines)


@query("a19_anomalies", O.sql(_anomalies(2025, True)))
def anomalies(spark, sf):
    return rounded(P.anomaly_report(prepared(spark, sf)))


@query("n11_anomalies_2026", O.sql(_anomalies(2026, False)))
def anomalies_2026(spark, sf):
    return rounded(P.anomaly_report(prepared(spark, sf), 2026, price=False))


# --- duplicates and conflicts -----------------------------------------------

@query("a20_exact_name_duplicates", O.sql(
    "select name, count(*) as rows from prep where name is not null group by 1 having count(*) > 1"))
def exact_duplicates(spark, sf):
    return D.repeated(prepared(spark, sf), "name")


@query("a20_clean_name_duplicates", O.sql("select name_clean, count(*) as rows from prep group by 1 having count(*) > 1"))
def clean_duplicates(spark, sf):
    return D.repeated(prepared(spark, sf), "name_clean")


@query("a20_ambiguous_clean_names", O.sql(
    "select name_clean, count(distinct name) as n_original_name_variants from prep group by 1 having count(distinct name) > 1"))
def ambiguous_clean(spark, sf):
    return D.variants(prepared(spark, sf), ["name_clean"], col("name"), "n_original_name_variants")


_KEYS = ["name", "country_origin", "domain", "price_category"]
_CONFLICT = ("select name, country_origin, domain, price_category, count(distinct {year}) as n_founded_variants from {src} "
             "where name is not null and country_origin is not null and domain is not null and price_category is not null "
             "group by 1, 2, 3, 4 having count(distinct {year}) > 1")


@query("a21_founded_conflicts_raw", O.sql(_CONFLICT.format(src="brands", year=O.number("founded"))))
def conflicts_raw(spark, sf):
    return D.variants(brands(spark, sf), _KEYS, to_number(col("founded")), "n_founded_variants")


@query("a21_founded_conflicts", O.sql(_CONFLICT.format(src="prep", year="founded")))
def conflicts(spark, sf):
    return D.variants(prepared(spark, sf), _KEYS, col("founded"), "n_founded_variants")


def _name_conflict(column, name):
    @query(f"a22_name_{column}_conflicts", O.sql(
        f"select name_clean, count(distinct {column}) as {name} from prep group by 1 having count(distinct {column}) > 1"))
    def run(spark, sf):
        return D.variants(prepared(spark, sf), ["name_clean"], col(column), name)
    return run


_name_conflict("domain", "n_domain_variants")
_name_conflict("country_origin", "n_country_variants")


@query("a21_orders_status_conflicts",
       "select o_custkey, count(distinct o_orderstatus) as n_statuses from orders group by 1 having count(distinct o_orderstatus) > 1")
def order_conflicts(spark, sf):
    return D.variants(table(spark, sf, "orders"), ["o_custkey"], col("o_orderstatus"), "n_statuses")


# --- sorted and top-k -------------------------------------------------------

@query("o1_sorted_missing_rank", O.sql(
    "select \"column\", row_number() over (order by missing_rate desc, missing_count desc, \"column\")::int as place from ("
    + _missing_sql("brands", [(c, "string") for c in CANONICAL_COLUMNS]) + ")"))
def sorted_rank(spark, sf):
    """The report's order, made visible as a place; eleven rows."""
    report = P.missing_report(brands(spark, sf), CANONICAL_COLUMNS)
    order = F.row_number().over(Window.orderBy(F.desc("missing_rate"), F.desc("missing_count"), "column"))
    return report.select("column", order.alias("place"))


def _length_sql(order, where):
    s = f"coalesce({O.strip('text')}, '')"
    return (f"select doc_id, d as text, length(d)::int as text_len from (select doc_id, {s} as d from documents) "
            f"where {where} order by length(d) {order}, doc_id limit 50")


@query("o2_longest_documents", _length_sql("desc", "true"))
def longest(spark, sf):
    return P.by_length(documents(spark, sf), "doc_id", col("text"))


@query("o2_shortest_documents", _length_sql("asc", "length(d) > 0"))
def shortest(spark, sf):
    return P.by_length(documents(spark, sf), "doc_id", col("text"), longest=False)


@query("o2_longest_descriptions", O.sql(
    f"select row_id, d as text, length(d)::int as text_len from (select row_id, coalesce({O.strip('description')}, '') as d from brands) "
    f"order by length(d) desc, row_id limit 50"))
def longest_descriptions(spark, sf):
    return P.by_length(brands(spark, sf), "row_id", col("description"))


@query("o3_largest_areas", O.sql(
    "select row_id, name, domain, plans, total_rented_area from prep where total_rented_area is not null "
    "order by total_rented_area desc, row_id limit 50"))
def largest_areas(spark, sf):
    return P.largest(prepared(spark, sf), "total_rented_area", ["row_id", "name", "domain", "plans", "total_rented_area"], "row_id")


# --- readiness and gate -----------------------------------------------------

def _line(section, metric, value):
    return f"select '{section}' as section, '{metric}' as metric, ({value})::double as value"


_READINESS = union([
    _line("dataset", "rows_total", "select count(*) from prep"),
    _line("domain_task", "rows_non_null_target", "select count(domain) from prep"),
    _line("domain_task", "rows_after_drop_unknown", "select count(*) from known_domain"),
    _line("domain_task", "n_classes_all", "select count(distinct domain) from known_domain"),
    _line("domain_task", "n_classes_ge_5", "select count(distinct domain) from domain_rows"),
    _line("domain_task", "rows_after_drop_rare_classes", "select count(*) from domain_rows"),
    _line("founded_task", "rows_non_null_target", "select count(founded) from prep"),
    _line("founded_task", "rows_in_valid_range_1850_2025", "select count(*) from founded_rows"),
    _line("price_category_task", "rows_non_null_target", "select count(price_category) from prep"),
    _line("price_category_task", "rows_unknown_only", "select count(*) from price_all where len(labels) = 0"),
    _line("price_category_task", "rows_after_drop_unknown_only", "select count(*) from price_rows"),
    _line("price_category_task", "n_known_labels", "5"),
    _line("price_category_task", "n_unique_combinations", "select count(distinct array_to_string(labels, ';')) from price_rows"),
    *[_line("price_category_task", f"known_label_support:{x}", f"select count(*) from price_rows where list_contains(labels, '{x}')")
      for x in KNOWN_PRICE_LABELS],
    _line("price_category_task", "min_known_label_support", "select min(n) from (" + union(
        f"select count(*) as n from price_rows where list_contains(labels, '{x}')" for x in KNOWN_PRICE_LABELS) + ")"),
    _line("price_category_task", "n_unexpected_labels",
          f"select count(distinct l) from (select unnest({O.unexpected_labels('price_category')}) as l from prep)"),
])
_QA = union([
    _READINESS,
    _line("dataset", "rows_raw", "select count(*) from brands"), _line("dataset", "rows_prepared", "select count(*) from prep"),
    _line("dataset", "rows_gained_or_lost", "0"), _line("dataset", "columns_raw", "12"), _line("dataset", "columns_prepared", "20"),
    _line("schema", "missing_required_columns", "0"), _line("schema", "missing_canonical_columns", "0"),
    f"select 'anomaly' as section, metric, value from ({_anomalies(2025, True)})",
])


@query("a23_training_readiness", O.sql(_READINESS))
def readiness(spark, sf):
    return R.training_readiness(staged(prepared(spark, sf)))


def _qa_tables(spark, sf):
    """Raw and prepared rows, each written once for all measures."""
    raw = staged(raw_brands(spark, sf))
    return raw, staged(prepare_features(raw))


@query("a24_qa_metrics", O.sql(_QA))
def qa_metrics(spark, sf):
    return rounded(R.qa_metrics(*_qa_tables(spark, sf)))


_RAW_COLUMNS = ["row_id", "name", "contry_origin", *CANONICAL_COLUMNS[2:]]
_PREPARED_COLUMNS = ["row_id", "name", "country_origin", *CANONICAL_COLUMNS[2:], "name_clean", "presence_own", "presence_franchise",
                     "n_regions", "desc_len", "desc_has_digits", "desc_year_mentions", "has_total_rented_area"]
_TEXT_LINES = [("schema", "raw_columns", ", ".join(_RAW_COLUMNS)), ("schema", "prepared_columns", ", ".join(_PREPARED_COLUMNS)), ("schema", "required_columns_check", "OK"),
               ("target_contract", "unknown_domain_value", "Неизвестно"), ("target_contract", "unknown_price_label", "неизвестно"),
               ("target_contract", "known_price_labels", "; ".join(KNOWN_PRICE_LABELS))]


@query("a24_qa_summary", O.sql(
    f"select section, metric as key, (round(value * 1000000)::bigint)::varchar as value from ({_QA}) union all "
    + union(f"select '{a}', '{k}', '{v}'" for a, k, v in _TEXT_LINES)
    + f" union all select 'unexpected_label', l, count(*)::varchar from (select unnest({O.unexpected_labels('price_category')}) as l from prep) group by l"))
def qa_summary(spark, sf):
    """All lines of the summary; measured values as text in millionths."""
    summary = R.qa_summary(*_qa_tables(spark, sf))
    number = F.when(F.col("section") != "unexpected_label", F.expr("try_cast(value as double)"))
    return summary.select("section", "key", F.coalesce(F.round(number * 1000000).cast("bigint").cast("string"), "value").alias("value"))


def _gate_sql():
    rules = union(f"select '{r}' as rule, '{s}' as severity, '{a}' as section, '{m}' as metric, '{o}' as operator, {x}::double as \"limit\""
                  for r, s, a, m, o, x in R.GATE_RULES)
    return (f"select rule, severity, coalesce(value, 0.0::double) as value, operator, \"limit\", "
            f"(case operator when '>=' then coalesce(value, 0) >= \"limit\" else coalesce(value, 0) <= \"limit\" end)::int as passed "
            f"from ({rules}) left join ({_QA}) using (section, metric)")


@query("g1_data_gate", O.sql(_gate_sql()))
def data_gate(spark, sf):
    return rounded(R.data_gate(R.qa_metrics(*_qa_tables(spark, sf))))


_OLD_READINESS = union([
    _line("dataset", "rows_total", "select count(*) from brands"),
    _line("domain_task", "rows_non_null_target", "select count(domain) from brands"),
    _line("domain_task", "n_classes_all", f"select count(distinct {O.strip('domain')}) from brands"),
    _line("domain_task", "n_classes_ge_5", f"select count(*) from (select {O.strip('domain')} as d from brands where domain is not null group by 1 having count(*) >= 5)"),
    _line("domain_task", "rows_after_drop_rare_classes", f"select sum(n) from (select {O.strip('domain')} as d, count(*) as n from brands where domain is not null group by 1 having count(*) >= 5)"),
    _line("price_category_task", "rows_non_null_target", "select count(*) from brands where coalesce(price_category, 'неизвестно') <> ''"),
    _line("price_category_task", "n_unique_combinations", "select count(distinct coalesce(price_category, 'неизвестно')) from brands"),
])


@query("n8_readiness_raw_values", O.sql(_OLD_READINESS))
def old_readiness(spark, sf):
    return R.readiness_raw_values(brands(spark, sf))


@query("n8_label_distribution_raw_values", O.sql(
    f"select label, count(*) as count, round(count(*)::double / (select count(*) from brands), 6) as rate from "
    f"(select unnest(list_filter(list_transform(string_split(coalesce(price_category, 'неизвестно'), ';'), lambda p: {O.strip('p')}), "
    f"lambda p: p <> '')) as label from brands) group by 1"))
def old_labels(spark, sf):
    return rounded(P.label_distribution_raw_values(brands(spark, sf)))


@query("n9_clean_name_without_yo", O.sql(
    f"select row_id, {O.clean_name('replace(replace(name, chr(1105), chr(32)), chr(1025), chr(32))')} as name_clean from brands"))
def name_without_yo(spark, sf):
    return brands(spark, sf).select("row_id", text.clean_name(col("name"), yo=False).alias("name_clean"))
