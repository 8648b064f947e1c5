"""Queries for sources, schema operators, scalar functions and row filters."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from brandlens.contract import (
    CANONICAL_COLUMNS, FORBIDDEN_FEATURES, KNOWN_PRICE_LABELS, REQUIRED_COLUMNS, SAFE_FEATURES, TARGET_COLUMNS, check_feature_contract,
    label_column,
)
from brandlens.functions import labels, numbers, text
from brandlens.operators import checks, prepare, profile, quality, schema, split
from brandlens.plans import oracle as O
from brandlens.plans.registry import brands, prepared, query, table
from brandlens.sources import csv_files
from brandlens.sources.brands import documents, raw_brands
from brandlens.sources.staging import shared_folder

ROW = ["row_id"]


# --- sources and schema -----------------------------------------------------

@query("s1_csv_round_trip", O.sql("select cast(row_id as varchar) as row_id, "
                                  + ", ".join(f"{O.na(c)} as {c}" for c in CANONICAL_COLUMNS) + " from brands"))
def csv_round_trip(spark, sf):
    path = f"{shared_folder(spark)}/brands-{uuid.uuid4().hex}"
    csv_files.write_table(brands(spark, sf).select("row_id", *CANONICAL_COLUMNS), path, "csv")
    return csv_files.read_brand_csv(spark, path)


@query("s2_harmonized_schema", O.sql("select row_id, country_origin from brands"))
def harmonized(spark, sf):
    return schema.harmonize(raw_brands(spark, sf)).select("row_id", "country_origin")


@query("s4_filled_feature_columns", O.sql(
    "select row_id, '' as description, 'Неизвестно' as country_origin, cast(null as double) as plans, name_clean from prep"))
def filled_columns(spark, sf):
    df = prepared(spark, sf).select("row_id", "name_clean")
    return schema.fill_feature_columns(df).select("row_id", "description", "country_origin", "plans", "name_clean")


@query("s5_model_input", O.sql(
    "select row_id, coalesce(description, '') as description, name_clean, country_origin, presence_world, plans, "
    "presence_own, presence_franchise, n_regions::double as n_regions, desc_len::double as desc_len, "
    "desc_has_digits::double as desc_has_digits, desc_year_mentions::double as desc_year_mentions from prep"))
def model_input(spark, sf):
    return schema.model_input(prepared(spark, sf), keep=ROW)


@query("s7_json_summary", O.sql("select 'desc_len' as key, sum(desc_len)::bigint as value from prep "
                                "union all select 'rows', count(*) from prep"))
def json_summary(spark, sf):
    path = f"{shared_folder(spark)}/summary-{uuid.uuid4().hex}"
    totals = prepared(spark, sf).agg(F.sum("desc_len").alias("desc_len"), F.count(F.lit(1)).alias("rows"))
    csv_files.write_table(totals.select(F.explode(F.create_map(
        F.lit("desc_len"), "desc_len", F.lit("rows"), "rows")).alias("key", "value")), path, "json")
    return spark.read.schema("key string, value bigint").json(path)


def _line(columns):
    fields = ", ".join(f"coalesce(length(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')" for c in columns)
    return f"concat_ws('|', {fields})"


_LINE = _line(CANONICAL_COLUMNS)


@query("s8_fingerprint", O.sql(f"select count(*) as n_rows, sum({O.hash32(_LINE)})::varchar as digest from brands"))
def fingerprint(spark, sf):
    return quality.fingerprint(brands(spark, sf), CANONICAL_COLUMNS)


_LI = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag"]


@query("s8_fingerprint_by_status", "select l_linestatus, count(*) as n_rows, sum("
       + O.hash32(_line(_LI))
       + ")::varchar as digest from lineitem group by l_linestatus")
def fingerprint_lineitem(spark, sf):
    return quality.fingerprint(table(spark, sf, "lineitem"), _LI, ["l_linestatus"])


@query("s9_preview", O.sql("select row_id, name, presence_own, presence_franchise, n_regions from prep order by row_id limit 200"))
def preview(spark, sf):
    return profile.preview(prepared(spark, sf), "row_id",
                           ["row_id", "name", "presence_own", "presence_franchise", "n_regions"], 200)


@query("s10_seeded_sample", O.sql(
    f"select row_id, name from brands order by {O.hash32(O.keyed('row_id', 42))}, row_id limit 20"))
def sample(spark, sf):
    return split.seeded_sample(brands(spark, sf), 20).select("row_id", "name")


@query("s11_dropped_columns", O.sql("select row_id, name, country_origin, presence_world, presence_russia, "
                                    "presence_regions, plans from brands"))
def dropped(spark, sf):
    return brands(spark, sf).drop(*TARGET_COLUMNS, "description", "total_rented_area", "no_such_column").select(
        "row_id", "name", "country_origin", "presence_world", "presence_russia", "presence_regions", "plans")


_RAW_ORDER = ["name", "contry_origin", *CANONICAL_COLUMNS[2:]]
_PREP_ORDER = ["name", "country_origin", *CANONICAL_COLUMNS[2:], "name_clean", "presence_own", "presence_franchise",
               "n_regions", "desc_len", "desc_has_digits", "desc_year_mentions", "has_total_rented_area"]


@query("s12_schema_report", O.sql(
    f"select '{', '.join(_RAW_ORDER)}' as raw_columns, '{', '.join(_PREP_ORDER)}' as prepared_columns, "
    f"'' as missing_required_columns, '' as missing_canonical_columns, '{', '.join(_PREP_ORDER[11:])}' as extra_columns, "
    f"11 as raw_n_columns, 19 as prepared_n_columns, count(*) as n_rows from prep"))
def schema_report(spark, sf):
    raw = raw_brands(spark, sf).select(*_RAW_ORDER)
    return schema.schema_report(raw, prepare.prepare_features(raw))


_J7 = ([("both", c) for c in ["row_id", "name", *CANONICAL_COLUMNS[2:]]] + [("left_only", "contry_origin")]
       + [("right_only", c) for c in ["country_origin", *_PREP_ORDER[11:]]])


@query("j7_column_sets", " union all ".join(f"select '{s}' as side, '{c}' as \"column\"" for s, c in _J7))
def column_sets(spark, sf):
    """Columns that the raw and the prepared table share, and those that only one of them has."""
    raw = raw_brands(spark, sf)
    return checks.column_sets(raw, prepare.prepare_features(raw))


# --- text functions ---------------------------------------------------------

def _by_row(name, select, oracle_select):
    """Register a row-wise query over the brand table."""
    @query(name, O.sql(f"select row_id, {oracle_select} from brands"))
    def run(spark, sf):
        return brands(spark, sf).select("row_id", *select())
    return run


_by_row("f1_basic_text", lambda: [text.basic_text(F.col("name")).alias("name_basic")],
        f"{O.basic('name')} as name_basic")
_by_row("f2_clean_name", lambda: [text.clean_name(F.col("name")).alias("name_clean")],
        f"{O.clean_name('name')} as name_clean")
_by_row("f3_country", lambda: [text.country(F.col("country_origin")).alias("country")],
        f"{O.country('country_origin')} as country")
_by_row("f4_country_key", lambda: [text.country_key(F.col("country_origin")).alias("country_key")],
        f"{O.country_key('country_origin')} as country_key")
_by_row("f5_domain", lambda: [text.domain(F.col("domain")).alias("domain")], f"{O.domain('domain')} as domain")
_by_row("f6_domain_key", lambda: [text.domain_key(F.col("domain")).alias("domain_key")],
        f"{O.domain_key('domain')} as domain_key")
_by_row("f7_price_labels", lambda: [labels.normal_labels(F.col("price_category")).alias("labels")],
        f"{O.normal_labels('price_category')} as labels")
# The trimmed domain is appended to the labels of every third row, so that some are unexpected.
_MIXED = "case when row_id % 3 = 0 then concat_ws(';', price_category, domain) else price_category end"
_by_row("f8_known_and_unexpected_labels", lambda: [
    F.array_join(labels.split_labels(F.expr(_MIXED))["known"], ";").alias("known"),
    F.array_join(labels.split_labels(F.expr(_MIXED))["unexpected"], ";").alias("unexpected")],
    f"array_to_string({O.known_labels(_MIXED)}, ';') as known, array_to_string({O.unexpected_labels(_MIXED)}, ';') as unexpected")
_by_row("f9_presence_pair", lambda: [numbers.presence_pair(F.col("presence_russia"))["own"].alias("own"),
                                               numbers.presence_pair(F.col("presence_russia"))["franchise"].alias("franchise")],
        f"{O.own('presence_russia')} as own, {O.franchise('presence_russia')} as franchise")
_by_row("f10_item_count", lambda: [labels.item_count(F.col("presence_regions")).alias("n_regions")],
        f"{O.item_count('presence_regions')} as n_regions")
_by_row("f11_to_number", lambda: [numbers.to_number(F.col(c)).alias(c) for c in
                                            ["founded", "presence_world", "plans", "total_rented_area"]],
        ", ".join(f"{O.number(c)} as {c}" for c in ["founded", "presence_world", "plans", "total_rented_area"]))
_by_row("f12_to_f16_description", lambda: [
    text.char_count(F.col("description")).alias("desc_len"), text.word_count(F.col("description")).alias("words"),
    text.has_digit(F.col("description")).alias("has_digit"), text.year_mentions(F.col("description")).alias("years"),
    text.empty_flag(F.col("description")).alias("is_empty")],
    f"length(coalesce(description, ''))::int as desc_len, {O.word_count('description')} as words, "
    f"{O.has_digit('description')} as has_digit, {O.year_mentions('description')} as years, {O.blank('description')}::int as is_empty")
_by_row("f17_known_flag", lambda: [numbers.known_flag(F.col("total_rented_area")).alias("known")],
        "(total_rented_area is not null)::int as known")
_by_row("f18_decade", lambda: [numbers.decade(numbers.to_number(F.col("founded"))).alias("decade")],
        f"(floor({O.number('founded')} / 10) * 10)::bigint as decade")
_by_row("f19_clip", lambda: [numbers.clip(numbers.to_number(F.col("founded"))).alias("year")],
        f"case when {O.number('founded')} is not null then {O.inside(O.number('founded'), 1850, 2025)} end as year")
_by_row("f20_round_half_even", lambda: [numbers.round_half_even(numbers.to_number(F.col("plans")) / 4).alias("q")],
        f"round_even({O.number('plans')} / 4, 0)::int as q")
_by_row("f22_missing_text", lambda: [text.missing_text(F.col("description")).cast("int").alias("missing")],
        f"{O.missing('description')}::int as missing")
_by_row("f25_finite", lambda: [numbers.finite(F.when(F.col("row_id") % 5 == 0, F.lit(float("nan")))
                                                        .otherwise(numbers.to_number(F.col("plans")))).alias("value")],
        f"case when row_id % 5 <> 0 then {O.number('plans')} end as value")
_by_row("f26_log1p_expm1", lambda: [
    F.round(F.log1p(numbers.to_number(F.col("plans"))), 6).alias("logged"),
    F.round(F.expm1(F.log1p(numbers.to_number(F.col("plans")))), 6).alias("back")],
    f"round(ln(1 + {O.number('plans')}), 6) as logged, round(exp(ln(1 + {O.number('plans')})) - 1, 6) as back")
_by_row("f27_labels_text", lambda: [
    labels.indicators_text(labels.indicators(labels.known_labels(F.col("price_category")))).alias("labels")],
    "coalesce(nullif(array_to_string(list_filter([" + O.texts(KNOWN_PRICE_LABELS) + "], lambda l: list_contains("
    + O.known_labels("price_category") + ", l)), '; '), ''), 'неизвестно') as labels")


@query("f1_basic_text_documents", f"select doc_id, {O.basic('text')} as normalized from documents")
def basic_documents(spark, sf):
    return documents(spark, sf).select("doc_id", text.basic_text(F.col("text")).alias("normalized"))


@query("f12_to_f16_documents",
       f"select doc_id, length(coalesce(text, ''))::int as chars, {O.word_count('text')} as words, "
       f"{O.has_digit('text')} as has_digit, {O.year_mentions('text')} as years, {O.blank('text')}::int as is_empty from documents")
def measured_documents(spark, sf):
    c = F.col("text")
    return documents(spark, sf).select(
        "doc_id", text.char_count(c).alias("chars"), text.word_count(c).alias("words"), text.has_digit(c).alias("has_digit"),
        text.year_mentions(c).alias("years"), text.empty_flag(c).alias("is_empty"))


# --- preparation and row filters -------------------------------------------

_P1 = ["row_id", "name_clean", "country_origin", "domain", "price_category", "founded", "presence_world", "plans",
       "total_rented_area", "presence_own", "presence_franchise", "n_regions", "desc_len", "desc_has_digits",
       "desc_year_mentions", "has_total_rented_area"]


@query("p1o_prepared_features", O.sql(f"select {', '.join(_P1)} from prep"))
def prepared_features(spark, sf):
    return prepared(spark, sf).select(*_P1)


@query("p2o_features_without_target", O.sql(f"select {', '.join(c for c in _P1 if c != 'founded')} from prep"))
def without_target(spark, sf):
    return prepare.features_without(raw_brands(spark, sf), "founded").select(*[c for c in _P1 if c != "founded"])


@query("p3o_domain_rows", O.sql("select row_id, domain from domain_rows"))
def domain_rows(spark, sf):
    return prepare.domain_rows(prepared(spark, sf).select("row_id", "domain"))


@query("p4o_founded_rows", O.sql("select row_id, founded from founded_rows"))
def founded_rows(spark, sf):
    return prepare.founded_rows(prepared(spark, sf)).select("row_id", "founded")


@query("p5o_price_rows", O.sql("select row_id, array_to_string(labels, ';') as labels from price_rows"))
def price_rows(spark, sf):
    return prepare.price_rows(prepared(spark, sf)).select("row_id", F.array_join("labels", ";").alias("labels"))


@query("p5o_price_row_counts", O.sql(
    "select count(*) as rows_before_target_filter, count(*) filter (len(labels) = 0) as rows_unknown_only_dropped, "
    "count(*) filter (len(labels) > 0) as rows_after_target_filter from price_all"))
def price_counts(spark, sf):
    return prepare.price_row_counts(prepared(spark, sf))


@query("p5o_unexpected_labels", O.sql(
    f"select label, count(*) as rows from (select unnest({O.unexpected_labels(_MIXED)}) as label from brands) group by label"))
def unexpected(spark, sf):
    return prepare.unexpected_label_counts(brands(spark, sf).withColumn("price_category", F.expr(_MIXED)))


@query("p6o_founded_out_of_range", O.sql(
    f"select * from (select row_id, name, country_origin, domain, price_category, founded, {O.number('founded')} as founded_num "
    f"from brands) where founded_num < 1850 or founded_num > 2025"))
def out_of_range(spark, sf):
    return prepare.founded_out_of_range(brands(spark, sf))


_SUPPORT = " union all ".join(
    f"select {i} as label_idx, '{label}' as label, count(*) filter (list_contains(labels, '{label}')) as support, "
    f"(count(*) filter (list_contains(labels, '{label}')) >= 5)::int as enough from price_rows"
    for i, label in enumerate(KNOWN_PRICE_LABELS))


@query("p8o_label_support", O.sql(_SUPPORT))
def label_support(spark, sf):
    return prepare.label_support(prepare.price_rows(prepared(spark, sf)))


@query("p10o_range_and_member_filter", O.sql(
    "select row_id, founded, plans, presence_world from prep where founded between 1850 and 2020 and plans between 1 and 1000 "
    "and presence_world between 1 and 10000 and price_category in ('дисконт', 'ниже среднего')"))
def range_filters(spark, sf):
    return prepared(spark, sf).filter(
        F.col("founded").between(1850, 2020) & F.col("plans").between(1, 1000) & F.col("presence_world").between(1, 10000)
        & F.col("price_category").isin("дисконт", "ниже среднего")).select("row_id", "founded", "plans", "presence_world")


# --- contracts as tables ----------------------------------------------------

@query("s3_required_columns", O.sql(" union all ".join(
    f"select '{c}' as \"column\", 1 as present, count({c}) as non_null from brands" for c in REQUIRED_COLUMNS)))
def required_columns(spark, sf):
    """Each required column: whether the table has it, and how many rows fill it."""
    return schema.required_columns_report(brands(spark, sf), REQUIRED_COLUMNS)


@query("p7o_feature_contract", O.sql(" union all ".join(
    f"select '{c}' as \"column\", 'safe' as kind, 1 as present, count({c}) as non_null from prep" for c in SAFE_FEATURES)
    + " union all " + " union all ".join(f"select '{c}', 'forbidden', 0, 0" for c in FORBIDDEN_FEATURES)))
def feature_contract(spark, sf):
    """The model's input holds every safe feature and no forbidden one."""
    features = prepared(spark, sf).select(*SAFE_FEATURES)
    check_feature_contract(features.columns)
    safe = schema.required_columns_report(features, SAFE_FEATURES).withColumn("kind", F.lit("safe"))
    return safe.unionByName(schema.required_columns_report(features, FORBIDDEN_FEATURES).withColumn("kind", F.lit("forbidden")))


@query("f21_label_columns", O.sql(
    "select label, replace(replace(replace(label, ' / ', '_'), ' ', '_'), '-', '_') as column_name, count(*) as n_rows "
    f"from (select unnest({O.known_labels('price_category')}) as label from prep) group by 1"))
def label_columns(spark, sf):
    """The known labels, their column names, and the rows that have them."""
    names = F.create_map(*[x for label in KNOWN_PRICE_LABELS for x in (F.lit(label), F.lit(label_column(label)))])
    found = prepared(spark, sf).select(F.explode(labels.known_labels(F.col("price_category"))).alias("label"))
    return found.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("column_name", names[F.col("label")])
