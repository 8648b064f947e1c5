"""Profiling reports over one table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from brandlens.contract import MAX_FOUNDED_YEAR, MIN_FOUNDED_YEAR, UNKNOWN_PRICE_LABEL
from brandlens.functions import labels, numbers, text
from brandlens.operators import quantiles as Q
from brandlens.operators.literal import measure

QUARTILES = ([0.25, 0.5, 0.75], ["p25", "median", "p75"])
MEDIAN = ([0.5], ["median"])
BLANK = "#blank"


def n_rows() -> Column:
    return F.count(F.lit(1))


# --- missing values, distributions ----------------------------------------

def missing_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: nulls, their rate and the type. One aggregate for all columns."""
    types = dict(df.dtypes)
    columns = list(columns or df.columns)
    counts = df.agg(n_rows().alias("total"), *[F.count_if(F.col(c).isNull()).alias(f"m_{c}") for c in columns])
    report = counts.select("total", F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"m_{c}").alias("missing_count"), F.lit(types[c]).alias("dtype"))
        for c in columns
    ])))
    rate = F.coalesce(F.try_divide("missing_count", "total"), F.lit(0.0))
    return (report.select("column", "missing_count", rate.alias("missing_rate"), "dtype")
            .orderBy(F.desc("missing_rate"), F.desc("missing_count"), "column"))


def value_counts(df: DataFrame, value: Column, name: str, missing: str = "MISSING") -> DataFrame:
    """How often each value occurs, most frequent first; null counts as ``missing``."""
    return (df.select(F.coalesce(value.cast("string"), F.lit(missing)).alias(name))
            .groupBy(name).agg(n_rows().alias("count")).orderBy(F.desc("count"), name))


def with_rate(counts: DataFrame, total: Column) -> DataFrame:
    return counts.withColumn("rate", F.coalesce(F.try_divide(F.col("count"), total), F.lit(0.0)))


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Value counts with their share of all rows."""
    counts = (df.select(F.coalesce(F.col(column).cast("string"), F.lit("MISSING")).alias(column))
              .groupBy(column).agg(n_rows().alias("count")))
    return with_rate(counts, counts.agg(F.sum("count")).scalar()).orderBy(F.desc("count"), column)


def mapping_counts(df: DataFrame, raw: Column, norm: Column, raw_name: str, norm_name: str) -> DataFrame:
    """Which raw value became which normalized one, and how often."""
    return (df.select(F.coalesce(raw, F.lit("MISSING")).alias(raw_name), norm.alias(norm_name))
            .groupBy(raw_name, norm_name).agg(n_rows().alias("count"))
            .orderBy(norm_name, F.desc("count"), raw_name))


def audit_labels(df: DataFrame, column: str = "price_category") -> DataFrame:
    """Label counts with the unknown marker kept as a label."""
    found = labels.label_list(F.col(column))
    shown = F.when(F.size(found) == 0, F.array(labels.normal_labels(F.col(column)))).otherwise(found)
    return (df.select(F.explode(shown).alias("price_label")).groupBy("price_label")
            .agg(n_rows().alias("count")).orderBy(F.desc("count"), "price_label"))


def label_distribution(df: DataFrame, column: str = "price_category") -> DataFrame:
    """Known and unexpected label counts; the rate divides by all rows, labelled or not."""
    both = F.concat(labels.known_labels(F.col(column)), labels.unexpected_labels(F.col(column)))
    counts = df.select(F.explode(both).alias("label")).groupBy("label").agg(n_rows().alias("count"))
    return with_rate(counts, df.agg(n_rows()).scalar()).orderBy(F.desc("count"), "label")


def label_distribution_raw_values(df: DataFrame, column: str = "price_category") -> DataFrame:
    """Older rule: the raw text is split at semicolons only and null counts as unknown."""
    parts = F.transform(F.split(F.coalesce(F.col(column), F.lit(UNKNOWN_PRICE_LABEL)), ";"), text.strip)
    counts = (df.select(F.explode(F.filter(parts, lambda p: p != "")).alias("label"))
              .groupBy("label").agg(n_rows().alias("count")))
    return with_rate(counts, df.agg(n_rows()).scalar()).orderBy(F.desc("count"), "label")


def decade_distribution(df: DataFrame, year: Column) -> DataFrame:
    """Rows per decade and their share of the rows with a year."""
    counts = (df.select(numbers.decade(year).alias("decade")).filter("decade is not null")
              .groupBy("decade").agg(n_rows().alias("count")))
    return with_rate(counts, counts.agg(F.sum("count")).scalar()).orderBy("decade")


# --- numbers ---------------------------------------------------------------

def numeric_summary(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Per column: non-null count, minimum, quartiles, maximum, mean."""
    freq = Q.value_frequencies(df, columns)
    statistics = [Q.non_null().alias("count_non_null"), F.min("value").alias("min"),
                  F.max("value").alias("max"), Q.mean().alias("mean")]
    return Q.summarize(freq, statistics, *QUARTILES).select(
        "column", "count_non_null", "min", "p25", "median", "p75", "max", "mean"
    )


def founded_summary(df: DataFrame, year: Column) -> DataFrame:
    v = F.col("value")
    return Q.summarize(
        Q.value_frequencies(df, {"founded": year}),
        [Q.rows().alias("rows_total"), Q.non_null().alias("rows_non_null"),
         Q.rows_where(v < MIN_FOUNDED_YEAR).alias("rows_lt_1850"),
         Q.rows_where(v > MAX_FOUNDED_YEAR).alias("rows_gt_2025"),
         F.min("value").alias("min"), F.max("value").alias("max")],
        *MEDIAN,
    ).select("rows_total", "rows_non_null", "rows_lt_1850", "rows_gt_2025", "min", "median", "max")


def count_summary(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Per count column: rows, non-null, negative, minimum, median, maximum."""
    return Q.summarize(
        Q.value_frequencies(df, columns),
        [Q.rows().alias("rows_total"), Q.non_null().alias("rows_non_null"),
         Q.rows_where(F.col("value") < 0).alias("negative_count"),
         F.min("value").alias("min"), F.max("value").alias("max")],
        *MEDIAN,
    ).select("column", "rows_total", "rows_non_null", "negative_count", "min", "median", "max")


def area_summary(df: DataFrame, area: Column) -> DataFrame:
    v = F.col("value")
    known = Q.non_null()
    return Q.summarize(
        Q.value_frequencies(df, {"area": area}),
        [Q.rows().alias("rows_total"), known.alias("rows_known"),
         F.coalesce(F.try_divide(known, Q.rows()), F.lit(0.0)).alias("known_rate"),
         Q.rows_where(v.isNull()).alias("rows_missing"), Q.rows_where(v == 0).alias("rows_zero"),
         Q.rows_where(v < 0).alias("rows_negative"), F.min("value").alias("min"),
         F.max("value").alias("max"), Q.mean().alias("mean")],
        *QUARTILES,
    ).select("rows_total", "rows_known", "known_rate", "rows_missing", "rows_zero", "rows_negative",
             "min", "p25", "median", "p75", "max", "mean")


def bucket_counts(df: DataFrame, buckets: Sequence[tuple[str, Column]]) -> DataFrame:
    """Rows per named condition; every bucket appears, also with zero rows."""
    counts = df.agg(*[F.count_if(condition).alias(name) for name, condition in buckets])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("bucket"), F.col(f"`{name}`").alias("count")) for name, _ in buckets
    ])))


def length_histogram(df: DataFrame, c: Column) -> DataFrame:
    """Six fixed buckets over the stripped text length."""
    n = F.length(F.coalesce(text.strip(c), F.lit("")))
    return bucket_counts(df, [
        ("0", n == 0), ("1_50", n.between(1, 50)), ("51_150", n.between(51, 150)),
        ("151_300", n.between(151, 300)), ("301_600", n.between(301, 600)), ("600_plus", n > 600),
    ])


def area_histogram(df: DataFrame, v: Column) -> DataFrame:
    """Six fixed buckets over known areas, open below except the first."""
    def within(low: float, high: float) -> Column:
        return (v > low) & (v <= high)

    return bucket_counts(df, [
        ("0_1000", v.between(0, 1000)), ("1000_5000", within(1000, 5000)),
        ("5000_10000", within(5000, 10000)), ("10000_50000", within(10000, 50000)),
        ("50000_100000", within(50000, 100000)), ("100000_plus", v > 100000),
    ])


def area_histogram_whole(df: DataFrame, v: Column) -> DataFrame:
    """Older bucket edges on whole numbers: a value like 1000.5 falls in no bucket."""
    return bucket_counts(df, [
        ("0_1000", v.between(0, 1000)), ("1001_5000", v.between(1001, 5000)),
        ("5001_10000", v.between(5001, 10000)), ("10001_50000", v.between(10001, 50000)),
        ("50001_100000", v.between(50001, 100000)), ("100000_plus", v > 100000),
    ])


# --- text ------------------------------------------------------------------

def text_quality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per text column: blank rows, mean and median length, distinct values (null as empty)."""
    # One scan for lengths and blanks; a second one for the distinct values.
    freq = Q.value_frequencies(df, {c: text.char_count(F.col(c)) for c in columns}
                               | {c + BLANK: text.is_blank(F.col(c)).cast("int") for c in columns})
    is_flag = F.col("column").endswith(BLANK)
    blanks = (freq.filter(is_flag).groupBy(F.regexp_replace("column", BLANK + "$", "").alias("column"))
              .agg(Q.rows().alias("total"), Q.rows_where(F.col("value") == 1).alias("empty_count")))
    lengths = Q.summarize(freq.filter(~is_flag), [Q.mean().alias("avg_length")], [0.5], ["median_length"])
    # Long texts are compared by digest, so the distinct count does not shuffle whole texts.
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), text_identity(F.col(c)).alias("v")) for c in columns])
    distinct = df.select(F.inline(pairs)).groupBy("column").agg(F.countDistinct("v").alias("n_unique"))
    # One row per column on every side.
    return (F.broadcast(blanks).join(distinct, "column").join(F.broadcast(lengths), "column")
            .select("column", "empty_count",
                    F.coalesce(F.try_divide("empty_count", "total"), F.lit(0.0)).alias("empty_rate"),
                    "avg_length", "median_length", "n_unique")
            .orderBy(F.desc("empty_rate"), "column"))


def text_identity(c: Column) -> Column:
    """The text, or its SHA-256 where that is shorter; null as empty text."""
    value = F.coalesce(c.cast("string"), F.lit(""))
    return F.when(F.octet_length(value) <= 64, value).otherwise(F.sha2(value, 256))


def shown_text(df: DataFrame, c: Column) -> DataFrame:
    """The stripped text as a column of its own, so that it is made once per row."""
    return df.select(F.coalesce(text.strip(c), F.lit("")).alias("shown"))


def description_columns() -> dict[str, Column]:
    """Audit columns of a long text, over ``shown``."""
    shown = F.col("shown")
    return {
        "desc_len": F.length(shown),
        "desc_word_count": text.word_count(shown),
        "desc_has_digits": text.has_digit(shown),
        "desc_year_mentions": text.year_mentions(shown),
        "desc_is_empty": (shown == "").cast("int"),
    }


def description_summary(df: DataFrame, c: Column) -> DataFrame:
    """One row: blank texts, length and word statistics, rows with digits and with years."""
    freq = Q.value_frequencies(shown_text(df, c), description_columns())
    v = F.col("value")
    stats = Q.summarize(
        freq, [Q.rows().alias("rows"), F.max("value").alias("max"), Q.mean().alias("mean"),
               Q.rows_where(v > 0).alias("positive")], *MEDIAN)

    def pick(column: str, statistic: str) -> Column:
        return F.max(F.when(F.col("column") == column, F.col(statistic)))

    return stats.agg(
        pick("desc_len", "rows").alias("rows_total"),
        pick("desc_is_empty", "positive").alias("rows_empty"),
        pick("desc_is_empty", "mean").alias("empty_rate"),
        pick("desc_len", "mean").alias("mean_len"),
        pick("desc_len", "median").alias("median_len"),
        pick("desc_len", "max").cast("bigint").alias("max_len"),
        pick("desc_word_count", "mean").alias("mean_word_count"),
        pick("desc_word_count", "median").alias("median_word_count"),
        pick("desc_has_digits", "positive").alias("rows_with_digits"),
        pick("desc_year_mentions", "positive").alias("rows_with_year_mentions"),
    )


def year_mention_histogram(df: DataFrame, c: Column) -> DataFrame:
    return (shown_text(df, c).select(description_columns()["desc_year_mentions"].alias("year_mentions_count"))
            .groupBy("year_mentions_count").agg(n_rows().alias("rows")).orderBy("year_mentions_count"))


def by_length(df: DataFrame, key: str, c: Column, n: int = 50, longest: bool = True) -> DataFrame:
    """The n longest, or shortest non-empty, texts. Ties by key."""
    shown = F.coalesce(text.strip(c), F.lit(""))
    sized = df.select(key, shown.alias("text"), F.length(shown).alias("text_len"))
    if longest:
        return sized.orderBy(F.desc("text_len"), key).limit(n)
    return sized.filter("text_len > 0").orderBy("text_len", key).limit(n)


# --- presence and area -----------------------------------------------------

def presence_summary(df: DataFrame, c: Column) -> DataFrame:
    pair = numbers.presence_pair(c)
    return df.agg(
        n_rows().alias("rows_total"), F.count(c).alias("rows_non_null_raw"),
        F.count(pair["own"]).alias("presence_own_non_null"),
        F.count(pair["franchise"]).alias("presence_franchise_non_null"),
    )


def region_summary(df: DataFrame, c: Column) -> DataFrame:
    """Rows, filled rows, and mean, median and maximum of the list length."""
    freq = Q.value_frequencies(df.select(labels.item_count(c).alias("items"), c.isNotNull().alias("filled")),
                               {"items": F.col("items")}, keys=["filled"])
    stats = Q.summarize(
        freq, [Q.rows().alias("rows_total"), Q.rows_where(F.col("filled")).alias("rows_non_null_raw"),
                           Q.mean().alias("mean_n_regions"),
                           F.max("value").cast("bigint").alias("max_n_regions")],
        [0.5], ["median_n_regions"])
    return stats.select("rows_total", "rows_non_null_raw", "mean_n_regions", "median_n_regions", "max_n_regions")


def known_rate_by(df: DataFrame, group: Column, value: Column, name: str = "domain") -> DataFrame:
    """Per group: rows, rows with a value, and the rate; null groups as MISSING."""
    return (df.select(F.coalesce(group, F.lit("MISSING")).alias(name), numbers.known_flag(value).alias("known"))
            .groupBy(name).agg(n_rows().alias("rows_total"), F.sum("known").alias("rows_known"))
            .withColumn("known_rate", F.col("rows_known") / F.col("rows_total"))
            .orderBy(F.desc("known_rate"), name))


def largest(df: DataFrame, value: str, columns: Sequence[str], key: str, n: int = 50) -> DataFrame:
    """The n rows with the largest value. Ties by key."""
    return (df.filter(F.col(value).isNotNull()).orderBy(F.desc(value), key)
            .select(*[c for c in columns if c in df.columns]).limit(n))


def preview(df: DataFrame, key: str, columns: Sequence[str], n: int) -> DataFrame:
    """The first n rows in key order."""
    return df.orderBy(key).select(*[c for c in columns if c in df.columns]).limit(n)


# --- anomalies -------------------------------------------------------------

def anomaly_aggregates(columns: Sequence[str], last_year: int = MAX_FOUNDED_YEAR,
                       price: bool = True) -> dict[tuple[str, str], Column]:
    """Counts of out-of-range, missing and negative values; absent columns are skipped."""
    have = set(columns)
    found: dict[str, Column] = {}
    if "founded" in have:
        year = numbers.to_number(F.col("founded"))
        found["founded_lt_1850"] = F.count_if(year < MIN_FOUNDED_YEAR)
        found[f"founded_gt_{last_year}"] = F.count_if(year > last_year)
        found["founded_missing"] = F.count_if(year.isNull())
    for column in ["presence_world", "plans", "total_rented_area"]:
        if column in have:
            found[f"{column}_negative"] = F.count_if(numbers.to_number(F.col(column)) < 0)
    if "total_rented_area" in have:
        area = numbers.to_number(F.col("total_rented_area"))
        found["total_rented_area_known_count"] = F.count(area)
        found["total_rented_area_known_rate"] = F.coalesce(F.try_divide(F.count(area), n_rows()), F.lit(0.0))
    if "description" in have:
        found["description_empty"] = F.count_if(text.is_blank(F.col("description")))
    if price and "price_category" in have:
        found["price_category_unknown_only"] = F.count_if(F.size(labels.known_labels(F.col("price_category"))) == 0)
    return {("anomaly", name): c for name, c in found.items()}


def anomaly_report(df: DataFrame, last_year: int = MAX_FOUNDED_YEAR, price: bool = True) -> DataFrame:
    """(metric, value) of all anomaly counts in one pass."""
    return measure(df, anomaly_aggregates(df.columns, last_year, price)).select("metric", "value")
