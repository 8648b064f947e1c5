"""Dashboard views and summary cards as queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brandlens.contract import DOMAIN_ALIASES, HIGHLIGHT_BRAND, HIGHLIGHT_LABEL, KNOWN_PRICE_LABELS
from brandlens.functions.numbers import decade, finite, to_number
from brandlens.functions.text import missing_text, strip
from brandlens.operators import quantiles as Q
from brandlens.operators.checks import year_column

TOP = 10


def alias(c: Column, names: dict[str, str] = DOMAIN_ALIASES) -> Column:
    """Display name of a value, the value itself if it has none."""
    lookup = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, c), c)


def cross_filter(df: DataFrame, domain: str | None) -> DataFrame:
    """Rows of the selected domain, or all without a selection."""
    return df if domain is None else df.filter(F.col("domain") == domain)


def top_groups(df: DataFrame, group: str, counted: Column | None = None, n: int = TOP) -> DataFrame:
    """The n groups with most rows, or with most non-null values. Ties by group."""
    count = F.count(F.lit(1) if counted is None else counted)
    return (df.filter(F.col(group).isNotNull()).groupBy(group).agg(count.alias("count"))
            .orderBy(F.desc("count"), group).limit(n))


def in_top_groups(df: DataFrame, group: str, top: DataFrame) -> DataFrame:
    """Rows of the top groups. The list has at most its limit of rows, so it is broadcast."""
    return df.join(F.broadcast(top.select(group)), group, "left_semi")


def domain_view(df: DataFrame, domain: str | None = None, n: int = TOP) -> DataFrame:
    shown = top_groups(cross_filter(df, domain), "domain", n=n)
    return shown.select("domain", alias(F.col("domain")).alias("domain_label"), "count").orderBy(F.desc("count"), "domain")


def founded_view(df: DataFrame, domain: str | None = None, first: int = 1850, last: int = 2020) -> DataFrame:
    """Rows per ten-year bin, with quartile and median lines over the bins."""
    year = to_number(F.col("founded"))
    bins = (cross_filter(df, domain).filter(year.between(first, last))
            .groupBy(decade(year).alias("bin")).agg(F.count(F.lit(1)).alias("count")))
    # The year range bounds the number of bins.
    lines = F.lit(bins.agg(F.percentile("count", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))).scalar())
    return bins.select("bin", "count", lines[0].alias("lower_quartile"), lines[1].alias("median"),
                       lines[2].alias("upper_quartile")).orderBy("bin")


def presence_points(df: DataFrame, domain: str | None = None, highlight: str = HIGHLIGHT_BRAND,
                    highlight_label: str = HIGHLIGHT_LABEL) -> DataFrame:
    """Brands of the ten domains with most known countries, with flags and mark sizes.

    The top ten are chosen before the range filters.
    """
    have_id = [c for c in ["row_id"] if c in df.columns]
    rows = cross_filter(df, domain)
    top = top_groups(rows, "domain", F.col("country_origin"))
    points = in_top_groups(rows, "domain", top).select(
        *have_id, "name", "domain", to_number(F.col("presence_world")).alias("presence_world"),
        to_number(F.col("plans")).alias("plans"))
    points = points.filter(F.col("plans").between(1, 1000) & F.col("presence_world").between(1, 10000))
    return points.withColumns({
        "top_brand_flag": top_brand_flag(), "top_label": top_label(),
        "highlight_flag": F.when(F.col("name") == highlight, F.lit(highlight_label)),
        "highlight_size": F.when(F.col("name") == highlight, F.col("presence_world") * 3)
        .otherwise(F.col("presence_world")),
    })


def top_brand_flag() -> Column:
    top = (F.col("presence_world") >= 2000) | (F.col("plans") >= 100)
    return F.when(top, F.lit("Top players")).otherwise(F.lit("Other brands"))


def top_label() -> Column:
    return F.when(F.col("presence_world") >= 2000, F.lit(HIGHLIGHT_LABEL))


def presence_lines(points: DataFrame) -> DataFrame:
    """One row: mean and median of both axes and the linear trend of plans over presence."""
    x, y = F.col("presence_world"), F.col("plans")
    base = points.agg(F.count(F.lit(1)).alias("points"), F.avg(x).alias("mean_presence"), F.avg(y).alias("mean_plans"),
                      F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))
    medians = Q.exact_quantiles(Q.value_frequencies(points, {"presence_world": x, "plans": y}), [0.5])
    return base.withColumns({
        name: F.lit(medians.filter(F.col("column") == column).select(F.col("q")[0]).scalar())
        for name, column in [("median_presence", "presence_world"), ("median_plans", "plans")]
    })


def price_view(label_counts: DataFrame) -> DataFrame:
    """Known price labels with their share of the label total."""
    kept = label_counts.filter(F.col("label").isin(KNOWN_PRICE_LABELS)).select("label", "count")
    return (kept.withColumn("share", F.try_divide(F.col("count"), kept.agg(F.sum("count")).scalar()))
            .orderBy(F.desc("count"), "label"))


# --- result view ------------------------------------------------------------

def top_values(df: DataFrame, column: str, n: int | None = TOP) -> DataFrame:
    """Most frequent trimmed values; missing ones count as unknown."""
    shown = F.when(missing_text(F.col(column)), F.lit("неизвестно")).otherwise(strip(F.col(column)))
    counts = (df.select(shown.alias(column)).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.desc("count"), column))
    return counts if n is None else counts.limit(n)


def summary_cards(result: DataFrame) -> DataFrame:
    """One row: rows, distinct predicted domains, median year, distinct price predictions."""
    def filled(column: str) -> Column:
        return F.when(~missing_text(F.col(column)), F.col(column))

    year = finite(F.col(year_column(result)).cast("double"))
    median = Q.exact_quantiles(Q.value_frequencies(result, {"year": year}), [0.5]).select(F.col("q")[0])
    return result.agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct(filled("pred_domain")).alias("distinct_domains"),
        F.countDistinct(filled("pred_price_category")).alias("distinct_price_categories"),
    ).withColumn("median_year", F.lit(median.scalar()))
