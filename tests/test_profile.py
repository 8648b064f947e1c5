import numpy as np
import pytest
from pyspark.sql import functions as F

from brandlens.operators import duplicates, profile, quantiles, skew


@pytest.mark.parametrize("shape", ["uniform", "hot", "few"])
def test_range_quantiles_equal_numpy(spark, shape):
    rng = np.random.default_rng(3)
    data = {"uniform": rng.normal(0, 1e6, 3000), "hot": np.concatenate([np.full(2000, 7.5), rng.random(1000) * 20]),
            "few": np.array([1.0, 4.0])}[shape]
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    df = spark.createDataFrame([(float(x),) for x in data] + [(None,)], "x double")
    freq = quantiles.value_frequencies(df, {"x": F.col("x"), "y": -F.col("x")})
    for column, sign in [("x", 1), ("y", -1)]:
        expected = np.quantile(sign * data, probs)
        for q in [quantiles.exact_quantiles(freq, probs), quantiles.exact_quantiles(freq, probs, range_rows=5)]:
            got = q.filter(F.col("column") == column).first().q
            assert np.allclose(got, expected, rtol=1e-9, atol=1e-9)


def test_numeric_summary_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    row = profile.numeric_summary(df, {"x": F.col("x")}).first()
    assert row.count_non_null == 0 and row.p25 is None and row["mean"] is None


def test_size_join_equals_plain_join(spark):
    rows = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("k"), F.col("id") % 1700)).alias("k"))
    sizes = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")
    plain = rows.join(sizes, "k").orderBy("id").collect()
    assert skew.join_group_sizes(rows, sizes, "k").select("k", "id", "n").orderBy("id").collect() == plain
    kept = skew.join_group_sizes(rows, sizes, "k", "left_semi")
    assert kept.select("id").orderBy("id").collect() == rows.join(sizes, "k", "left_semi").select("id").orderBy("id").collect()


def test_large_groups_have_a_row_for_each_spelling(spark):
    pairs = spark.range(500).select(F.lit("same").alias("name_clean_candidate"), F.format_string("n%03d", "id").alias("original"))
    rows = duplicates.variant_examples(pairs).collect()
    assert [(r.original, r.n_original_variants) for r in rows] == [(f"n{i:03d}", 500) for i in range(500)]



def test_duplicates_and_conflicts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 2), ("", 3), ("", 3)], "k string, v int")
    assert {(r.k, r.rows) for r in duplicates.repeated(df, "k").collect()} == {("a", 2), ("", 2)}
    assert [(r.k, r.n) for r in duplicates.variants(df, ["k"], F.col("v"), "n").collect()] == [("a", 2)]


def test_histograms_show_every_bucket(spark):
    df = spark.createDataFrame([(" a ",), (None,), ("x" * 601,)], "t string")
    got = {r.bucket: r["count"] for r in profile.length_histogram(df, F.col("t")).collect()}
    assert got == {"0": 1, "1_50": 1, "51_150": 0, "151_300": 0, "301_600": 0, "600_plus": 1}
    areas = spark.createDataFrame([(0.0,), (1000.0,), (1000.5,), (-1.0,), (200000.0,)], "v double")
    got = {r.bucket: r["count"] for r in profile.area_histogram(areas, F.col("v")).collect()}
    assert (got["0_1000"], got["1000_5000"], got["100000_plus"], sum(got.values())) == (2, 1, 1, 4)


def test_label_rate_divides_by_all_rows(spark):
    df = spark.createDataFrame([("дисконт;средний",), ("неизвестно",), (None,), ("дисконт",)], "price_category string")
    got = {r.label: (r["count"], r.rate) for r in profile.label_distribution(df).collect()}
    assert got == {"дисконт": (2, 0.5), "средний": (1, 0.25)}
