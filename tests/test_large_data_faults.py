"""Faults that only show on data other than the fixture's."""
import pytest
from pyspark.sql import functions as F

from brandlens.functions.numbers import presence_pair
from brandlens.operators import baselines, checks, quality, split
from brandlens.sources.csv_files import read_brand_csv


def test_null_strata_keep_their_rows(spark):
    df = spark.range(100).select(F.col("id").alias("row_id"), F.when(F.col("id") % 4 > 0, F.col("id") % 4).alias("s"))
    parts = split.add_holdout(df, ["s"])
    assert parts.count() == 100
    assert parts.filter("s is null and split = 'holdout'").count() == 5
    assert {r.n for r in split.add_folds(df, ["s"], folds=5).groupBy("s", "fold").agg(F.count("*").alias("n")).collect()} == {5}
    assert sorted(r["rank"] for r in split.stratum_rank(df, ["s"], "row_id").filter("s is null").collect()) == list(range(1, 26))


def test_baselines_use_all_folds(spark):
    df = spark.range(200).select((F.col("id") % 10).cast("int").alias("fold"), (F.col("id") % 7).cast("double").alias("y_true"))
    assert baselines.mode_baseline(df, n_folds=10).count() == 10
    assert baselines.median_baseline(df, n_folds=10).count() == 10


def test_fields_cannot_run_together(spark):
    a = spark.createDataFrame([("a|", "b")], "x string, y string")
    b = spark.createDataFrame([("a", "|b")], "x string, y string")
    assert quality.fingerprint_text(a, ["x", "y"]) != quality.fingerprint_text(b, ["x", "y"])


def test_digest_sums_beyond_64_bits(spark):
    row = quality.fingerprint(spark.range(3), ["id"]).first()
    assert isinstance(row.digest, str) and int(row.digest) > 0


def test_digits_of_all_scripts(values):
    assert values(presence_pair, ["\u0661\u0662 \u0438 \u0664 \u0444\u0440\u0430\u043d\u0447\u0430\u0439\u0437\u0438\u043d\u0433\u043e\u0432\u044b\u0445"])[0] == (12.0, 4.0)


def test_row_ids_must_prove_identity(spark):
    source = spark.createDataFrame([(1, "a"), (1, "b")], "row_id long, domain string")
    result = spark.createDataFrame([(1, "x")], "row_id long, pred_domain string")
    with pytest.raises(ValueError):
        checks.align_original(source, result)


def test_csv_refuses_other_headers_and_ragged_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name,domain\nn1,d1\n")
    (tmp_path / "b.csv").write_text("domain,name\nd2,n2\n")
    with pytest.raises(Exception):
        read_brand_csv(spark, str(tmp_path), multi_line=False).collect()
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "c.csv").write_text("name,domain\nn1,d1,more\n")
    with pytest.raises(Exception):
        read_brand_csv(spark, str(tmp_path / "c"), multi_line=False).collect()
