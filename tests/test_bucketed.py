"""Comparisons of tables that lie in buckets of the row id."""

import pytest
from pyspark.sql import functions as F

from brandlens.operators import checks
from brandlens.sources.staging import bucketed


@pytest.fixture
def tables(spark, tmp_path):
    ids = spark.range(500).withColumnRenamed("id", "row_id")
    filled = {c: F.lit(0.25) for c in checks.PROBABILITY_COLUMNS} | {
        "pred_domain": F.lit("a"), "pred_founded": F.lit(2000.0), "pred_founded_rounded": F.lit(2000.0), "pred_price_category": F.lit("x")}
    result = ids.withColumns(filled)
    again = result.withColumn("pred_founded", F.when(F.col("row_id") == 3, 1999.0).otherwise(F.col("pred_founded")))
    source = ids.withColumn("domain", F.concat(F.lit("d"), F.col("row_id")))
    made = {"result": result, "again": again, "source": source}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield {n: bucketed(df, f"bucketed_{n}", "row_id", 6, str(tmp_path / n)) for n, df in made.items()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for n in made:
        spark.sql(f"drop table bucketed_{n}")


def moved(df):
    return df._jdf.queryExecution().executedPlan().toString().count("hashpartitioning")


def test_bucketed_tables_hold_all_rows(tables):
    assert {n: t.count() for n, t in tables.items()} == {"result": 500, "again": 500, "source": 500}


def test_results_are_compared_in_place(tables):
    differences = checks.result_differences(tables["result"], tables["again"])
    assert moved(differences) == 0
    assert list(differences.first()) == [0, 1, 0]


def test_originals_are_joined_in_place(tables):
    aligned = checks.align_original(tables["source"], tables["result"])
    assert moved(aligned) == 0
    assert aligned.filter("original_domain = concat('d', row_id)").count() == 500
