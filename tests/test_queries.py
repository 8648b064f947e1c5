"""Registered queries against their oracle SQL on the smallest tables (all of them:
check_queries.py)."""

import pytest

import __spark_entry__ as entry
from check_queries import compare, oracle
from brand_data import SF

SAMPLE = ["s8_fingerprint", "f2_clean_name", "f8_known_and_unexpected_labels", "p1o_prepared_features", "p3o_domain_rows",
          "a6_variant_examples_j1", "a10_range_quantiles_lineitem", "a11_text_quality", "g1_data_gate", "m5_stratified_holdout",
          "m8_plain_folds", "e2_class_report", "h4_threshold_strategy", "g7_publishable_runs", "v2_founded_view_w3", "m2_category_block_m16",
          "m16_code_table", "h7_threshold_contract", "n2_in_sample_thresholds", "j7_column_sets", "a24_qa_summary", "g3_smoke_checks"]


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", SAMPLE)
def test_query(spark, con, name):
    assert compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]).startswith("ok")


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(entry.queries()) - set(entry.oracle_sql()) <= set(entry.LLM_QUERIES)
