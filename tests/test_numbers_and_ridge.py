"""Distributed numbering, ridge by normal equations, wide quantiles and run tables."""

import contextlib

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

import __spark_entry__ as entry
from brandlens.models import candidates as K, ridge
from brandlens.operators import numbering, quantiles, split, thresholds
from brandlens.plans import runs


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 12)) * rng.uniform(0.1, 9, 12) + rng.normal(size=12)
    x[:, 3] *= rng.random(400) < 0.1  # mostly zero
    x[:, 4] = 0.0
    return x, x @ rng.normal(size=12) + 7 + rng.normal(size=400)


def test_ridge_equals_a_direct_solve_in_each_fold(spark, points, tmp_path):
    x, y = points
    rows = spark.createDataFrame([(i % 5, Vectors.sparse(12, {k: float(v) for k, v in enumerate(r) if v}), float(t)) for i, (r, t) in enumerate(zip(x, y))],
                                 ["fold", "features", "label"]).repartition(6)
    alphas = [0.3, 1.0, 3.0]
    for fold in range(5):
        train = rows.filter(F.col("fold") != fold)
        a, b = x[np.arange(400) % 5 != fold], y[np.arange(400) % 5 != fold]
        centred = a - a.mean(axis=0)
        for alpha, model in zip(alphas, ridge.fit(train, alphas)):
            w = np.linalg.solve(centred.T @ centred + alpha * np.eye(12), centred.T @ (b - b.mean()))
            assert np.allclose(model.coefficients.toArray(), w, rtol=1e-6, atol=1e-9)
            assert model.intercept == pytest.approx(b.mean() - a.mean(axis=0) @ w, rel=1e-6)
    # A model of given coefficients can be saved and read like a fitted one.
    PipelineModel([model]).write().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model")).transform(rows).orderBy("label").select("prediction").collect()
    assert again == model.transform(rows).orderBy("label").select("prediction").collect()


def test_the_ridge_candidate_fits_all_penalties_at_once(spark, points):
    x, y = points
    rows = spark.createDataFrame([(Vectors.dense(r), float(t)) for r, t in zip(x, y)], ["features", "label"])
    candidate = next(c for c in K.founded_candidates(max_iter=2000) if c["name"] == "Ridge")
    exact = candidate["fit_all"](rows, candidate["grid"])
    # The way of very wide vectors.
    for near, model in zip(candidate["fit_all"].iterated(rows, candidate["grid"]), exact):
        assert np.allclose(near.coefficients.toArray(), model.coefficients.toArray(), rtol=1e-3, atol=1e-3)


@contextlib.contextmanager
def most_results(spark, size):
    """Bytes of results that a stage may send to the driver."""
    conf = spark.sparkContext._jsc.sc().conf()
    before = conf.get("spark.driver.maxResultSize", "1g")
    conf.set("spark.driver.maxResultSize", size)
    try:
        yield
    finally:
        conf.set("spark.driver.maxResultSize", before)


@pytest.mark.parametrize("rows_of_a_sum", [None, 100])
def test_the_ridge_matrix_stays_off_the_driver(spark, monkeypatch, rows_of_a_sum):
    if rows_of_a_sum:
        monkeypatch.setattr(ridge, "ROWS_OF_A_SUM", rows_of_a_sum)
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 1100)) * (rng.random((400, 1100)) < 0.05)
    x[:, :300] += rng.normal(size=300)
    y = x @ rng.normal(size=1100) + 7
    vectors = [Vectors.dense(r) if i % 3 == 0 else Vectors.sparse(1100, {k: float(v) for k, v in enumerate(r) if v}) for i, r in enumerate(x)]
    rows = spark.createDataFrame(list(zip(vectors, y.tolist())), ["features", "label"]).repartition(6).persist()
    with most_results(spark, "1200k"):  # a quarter of the half matrix
        models = ridge.fit(rows, [0.3, 3.0])
    rows.unpersist()
    centred = x - x.mean(axis=0)
    for alpha, model in zip([0.3, 3.0], models):
        w = np.linalg.solve(centred.T @ centred + alpha * np.eye(1100), centred.T @ (y - y.mean()))
        assert np.allclose(model.coefficients.toArray(), w, rtol=1e-6, atol=1e-9)
        assert model.intercept == pytest.approx(y.mean() - x.mean(axis=0) @ w, rel=1e-6)


@pytest.fixture(scope="module")
def brand_tables(spark, tmp_path_factory):
    """120 parts whose ridge has about 4100 columns: 67 MB in half a matrix."""
    folder = str(tmp_path_factory.mktemp("brands"))
    words = np.array([f"{a}{b}{c}" for a in "bcdfgklmnp" for b in "aeiou" for c in ("ron", "lis", "tak", "vem")])
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(words, 100)) for _ in range(60)]
    tables = {
        "part": ([(k, f"part {words[k % 90]} {words[k % 70]}", f"Brand#{k % 6}", k % 50 + 1) for k in range(1, 121)], "p_partkey long, p_name string, p_brand string, p_size int"),
        "supplier": ([(k, k % 5) for k in range(10)], "s_suppkey long, s_nationkey int"),
        "nation": ([(k, f"LAND{k}") for k in range(5)], "n_nationkey int, n_name string"),
        "lineitem": ([(k % 100 + 1, float(k % 9 + 1)) for k in range(400)], "l_partkey long, l_quantity double"),
        "documents": (list(enumerate([f"{t} {texts[i - 1]}" for i, t in enumerate(texts)])), "doc_id long, text string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name, right", [
    ("b5_scoring_summary", lambda rows: [r.rows_scored for r in rows] == [120]),
    ("b6_cascaded_years", lambda rows: sorted(rows) == [(k, 1, 1, 1) for k in range(1, 121)]),
    ("m10_m13_ridge_selection", lambda rows: len(rows) == 17 and all(r.finite_rows == r.rows > 0 for r in rows if r.part == "fold")),
])
def test_queries_with_a_ridge_send_the_driver_little(spark, brand_tables, name, right):
    with most_results(spark, "4m"):
        assert right(entry.queries()[name](spark, brand_tables).collect())


def test_numbers_follow_the_order(spark):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("v"))
    assert numbering.numbered(df, ["v"]).orderBy("number").select("v").collect() == df.orderBy("v").collect()
    assert sorted(r.number for r in numbering.numbered(df, [F.desc("v")], "number").collect()) == list(range(20_000))
    assert numbering.numbered(df.filter("v < 0"), ["v"]).count() == 0


def test_code_table_of_a_million_values(spark):
    keys = spark.range(1_000_000).select(F.format_string("k%07d", F.col("id")).alias("k"))
    table = numbering.code_table(keys.unionByName(keys.limit(1000)).unionByName(spark.createDataFrame([(None,)], "k string")), "k")
    wrong = table.filter(F.substring("k", 2, 7).cast("long") != F.col("code")).count()
    assert (wrong, table.count()) == (0, 1_000_000)
    rows = spark.createDataFrame([("k0000042",), (None,), ("unseen",)], "k string")
    assert {(r.k, r.code) for r in numbering.encode(rows, table, "k").collect()} == {("k0000042", 42), (None, None), ("unseen", None)}
    assert numbering.decode(spark.createDataFrame([(999_999,)], "code long"), table, "k").first().k == "k0999999"


def test_holdout_of_very_many_strata(spark):
    rows = spark.range(30_000).select(F.col("id").alias("row_id"), (F.col("id") % 9000).alias("s"))
    sizes = split.holdout_sizes(rows.groupBy("s").agg(F.count("*").alias("n")), 0.2)
    assert sizes.agg(F.sum("holdout")).first()[0] == 6000
    # Three or four rows each: remainders of four are largest, then ties by stratum.
    assert {(r.n, r.holdout) for r in sizes.groupBy("n", "holdout").agg(F.count("*")).collect()} <= {(3, 0), (3, 1), (4, 0), (4, 1)}
    plan = sizes._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    parts = split.add_holdout(rows, ["s"])
    assert parts.count() == 30_000 and parts.filter("split = 'holdout'").count() == 6000


@pytest.mark.parametrize("data", [[1e300, -1e300, 1e-300, 0.0, -0.0, 5e-324, 1.7e308, -1.7e308], list(np.geomspace(1e-12, 1e-3, 500)), [float("inf"), 1.0, 2.0, 3.0], [2.5] * 9])
def test_quantiles_of_wide_ranges(spark, data):
    probs = [0.0, 0.2, 0.5, 0.75]
    freq = quantiles.value_frequencies(spark.createDataFrame([(float(x),) for x in data], "x double"), {"x": F.col("x")})
    expected = [np.quantile(np.array(sorted(data)), p) for p in probs]
    for size in (quantiles.RANGE_ROWS, 2):
        assert np.allclose(quantiles.exact_quantiles(freq, probs, range_rows=size).first().q, expected, rtol=1e-9, atol=1e-320)


def test_a_run_replaces_its_own_rows_only(spark, tmp_path):
    path = str(tmp_path / "metrics")
    one = spark.createDataFrame([("007", "a", 1.0), ("007", "b", 2.0)], "run_id string, metric string, value double")
    runs.replace_run(one, path)
    runs.replace_run(one.withColumn("run_id", F.lit("2026-01-01")), path)
    runs.replace_run(one.filter("metric = 'a'"), path)
    assert sorted((r.run_id, r.metric) for r in spark.read.parquet(path).collect()) == [("007", "a"), ("2026-01-01", "a"), ("2026-01-01", "b")]


def test_threshold_contract_finds_faults(spark):
    rows = [(i, x, 0.5) for i, x in enumerate(thresholds.KNOWN_PRICE_LABELS)]
    faults = lambda rows: {r.name: r.violations for r in thresholds.threshold_contract(spark.createDataFrame(rows, "label_idx int, label string, threshold double")).collect() if r.violations}
    assert faults(rows) == {}
    assert faults(rows[:4]) == {"labels_complete": 1}
    assert faults([*rows, rows[0]]) == {"labels_once": 1}
    assert faults([(1, rows[0][1], float("nan")), *rows[1:]]) == {"labels_in_order": 1, "thresholds_in_range": 1}
