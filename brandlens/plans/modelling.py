"""Queries for feature vectors, training and scoring.

The training query runs a whole family with all grid points and folds, and scoring queries one model
with its full parameters. Selections over all families are jobs of ``plans.runs``. Rows are never cut.
"""

from __future__ import annotations

import json
import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from brandlens.contract import FEATURE_CONTRACT_VERSION, NUMERIC_FEATURES
from brandlens.models import candidates as K, features as X, training as T
from brandlens.models.scoring import score, score_cascaded, write_scored
from brandlens.operators import numbering
from brandlens.operators.prepare import domain_rows, founded_rows
from brandlens.operators.schema import model_input
from brandlens.plans import oracle as O
from brandlens.plans.registry import brands, prepared, query, rounded
from brandlens.sources.staging import shared_folder, staged


def feature_rows(spark, sf, keep=("row_id",)):
    return staged(model_input(prepared(spark, sf), keep=keep))


# --- feature blocks ---------------------------------------------------------

@query("m1_numeric_block", O.sql("select row_id, " + ", ".join(
    f"round((coalesce({c}, 0) - avg(coalesce({c}, 0)) over ()) / stddev_pop(coalesce({c}, 0)) over (), 6) as z_{c}"
    for c in NUMERIC_FEATURES) + " from prep"))
def numeric_block(spark, sf):
    rows = feature_rows(spark, sf)
    z = vector_to_array("num")
    scaled = X.run(X.fit_numbers(rows, NUMERIC_FEATURES, rows.count()), rows)
    return rounded(scaled.select("row_id", *[z[i].alias(f"z_{c}") for i, c in enumerate(NUMERIC_FEATURES)]))


@query("m2_category_block_m16", O.sql(
    "select row_id, (dense_rank() over (order by country_origin) - 1)::int as slot, (select count(distinct country_origin) from prep)::int as n_slots, "
    "1.0::double as filled from prep"))
def category_block(spark, sf):
    rows = feature_rows(spark, sf)
    encoded = X.run(X.fit_category(rows, "country_origin"), rows)
    slots = vector_to_array("o_country_origin")
    return encoded.select("row_id", F.col("i_country_origin").cast("int").alias("slot"), F.size(slots).alias("n_slots"),
                          F.aggregate(slots, F.lit(0.0), lambda a, x: a + x).alias("filled"))


def _terms(column):
    words = rf"regexp_extract_all(lower({column}), '[{O.WORD}]{{2,}}')"
    pairs = "list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1])"
    return f"select row_id, unnest(list_concat(w, {pairs})) as term from (select row_id, {words} as w from (select row_id, coalesce({column}, '') as {column} from prep))"


for _column, _size in X.TEXT_BLOCKS:
    O.CTES[f"said_{_column}"] = f"select row_id, term, count(*) as tf from ({_terms(_column)}) group by 1, 2"
    O.CTES[f"vocab_{_column}"] = (f"select term, sum(tf)::bigint as occurrences, count(*) as documents, "
                                  f"ln((1 + (select count(*) from prep)) / (1 + count(*))::double) + 1 as idf from said_{_column} "
                                  f"group by 1 having count(*) >= 2 order by sum(tf) desc, term limit {_size}")
    O.CTES[f"weights_{_column}"] = (f"select row_id, term, tf * idf / sqrt(sum(tf * idf * tf * idf) over (partition by row_id)) as w "
                                    f"from said_{_column} join vocab_{_column} using (term)")


def _tokenized(spark, sf, column):
    rows = feature_rows(spark, sf)
    return rows, X.run(X.text_stages(column, "t_"), rows)


def _vocabulary_query(column, size):
    @query(f"m3_vocabulary_{column}", O.sql(f"select term, occurrences, documents, round(idf, 6) as idf from vocab_{column}"))
    def run(spark, sf):
        rows, tokenized = _tokenized(spark, sf, column)
        total = rows.count()
        found = X.vocabulary(tokenized, "t_terms", size)
        idf = F.log((F.lit(1) + total) / (F.lit(1) + F.col("documents"))) + 1
        return rounded(found.select("term", "occurrences", "documents", idf.alias("idf")))

    @query(f"m3_tfidf_{column}", O.sql(f"select term, round(sum(w), 4) as weight, count(*) as rows from weights_{column} group by 1"))
    def weights(spark, sf):
        """Column sums of the sparse TF-IDF vectors, named by term."""
        rows = feature_rows(spark, sf)
        stages = X.fit_text(rows, column, size, rows.count(), "t_")
        terms = F.array(*[F.lit(t) for t in stages[2].vocabulary])
        summary = Summarizer.metrics("sum", "numNonZeros").summary(F.col("t_tfidf"))
        totals = X.run(stages, rows).select(summary.alias("s"))
        cells = F.arrays_zip(terms.alias("term"), vector_to_array("s.sum").alias("weight"),
                             vector_to_array("s.numNonZeros").alias("rows"))
        return totals.select(F.inline(cells)).select(
            "term", F.round("weight", 4).alias("weight"), F.col("rows").cast("bigint").alias("rows"))
    return run, weights


for _column, _size in X.TEXT_BLOCKS:
    _vocabulary_query(_column, _size)


@query("m4_feature_vector", O.sql(
    "select count(*) as rows, (8 + (select count(distinct country_origin) from prep) + (select count(*) from vocab_description) "
    "+ (select count(*) from vocab_name_clean))::int as n_slots, "
    "((select count(*) from weights_description) + (select count(*) from weights_name_clean) + count(*))::bigint as text_and_category_entries from prep"))
def feature_vector(spark, sf):
    """Width of the assembled vector and its filled slots behind the eight numbers."""
    rows = feature_rows(spark, sf)
    fitted = X.fit_features(rows)
    summary = Summarizer.metrics("numNonZeros", "count").summary(F.col("features"))
    totals = X.vectors(fitted, rows, []).select(summary.alias("s"))
    filled = vector_to_array("s.numNonZeros")
    tail = F.slice(filled, F.lit(9), F.size(filled))
    return totals.select(F.col("s.count").alias("rows"), F.size(filled).alias("n_slots"),
                         F.aggregate(tail, F.lit(0.0), lambda a, x: a + x).cast("bigint").alias("text_and_category_entries"))


@query("m17_balanced_weights", O.sql(
    "select row_id, round((select count(*) from domain_rows) / ((select count(distinct domain) from domain_rows) * (count(*) over (partition by domain)))::double, 6) as weight "
    "from domain_rows"))
def balanced_weights(spark, sf):
    rows = staged(domain_rows(prepared(spark, sf).select("row_id", "domain")))
    return rounded(T.balanced(rows, "domain").select("row_id", "weight"))


@query("n6_targets_as_features", O.sql(
    "select count(*) as rows, (11 + (select count(distinct country_origin) + count(distinct domain) + count(distinct price_category) from prep) "
    "+ (select count(*) from vocab_description) + (select count(*) from vocab_name_clean))::int as n_slots from prep"))
def targets_as_features(spark, sf):
    """Older experiment outside the feature contract: target-like columns among the features."""
    rows = staged(model_input(prepared(spark, sf), keep=["row_id", "founded", "total_rented_area", "has_total_rented_area", "domain", "price_category"]))
    fitted = X.fit_features(rows, [*NUMERIC_FEATURES, "founded", "total_rented_area", "has_total_rented_area"],
                            ["country_origin", "domain", "price_category"], check=False)
    summary = Summarizer.metrics("count", "max").summary(F.col("features"))
    return X.vectors(fitted, rows, []).select(summary.alias("s")).select(F.col("s.count").alias("rows"), F.size(vector_to_array("s.max")).alias("n_slots"))


@query("m16_code_table", O.sql("select row_id, (dense_rank() over (order by country_origin) - 1)::bigint as code, country_origin as decoded from prep"))
def codes(spark, sf):
    """Categories numbered by a distributed code table, and read back from their numbers."""
    rows = staged(prepared(spark, sf).select("row_id", "country_origin"))
    table = numbering.code_table(rows, "country_origin")
    coded = numbering.encode(rows, table, "country_origin").select("row_id", "code")
    return numbering.decode(coded, table, "country_origin").select("row_id", "code", F.col("country_origin").alias("decoded"))


# --- training and scoring ---------------------------------------------------

O.CTES["founded_split"] = (f"select row_id, founded, row_number() over (order by {O.hash32(O.keyed('row_id', 42))}, row_id) <= ceil(count(*) over () * 0.2::double) as held "
                           "from founded_rows")
O.CTES["founded_folds"] = (
    "select row_id, founded, (least(4, case when r < (n % 5) * (n // 5 + 1) then r // (n // 5 + 1) else (n % 5) + (r - (n % 5) * (n // 5 + 1)) // greatest(n // 5, 1) end))::int as fold "
    f"from (select row_id, founded, row_number() over (order by {O.hash32(O.keyed('row_id', '42|fold'))}, row_id) - 1 as r, count(*) over () as n from founded_split where not held)")
O.CTES["founded_baseline"] = ("select f.fold, count(*) as rows, avg(abs(f.founded - m.median)) as mae from founded_folds f join "
                              "(select t.fold, quantile_cont(s.founded, 0.5) as median from (select distinct fold from founded_folds) t join founded_folds s on s.fold <> t.fold group by 1) m "
                              "on m.fold = f.fold group by 1")


@query("m10_m13_ridge_selection", O.sql(
    "select 'fold' as part, 'Ridge' as name, params, fold, rows, rows as finite_rows, null::double as cv_best, null::double as cv_std, null::int as winner "
    "from founded_baseline cross join (select unnest(['{\"alpha\": 0.3}', '{\"alpha\": 1.0}', '{\"alpha\": 3.0}']) as params) "
    "union all select 'board', 'DummyMedian', '{}', null, null, null, round(avg(mae), 6), round(stddev_pop(mae), 6), 0 from founded_baseline "
    "union all select 'board', 'Ridge', null, null, null, null, null, null, 1"))
def ridge_selection(spark, sf):
    """The linear family of the year target, all penalties and folds: the out-of-fold rows of every
    grid point, the baseline's scores and the winner. A model's own scores are not shown."""
    rows = T.founded_training_rows(prepared(spark, sf))  # reads them once
    candidates = [c for c in K.founded_candidates() if c["family"] == "linear"]
    result = T.train_founded(rows, candidates, parallelism=5)
    points = F.array(*[F.lit(json.dumps(p, sort_keys=True)) for p in candidates[0]["grid"]])
    year = F.col("y_pred")
    folds = (result["oof"].groupBy(points[F.col("grid")].alias("params"), "fold")
             .agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.isnan(year) & (F.abs(year) < float("inf"))).alias("finite_rows"))
             .select(F.lit("fold").alias("part"), F.lit("Ridge").alias("name"), "params", "fold", "rows", "finite_rows",
                     F.lit(None).cast("double").alias("cv_best"), F.lit(None).cast("double").alias("cv_std"), F.lit(None).cast("int").alias("winner")))
    dummy = F.col("family") == "baseline"
    board = result["leaderboard"].select(
        F.lit("board").alias("part"), "name", F.when(dummy, F.col("best_params")).alias("params"), F.lit(None).cast("int").alias("fold"),
        F.lit(None).cast("bigint").alias("rows"), F.lit(None).cast("bigint").alias("finite_rows"),
        F.when(dummy, F.col("cv_best")).alias("cv_best"), F.when(dummy, F.col("cv_std")).alias("cv_std"), "winner")
    return rounded(folds.unionByName(board))


def year_model(spark, sf):
    """One candidate with its full parameters, fitted on all rows with a valid year."""
    rows = staged(model_input(founded_rows(prepared(spark, sf)), keep=["row_id", "founded"]))
    ridge = next(c for c in K.founded_candidates() if c["name"] == "Ridge")
    fitted = X.fit_features(rows)
    return {"founded": T.founded_pipeline(fitted, T.fit_founded(X.vectors(fitted, rows, ["founded"]), ridge["build"], [{"alpha": 1.0}], 1, ridge["fit_all"])[0])}


def _year_checks(result, low, high):
    year, absent = F.col("pred_founded"), F.col("pred_domain").isNull() & F.col("pred_price_category").isNull()
    flags = {"year_in_range": F.coalesce(year.between(low, high), F.lit(False)),
             "year_is_rounded": F.coalesce(F.abs(F.col("pred_founded_rounded") - year) <= 0.5, F.lit(False)), "others_are_null": absent}
    return result.select("row_id", *[c.cast("int").alias(n) for n, c in flags.items()])


_YEAR_CHECKS = O.sql("select row_id, 1 as year_in_range, 1 as year_is_rounded, 1 as others_are_null from brands")


@query("b1_b3_scored_years", _YEAR_CHECKS)
def scored_years(spark, sf):
    """All brands scored by a trained year model; the models that are absent leave nulls."""
    return _year_checks(score(brands(spark, sf), year_model(spark, sf)), 1850, 2025)


@query("b6_cascaded_years", _YEAR_CHECKS)
def cascaded_years(spark, sf):
    """The superseded cascade, whose years are only clipped at zero."""
    return _year_checks(score_cascaded(brands(spark, sf), year_model(spark, sf)), 0, float("inf"))


@query("b5_scoring_summary", O.sql(
    f"select count(*) as rows_scored, '{FEATURE_CONTRACT_VERSION}' as feature_contract_version, 0 as domain_model_used, "
    f"1 as founded_model_used, 0 as price_category_model_used from brands"))
def summary(spark, sf):
    """Rows counted by the pass that writes the scoring."""
    models = year_model(spark, sf)
    return write_scored(score(brands(spark, sf), models), models, f"{shared_folder(spark)}/scored-{uuid.uuid4().hex}")
