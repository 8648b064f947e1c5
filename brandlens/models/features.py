"""The feature vector: scaled numbers, one-hot categories and two TF-IDF blocks.

Every fit sees training rows only. All stages are Spark ML stages, so the fitted pipeline can be
saved, and rows stay sparse.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import (
    CountVectorizerModel, ElementwiseProduct, Normalizer, OneHotEncoder, SQLTransformer, StandardScaler,
    StringIndexer, VectorAssembler,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, functions as F

from brandlens.contract import CATEGORICAL_FEATURES, NUMERIC_FEATURES, UNKNOWN_COUNTRY, check_feature_contract
from brandlens.functions.text import WORD

# Text column and vocabulary size.
TEXT_BLOCKS = [("description", 4000), ("name_clean", 1500)]
MIN_DOCUMENTS = 2


def vocabulary(tokenized: DataFrame, terms: str, size: int, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(term, occurrences, documents) of the most frequent terms; ties by term.

    Terms of too few documents are dropped first. A row gives its terms and once more its distinct
    terms, so one pass counts both, combined before the shuffle.
    """
    both = F.array(F.struct(F.lit(0).alias("once"), F.col(terms).alias("t")), F.struct(F.lit(1).alias("once"), F.array_distinct(terms).alias("t")))
    return (tokenized.select(F.inline(both)).select("once", F.explode("t").alias("term")).groupBy("term")
            .agg(F.count_if(F.col("once") == 0).alias("occurrences"), F.count_if(F.col("once") == 1).alias("documents"))
            .filter(F.col("documents") >= min_documents)
            .orderBy(F.desc("occurrences"), "term").limit(size))


def idf(documents: int, total: int) -> float:
    """Smoothed inverse document frequency with one added."""
    return math.log((1 + total) / (1 + documents)) + 1


def text_stages(column: str, prefix: str) -> list[Transformer]:
    """Lower-case words of two or more letters, and their pairs, as one term list.

    Plain SQL expressions, so that no row leaves the generated code.
    """
    words = f"regexp_extract_all(lower({column}), '[{WORD}]{{2,}}', 0)".replace("\\", "\\\\")
    pairs = (f"zip_with(slice({prefix}words, 1, greatest(size({prefix}words) - 1, 0)), slice({prefix}words, 2, size({prefix}words)), "
             "(a, b) -> concat(a, ' ', b))")
    return [
        SQLTransformer(statement=f"SELECT *, {words} AS {prefix}words FROM __THIS__"),
        SQLTransformer(statement=f"SELECT *, concat({prefix}words, {pairs}) AS {prefix}terms FROM __THIS__"),
    ]


def run(stages: Sequence[Transformer], df: DataFrame) -> DataFrame:
    return PipelineModel(list(stages)).transform(df)


def fit_text(rows: DataFrame, column: str, size: int, total: int, prefix: str) -> list[Transformer]:
    """TF-IDF of one text column, normalized to unit length."""
    stages = text_stages(column, prefix)
    found = vocabulary(run(stages, rows.select(column)), f"{prefix}terms", size).collect()  # at most size rows
    if not found:
        raise ValueError(f"No term of {column} occurs in {MIN_DOCUMENTS} rows.")
    weights = Vectors.dense([idf(r.documents, total) for r in found])
    return [
        *stages,
        CountVectorizerModel.from_vocabulary([r.term for r in found], inputCol=f"{prefix}terms", outputCol=f"{prefix}counts"),
        ElementwiseProduct(scalingVec=weights, inputCol=f"{prefix}counts", outputCol=f"{prefix}weighted"),
        Normalizer(p=2.0, inputCol=f"{prefix}weighted", outputCol=f"{prefix}tfidf"),
    ]


def fit_numbers(rows: DataFrame, columns: Sequence[str], total: int) -> list[Transformer]:
    """Null to zero, then centred and divided by the population standard deviation."""
    filled = ", ".join(f"coalesce(cast({c} as double), 0D) AS f_{c}" for c in columns)
    first = [
        SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"),
        VectorAssembler(inputCols=[f"f_{c}" for c in columns], outputCol="num_raw"),
    ]
    scaler = StandardScaler(withMean=True, withStd=True, inputCol="num_raw", outputCol="num_sample")
    fitted = scaler.fit(run(first, rows.select(*columns)))
    # The scaler divides by the sample deviation; this factor makes it the population's.
    factor = math.sqrt(total / (total - 1)) if total > 1 else 1.0
    return [*first, fitted, ElementwiseProduct(scalingVec=Vectors.dense([factor] * len(columns)),
                                               inputCol="num_sample", outputCol="num")]


def fit_category(rows: DataFrame, column: str) -> list[Transformer]:
    """One slot per category in sorted order; null counts as unknown, unseen gives all zeros."""
    filled = SQLTransformer(statement=f"SELECT *, coalesce(cast({column} as string), '{UNKNOWN_COUNTRY}') AS c_{column} FROM __THIS__")
    known = filled.transform(rows.select(column))
    indexer = StringIndexer(inputCol=f"c_{column}", outputCol=f"i_{column}", handleInvalid="keep",
                            stringOrderType="alphabetAsc").fit(known)
    encoder = OneHotEncoder(inputCols=[f"i_{column}"], outputCols=[f"o_{column}"], dropLast=True)
    return [filled, indexer, encoder.fit(indexer.transform(known))]


def fit_features(rows: DataFrame, numeric: Sequence[str] = NUMERIC_FEATURES,
                 categorical: Sequence[str] = CATEGORICAL_FEATURES,
                 text: Sequence[tuple[str, int]] = TEXT_BLOCKS, check: bool = True) -> PipelineModel:
    """Fit the feature pipeline on training rows; its output column is ``features``.

    ``check=False`` admits column lists outside the contract, as older experiments used them.
    """
    if check:
        check_feature_contract([*numeric, *categorical, *[c for c, _ in text]])
    total = rows.count()
    stages: list[Transformer] = fit_numbers(rows, numeric, total)
    for column in categorical:
        stages += fit_category(rows, column)
    for column, size in text:
        stages += fit_text(rows, column, size, total, f"t_{column}_")
    blocks = ["num", *[f"o_{c}" for c in categorical], *[f"t_{c}_tfidf" for c, _ in text]]
    stages.append(VectorAssembler(inputCols=blocks, outputCol="features"))
    return PipelineModel(stages)


def vectors(features: PipelineModel, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Only the kept columns and the feature vector."""
    return features.transform(rows).select(*keep, "features")
