"""A corpus pipeline of the training-data operators: from raw documents to packed windows.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written to the shared folder
and read again as the next stage's documents. All stages but the last return the columns of docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from brandlens.llm import mixing, near_duplicates, packing, passages, repeats
from brandlens.llm.queries import LANGUAGE_WEIGHTS, language_labels
from brandlens.llm.shared import new_path, ship_package


# Bytes from which a string that occurs elsewhere is cut: below the length of passages of over 50 words.
REPEAT_BYTES = 240


def _as_row(docs: DataFrame) -> DataFrame:
    """All columns as one, beside those that an operator reads, so that no name can clash."""
    return docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the passage classifier does not reject. Held-out labels are not used."""
    ship_package(spark)
    model = passages.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return passages.score(_as_row(docs), model).filter("quality_score >= 0.5").select("row.*")


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the row with the smallest doc_id."""
    ship_package(spark)
    return near_duplicates.keep_one(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without strings of REPEAT_BYTES that occur elsewhere; n_chars follows the text."""
    ship_package(spark)
    cut = repeats.deduplicated(docs, REPEAT_BYTES)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def mixed_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that languages have their shares of words; none is lowered or lost."""
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    domains = mixing.fit_domains(docs, language_labels(docs, labels), list(LANGUAGE_WEIGHTS))
    mixed = mixing.mixed_rates(_as_row(docs), domains, LANGUAGE_WEIGHTS, total=float("inf"), floor=1.0)
    return mixed.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed windows."""
    ship_package(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", without_near_duplicates),
    ("suffix-array dedup", without_repeats),
    ("mixing sources to target weights", mixed_languages),
    ("packing", packed),
]

# Learned models, tokenizers and classes of a graph have no SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, name.split()[0])
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
