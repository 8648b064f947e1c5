"""Registration of queries with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from brandlens.operators.prepare import prepare_features
from brandlens.operators.schema import harmonize
from brandlens.sources.brands import raw_brands, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without an oracle only its rows are checked."""
    def register(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"Query {name} is registered twice")
        QUERIES[name] = f
        if oracle is not None:
            ORACLES[name] = oracle
        return f
    return register


def brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The brand table with its columns named right, still dirty."""
    return harmonize(raw_brands(spark, sf_dir))


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_features(raw_brands(spark, sf_dir))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of digits, for comparison."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


__all__ = ["QUERIES", "ORACLES", "query", "brands", "prepared", "rounded", "table"]
