"""Small control tables as Spark literals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def literal_rows(spark: SparkSession, names: Sequence[str], rows: Sequence[Sequence]) -> DataFrame:
    """A few fixed rows (rules, limits, labels), folded into the plan."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def unpivot_row(df: DataFrame, metrics: Sequence[str], constants: dict[str, str] | None = None,
                name: str = "metric", value: str = "value", keys: Sequence[str] = ()) -> DataFrame:
    """A one-row aggregate (per key) to (constants, name, value) rows."""
    constants = constants or {}
    return df.select(*keys, F.inline(F.array(*[
        F.struct(*[F.lit(v).alias(k) for k, v in constants.items()],
                 F.lit(m).alias(name), F.col(f"`{m}`").cast("double").alias(value))
        for m in metrics
    ])))


def measure(df: DataFrame, aggregates: dict[tuple[str, str], Column]) -> DataFrame:
    """(section, metric, value) of many aggregates, all computed in one pass."""
    names = {key: f"m{i}" for i, key in enumerate(aggregates)}
    counts = df.agg(*[c.cast("double").alias(names[key]) for key, c in aggregates.items()])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(section).alias("section"), F.lit(metric).alias("metric"), F.col(name).alias("value"))
        for (section, metric), name in names.items()])))


def passes(value, operator, limit):
    """Inclusive limit check by operator text; null value fails."""
    return F.coalesce(
        F.when(operator == ">=", value >= limit).when(operator == "<=", value <= limit), F.lit(False)
    ).cast("int")
