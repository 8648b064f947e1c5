"""Exact linear-interpolated quantiles by selection.

Values are counted by the leading digits of a number that grows with them. Only the digits that
hold a wanted rank are counted again by their next digits, until few distinct values are left; those
are sorted. No step sorts the table, and no table that grows with it is broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from brandlens.sources.staging import staged

# Distinct values that one task sorts.
RANGE_ROWS = 50_000
# Buckets to a power of e in the first step, and of a bucket in each further one.
_FIRST_STEPS = 64
_NEXT_STEPS = 1024


def value_frequencies(df: DataFrame, columns: Mapping[str, Column], keys: Sequence[str] = ()) -> DataFrame:
    """Staged (keys, column, value, n): how often each value, null included, occurs.

    One scan for all columns; equal values are combined before the shuffle, so a hot value costs
    one row per task. All later statistics read this small table instead of the data.
    """
    pairs = F.array(*[
        F.struct(F.lit(name).alias("column"), value.cast("double").alias("value"))
        for name, value in columns.items()
    ])
    counted = (df.select(*keys, F.inline(pairs)).groupBy(*keys, "column", "value")
               .agg(F.count(F.lit(1)).alias("n")))
    return staged(counted)


def _holding(counts: DataFrame, probs: Sequence[float], keys: Sequence[str], within: Sequence[str]) -> DataFrame:
    """The rows of (keys, path, bucket, rows, ...) that hold a wanted rank, with ``start``, the rows
    before them, and ``ranks``. The first step finds each key's ``total`` as well."""
    if "total" not in counts.columns:
        counts = counts.withColumns({"total": F.sum("rows").over(Window.partitionBy(*keys)), "before": F.lit(0)})
    earlier = Window.partitionBy(*keys, *within).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # Zero-based ranks below and above every quantile position.
    ranks = [f((F.col("total") - 1) * F.lit(float(p))).cast("bigint") for p in probs for f in (F.floor, F.ceil)]
    here = (F.col("start") <= F.col("rank")) & (F.col("rank") < F.col("start") + F.col("rows"))
    placed = counts.withColumn("start", F.col("before") + F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    return (placed.withColumn("rank", F.explode(F.array_distinct(F.array(*ranks)))).filter(here)
            .groupBy(*keys, *within, "bucket", "start", "total", "distinct", "low", "high").agg(F.collect_list("rank").alias("ranks")))


def exact_quantiles(freq: DataFrame, probs: Sequence[float], keys: Sequence[str] = ("column",),
                    range_rows: int = RANGE_ROWS) -> DataFrame:
    """(keys, q): quantiles of ``value`` weighted by ``n``, as an array in the order of ``probs``.

    ``freq`` is a staged value table (one row for each value of a key) whose keys are few (columns,
    folds). A task sorts at most about ``range_rows`` values of a key.
    """
    keys = list(keys)
    measures = [F.sum("n").alias("rows"), F.count(F.lit(1)).alias("distinct"), F.min("value").alias("low"), F.max("value").alias("high")]
    v = F.col("value")
    # log1p never falls while its argument grows, so neither does a bucket's number.
    first = F.rint(F.signum(v) * F.log1p(F.abs(v)) * _FIRST_STEPS)
    values = freq.filter(v.isNotNull()).select(*keys, "value", "n", first.alias("bucket"))
    # A few rows for each key: at most two buckets for each quantile.
    wanted = staged(_holding(values.groupBy(*keys, "bucket").agg(*measures), probs, keys, []))
    path: list[str] = []
    while (wanted.agg(F.max("distinct")).first()[0] or 0) > range_rows:
        path.append(f"step{len(path)}")
        parents = wanted.withColumnRenamed("bucket", path[-1]).withColumnRenamed("start", "before").drop("distinct", "ranks")
        inside = values.withColumnRenamed("bucket", path[-1]).join(F.broadcast(parents), [*keys, *path])
        # Halves, so that a range over all doubles has a width.
        width = F.col("high") / 2 - F.col("low") / 2
        place = F.when(width > 0, F.rint((v / 2 - F.col("low") / 2) / width * _NEXT_STEPS)).otherwise(0.0)
        inside = inside.withColumn("bucket", place)
        counts = inside.groupBy(*keys, *path, "bucket", "total", "before").agg(*measures)
        wanted = staged(_holding(counts, probs, keys, path))
        values = staged(inside.select(*keys, *path, "value", "n", "bucket").join(F.broadcast(wanted.select(*keys, *path, "bucket")), [*keys, *path, "bucket"]))

    inside = (Window.partitionBy(*keys, *path, "bucket").orderBy("value")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    hits = (values.join(F.broadcast(wanted.select(*keys, *path, "bucket", "start", "total", "ranks")), [*keys, *path, "bucket"])
            .withColumn("end", F.col("start") + F.sum("n").over(inside))
            .withColumn("rank", F.explode("ranks")).filter((F.col("rank") >= F.col("end") - F.col("n")) & (F.col("rank") < F.col("end"))))
    found = hits.groupBy(*keys, "total").agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"))

    def interpolated(p: float) -> Column:
        x = (F.col("total") - 1) * F.lit(float(p))
        low, high = F.floor(x).cast("bigint"), F.ceil(x).cast("bigint")
        return F.col("at")[low] + (F.col("at")[high] - F.col("at")[low]) * (x - low)

    return found.select(*keys, F.array(*[interpolated(p) for p in probs]).alias("q"))


def summarize(freq: DataFrame, statistics: Sequence[Column], probs: Sequence[float],
              names: Sequence[str], keys: Sequence[str] = ("column",)) -> DataFrame:
    """Frequency-weighted statistics per key plus the named quantiles; one row per key."""
    base = freq.groupBy(*keys).agg(*statistics)
    q = exact_quantiles(freq, probs, keys)
    q = q.select(*keys, *[F.col("q")[i].alias(name) for i, name in enumerate(names)])
    return base.join(q, list(keys), "left")


# Statistics over a value table.
def rows() -> Column:
    return F.sum("n")


def rows_where(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))


def non_null() -> Column:
    return rows_where(F.col("value").isNotNull())


def mean() -> Column:
    return F.try_divide(F.sum(F.col("value") * F.col("n")), non_null())


