"""Mixing to target weights by soft membership.

A classifier learned from a labelled table predicts each document's posterior over domains. The
mix is a nonnegative rate per document (1: as is, 2: twice, 0: never) whose expected token totals
per domain, sum of rate x tokens x posterior, match the targets: least squares by projected
gradient, started at 1, in the metric of tokens so that documents of all lengths are treated
alike. One step needs only the residual per domain, so an iteration is one aggregate, and a rate
is computed again from the short list of steps wherever it is needed.

Cases: a null or empty text has no tokens, the prior as posterior and a rate like any other; null
labels, and labels of domains without target, do not train; a domain without labelled rows gets no
posterior beyond smoothing; repeated rows have equal rates, but rows with one id share one draw of
copies; an empty table gives no rows; the operator's own columns replace further columns of their
names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .shared import slices, staged, text_column
from .text_hash import Stretches, joined, words

BUCKETS = 1 << 14


def _counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all words: their text, their bucket; and the number of words of each text."""
    buffer, begins = joined([t.encode() for t in texts])
    start, end = words(buffer)
    doc = np.searchsorted(begins, start, side="right") - 1
    bucket = (Stretches(buffer, lower=True).hashes(start, end) % np.uint64(BUCKETS)).astype(np.int64)
    return doc, bucket, np.bincount(doc, minlength=len(texts))[:len(texts)]


@dataclass
class Domains:
    """Log prior and log word shares of each domain."""
    names: list[str]
    prior: np.ndarray
    words: np.ndarray

    def posteriors(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and posterior of each text. Words count less the more there are (square root of
        their number), because neighbouring words are no independent evidence."""
        doc, bucket, n = _counts(texts)
        score = np.stack([np.bincount(doc, row[bucket], len(texts))[:len(texts)] for row in self.words], axis=1)
        score = score / np.sqrt(np.maximum(n, 1))[:, None] + self.prior
        p = np.exp(score - score.max(axis=1, keepdims=True))
        return n, p / p.sum(axis=1, keepdims=True)


@dataclass
class Mix:
    """The steps of the rates: rate = max(floor, ... max(floor, 1 - p @ steps[0]) ...)."""
    floor: float = 0.0
    steps: list[np.ndarray] = field(default_factory=list)

    def rates(self, p: np.ndarray) -> np.ndarray:
        rate = np.ones(len(p))
        for step in self.steps:
            rate = np.maximum(rate - p @ step, self.floor)
        return rate


def fit_domains(docs: DataFrame, labelled: DataFrame, names: list[str]) -> Domains:
    """Learn from documents (doc_id, text) with rows (doc_id, domain) in the labelled table."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(names), BUCKETS + 1))
        for batch in batches:
            for rows in slices(batch):
                doc, bucket, _ = _counts(text_column(rows))
                domain = np.asarray(rows.column("domain")).astype(np.int64)
                total[:, :BUCKETS] += np.bincount(domain[doc] * BUCKETS + bucket, minlength=len(names) * BUCKETS).reshape(-1, BUCKETS)
                total[:, BUCKETS] += np.bincount(domain, minlength=len(names))
        domain, cell = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(domain * (BUCKETS + 1) + cell), pa.array(total[domain, cell])], names=["cell", "n"])

    place = F.create_map(*[x for k, name in enumerate(names) for x in (F.lit(name), F.lit(k))])[F.col("domain")]
    known = labelled.select("doc_id", place.alias("domain")).filter(F.col("domain").isNotNull())
    cells = docs.select("doc_id", "text").join(known, "doc_id").select("text", "domain").mapInArrow(count, "cell long, n double")
    # At most one cell for each domain and bucket comes back.
    rows = cells.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(len(names) * (BUCKETS + 1))
    total[rows["cell"].to_numpy(dtype=np.int64)] = rows["n"]
    total = total.reshape(len(names), -1)
    seen = total[:, :BUCKETS] + 0.1
    share, size = np.log(seen / seen.sum(axis=1, keepdims=True)), total[:, BUCKETS] + 1
    return Domains(names, np.log(size / size.sum()), share - share.mean(axis=0))


def members(docs: DataFrame, domains: Domains) -> DataFrame:
    """n_tokens and posterior (array) of each document, with its other columns."""
    shared = docs.sparkSession.sparkContext.broadcast(domains)
    docs = docs.drop("n_tokens", "posterior")
    schema = T.StructType([*docs.schema, T.StructField("n_tokens", T.LongType()), T.StructField("posterior", T.ArrayType(T.DoubleType()))])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                n, p = shared.value.posteriors(text_column(rows))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(n, pa.int64()), pa.array(list(p), pa.list_(pa.float64()))],
                                                 names=[*rows.schema.names, "n_tokens", "posterior"])

    return docs.mapInArrow(predict, schema)


def _totals(rows: DataFrame, mix: Mix, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Expected tokens per domain under the rates, and sums of tokens x posterior x posterior."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + k * k)
        for batch in batches:
            n = np.asarray(batch.column("n_tokens")).astype(float)
            p = np.asarray(batch.column("posterior").flatten(), dtype=float).reshape(-1, k)
            total[:k] += (mix.rates(p) * n) @ p
            total[k:] += ((p * n[:, None]).T @ p).reshape(-1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["cell", "total"])

    out = np.zeros(k + k * k)
    for row in rows.mapInArrow(add, "cell long, total double").groupBy("cell").agg(F.sum("total").alias("total")).collect():
        out[row["cell"]] = row["total"]
    return out[:k], out[k:].reshape(k, k)


def fit_rates(rows: DataFrame, weights: np.ndarray, total: float | None = None, floor: float = 0.0, most_steps: int = 40,
              close: float = 1e-6) -> Mix:
    """Steps that bring the expected tokens per domain to weights x total.

    total: tokens of the mix, by default as many as now; with total = inf the smallest that lowers
    no domain.
    """
    mix, k = Mix(floor), len(weights)
    now, spread = _totals(rows, mix, k)
    weights = weights / weights.sum()
    size = now.sum() if total is None else (now / weights).max() if np.isinf(total) else total
    goal = weights * size
    scale = 1 / np.maximum(np.diag(spread), 1e-12)
    root = np.sqrt(scale)
    length = 1 / max(float(np.linalg.eigvalsh(root[:, None] * spread * root).max()), 1e-12)
    while np.abs(now - goal).sum() > close * size and len(mix.steps) < most_steps:
        mix.steps.append(length * scale * (now - goal))
        now, _ = _totals(rows, mix, k)
    return mix


def mixed_rates(docs: DataFrame, domains: Domains, weights: dict[str, float], seed: int = 11, **options) -> DataFrame:
    """docs with n_tokens, posterior, rate and copies (the rate, rounded up or down by a draw on the id)."""
    rows = members(docs.drop("rate", "copies"), domains)
    mix = fit_rates(staged(members(docs.select("text"), domains).select("n_tokens", "posterior"), "members"),
                    np.array([weights[n] for n in domains.names]), **options)
    rate = F.lit(1.0)
    for step in mix.steps:
        moved = sum((F.col("posterior")[k] * F.lit(float(s)) for k, s in enumerate(step)), F.lit(0.0))
        rate = F.greatest(rate - moved, F.lit(mix.floor))
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    return rows.withColumn("rate", rate).withColumn("copies", (F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("int")).cast("int"))
