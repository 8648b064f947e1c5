"""Ridge regression by normal equations: one pass over the rows for all penalties.

Sums of x xT, x y, x and y are taken together in the executors' Python workers, each over many
rows, and added up there. The linear system of each penalty is solved there too, in one task.
Only the upper half of the square matrix over the columns is held; the driver gets coefficients.
"""

from __future__ import annotations

import sys
import threading
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import nullcontext

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame

# Columns up to which a worker holds the half matrix twice (2 GB); a wider fit goes on by iteration.
MOST_COLUMNS = 16_000
# Folds are worked on at the same time; of wider matrices (0.5 GB) the cluster holds one.
WIDE_COLUMNS = 8_000
_ONE_MATRIX = threading.Lock()
# Rows of the half matrix that are held, sent and eliminated together.
BLOCK = 256
# Rows that become dense at a time, and rows for which a half matrix may be sent.
SLAB = 1024
ROWS_OF_A_SUM = 1 << 17

_SENT = "block int, cells binary"
_FOUND = "place int, coefficients array<double>, intercept double"
# The workers need not be able to import this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def half_matrix(columns: int) -> list[np.ndarray]:
    """Rows of the upper half in blocks, each from its diagonal on."""
    return [np.zeros((min(BLOCK, columns - at), columns - at)) for at in range(0, columns, BLOCK)]


def _dense(batch: pa.RecordBatch, columns: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of a batch of Spark vectors, sparse or dense ones."""
    vectors = batch.column(0)
    values, sparse = vectors.field("values"), np.asarray(vectors.field("type")) == 0
    sizes = np.asarray(values.value_lengths())
    row = np.repeat(np.arange(len(sizes)), sizes)
    column = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    column[sparse[row]] = np.asarray(vectors.field("indices").flatten())
    x = np.zeros((len(sizes), columns))
    x[row, column] = np.asarray(values.flatten())
    return x, np.asarray(batch.column(1))


def sums(batches: Iterable[pa.RecordBatch], columns: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The upper half of the sum of x xT, and the sums of x y, x, 1 and y in one row."""
    half, edge = half_matrix(columns), np.zeros(2 * columns + 2)
    for batch in batches:
        for at in range(0, batch.num_rows, SLAB):
            x, y = _dense(batch.slice(at, SLAB), columns)
            for k, rows in enumerate(half):
                rows += x[:, k * BLOCK:(k + 1) * BLOCK].T @ x[:, k * BLOCK:]
            edge += np.concatenate([y @ x, x.sum(axis=0), [len(y), y.sum()]])
    return half, edge


def _sent(blocks: Iterable[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    for k, cells in blocks:
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([cells.tobytes()], pa.binary())], names=["block", "cells"])


def _added(batches: Iterable[pa.RecordBatch]) -> dict[int, np.ndarray]:
    """Blocks that were sent, added up by number."""
    found: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, cells in zip(batch.column(0).to_pylist(), batch.column(1)):
            cells = np.frombuffer(cells.as_buffer())
            if k in found:
                found[k] += cells
            else:
                found[k] = cells.copy()
    return found


def _received(batches: Iterable[pa.RecordBatch], columns: int) -> tuple[list[np.ndarray], np.ndarray]:
    """What sums() gives, from the blocks of all of them."""
    found = _added(batches)
    return [found.pop(k).reshape(rows.shape) for k, rows in enumerate(half_matrix(columns), 1)], found[0]


def factor(half: list[np.ndarray]) -> None:
    """Cholesky's factor of a matrix, in the place of its upper half."""
    for k, rows in enumerate(half):
        n = len(rows)
        lower = np.linalg.cholesky(rows[:, :n])
        rows[:, n:] = np.linalg.solve(lower, rows[:, n:])
        rows[:, :n] = lower.T
        for later in half[k + 1:]:
            later -= rows[:, n:n + len(later)].T @ rows[:, n:]
            n += len(later)


def substitute(half: Sequence[np.ndarray], right: np.ndarray) -> np.ndarray:
    """The solution of a factored system."""
    x, at = right.copy(), 0
    for rows in half:
        n, rest = len(rows), x[at:]
        rest[:n] = np.linalg.solve(rows[:, :n].T, rest[:n])
        rest[n:] -= rows[:, n:].T @ rest[:n]
        at += n
    for rows in reversed(half):
        n = len(rows)
        at -= n
        rest = x[at:]
        rest[:n] = np.linalg.solve(rows[:, :n], rest[:n] - rows[:, n:] @ rest[n:])
    return x


def solve(half: list[np.ndarray], edge: np.ndarray, alphas: Sequence[float]) -> Iterator[tuple[np.ndarray, float]]:
    """Coefficients and intercept for each penalty alpha * |w|^2 on the summed squares; the
    intercept has no penalty. The half matrix is changed."""
    columns, n = len(edge) // 2 - 1, edge[-2]
    mean, label_mean = edge[columns:-2] / n, edge[-1] / n
    towards = edge[:columns] - n * mean * label_mean
    for k, rows in enumerate(half):
        rows -= n * np.outer(mean[k * BLOCK:(k + 1) * BLOCK], mean[k * BLOCK:])
    for alpha in alphas:
        system = [rows.copy() for rows in half]
        for rows in system:
            rows[np.diag_indices(len(rows))] += alpha
        factor(system)
        w = substitute(system, towards)
        yield w, float(label_mean - w @ mean)


def _solved(half: list[np.ndarray], edge: np.ndarray, alphas: Sequence[float]) -> Iterator[pa.RecordBatch]:
    for place, (w, b) in enumerate(solve(half, edge, alphas)):
        yield pa.RecordBatch.from_arrays([pa.array([place], pa.int32()), pa.array([w], pa.list_(pa.float64())), pa.array([b])],
                                         names=["place", "coefficients", "intercept"])


def as_model(rows: DataFrame, coefficients: np.ndarray, intercept: float, features: str = "features") -> LinearRegressionModel:
    """A Spark ML model, which pipelines hold and save, of given coefficients."""
    context = rows.sparkSession.sparkContext
    java = context._jvm.org.apache.spark.ml.regression.LinearRegressionModel(
        f"ridge_{uuid.uuid4().hex[:12]}", _py2java(context, Vectors.dense(coefficients)), intercept)
    return LinearRegressionModel(java).setFeaturesCol(features)


def coefficients(rows: DataFrame, columns: int, alphas: Sequence[float], parts: int) -> DataFrame:
    """(place, coefficients, intercept) of each penalty, from sums over so many parts of the rows."""
    dealt = rows.select("features", "label").coalesce(parts)
    if parts == 1:
        return dealt.mapInArrow(lambda batches: _solved(*sums(batches, columns), alphas), _FOUND)

    def send(batches):
        half, edge = sums(batches, columns)
        return _sent(enumerate([edge, *half]))

    sent = dealt.mapInArrow(send, _SENT).repartition("block")
    added = sent.mapInArrow(lambda batches: _sent(_added(batches).items()), _SENT).repartition(1)
    return added.mapInArrow(lambda batches: _solved(*_received(batches, columns), alphas), _FOUND)


def fit(rows: DataFrame, alphas: Sequence[float]) -> list[LinearRegressionModel]:
    """A model for each penalty, from one pass over (features, label).

    The rows should be cached: they are counted first, which fills the cache in all tasks, and then
    read by one task for each ROWS_OF_A_SUM of them.
    """
    parts, columns = max(1, -(-rows.count() // ROWS_OF_A_SUM)), len(rows.first()["features"])
    with _ONE_MATRIX if columns > WIDE_COLUMNS else nullcontext():
        found = coefficients(rows, columns, alphas, parts).collect()  # one row per penalty
    return [as_model(rows, np.array(r.coefficients), r.intercept) for r in sorted(found, key=lambda r: r.place)]
