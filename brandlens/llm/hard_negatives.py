"""Hard-negative mining by angular triangle filtering.

A row's vector becomes integers, floor(scale * x), and a score is an integer inner product. Rows are
cut into blocks of one label. Each row stores its angles to a few reference directions (the mean
directions of the most frequent labels). For an anchor and a row, angles a and b to one reference
put the angle between them into [|a - b|, min(a + b, 2 pi - a - b)]; the narrowest of these over all
references gives a cosine interval, and times both norms a score interval, widened so that rounding
cannot exclude a score. Only rows whose interval overlaps a wanted window are scored:

1. Positives: blocks of the anchor's label. A row is scored if its upper bound reaches the last of
   the best scores so far; groups of rows with near angles are judged first, by their ranges.
2. Negatives: blocks of other labels. Each positive opens a window of scores; a block, then a group,
   then a row is passed over if its interval meets no window.

Anchor blocks meet row blocks by key, one bounded pair of blocks at a time, and a pair sends at most
the wanted number of rows for each anchor and positive.

Cases: rows with a null id, label or vector, or a null or non-finite component take no part; neither
do vectors whose integers have a length of 2^31 or more, since their scores may leave 64 bits.
Vectors of other lengths are never compared; a zero vector scores 0. Rows with one id are rows of
their own, and an anchor never meets its own id; equal rows with one id tie and all count. An anchor
without positives has no rows; nor has a negative positive score, since its window is empty. An
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import partitions, staged

BLOCK_ROWS = 2048
ANCHOR_ROWS = 256
REFERENCES = 8
_GROUP = 64
_MARGIN = 1e-7
_BLOCKS = ("dim int, label long, n int, ids binary, integers binary, angles binary, norms binary, "
           "low array<double>, high array<double>, least double, most double")


def integer_rows(table: DataFrame, scale: int, label: Column) -> DataFrame:
    """(vec_id, label, dim, vector): usable rows with their integers."""
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < math.inf))
    rows = table.select(F.col("vec_id").cast("long"), label.cast("long").alias("label"), F.when(fine, x).alias("x")).dropna()
    vector = F.transform("x", lambda v: F.floor(F.least(F.greatest(v * scale, F.lit(-2.0**32)), F.lit(2.0**32))))
    rows = rows.select("vec_id", "label", F.size("x").alias("dim"), vector.alias("vector"))
    length = F.aggregate("vector", F.lit(0.0), lambda s, v: s + v.cast("double") * v)
    return rows.filter(length < 2.0**62)


def reference_directions(rows: DataFrame, most: int = REFERENCES) -> dict[int, np.ndarray]:
    """Unit directions by vector length: the means of its most frequent labels, at most `most`.

    They decide how much is passed over, never the result.
    """
    means = (rows.select("dim", "label", F.posexplode("vector").alias("at", "x")).groupBy("dim", "label", "at")
             .agg(F.avg("x").alias("x"), F.count("*").alias("n")))
    whole = means.groupBy("dim", "label").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("at", "x"))).alias("mean"))
    first = Window.partitionBy("dim").orderBy(F.desc("n"), "label")
    found = whole.withColumn("k", F.row_number().over(first)).filter(F.col("k") <= most).orderBy("dim", "k").collect()
    out: dict[int, np.ndarray] = {}
    for r in found:
        mean = np.array([c["x"] for c in r["mean"]])
        if norm := np.linalg.norm(mean):
            out[r["dim"]] = np.concatenate([out.get(r["dim"], np.empty((0, r["dim"]))), [mean / norm]])
    return out


def _angles(vectors: np.ndarray, norms: np.ndarray, references: np.ndarray) -> np.ndarray:
    cosine = (vectors / np.maximum(norms, 1)[:, None]) @ references.T
    return np.arccos(np.clip(cosine, -1, 1))


def blocks(rows: DataFrame, references: dict[int, np.ndarray], block_rows: int) -> DataFrame:
    """Rows of one length and label, near angles together, as arrays; at most block_rows to a block."""
    table = rows.sparkSession.sparkContext.broadcast(references)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near, angle = np.zeros(batch.num_rows, dtype=np.int32), np.zeros(batch.num_rows)
            dims, lists = np.asarray(batch.column("dim")), batch.column("vector")
            for dim in np.unique(dims):
                own = np.flatnonzero(dims == dim)
                if not dim or dim not in table.value:
                    continue
                vectors = np.asarray(lists.take(pa.array(own)).flatten()).reshape(len(own), dim).astype(float)
                angles = _angles(vectors, np.sqrt((vectors * vectors).sum(axis=1)), table.value[dim])
                near[own], angle[own] = angles.argmin(axis=1), angles.min(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near), pa.array(angle)], names=[*batch.schema.names, "near", "angle"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            dim, label, n = rows["dim"][0].as_py(), rows["label"][0].as_py(), rows.num_rows
            vectors = np.asarray(rows["vector"].chunk(0).flatten()).reshape(n, dim).astype(np.int32)
            norms = np.sqrt((vectors.astype(float) ** 2).sum(axis=1))
            angles = _angles(vectors, norms, table.value.get(dim, np.empty((0, dim))))
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([label]), pa.array([n], pa.int32()),
                 *(pa.array([x.tobytes()], pa.binary()) for x in (np.asarray(rows["vec_id"].chunk(0)), vectors, angles, norms)),
                 pa.array([angles.min(axis=0)], pa.list_(pa.float64())), pa.array([angles.max(axis=0)], pa.list_(pa.float64())),
                 pa.array([norms.min()]), pa.array([norms.max()])],
                names=["dim", "label", "n", "ids", "integers", "angles", "norms", "low", "high", "least", "most"])

        key = None
        for batch in batches:
            keys = list(zip(batch.column("dim").to_pylist(), batch.column("label").to_pylist()))
            low = 0
            for k in range(batch.num_rows):
                if keys[k] != key or sum(b.num_rows for b in held) + k - low >= block_rows:
                    held += [batch.slice(low, k - low)] * (k > low)
                    if held:
                        yield block()
                    held, low, key = [], k, keys[k]
            if batch.num_rows > low:
                held.append(batch.slice(low))
        if held:
            yield block()

    described = rows.mapInArrow(describe, "vec_id long, label long, dim int, vector array<long>, near int, angle double")
    order = ["dim", "label", "near", "angle", "vec_id"]
    n = min(partitions(rows.sparkSession), -(-rows.count() // block_rows) or 1)
    ranged = described.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return staged(ranged.mapInArrow(cut, _BLOCKS).withColumn("block", F.monotonically_increasing_id()), "blocks", "none")


class Side:
    """One block's arrays."""

    def __init__(self, row: dict, prefix: str) -> None:
        n, dim = row[f"{prefix}n"], row["dim"]
        self.ids = np.frombuffer(row[f"{prefix}ids"], dtype=np.int64)
        self.integers = np.frombuffer(row[f"{prefix}integers"], dtype=np.int32).reshape(n, dim)
        self.angles = np.frombuffer(row[f"{prefix}angles"]).reshape(n, -1)
        self.norms = np.frombuffer(row[f"{prefix}norms"])

    def groups(self) -> tuple[np.ndarray, ...]:
        """Ranges of angles and norms over groups of neighbouring rows."""
        cuts = np.arange(0, len(self.ids), _GROUP)
        return (np.minimum.reduceat(self.angles, cuts), np.maximum.reduceat(self.angles, cuts),
                np.minimum.reduceat(self.norms, cuts), np.maximum.reduceat(self.norms, cuts))


def score_bounds(angle: np.ndarray, norm: float, low: np.ndarray, high: np.ndarray, least: np.ndarray, most: np.ndarray):
    """Bounds of the scores of an anchor with rows whose angles lie in [low, high] (rows x references)
    and whose norms lie in [least, most]."""
    nearest = np.maximum(np.maximum(low - angle, angle - high), 0).max(axis=1, initial=0) - _MARGIN
    first, last = low + angle, high + angle
    around = np.where(last <= np.pi, last, np.where(first >= np.pi, 2 * np.pi - first, np.pi))
    farthest = around.min(axis=1, initial=np.pi) + _MARGIN
    upper, lower = np.cos(np.maximum(nearest, 0)), np.cos(np.minimum(farthest, np.pi))
    room = norm * most * _MARGIN + 1
    return (norm * np.where(lower > 0, least, most) * lower - room, norm * np.where(upper > 0, most, least) * upper + room)


def _scores(rows: Side, chosen: np.ndarray, anchor: np.ndarray, norm: float) -> np.ndarray:
    """Exact integer scores; floating point is exact where no sum can pass 2^53."""
    if len(chosen) and norm * rows.norms[chosen].max() < 2.0**52:
        return np.rint(rows.integers[chosen].astype(float) @ anchor.astype(float)).astype(np.int64)
    return rows.integers[chosen].astype(np.int64) @ anchor.astype(np.int64)


def _rows_of(groups: np.ndarray, n: int) -> np.ndarray:
    rows = (groups[:, None] * _GROUP + np.arange(_GROUP)).reshape(-1)
    return rows[rows < n]


def _best(rows: Side, anchor: int, vector: np.ndarray, angle: np.ndarray, norm: float, groups, wanted: int):
    """Ids and scores of the best rows of a block, best first, and how many were scored."""
    low, high = score_bounds(angle, norm, *groups)
    order = np.argsort(-high, kind="stable")
    ids, scores, done = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), 0
    for at in range(0, len(order), 4):
        part = order[at:at + 4]
        if len(ids) == wanted and high[part[0]] < scores[-1]:
            break
        chosen = _rows_of(part, len(rows.ids))
        if len(ids) == wanted:
            own = score_bounds(angle, norm, rows.angles[chosen], rows.angles[chosen], rows.norms[chosen], rows.norms[chosen])[1]
            chosen = chosen[own >= scores[-1]]
        chosen = chosen[rows.ids[chosen] != anchor]
        done += len(chosen)
        ids, scores = np.concatenate([ids, rows.ids[chosen]]), np.concatenate([scores, _scores(rows, chosen, vector, norm)])
        first = np.lexsort((ids, -scores))[:wanted]
        ids, scores = ids[first], scores[first]
    return ids, scores, done


def _meets(low: np.ndarray, high: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Whether each score interval overlaps any window."""
    return ((high[:, None] >= windows[:, 0]) & (low[:, None] <= windows[:, 1])).any(axis=1)


def _in_windows(rows: Side, vector: np.ndarray, angle: np.ndarray, norm: float, groups, windows: np.ndarray, wanted: int):
    """For each window the places and scores of its best rows in a block."""
    near = np.flatnonzero(_meets(*score_bounds(angle, norm, *groups), windows))
    chosen = _rows_of(near, len(rows.ids))
    if len(chosen):
        own = rows.angles[chosen], rows.norms[chosen]
        chosen = chosen[_meets(*score_bounds(angle, norm, own[0], own[0], own[1], own[1]), windows)]
    score = _scores(rows, chosen, vector, norm)
    order = np.lexsort((rows.ids[chosen], -score))
    score, chosen = score[order], chosen[order]
    for low, high in windows:
        # Scores fall, so a window is a stretch.
        begin, end = np.searchsorted(-score, -high, side="left"), np.searchsorted(-score, -low, side="right")
        yield chosen[begin:min(end, begin + wanted)], score[begin:min(end, begin + wanted)]


_PAYLOAD = ["n", "ids", "integers", "angles", "norms"]


def _pairs(anchors: DataFrame, rows: DataFrame, chosen: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """The chosen (a_block, block) with both sides' arrays, dealt evenly."""
    left = anchors.select(F.col("block").alias("a_block"), *[F.col(c).alias(f"a_{c}") for c in _PAYLOAD], *extra)
    right = rows.select("block", "dim", *_PAYLOAD)
    return (chosen.select("a_block", "block").join(right, "block").join(left, "a_block")
            .repartition(partitions(rows.sparkSession), "a_block", "block"))


def _meeting(anchors: DataFrame, rows: DataFrame) -> DataFrame:
    """Anchor blocks beside row blocks of one length, without their arrays. The row blocks are dealt
    over salts, so that no task holds all of them."""
    salts = partitions(rows.sparkSession)
    summary = [F.struct("label", "block", "low", "high", "least", "most").alias(name) for name in ("a", "r")]
    left = anchors.select("dim", summary[0], *[c for c in ("from_score", "to_score") if c in anchors.columns])
    left = left.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(rows.select("dim", summary[1], F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int").alias("salt")), ["dim", "salt"])


def _taking(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(name)[k].as_py() for name in batch.schema.names}


def positives(anchors: DataFrame, rows: DataFrame, wanted: int) -> DataFrame:
    """(a_block, anchor_at, anchor_id, rank, positive_id, score): the best other rows of the same label."""
    same = _meeting(anchors, rows).filter("a.label = r.label")
    pairs = _pairs(anchors, rows, same.select(F.col("a.block").alias("a_block"), F.col("r.block").alias("block")))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _taking(batches):
            a, r, out = Side(x, "a_"), Side(x, ""), []
            groups = r.groups()
            for k, anchor in enumerate(a.ids.tolist()):
                ids, scores, _ = _best(r, anchor, a.integers[k], a.angles[k], a.norms[k], groups, wanted)
                out.append((np.full(len(ids), k, dtype=np.int32), np.full(len(ids), anchor), ids, scores))
            at, anchor, ids, scores = (np.concatenate(c) for c in zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), x["a_block"])), pa.array(at), pa.array(anchor), pa.array(ids), pa.array(scores)],
                                             names=["a_block", "anchor_at", "anchor_id", "positive_id", "score"])

    found = pairs.mapInArrow(find, "a_block long, anchor_at int, anchor_id long, positive_id long, score long")
    best = Window.partitionBy("a_block", "anchor_at").orderBy(F.desc("score"), "positive_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= wanted)


def _overlapping(anchors: DataFrame, rows: DataFrame) -> DataFrame:
    """(a_block, block) of other labels whose score interval may meet a window of the anchors."""
    both = _meeting(anchors, rows).filter("a.label <> r.label")
    near = F.expr("greatest(0D, array_max(zip_with(zip_with(a.low, r.high, (x, y) -> x - y), zip_with(r.low, a.high, (x, y) -> x - y), (x, y) -> greatest(x, y))))")
    far = F.expr("array_min(zip_with(zip_with(a.low, r.low, (x, y) -> x + y), zip_with(a.high, r.high, (x, y) -> x + y), "
                 "(f, l) -> CASE WHEN l <= pi() THEN l WHEN f >= pi() THEN 2 * pi() - f ELSE pi() END))")
    # Without references nothing is known.
    upper = F.cos(F.greatest(F.coalesce(near, F.lit(0.0)) - 2 * _MARGIN, F.lit(0.0)))
    lower = F.cos(F.least(F.coalesce(far, F.lit(math.pi)) + 2 * _MARGIN, F.lit(math.pi)))
    most, least = F.col("a.most") * F.col("r.most"), F.col("a.least") * F.col("r.least")
    room = most * (2 * _MARGIN) + 2
    reaches = F.when(upper > 0, most).otherwise(least) * upper + room
    begins = F.when(lower > 0, least).otherwise(most) * lower - room
    return (both.filter((reaches >= F.col("from_score")) & (begins <= F.col("to_score")))
            .select(F.col("a.block").alias("a_block"), F.col("r.block").alias("block")))


def hard_negatives(table: DataFrame, wanted: int = 10, n_positives: int = 5, every: int = 100, low_share: int = 30, high_share: int = 90,
                   scale: int = 256, label: Column | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for anchors: the rows
    of (vec_id, label, embedding) whose id is divisible by `every`.

    A negative's score lies between low_share and high_share percent of the positive's.
    """
    rows = staged(integer_rows(table, scale, F.col("label") if label is None else label), "integers")
    references = reference_directions(rows)
    all_blocks = blocks(rows, references, block_rows)
    anchors = blocks(rows.filter(F.pmod("vec_id", F.lit(every)) == 0), references, ANCHOR_ROWS)
    mined = staged(positives(anchors, all_blocks, n_positives), "positives")

    # Whole scores from low to high: 100 s >= low_share * p and 100 s <= high_share * p.
    window = {"low": F.expr(f"cast(ceil(cast(score as decimal(20,0)) * {low_share} / 100) as long)"),
              "high": F.expr(f"cast(floor(cast(score as decimal(20,0)) * {high_share} / 100) as long)")}
    windows = mined.withColumns(window).filter("low <= high")
    # At most n_positives for each of a block's anchors.
    asked = windows.groupBy("a_block").agg(
        F.sort_array(F.collect_list(F.struct("anchor_at", "rank", "positive_id", "score", "low", "high"))).alias("asked"),
        F.min("low").alias("from_score"), F.max("high").alias("to_score"))
    asking = staged(anchors.join(asked.withColumnRenamed("a_block", "block"), "block"), "windows", "none")
    pairs = _pairs(asking, all_blocks, _overlapping(asking, all_blocks), ("asked",))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _taking(batches):
            a, r, out = Side(x, "a_"), Side(x, ""), []
            groups, own = r.groups(), {}
            for w in x["asked"]:
                own.setdefault(w["anchor_at"], []).append(w)
            for k, mine in own.items():
                limits = np.array([(w["low"], w["high"]) for w in mine])
                found = _in_windows(r, a.integers[k], a.angles[k], a.norms[k], groups, limits, wanted)
                for w, (places, scores) in zip(mine, found):
                    out += [(int(a.ids[k]), k, w["rank"], w["positive_id"], w["score"], i, s) for i, s in zip(r.ids[places].tolist(), scores.tolist())]
            columns = list(zip(*out)) or [()] * 7
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([x["a_block"]] * len(out), pa.int64()), *(pa.array(c, t) for c, t in zip(columns, kinds))],
                                             names=["a_block", "anchor_id", "anchor_at", "positive", "positive_id", "positive_score", "negative_id", "negative_score"])

    found = pairs.mapInArrow(find, "a_block long, anchor_id long, anchor_at int, positive int, positive_id long, positive_score long, negative_id long, negative_score long")
    best = Window.partitionBy("a_block", "anchor_at", "positive").orderBy(F.desc("negative_score"), "negative_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= wanted)
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))
