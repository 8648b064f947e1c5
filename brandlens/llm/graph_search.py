"""Approximate nearest neighbours by cosine: robust-pruned directed graphs over shards.

Equal vectors become one node. Nodes are dealt to shards by hash, each shard small enough for one
task. A shard's graph grows node by node: a greedy beam search from the entry proposes neighbours,
and relaxed distance pruning keeps an edge only if no kept neighbour is clearly nearer to its end.
Queries go in blocks to every shard, a beam search finds candidates there, and their cosines are
computed again in double precision on the vectors as given.

A node stands for all ids of its vector; the `nearest + 1` smallest ids are kept with it, since no
other id of an equal vector can come among a query's nearest (ties go to smaller ids).

Cases: vectors that are null, zero or hold null or non-finite components take no part, neither do
rows without id; vectors of other lengths are never compared; queries without candidates have no
rows; an id that occurs twice is two candidates unless the vectors are equal, and no query meets
its own id; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .shared import staged

_INDEX = "dim int, shard int, n long, ids binary, vectors binary, edges binary, entry int"
_FOUND = "query_id long, vec_id long, score double"


def _search(unit: np.ndarray, edges: np.ndarray, entry: int, goal: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Greedy beam search: the nodes reached, nearest first, and their distances (1 - cosine)."""
    seen = np.zeros(len(unit), dtype=bool)
    seen[entry] = True
    ids, far, done = np.array([entry]), np.array([1 - unit[entry] @ goal]), np.zeros(1, dtype=bool)
    while not done.all():
        k = int(np.argmin(done))
        done[k] = True
        new = edges[ids[k]]
        new = new[new >= 0]
        new = new[~seen[new]]
        if not len(new):
            continue
        seen[new] = True
        ids, far = np.concatenate([ids, new]), np.concatenate([far, 1 - unit[new] @ goal])
        done = np.concatenate([done, np.zeros(len(new), dtype=bool)])
        order = np.argsort(far, kind="stable")[:beam]
        ids, far, done = ids[order], far[order], done[order]
    return ids, far


def _prune(unit: np.ndarray, ids: np.ndarray, far: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """Keep the nearest, drop what lies clearly nearer to a kept node than to the centre, and so on."""
    order = np.argsort(far, kind="stable")
    ids, far = ids[order], far[order]
    between = 1 - unit[ids] @ unit[ids].T
    alive, kept = np.ones(len(ids), dtype=bool), []
    while len(kept) < degree and alive.any():
        k = int(np.argmax(alive))
        kept.append(k)
        alive &= relax * between[k] > far
        alive[k] = False
    return ids[kept]


def build_graph(vectors: np.ndarray, degree: int = 24, beam: int = 48, relax: float = 1.2, seed: int = 5) -> tuple[np.ndarray, int]:
    """Edges (-1 where there is none) and the entry node of a graph over the rows of vectors.

    A node that others point back to may hold twice `degree` edges before it is pruned again.
    """
    n = len(vectors)
    unit = unit_rows(vectors)
    edges, size = np.full((n, 2 * degree), -1, dtype=np.int32), np.zeros(n, dtype=np.int32)
    entry = int(np.argmax(unit @ unit.mean(axis=0)))
    for node in np.random.default_rng(seed).permutation(n):
        if node == entry:
            continue
        ids, far = _search(unit, edges, entry, unit[node], beam)
        kept = _prune(unit, ids, far, degree, relax)
        edges[node, :len(kept)], size[node] = kept, len(kept)
        for other in kept:
            if size[other] == 2 * degree:
                around = edges[other].copy()
                again = _prune(unit, around, 1 - unit[around] @ unit[other], degree, relax)
                edges[other], size[other] = -1, len(again)
                edges[other, :len(again)] = again
            edges[other, size[other]] = node
            size[other] += 1
    return edges, entry


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / largest
    return (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float32)


def _usable(table: DataFrame) -> DataFrame:
    """Rows with an id and a vector of finite numbers that are not all zero."""
    v = F.col("vector")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)) & F.exists(v, lambda x: x != 0)
    return (table.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector"))
            .filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).filter(F.coalesce(fine, F.lit(False))))


def index(table: DataFrame, nearest: int, shard_rows: int = 4096, **options) -> DataFrame:
    """One row for each shard: its nodes' ids and vectors, and its graph. Written to the shared folder."""
    rows = _usable(table)
    first = Window.partitionBy("vector").orderBy("vec_id")
    nodes = (rows.withColumn("k", F.row_number().over(first)).filter(F.col("k") <= nearest + 1)
             .groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    nodes = staged(nodes.withColumn("dim", F.size("vector")), "vectors")
    shards = nodes.groupBy("dim").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("shards"))
    dealt = nodes.join(F.broadcast(shards), "dim").select("dim", F.pmod(F.xxhash64("vector"), "shards").cast("int").alias("shard"), "vector", "ids")

    def build(key, group):
        dim, n = key[0].as_py(), group.num_rows
        vectors = np.asarray(group.column("vector").combine_chunks().flatten(), dtype=float).reshape(n, dim)
        ids = np.full((n, nearest + 1), -1, dtype=np.int64)
        for at, own in enumerate(group.column("ids").to_pylist()):
            ids[at, :len(own)] = own
        edges, entry = build_graph(vectors, **options)
        return pa.table({"dim": pa.array([dim], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int32()), "n": pa.array([n], pa.int64()),
                         "ids": pa.array([ids.tobytes()], pa.binary()), "vectors": pa.array([vectors.tobytes()], pa.binary()),
                         "edges": pa.array([edges.tobytes()], pa.binary()), "entry": pa.array([entry], pa.int32())})

    return staged(dealt.groupBy("dim", "shard").applyInArrow(build, _INDEX), "graphs")


def search(shards: DataFrame, queries: DataFrame, nearest: int = 5, beam: int = 80, block_rows: int = 256) -> DataFrame:
    """query_id, rank, vec_id and score of the nearest nodes of each query (vec_id, embedding)."""
    wanted = _usable(queries).withColumn("dim", F.size("vector"))
    n_shards = shards.groupBy("dim").agg(F.count("*").cast("int").alias("shards"))
    n_blocks = wanted.groupBy("dim").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    # Both tables have a row for each length of vectors.
    blocks = (wanted.join(F.broadcast(n_blocks), "dim").withColumn("block", F.pmod(F.xxhash64("vec_id", "vector"), "blocks"))
              .groupBy("dim", "block").agg(F.collect_list("vec_id").alias("query_ids"), F.flatten(F.collect_list("vector")).alias("goals")))
    asked = blocks.join(F.broadcast(n_shards), "dim").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    # Every block of queries meets every shard once, by the shard's key.
    pairs = asked.join(shards, ["dim", "shard"]).select("dim", "query_ids", "goals", "ids", "vectors", "edges", "entry", "n")
    dealt = pairs.repartition("query_ids", "entry", "n")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                x = {name: batch.column(name)[row] for name in batch.schema.names}
                dim, n = x["dim"].as_py(), x["n"].as_py()
                vectors = np.frombuffer(x["vectors"].as_py(), dtype=float).reshape(n, dim)
                ids = np.frombuffer(x["ids"].as_py(), dtype=np.int64).reshape(n, -1)
                edges = np.frombuffer(x["edges"].as_py(), dtype=np.int32).reshape(n, -1)
                unit, norms = unit_rows(vectors), np.sqrt((vectors * vectors).sum(axis=1))
                own = np.asarray(x["query_ids"].values)
                goals = np.asarray(x["goals"].values, dtype=float).reshape(len(own), dim)
                out = [_best(vectors, norms, ids, _search(unit, edges, x["entry"].as_py(), g, beam)[0], q, v, nearest)
                       for q, v, g in zip(own, goals, unit_rows(goals))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(own, [len(o[0]) for o in out])), pa.array(np.concatenate([o[0] for o in out])),
                     pa.array(np.concatenate([o[1] for o in out]))], names=["query_id", "vec_id", "score"])

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (dealt.mapInArrow(answer, _FOUND).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= nearest)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def _best(vectors: np.ndarray, norms: np.ndarray, ids: np.ndarray, found: np.ndarray, own: int, goal: np.ndarray, nearest: int):
    """Ids and cosines of the nearest of the nodes found, without the query's own id."""
    score = (vectors[found] * goal).sum(axis=1) / (norms[found] * np.sqrt((goal * goal).sum()))
    members = ids[found]
    wanted = (members >= 0) if own < 0 else (members >= 0) & (members != own)
    who, value = members[wanted], np.repeat(score[:, None], members.shape[1], axis=1)[wanted]
    order = np.lexsort((who, -value))[:nearest]
    return who[order], value[order]


def nearest_rows(table: DataFrame, nearest: int = 5, every: int = 50) -> DataFrame:
    """The nearest rows of each row of (vec_id, embedding) whose id is divisible by `every`."""
    return search(index(table, nearest), table.filter(F.col("vec_id") % every == 0), nearest)
