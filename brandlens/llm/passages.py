"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages of 64 words. An encoder turns each passage's features into a
vector, gated attention weighs the passages, and a logistic unit scores the weighted sum. Encoder,
attention and score are learned together from document labels alone.

The features of a passage come from its bytes only: shares of pairs of neighbouring byte classes
(lower, upper, digit, space, line end, symbols ...), word lengths, and how many of its words,
word triples and lines occur elsewhere in the passage or text.

Training takes a bounded sample of labelled rows (parameter `most_rows`, smallest hashes of
doc_id first); scoring reads every passage of every text.

Cases: a null, empty or blank text is one passage of zeros and gets that bag's score; a null
doc_id counts as an empty string for the held-out rule; null labels do not train; without labels
of both kinds the score is the labels' mean, or 0.5 without any; repeated rows score alike; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .shared import slices, text_column
from .text_hash import Stretches, joined, mixed, words

PASSAGE_WORDS = 64
HELD_OUT = 1


def _byte_classes() -> np.ndarray:
    kinds = np.full(256, 9, dtype=np.int64)
    kinds[128:] = 0
    for kind, chars in enumerate(["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\x0b\x0c", "\n\r", ".",
                                  ",;:", "!?", "#*$%&|<>"]):
        kinds[list(chars.encode())] = kind
    return kinds


_CLASSES = _byte_classes()
_N = 10
N_FEATURES = _N * _N + 6


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of the texts, and the number of passages of each text."""
    raw = [t.encode() for t in texts]
    buffer, begins = joined(raw)
    start, end = words(buffer)
    doc = np.searchsorted(begins, start, side="right") - 1
    n_words = np.bincount(doc, minlength=len(texts))[:len(texts)]
    n = np.maximum(-(-n_words // PASSAGE_WORDS), 1)
    first_passage = np.cumsum(n) - n
    first_word = np.cumsum(n_words) - n_words
    passage = first_passage[doc] + (np.arange(len(start)) - first_word[doc]) // PASSAGE_WORDS
    total = int(n.sum())
    out = np.zeros((total, N_FEATURES), dtype=np.float32)
    if not len(start):
        return out, n
    # A byte belongs to the passage of the word that starts last before it.
    of_byte = np.repeat(passage, np.diff(np.concatenate([[0], start[1:], [len(buffer) - 1]])))
    kinds = _CLASSES[buffer]
    pairs = np.bincount(of_byte * (_N * _N) + kinds[:-1] * _N + kinds[1:], minlength=total * _N * _N)
    pairs = pairs[:total * _N * _N].reshape(total, -1).astype(np.float32)
    out[:, :_N * _N] = np.sqrt(pairs / np.maximum(pairs.sum(axis=1, keepdims=True), 1))
    in_passage = np.maximum(np.bincount(passage, minlength=total), 1)
    out[:, -1] = np.log1p(np.bincount(passage, minlength=total)) / 4
    out[:, -2] = np.bincount(passage, end - start, total) / in_passage / 10
    word = Stretches(buffer).hashes(start, end)

    def again(keys: np.ndarray) -> np.ndarray:
        """Share of a passage's words whose key occurs more than once."""
        _, at, times = np.unique(keys, return_inverse=True, return_counts=True)
        return np.bincount(passage, times[at] > 1, total) / in_passage

    step = np.uint64(0x9E3779B97F4A7C15)
    out[:, -3] = again(mixed(word + passage.astype(np.uint64) * step))
    out[:, -4] = again(mixed(word + doc.astype(np.uint64) * step))
    triple = word.copy()
    if len(word) > 2:
        triple[:-2] = mixed(word[:-2] * np.uint64(3) + word[1:-1] * np.uint64(5) + word[2:] * np.uint64(7))
        triple[:-2][doc[:-2] != doc[2:]] += np.arange(len(word) - 2, dtype=np.uint64)[doc[:-2] != doc[2:]]
    out[:, -5] = again(mixed(triple + doc.astype(np.uint64) * step))
    out[:, -6] = np.bincount(passage, np.isin(buffer[start], np.arange(65, 91)), total) / in_passage
    return out, n


@dataclass
class Model:
    """Weights of the encoder, the gated attention and the score."""
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    constant: float | None = None

    def scores(self, x: np.ndarray, n: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(n), self.constant)
        return _forward(self.weights, np.clip((x - self.mean) / self.scale, -8, 8), n)["p"]


def _sums(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, np.cumsum(n) - n, axis=0)


def _forward(w: dict[str, np.ndarray], x: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
    h = np.tanh(x @ w["encode"] + w["encode_bias"])
    tall, gate = np.tanh(h @ w["attend"]), 1 / (1 + np.exp(-(h @ w["gate"])))
    logit = (tall * gate) @ w["weigh"]
    logit = np.exp(logit - np.repeat(np.maximum.reduceat(logit, np.cumsum(n) - n), n))
    a = logit / np.repeat(_sums(logit, n), n)
    bag = _sums(a[:, None] * h, n)
    return {"h": h, "tall": tall, "gate": gate, "a": a, "bag": bag, "p": 1 / (1 + np.exp(-(bag @ w["score"] + w["score_bias"])))}


def _gradients(w: dict[str, np.ndarray], x: np.ndarray, n: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    f = _forward(w, x, n)
    d = (f["p"] - y) / len(y)
    d_bag = np.repeat(d[:, None] * w["score"], n, axis=0)
    d_a = (d_bag * f["h"]).sum(axis=1)
    d_logit = f["a"] * (d_a - np.repeat(_sums(f["a"] * d_a, n), n))
    product = f["tall"] * f["gate"]
    d_tall = d_logit[:, None] * w["weigh"] * f["gate"] * (1 - f["tall"] ** 2)
    d_gate = d_logit[:, None] * w["weigh"] * product * (1 - f["gate"])
    d_h = (f["a"][:, None] * d_bag + d_tall @ w["attend"].T + d_gate @ w["gate"].T) * (1 - f["h"] ** 2)
    return {"encode": x.T @ d_h, "encode_bias": d_h.sum(axis=0), "attend": f["h"].T @ d_tall, "gate": f["h"].T @ d_gate,
            "weigh": product.T @ d_logit, "score": f["bag"].T @ d, "score_bias": d.sum(keepdims=True)}


def fit(x: np.ndarray, n: np.ndarray, y: np.ndarray, width: int = 16, rounds: int = 60, least_steps: int = 600, bags: int = 64,
        rate: float = 0.005, decay: float = 1e-4, seed: int = 7) -> Model:
    """Learn from bags of passages (rows of x, n to a bag) with labels y of 0 and 1.

    rounds: passes over the bags, more if that gives fewer than `least_steps` steps.
    """
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), {}, float(y.mean()) if len(y) else 0.5)
    draw = np.random.default_rng(seed)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-2
    x = np.clip((x - mean) / scale, -8, 8)
    shapes = {"encode": (x.shape[1], width), "encode_bias": (width,), "attend": (width, width), "gate": (width, width), "weigh": (width,),
              "score": (width,), "score_bias": (1,)}
    w = {k: draw.normal(0, 1 / np.sqrt(s[0]), s) * (not k.endswith("bias")) for k, s in shapes.items()}
    first, second, step = {k: 0.0 for k in w}, {k: 0.0 for k in w}, 0
    begin = np.cumsum(n) - n
    batches = max(len(y) // bags, 1)
    for _ in range(max(rounds, -(-least_steps // batches))):
        for chosen in np.array_split(draw.permutation(len(y)), batches):
            rows = np.concatenate([np.arange(begin[i], begin[i] + n[i]) for i in chosen])
            step += 1
            for k, g in _gradients(w, x[rows], n[chosen], y[chosen]).items():
                g = g + decay * w[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                w[k] = w[k] - rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return Model(mean, scale, w)


def remainder(doc_id: Column) -> Column:
    """crc32 of doc_id as text, modulo 3; a null doc_id is an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3


def train(docs: DataFrame, labels: DataFrame, most_rows: int = 4000, **options) -> Model:
    """Learn quality from labelled documents outside the held-out third, at most `most_rows` of them."""
    chosen = (labels.filter(F.col("quality").isin(0, 1) & (remainder(F.col("doc_id")) != HELD_OUT)).select("doc_id", "quality")
              .orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(most_rows))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                x, n = features(text_column(rows))
                cut = np.split(x, np.cumsum(n)[:-1])
                yield pa.RecordBatch.from_arrays([rows.column("doc_id").cast(pa.int64()), rows.column("quality"),
                                                  pa.array([c.tobytes() for c in cut], pa.binary())], names=["doc_id", "quality", "x"])

    # At most most_rows labels are broadcast, and their passages are gathered.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", F.col("quality").cast("int").alias("quality"))
    rows = sample.mapInArrow(extract, "doc_id long, quality int, x binary").toPandas().sort_values(["doc_id", "x"])
    bags = [np.frombuffer(b, dtype=np.float32).reshape(-1, N_FEATURES) for b in rows["x"]]
    x = np.concatenate(bags) if bags else np.zeros((0, N_FEATURES), np.float32)
    return fit(x, np.array([len(b) for b in bags], dtype=np.int64), rows["quality"].to_numpy(dtype=float), **options)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with a column quality_score, between 0 and 1; a column of that name is replaced."""
    spark, docs = docs.sparkSession, docs.drop("quality_score")
    shared = spark.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema, T.StructField("quality_score", T.DoubleType())])

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                p = shared.value.scores(*features(text_column(rows)))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(p, pa.float64())], names=[*rows.schema.names, "quality_score"])

    return docs.mapInArrow(rate, schema)


def classified(docs: DataFrame, labels: DataFrame, most_rows: int = 4000) -> DataFrame:
    """doc_id, held_out, score and predicted of each document."""
    return (score(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), train(docs, labels, most_rows))
            .select("doc_id", (remainder(F.col("doc_id")) == HELD_OUT).alias("held_out"), F.col("quality_score").alias("score"),
                    (F.col("quality_score") >= 0.5).cast("int").alias("predicted")))
