"""Graph search, passage classifier and the pipeline."""
import zlib

import numpy as np
import pytest

import corpus_pipeline
from brandlens.llm import graph_search, passages
from brandlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
TABLE = "vec_id long, embedding array<float>, rank string, score string, vector int"


def exact(rows, nearest, every):
    out = {}
    for q, v, *_ in rows:
        if q is None or q % every or not usable(v):
            continue
        all_ = [(-cosine(v, w), i) for i, w, *_ in rows if i is not None and i != q and usable(w) and len(w) == len(v)]
        out[q] = sorted(all_)[:nearest]
    return out


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)


def cosine(a, b):
    a, b = np.array(a, float), np.array(b, float)
    return (a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum()))


def test_recall_on_embeddings(llm):
    rows = [(r.vec_id, list(r.embedding)) for r in llm.read.parquet(f"{SF}/embeddings.parquet").collect()]
    truth, found = exact(rows, 5, 50), {}
    for r in QUERIES["op9_graph_search"](llm, SF).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    assert found.keys() == truth.keys()
    hits = sum(len({i for _, i in found[q]} & {i for _, i in truth[q]}) for q in truth)
    assert hits / (5 * len(truth)) >= 0.9
    vectors = dict(rows)
    for q, near in found.items():
        assert all(-s == pytest.approx(cosine(vectors[q], vectors[i]), abs=1e-12) for s, i in near)


def test_recall_over_several_shards(llm):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(1200, 24)).astype(np.float32)
    table = llm.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    index = graph_search.index(table, 5, shard_rows=200)
    assert index.count() > 4
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    hits = 0
    for r in graph_search.search(index, table.filter("vec_id % 20 = 0"), 5, block_rows=16).collect():
        near = np.argsort(-(unit @ unit[r.query_id]))
        hits += r.vec_id in near[near != r.query_id][:5]
    assert hits / (60 * 5) >= 0.9


def test_odd_vectors(llm):
    """Copies, scaled copies, ties, other lengths and unusable vectors."""
    rows = [(i, [1.0, 0.0, 0.5]) for i in (0, 1, 2, 3, 4, 5, 6, 7, 50)] + [(8, [2.0, 0.0, 1.0]), (9, [0.0, 1.0, 0.0]), (100, [0.0, 1.0]), (101, [1.0, 1.0]), (150, None),
            (200, [0.0, 0.0, 0.0]), (250, [1.0, None, 2.0]), (300, [float("nan"), 1.0, 1.0]), (350, [float("inf"), 1.0, 1.0]), (None, [1.0, 0.0, 0.5]), (400, [])]
    rows = [(*r, "a", "b", 3) for r in rows]
    table = llm.createDataFrame(rows, TABLE)
    found = {}
    for r in graph_search.nearest_rows(table).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert found[0][:4] == [1, 2, 3, 4] and found[50][:4] == [0, 1, 2, 3] and found[100] == [101]
    assert set(found) == {0, 50, 100}
    assert graph_search.nearest_rows(table.filter("vec_id < -1")).count() == 0


def test_gradients_by_differences():
    rng = np.random.default_rng(2)
    n, y = np.array([2, 1, 4]), np.array([1.0, 0.0, 1.0])
    x = rng.normal(size=(7, 5))
    shapes = {"encode": (5, 3), "encode_bias": (3,), "attend": (3, 3), "gate": (3, 3), "weigh": (3,), "score": (3,), "score_bias": (1,)}
    w = {k: rng.normal(size=s) for k, s in shapes.items()}

    def loss():
        p = passages._forward(w, x, n)["p"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    for name, gradient in passages._gradients(w, x, n, y).items():
        for place in np.ndindex(w[name].shape):
            kept = w[name][place]
            w[name][place] = kept + 1e-6
            up = loss()
            w[name][place] = kept - 1e-6
            down = loss()
            w[name][place] = kept
            assert gradient[place] == pytest.approx((up - down) / 2e-6, abs=1e-6)


def test_attention_finds_the_bad_passage():
    """Documents are bad because of one passage; attention must weigh it most."""
    good, bad = "some quiet words in a plain line of text. " * 40, "LOUD!! $$$ NOISE!! " * 22
    rng = np.random.default_rng(1)
    texts = [good * 2 + (bad if i % 2 else "") + good * int(rng.integers(1, 4)) for i in range(60)]
    y = np.array([1.0 - i % 2 for i in range(60)])
    x, n = passages.features(texts)
    model = passages.fit(x, n, y)
    assert ((model.scores(x, n) >= 0.5) == y).all()


def test_held_out_accuracy(llm):
    found = {r.doc_id: r for r in QUERIES["op10_passages"](llm, SF).collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5) for d, r in found.items())
    labels = [r for r in llm.read.parquet(f"{SF}/labels.parquet").collect() if found[r.doc_id].held_out]
    assert np.mean([found[r.doc_id].predicted == r.quality for r in labels]) >= 0.95


def test_classifier_on_odd_rows(llm, odd, none):
    labels = llm.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (6, 0), (7, 1), (8, 0), (11, 1)], "doc_id long, quality int")
    found = passages.classified(odd, labels).collect()
    assert len(found) == odd.count() and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id in (3, 4, 5, 10)}) == 1
    assert passages.classified(none, labels).count() == 0
    assert {r.score for r in passages.classified(odd, labels.filter("quality = 3")).collect()} == {0.5}
    scored = passages.score(odd, passages.train(odd, labels))
    assert sorted(scored.columns) == sorted(odd.columns)


def test_pipeline_stages(llm, odd):
    """Each stage's rows follow from the rows before; clean documents stay."""
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    sf_dir, before = SF, docs
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frames.append(stage(llm, frames[-1], sf_dir).cache())
        assert frames[-1].columns == before.columns
    rows = [{r.doc_id: r.text for r in f.collect()} for f in frames]
    labels = {r.doc_id: r.quality for r in llm.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert all(labels.get(d, 1) == 1 for d in rows[1]) and all(d in rows[1] for d, q in labels.items() if q == 1)
    assert set(rows[2]) <= set(rows[1]) and all(rows[2][d] == rows[1][d] for d in rows[2])
    assert set(rows[3]) == set(rows[2]) and set(rows[4]) == set(rows[3]) and all(rows[4][d] == rows[3][d] for d in rows[4])
    packed = corpus_pipeline.STAGES[-1][1](llm, frames[-1], sf_dir).toPandas()
    whole = corpus_pipeline.run(llm, sf_dir).toPandas()
    assert len(corpus_pipeline.STAGES) == 5 and whole["length"].sum() == packed["length"].sum()


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_odd_rows(llm, odd, none, empty):
    docs = none if empty else odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(llm, docs, "/root/testdata/sf0.001")
        assert out.columns == odd.columns
        assert (out.count() == 0) == empty
    assert (corpus_pipeline.STAGES[-1][1](llm, docs, "/root/testdata/sf0.001").count() == 0) == empty
