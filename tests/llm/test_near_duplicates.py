"""Links and classes against brute force over all pairs."""
import random
import re

import numpy as np
import pytest

from brandlens.llm import near_duplicates as nd, repeats
from brandlens.llm.components import components
from brandlens.llm.queries import QUERIES

LOWER = {i: i + 32 for i in range(65, 91)}


def brute_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4)) or (frozenset([tuple(words)]) if words else frozenset())


def brute(rows):
    """component of each row, by position."""
    sets = [brute_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= 75 * len(a | b):
                parent[top(i)] = top(j)
    names = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            names[top(i)] = min(names.get(top(i), doc), doc)
    return [(doc, len(s), names.get(top(i)) if doc is not None else None) for i, ((doc, _), s) in enumerate(zip(rows, sets))]


def key(rows):
    return sorted(rows, key=str)


def found(df):
    return key((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def edited(rng, words, share):
    return [rng.choice("abcdefgh") * 3 if rng.random() < share else w for w in words]


def corpus(seed, groups=6, size=14):
    """Groups of edited copies around the threshold, and a passage that all documents share."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(30)]
    rows = []
    for g in range(groups):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([6, 20, 60, 150]))]
        for _ in range(size):
            words = edited(rng, base, rng.choice([0, 0.01, 0.03, 0.06]))
            rows.append((len(rows), " ".join(words + passage * rng.randrange(2))))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", [None, -1.0, 3.0])
def test_classes_of_edited_copies(llm, monkeypatch, limit):
    """Also with all elements frequent, and with few of them."""
    if limit is not None:
        emit = nd._entries
        monkeypatch.setattr(nd, "_BLOCK_NODES", 5)
        monkeypatch.setattr(nd, "_entries", lambda docs, counts: emit(docs, np.where(counts > limit, 1 << 40, 0)))
    rows = corpus(3)
    assert found(nd.near_duplicates(llm.createDataFrame(rows, "doc_id long, text string").repartition(4))) == key(brute(rows))


def test_index_entries_meet_for_all_linked_pairs():
    """Any two sets above the threshold share an entry, whatever is frequent."""
    rng = np.random.default_rng(5)
    for _ in range(400):
        n = int(rng.integers(1, 120))
        pool = np.unique(rng.integers(0, 1 << 63, 2 * n + 8, dtype=np.uint64))
        often = rng.random(len(pool)) < rng.choice([0, 0.3, 0.8, 1])
        a = np.sort(rng.choice(len(pool), n, replace=False))
        b = np.unique(np.concatenate([a[rng.random(n) < rng.choice([0.85, 0.95, 1])], rng.choice(len(pool), int(rng.integers(0, n // 6 + 1)), replace=False)]))
        both = len(np.intersect1d(a, b))
        if not len(b) or 100 * both < 75 * (len(a) + len(b) - both) or np.array_equal(a, b):
            continue
        x, y = (nd.index_entries(pool[i], often[i]) for i in (a, b))
        assert len(np.intersect1d(x, y))


def test_odd_rows(odd, none):
    assert found(nd.near_duplicates(odd)) == key(brute([(r.doc_id, r.text) for r in odd.collect()]))
    assert nd.near_duplicates(none).count() == 0
    kept = nd.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "3", "4", "5", "None", "6", "8", "9", "10", "11", "11"])


def test_one_row_of_each_class_stays(llm):
    """Of equal rows, of copies without id and of near copies one keeps its text through the next stage."""
    one, two, three, own, near = (" ".join(f"{c}{i}" for i in range(150)) for c in "abcde")
    rows = [(1, one), (1, one), (None, two), (None, two), (None, two), (3, three), (None, three), (4, near), (5, near + " end"), (5, own), (6, None), (6, None)]
    docs = llm.createDataFrame([(d, t, i) for i, (d, t) in enumerate(rows)], "doc_id long, text string, key long").repartition(3)
    kept = nd.keep_one(docs)
    assert kept.columns == docs.columns
    expected = sorted([(1, one), (None, two), (3, three), (4, near), (5, own), (6, None), (6, None)], key=str)
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=str) == expected
    assert sorted([(r.doc_id, r.text) for r in repeats.deduplicated(kept).collect()], key=str) == expected


def test_documents(llm):
    rows = [(r.doc_id, r.text) for r in llm.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert found(QUERIES["op5_near_duplicates"](llm, "/root/testdata/sf0.001")) == key(brute(rows))


def test_components_of_a_long_chain(llm):
    order = list(range(300))
    random.Random(1).shuffle(order)
    edges = list(zip(order, order[1:])) + [(500, 501), (501, 500), (600, 600)]
    labels = {r.node: r.label for r in components(llm.createDataFrame(edges, "a long, b long")).collect()}
    assert labels == {n: 0 for n in range(300)} | {500: 500, 501: 500}
