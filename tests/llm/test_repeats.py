"""Suffix arrays and cuts against brute force."""
import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from brandlens.llm import repeats, suffix_sort
from brandlens.llm.queries import QUERIES
from brandlens.llm.shared import staged


def brute(texts, size=400):
    """Per text: bytes, removed, spans, digest."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + size] for b in raw for i in range(len(b) - size + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - size + 1):
            if seen[b[i:i + size]] > 1:
                gone[i:i + size] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    return out


def found(df):
    return sorted(((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()))


def test_suffix_array():
    rng = random.Random(1)
    for _ in range(200):
        data = bytes(rng.choice(b"aab") for _ in range(rng.randint(1, 60))) + b"\xff" * rng.randrange(2)
        assert suffix_sort.suffix_array(data, 100).tolist() == sorted(range(len(data)), key=lambda i: data[i:])


def test_common_prefixes():
    data = b"abcdefghijklmnopabcdefghijklmnoq" * 2
    places = np.array([0, 16, 32])
    assert suffix_sort.common_prefixes(data, places, 24).tolist() == [8, 8]


def corpus(seed):
    """Texts of random words with shared passages around the length, periods and copies."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(2, 9)))
    passages = [" ".join(word() for _ in range(n)) for n in (40, 60, 62, 64, 66, 70, 120, 300)]
    rows = []
    for i in range(40):
        parts = [" ".join(word() for _ in range(rng.randint(0, 60)))]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(passages), " ".join(word() for _ in range(rng.randint(0, 40)))]
        rows.append((i, " ".join(parts)))
    rows += [(100, "xy" * 500), (101, "z" * 399), (102, "z" * 400), (103, "q" * 401), (104, "ab" * 199 + "abc" + "ab" * 200)]
    # One passage in many surroundings.
    rows += [(200 + i, f"{word()} {word()} {passages[6]} {word()} {i}") for i in range(40)]
    return rows


@pytest.mark.parametrize("block", [512, 3])
def test_cut(llm, monkeypatch, block):
    monkeypatch.setattr(repeats, "_BLOCK_CONTEXTS", block)
    monkeypatch.setattr(repeats, "_BUNDLE_BYTES", 4000)
    rows = corpus(2)
    assert found(repeats.cut(llm.createDataFrame(rows, "doc_id long, text string").repartition(3))) == sorted(
        (str(d), *x) for (d, _), x in zip(rows, brute([t for _, t in rows])))


def test_slices_of_long_texts(llm):
    rows = corpus(4) + [(300, "".join(t for _, t in corpus(5)[:12])), (301, "".join(t for _, t in corpus(5)[6:20]))]
    assert max(len(t) for _, t in rows) > 5000
    assert found(repeats.cut(llm.createDataFrame(rows, "doc_id long, text string").repartition(3), slice_windows=700)) == sorted(
        (str(d), *x) for (d, _), x in zip(rows, brute([t for _, t in rows])))


@pytest.mark.parametrize("size", [240, 120])
def test_other_lengths(llm, size):
    rows = corpus(3)
    assert found(repeats.cut(llm.createDataFrame(rows, "doc_id long, text string").repartition(3), size)) == sorted(
        (str(d), *x) for (d, _), x in zip(rows, brute([t for _, t in rows], size)))


def test_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(repeats.cut(odd)) == sorted((str(d), *x) for (d, _), x in zip(rows, brute([t for _, t in rows])))
    assert repeats.cut(none).count() == 0
    left = repeats.deduplicated(odd)
    assert left.columns == odd.columns and left.count() == len(rows)
    texts = {r.n: r.text for r in left.collect()}
    assert [texts[i] for i in (0, 1, 2, 3)] == ["", "", "", None]


def test_documents(llm):
    rows = [(r.doc_id, r.text) for r in llm.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert found(QUERIES["op7_repeats"](llm, "/root/testdata/sf0.001")) == sorted((str(d), *x) for (d, _), x in zip(rows, brute([t for _, t in rows])))


def test_lists_come_from_arrays():
    """Members and windows are built without an object for each window; the hashes of a batch stay small."""
    runs = repeats._runs([np.array([True, True, False, True]), np.array([], dtype=bool), np.array([False])])
    assert runs.to_pylist() == [[{"low": 0, "high": 1}, {"low": 3, "high": 3}], [], []]
    lists = repeats._lists(np.array([2, 0, 1]), runs.type.value_type, [np.arange(3), np.arange(3)], np.array([False, True, False]))
    assert lists.to_pylist() == [[{"low": 0, "high": 0}, {"low": 1, "high": 1}], None, [{"low": 2, "high": 2}]]
    assert repeats._SLICE_BYTES <= 256 << 10


def test_rows_joined_by_chain(llm, monkeypatch):
    """Only chains that occur twice are joined by name, and their rows grow as the texts that share a passage."""
    passage = corpus_passage(1500)

    def joined(n):
        frames = {}
        monkeypatch.setattr(repeats, "staged", lambda df, name: frames.setdefault(name, staged(df, name)))
        rows = [(i, f"{corpus_passage(50, 2000 + i)} {passage} {corpus_passage(50, 3000 + i)}") for i in range(n)]
        texts = repeats._keyed(llm.createDataFrame(rows, "doc_id long, text string").repartition(3))
        assert repeats.removed_spans(texts).count() == n
        return frames["occurrences"].join(frames["chains"], ["h1", "h2"]).count(), frames["occurrences"].count()

    (few, all_few), (many, all_many) = joined(20), joined(60)
    assert 20 <= few <= all_few - 40 and 60 <= many <= all_many - 120
    assert many <= 4 * few


def corpus_passage(n, seed=1000):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcde") for _ in range(rng.randint(2, 9))) for _ in range(n))
