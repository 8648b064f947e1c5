"""Hard negatives, line deduplication and source divergence against plain versions."""
import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from brandlens.llm import divergence, hard_negatives, line_dedup
from brandlens.llm.perfect_hash import Shard

SF = "/root/testdata/sf0.001"


# --- minimal perfect hash -----------------------------------------------------

def test_perfect_hash():
    rng = np.random.default_rng(1)
    high, low = rng.integers(0, 1 << 63, (2, 5000), dtype=np.uint64)
    high[:100], low[100:200] = high[0], low[100]  # names that share a half
    shard = Shard.unpacked(Shard.build(high, low, {"count": np.arange(5000)}).packed())
    index = shard.probe(high, low)
    assert sorted(index) == list(range(5000)) and shard.n == 5000
    assert (shard.arrays["count"][index] == np.arange(5000)).all()
    assert (shard.probe(high, low + np.uint64(1)) == -1).all()
    assert len(Shard.build(high[:0], low[:0], {}).probe(high, low)) == 5000


# --- lines --------------------------------------------------------------------

STRIP, LOWER = " \t\n\v\f\r", str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_lines(rows):
    docs = [(d, (t or "").split("\n")) for d, t in rows]
    holders = defaultdict(set)
    key = lambda line: line.strip(STRIP).translate(LOWER)
    for k, (_, lines) in enumerate(docs):
        for line in lines:
            if len(key(line)) >= 20:
                holders[key(line)].add(k)
    low = lambda d: -math.inf if d is None else d
    keeper = {k: max(low(docs[i][0]) for i in v) for k, v in holders.items() if len(v) >= 3}
    out = []
    for d, lines in docs:
        kept = [x for x in lines if key(x) not in keeper or keeper[key(x)] == low(d)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def found_lines(docs, **options):
    rows = line_dedup.without_repeated_lines(docs, **options).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    return sorted((tuple(r) for r in rows), key=str)


def line_rows():
    random.seed(4)
    pool = [f"  A Repeated line of number {k} here\t" for k in range(12)] + ["ÄÖÜ ist zwanzig Zeichen lang", "short line", "", " \v ", "x" * 20, "X" * 20, "日本" * 9]
    rows = [(d, "\n".join(random.choices(pool, k=random.randint(0, 9)) + [f"only document {d} has this line"])) for d in range(40)]
    return rows + [(7, rows[7][1]), (None, pool[0]), (None, pool[0] + "\n" + pool[0]), (50, None), (51, ""), (52, "\n\n"), (53, "\n".join(pool * 3000))]


@pytest.mark.parametrize("bound", [line_dedup.BROADCAST_BYTES, 100, 0])
def test_lines(llm, bound):
    rows = line_rows()
    docs = llm.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found_lines(docs, broadcast_bytes=bound) == plain_lines(rows)


def test_lines_of_odd_rows(llm, odd, none):
    # Added columns of the same name are replaced, all others pass.
    docs = odd.withColumns({"n_lines": F.lit("x"), "row": F.lit(1), "key": F.lit(2), "dropped": F.lit(3)})
    found = line_dedup.without_repeated_lines(docs, broadcast_bytes=0)
    assert set(found.columns) == {*docs.columns, "n_dropped", "kept_text"}
    assert sorted(tuple(r) for r in found.select("n", "ids", "key", "dropped").collect()) == sorted(tuple(r) for r in docs.select("n", "ids", "key", "dropped").collect())
    assert found_lines(docs) == plain_lines([(r.doc_id, r.text) for r in odd.collect()])
    assert line_dedup.without_repeated_lines(none).count() == 0


def test_line_query_hash(llm):
    from brandlens.llm.queries import op12_line_dedup
    docs = llm.read.parquet(f"{SF}/documents.parquet").collect()
    expected = [(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in plain_lines([(r.doc_id, r.text) for r in docs])]
    assert sorted(tuple(r) for r in op12_line_dedup(llm, SF).collect()) == sorted(expected)


# --- divergence ---------------------------------------------------------------

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain_divergence(rows, min_documents, most=50):
    counts, documents = Counter(), Counter()
    groups = {(lang or "", source or "") for lang, source, _ in rows}
    for lang, source, text in rows:
        own = Counter(t.translate(LOWER) for t in TERM.findall(text or ""))
        for t, n in own.items():
            counts[lang or "", source or "", t] += n
            documents[lang or "", t] += 1
    out = []
    for lang, source in groups:
        terms = [t for (x, t), n in documents.items() if x == lang and n >= min_documents]
        totals = {s: sum(counts[lang, s, t] for t in terms) for x, s in groups if x == lang}
        p = lambda n, total: 1 + 10**9 * (n + 5) // (total + 5 * len(terms))
        of = lambda s, t: p(counts[lang, s, t], totals[s])
        pairs = [(sum(abs(of(source, t) - of(s, t)) for t in terms), s) for s in totals if s != source]
        above = [(of(source, t) - p(sum(counts[lang, s, t] for s in totals), sum(totals.values())), t) for t in terms if counts[lang, source, t]]
        for part, found, limit in (("pair", pairs, None), ("term", [x for x in above if x[0] > 0], most)):
            ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]
            out += [(lang, source, part, item, value, k + 1) for k, (value, item) in enumerate(ranked)]
    return sorted(out)


def divergence_rows():
    random.seed(9)
    words = [f"w{chr(97 + k)}" for k in range(26)] + ["É", "é", "Ẑ", "日本", "a_b", "Two2Three"]
    weights = {s: [random.random() ** 3 for _ in words] for s in ("s1", "s2", "s3", None, "")}
    rows = [(random.choice(["en", "de", None]), s, " ".join(random.choices(words, weights[s], k=random.randint(0, 30)))) for s in weights for _ in range(25)]
    return rows + [("xx", "s1", "rare"), ("xx", "s2", None), ("en", "empty", ""), ("en", "s1", "wa " * 40_000)] + [("de", "s1", "equal words here")] * 3


# Digests of six bits make most of them stand for several terms.
@pytest.mark.parametrize("bits", [64, 6])
def test_divergence(llm, bits):
    rows = divergence_rows()
    docs = llm.createDataFrame(rows, "lang string, source string, text string").withColumns({"n": F.lit(1), "digest": F.lit("x"), "term": F.lit(None)})
    found = divergence.divergence(docs.repartition(5), min_documents=12, most_terms=4, bits=bits)
    assert sorted(tuple(r) for r in found.collect()) == plain_divergence(rows, 12, 4)


def test_divergence_tiles(llm):
    rows = divergence_rows()
    found = divergence.divergence(llm.createDataFrame(rows, "lang string, source string, text string"), min_documents=5, term_block=5, source_block=2)
    assert sorted(tuple(r) for r in found.collect()) == plain_divergence(rows, 5)


def test_divergence_of_odd_rows(llm, odd, none):
    docs = odd.withColumn("source", F.lit("s"))
    found = divergence.divergence(docs, min_documents=1, most_terms=10)
    assert sorted(tuple(r) for r in found.collect()) == plain_divergence([(r.lang, r.source, r.text) for r in docs.collect()], 1, 10)
    assert divergence.divergence(none.withColumn("source", F.lit("s"))).count() == 0


# --- hard negatives -----------------------------------------------------------

def plain_negatives(rows, every, wanted=10, n_positives=5):
    fine = [(i, l, [math.floor(256 * x) for x in v]) for i, l, v in rows
            if None not in (i, l, v) and all(x is not None and math.isfinite(x) for x in v)]
    fine = [r for r in fine if sum(x * x for x in r[2]) < 2**62]
    out = []
    for a, label, v in fine:
        if a % every:
            continue
        scores = [(-sum(x * y for x, y in zip(v, w)), i, m) for i, m, w in fine if i != a and len(w) == len(v)]
        for s, p, _ in sorted(x for x in scores if x[2] == label)[:n_positives]:
            hits = sorted(x for x in scores if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s)[:wanted]
            out += [(a, p, k + 1, i, -s, -t) for k, (t, i, _) in enumerate(hits)]
    return sorted(out)


def vector_rows(n, dim, spread):
    rng = np.random.default_rng(n)
    centres = rng.normal(size=(4, dim))
    labels = rng.integers(0, 4, n)
    v = centres[labels] * rng.uniform(0.2, 2, (n, 1)) + rng.normal(size=(n, dim)) * spread
    return [(int(i), int(x), [float(c) for c in w]) for i, x, w in zip(rng.permutation(n), labels, v)]


@pytest.mark.parametrize("block", [hard_negatives.BLOCK_ROWS, 16])
@pytest.mark.parametrize("spread", [0.3, 3.0])
def test_hard_negatives(llm, block, spread):
    rows = vector_rows(700, 12, spread)
    table = llm.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(4)
    found = hard_negatives.hard_negatives(table, every=40, block_rows=block)
    assert sorted(tuple(r) for r in found.collect()) == plain_negatives(rows, 40)


def test_hard_negatives_of_odd_rows(llm):
    rows = vector_rows(60, 4, 1.0)
    rows += [(100, 1, None), (101, None, [1.0] * 4), (None, 2, [1.0] * 4), (104, 2, [0.0] * 4), (105, 1, [math.nan] * 4), (106, 1, [1.0, None, 1.0, 1.0]),
             (107, 1, [math.inf] * 4), (108, 2, [1e300] * 4), (110, 2, [1e6, -1e6, 1e6, 1e6]), (115, 3, [1e6, -1e6, 1e6, 1e6]), (116, 2, [1.0, 2.0]),
             (120, 3, [1.0, 2.5]), (125, 3, []), (130, 2, [0.0] * 4)] + rows[:3]
    table = llm.createDataFrame([(*r, "x", 1.5) for r in rows], "vec_id long, label int, embedding array<double>, block string, score double")
    found = hard_negatives.hard_negatives(table, every=5, block_rows=8)
    assert sorted(tuple(r) for r in found.collect()) == plain_negatives(rows, 5)
    assert hard_negatives.hard_negatives(table.filter("vec_id < -1")).count() == 0


def test_score_bounds_hold():
    rng = np.random.default_rng(3)
    refs = rng.normal(size=(6, 10))
    refs /= np.linalg.norm(refs, axis=1, keepdims=True)
    rows, anchor = rng.integers(-300, 300, (500, 10)), rng.integers(-300, 300, 10)
    rows[:5], rows[5:10] = anchor, -anchor
    norms = np.linalg.norm(rows, axis=1)
    angles, own = hard_negatives._angles(rows, norms, refs), hard_negatives._angles(anchor[None], np.array([np.linalg.norm(anchor)]), refs)[0]
    low, high = hard_negatives.score_bounds(own, np.linalg.norm(anchor), angles, angles, norms, norms)
    score = rows @ anchor
    assert (low <= score).all() and (score <= high).all()
    assert (high - low)[:10].max() < 0.01 * norms[0] ** 2 or len(refs) < 10  # tight where a reference is near


def test_sums_over_many_groups():
    """Numbers of groups beyond 16 bits add up like small ones."""
    for most in (3, 1 << 16, 1 << 20):
        rng = np.random.default_rng(most)
        code, digest, n = rng.integers(0, most, 5000), rng.integers(0, 4, 5000).astype(np.uint64) << np.uint64(62), rng.integers(1, 9, 5000)
        code[:2] = most
        plain = {}
        for key, value in zip(zip(code.tolist(), digest.tolist()), n.tolist()):
            plain[key] = plain.get(key, 0) + value
        c, d, total = divergence._sums(code, digest, n)
        assert list(zip(zip(c.tolist(), d.tolist()), total.tolist())) == sorted(plain.items())
