"""Quality rules, licence scans, token counts and mixing against plain versions."""
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from brandlens.llm import fertility, licenses, mixing, token_counts
from brandlens.llm.queries import LANGUAGE_WEIGHTS, QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PATHS = [public_tokenizers.path(x) for x in ("piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken")]


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(covered),
            len(words) < 50 or 100 * len(covered) > 50 * len(words))


def test_base_rules(llm, odd, none):
    for docs in (llm.read.parquet(f"{SF}/documents.parquet"), odd):
        rows = sorted((str(r.doc_id), *base(r.text)) for r in docs.collect())
        found = fertility.quality_rules(docs, *PATHS, public_tokenizers.PATTERN).collect()
        assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found) == rows
        assert not any(r.kept and r.base_failed for r in found)
    assert fertility.quality_rules(none, *PATHS, public_tokenizers.PATTERN).count() == 0


def test_fertility_measures():
    import sentencepiece
    import tiktoken  # noqa: F401

    text = "the quick brown fox 日本語 jumps the the"
    tool = fertility.fertility(*PATHS, public_tokenizers.PATTERN)
    words = text.encode().split()
    distinct = list(dict.fromkeys(words))
    counts = np.array([words.count(w) for w in distinct], float)
    chars = sum(map(len, text.split()))
    model = sentencepiece.SentencePieceProcessor(model_file=PATHS[0])
    ids = [i for w in text.split() for i in model.encode(w)]
    share = np.array(list(Counter(ids).values())) / len(ids)
    pieces, _, byte_share, entropy = tool.measures(distinct, counts, chars)
    assert pieces == pytest.approx(chars / len(ids))
    assert byte_share == pytest.approx(sum(model.is_byte(i) for i in ids) / len(ids))
    assert entropy == pytest.approx(-(share * np.log2(share)).sum())


def test_fertility_rejects_outliers_and_keeps_the_rest(llm):
    rng = random.Random(4)
    docs = llm.read.parquet(f"{SF}/documents.parquet").filter("lang = 'en'").select("doc_id", "text", "lang")
    noise = [(10_000 + i, " ".join("".join(rng.choice("ж日ĸ₪€") for _ in range(9)) for _ in range(200)), "en") for i in range(3)]
    found = fertility.quality_rules(docs.unionByName(llm.createDataFrame(noise, docs.schema)), *PATHS, public_tokenizers.PATTERN).collect()
    assert [r.kept for r in found if r.doc_id >= 10_000] == [False] * 3
    good = {r.doc_id for r in llm.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()}
    clean = [r for r in found if r.doc_id in good and not r.base_failed]
    assert clean and all(r.kept for r in clean)


def test_fertility_bands_by_labels(llm):
    """Few of the labelled bad documents that pass the base are kept, and nearly all good ones."""
    found = {r.doc_id: r for r in QUERIES["op3_fertility"](llm, "/root/testdata/sf0.1").collect() if not r.base_failed}
    labels = [(r.quality, found[r.doc_id].kept) for r in llm.read.parquet("/root/testdata/sf0.1/labels.parquet").collect() if r.doc_id in found]
    kept = {q: [k for x, k in labels if x == q] for q in (0, 1)}
    assert len(kept[0]) > 200 and np.mean(kept[0]) <= 0.25
    assert len(kept[1]) > 3000 and np.mean(kept[1]) >= 0.999


def test_increasing_subsequence():
    rng = random.Random(2)
    for _ in range(100):
        values = [rng.randrange(30) for _ in range(rng.randrange(20))]
        chain = [values[i] for i in licenses.increasing(values)]
        best = [0] * len(values)
        for i, v in enumerate(values):
            best[i] = 1 + max([best[j] for j in range(i) if values[j] < v], default=0)
        assert chain == sorted(set(chain)) and len(chain) == max(best, default=0)


def test_alignment_is_rising_and_equal():
    rng = random.Random(3)
    for _ in range(100):
        a, b = ([rng.randrange(12) for _ in range(rng.randrange(40))] for _ in range(2))
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
    assert licenses.align([1, 2, 3, 9, 4], [1, 2, 3, 4]) == [(0, 0), (1, 1), (2, 2), (4, 3)]


def test_license_scan(llm, odd, none):
    mit, bsd = licenses.TEMPLATES["MIT text"], licenses.TEMPLATES["BSD text"]
    words = mit.split()
    changed = " ".join(w if i % 12 else "changed" for i, w in enumerate(words))
    scattered = " filler words go here and here and here and here and here and so on and on ".join(words)
    rows = [(1, f"Intro. {mit} Outro."), (2, f"// {changed.upper()}"), (3, f"{mit}\n\nplain text\n\n{bsd}"), (4, scattered), (5, "the software is here"), (6, None)]
    found = {(r.doc_id, r.license): r.coverage for r in licenses.license_scan(llm.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found.pop((2, "MIT text")) == pytest.approx(1 - len(words[::12]) / len(words), abs=0.03)
    assert found == {(1, "MIT text"): 1.0, (3, "MIT text"): 1.0, (3, "BSD text"): 1.0}
    assert licenses.license_scan(odd).count() == 0 and licenses.license_scan(none).count() == 0


def test_licenses_of_documents(llm):
    found = {r.doc_id for r in QUERIES["op4_licenses"](llm, "/root/testdata/sf0.01").collect()}
    assert found == {r.doc_id for r in llm.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("text rlike '(?i)licen[sc]e'").collect()}


def test_repeated_licenses():
    """Each occurrence is found, also without a gap, with stray words and with changes."""
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.8, 12)
    places = lambda text, name: [(h[4], h[5]) for h in scanner.scan(text) if h[0] == name]
    short, mit = "released under the mit license", licenses.TEMPLATES["MIT text"]
    assert places(f"the, {short}, the, {short}, the", "MIT") == [(1, 5), (7, 11)]
    assert places(" the ".join([short] * 40), "MIT") == [(6 * k, 6 * k + 4) for k in range(40)]
    n = len(licenses._WORD.findall(mit))
    between = " other words" * 30
    assert places(f"the {mit} the{between} the {mit} the", "MIT text") == [(1, n), (n + 63, 2 * n + 62)]
    changed = " ".join("changed" if i % 12 == 5 else w for i, w in enumerate(mit.split()))
    found = places(f"the software {changed} the {mit} copies {changed} the", "MIT text")
    assert len(found) == 3 and all(a[1] < b[0] for a, b in zip(found, found[1:]))
    assert {h[0] for x in licenses.TEMPLATES.values() for h in scanner.scan(x)} == set(licenses.TEMPLATES)


def best_segmentation(word, pieces, byte_score):
    """By plain recursion over all ends."""
    best = [(0.0, 0, 0)]
    for end in range(1, len(word) + 1):
        options = []
        for start in range(end):
            s, t, b = best[start]
            if word[start:end] in pieces:
                options.append((s + pieces[word[start:end]], t - 1, b))
            if start == end - 1:
                n = len(word[start].encode())
                options.append((s + n * byte_score, t - n, b - n))
        best.append(max(options))
    return -best[-1][1], -best[-1][2], best[-1][0]


def test_trie_scores():
    pieces = {"a": -1.0, "b": -2.0, "ab": -2.5, "abc": -3.0, "bc": -1.0, "▁a": -0.5}
    words = ["▁abc", "▁ab", "▁abca", "", "▁b", "▁日a", "▁abc"]
    assert token_counts.Trie(pieces, -4.0).insert(words) == {w: best_segmentation(w, pieces, -4.0) for w in words}


def test_token_counts(llm, odd, none):
    path = PATHS[0]
    tool = token_counts.Counter(path)
    docs = llm.read.parquet(f"{SF}/documents.parquet").limit(20)
    rows = [(r.doc_id, r.text) for x in (docs, odd) for r in x.select("doc_id", "text").collect() if len(r.text or "") < 20_000]
    found = {}
    for frame in (docs, odd):
        for r in token_counts.token_counts(frame, path).collect():
            found.setdefault(r.doc_id, []).append((r.n_pretokens, r.n_tokens, r.n_byte_tokens, round(r.log_probability, 6)))
    known = {}
    for doc, text in rows:
        words = WORD.findall(text or "")
        for w in words:
            if w not in known:
                known[w] = best_segmentation("▁" + w, tool.trie.pieces, tool.trie.byte_score)
        total = tuple(sum(known[w][k] for w in words) for k in range(3))
        assert any((n, t, b) == (len(words), *total[:2]) and math.isclose(p, total[2], rel_tol=1e-9, abs_tol=1e-5) for n, t, b, p in found[doc])
    assert token_counts.token_counts(none, path).count() == 0


def test_mix_meets_its_targets(llm):
    found = QUERIES["op2_mixing"](llm, "/root/testdata/sf0.01").toPandas()
    names = list(LANGUAGE_WEIGHTS)
    mass = np.array([(found["n_tokens"] * found["rate"] * found[f"share_{n}"]).sum() for n in names])
    assert mass / mass.sum() == pytest.approx([LANGUAGE_WEIGHTS[n] for n in names], abs=1e-4)
    assert mass.sum() == pytest.approx(found["n_tokens"].sum(), rel=1e-4)
    assert (found["rate"] >= 0).all() and (abs(found["copies"] - found["rate"]) < 1).all()


def test_rates_by_brute_projected_gradient():
    """The distributed steps equal plain projected gradient over all documents at once."""
    rng = np.random.default_rng(1)
    p = rng.dirichlet([0.3] * 3, 200)
    mix = mixing.Mix(0.0, [np.array([0.5, -0.2, 0.1]), np.array([2.0, 0.3, -1.0])])
    rate = np.ones(200)
    for step in mix.steps:
        rate = np.maximum(rate - p @ step, 0)
    assert mix.rates(p) == pytest.approx(rate)


def test_mixing_of_odd_rows(llm, odd, none):
    labelled = llm.createDataFrame([(1, "en"), (8, "de"), (8, None), (6, "fr"), (None, "en")], "doc_id long, domain string")
    domains = mixing.fit_domains(odd, labelled, ["en", "de"])
    found = mixing.mixed_rates(odd, domains, {"en": 1.0, "de": 3.0}, total=float("inf"), floor=1.0)
    assert found.count() == odd.count() and found.filter("copies < 1 or rate < 1").count() == 0
    assert mixing.mixed_rates(none, domains, {"en": 1.0, "de": 1.0}).count() == 0
    empty = mixing.fit_domains(none, labelled, ["en", "de"])
    assert mixing.mixed_rates(odd, empty, {"en": 1.0, "de": 1.0}).filter("rate is null").count() == 0
