"""Packing and token files against the tokenizer itself."""
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from brandlens.llm import packing, token_files
from brandlens.llm.queries import QUERIES
from brandlens.llm.shared import new_path
from brandlens.llm.tokens import Encoder

SF = "/root/testdata/sf0.001"
TEXTS = ["", None, "a b", "  x", "x  y", "a\n\n\nb", "a\tb", "end ", "\n", "<|endoftext|> hi", "a<|startoftext|>b <|ENDOFTEXT|>", "Ça İst ſ ﬁ été’s it's 12.5, $.x ²", "ab.\nCd, ef", "Σας ΣΑΣ A. ,b",
         "日本 語\nß ÿ µ ªº", "I'm. 'll.", "a.b, c,. d..", "\x1c a\x85b", "don't, ’s 's", "£ 5 €\nx", "é ü, á.", "x" * 5000 + " y"]


def plain(path, texts):
    tool = Tokenizer.from_file(path)
    return [tool.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_tokenizer(name):
    path = public_tokenizers.path(name)
    tool = Encoder(path)
    for _ in range(2):
        ids, n = tool.encode(pa.array(TEXTS))
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == plain(path, TEXTS)


def check_pieces(pieces, ids_of, window):
    pieces = pieces.sort_values(["sequence_id", "offset"])
    at = pieces["sequence_id"] * window + pieces["offset"]
    assert (at.to_numpy() == np.concatenate([[0], np.cumsum(pieces["length"])[:-1]])).all()
    assert (pieces["offset"] + pieces["length"] <= window).all()
    for p in pieces.itertuples():
        choices = ids_of[None if p.doc_id != p.doc_id else int(p.doc_id)]
        assert any(len(c) == p.doc_tokens and zlib.crc32(np.array(c[p.start:p.start + p.length], "<u4").tobytes()) == p.ids_crc32 for c in choices)


def ids_by_doc(rows, path):
    out = {}
    for (doc, _), ids in zip(rows, plain(path, [t for _, t in rows])):
        out.setdefault(doc, []).append(ids + [2])
    return out


def test_packing_of_documents(llm):
    rows = [(r.doc_id, r.text) for r in llm.read.parquet(f"{SF}/documents.parquet").collect()]
    ids = ids_by_doc(rows, public_tokenizers.path("word_bpe_49k.json"))
    found = QUERIES["op1_packing"](llm, SF).toPandas()
    check_pieces(found, ids, 4096)
    assert found["length"].sum() == sum(len(i) for x in ids.values() for i in x)


@pytest.mark.parametrize("window", [8, 4096])
def test_packing_of_odd_rows(odd, none, window):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    ids = ids_by_doc(rows, path)
    cut = packing.pack(odd, path, window, with_ids=True)
    check_pieces(cut.toPandas(), ids, window)
    full = packing.sequences(packing.pack(odd, path, window, with_ids=True), window).orderBy("sequence_id").collect()
    total = sum(len(i) for x in ids.values() for i in x)
    assert len(full) == -(-total // window) and all(len(r.ids) == window for r in full) and sum(r.n_tokens for r in full) == total
    assert packing.pack(none, path, window).count() == 0


def test_squeeze_round_trip():
    for x in (np.array([], "<u4"), np.array([0, 255, 256, 65535, 65536, (1 << 24) - 1, 1 << 24, (1 << 32) - 1], "<u4"), np.arange(70_000, dtype="<u4")):
        control, data = token_files.squeeze(x)
        assert len(control) == -(-len(x) // 4)
        assert (token_files.unsqueeze(control, data, len(x)) == x).all()
    # The table lookup gives each code's length.
    assert token_files._LENGTHS[0b11100100].tolist() == [1, 2, 3, 4]


def test_token_file_of_documents(llm):
    rows = sorted((r.doc_id, r.text) for r in llm.read.parquet(f"{SF}/documents.parquet").collect())
    found = QUERIES["op8_token_files"](llm, SF).orderBy("doc_id").collect()
    at = 0
    for (doc, _), ids, row in zip(rows, plain(public_tokenizers.path("byte_bpe_50k.json"), [t for _, t in rows]), found, strict=True):
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc, at, len(ids) + 1, zlib.crc32(np.array(ids + [2], "<u4").tobytes()))
        at += row.n_tokens


def test_token_file_of_odd_rows(llm, odd, none):
    path, file = public_tokenizers.path("byte_bpe_50k.json"), new_path(llm, "file")
    token_files.write_token_file(odd, path, file)
    found = token_files.read_token_file(llm, file).orderBy("start").collect()
    order = [r.doc_id for r in found]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    assert [r.start for r in found] == np.concatenate([[0], np.cumsum([r.n_tokens for r in found])[:-1]]).tolist()
    ids = ids_by_doc([(r.doc_id, r.text) for r in odd.collect()], path)
    assert sorted((str(r.doc_id), list(r.ids)) for r in found) == sorted((str(d), i) for d, x in ids.items() for i in x)
    empty = new_path(llm, "file")
    token_files.write_token_file(none, path, empty)
    assert token_files.read_token_file(llm, empty).count() == 0


def test_words_are_met_without_their_punctuation():
    """A worker remembers a word once, whatever stands after it, and keeps the words that come back."""
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        tokens = Encoder(public_tokenizers.path(name))
        texts = ["ein wort. ein wort,*** ein wort\nwort&&& d'ein wort's Ñandú! 3. 日本."] * 2
        ids, n = tokens.encode(pa.array(texts))
        plain = tokens.tokenizer.encode(texts[0], add_special_tokens=False).ids
        assert ids.tolist() == plain * 2 and n.tolist() == [len(plain)] * 2
        assert not {key for key in tokens.known if key.strip(" \n") in ("wort.", "wort,***", "wort&&&", "Ñandú!", "ñandú!")}
        tokens.encode(pa.array(["a wort"]))
        tokens._forget()
        assert 0 < len(tokens.known) == len(tokens.width) < 10
        assert tokens.encode(pa.array(texts))[0].tolist() == plain * 2
