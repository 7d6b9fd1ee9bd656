"""BPE against the tokenizers library and a plain merge loop; exact round trips; edge cases."""

import hashlib
import random

import numpy as np
import pytest
from conftest import SF_ORACLE

from vaultlens.llm import bpe
from vaultlens.llm.bpe import Bpe, Encoder, decode, default_vocabulary, encode, op5_bpe_encoding, round_trip

PATH = default_vocabulary()


@pytest.fixture(scope="module")
def model():
    return Bpe(PATH)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def as_bytes(ids):
    return np.array(ids, dtype="<u4").tobytes()


def plain_merge(model, piece):
    """Repeatedly merge the leftmost pair of lowest rank."""
    rank = dict(zip(model.pair_keys.tolist(), model.pair_ranks.tolist()))
    s = [int(model.byte_ids[b]) for b in piece]
    while True:
        found = [(rank[a * model.size + b], i) for i, (a, b) in enumerate(zip(s, s[1:])) if a * model.size + b in rank]
        if not found:
            return s
        r, i = min(found)
        s[i:i + 2] = [int(model.merged[r])]


def test_segment_tree_matches_plain_merges(model):
    rng = random.Random(3)
    pieces = [bytes(rng.choice(b"aeiou thern s\xc3\xa9") for _ in range(n)) for n in [1, 2, 3, 4, 5, 7, 8, 9, 16, 17, 31, 33, 64, 100] * 4]
    pieces += [b"a" * n for n in range(1, 70)] + [b""]
    assert model.encode_pieces(pieces) == [as_bytes(plain_merge(model, p)) for p in pieces]


TEXTS = ["", " ", "Hello, world's it'll  we're\n\n\tx", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext", "日本語 😀é ß",
         "x" * 3000, " " * 500, "١٢٣ Ⅷ ²", "  　", "don't DON'T 'S", "\x00\x1c\x85"]


def test_library_agrees(model, library):
    want = [as_bytes(e.ids) for e in library.encode_batch(TEXTS, add_special_tokens=False)]
    encoder = Encoder(model)
    assert encoder.encode(TEXTS) == want
    assert [model.decode(x) for x in want] == [library.decode(list(np.frombuffer(x, "<u4")), skip_special_tokens=False) for x in want]


def test_memo_limits_change_nothing(model, monkeypatch):
    want = Encoder(model).encode(TEXTS)
    monkeypatch.setattr(bpe, "MEMO_PIECES", 3)
    encoder = Encoder(model)
    assert [encoder.encode([t])[0] for t in TEXTS] == want


def test_query_matches_library(spark, library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()]
    got = {r.doc_id: r for r in op5_bpe_encoding(spark, SF_ORACLE).collect()}
    assert len(got) == len(docs)
    for (i, t), e in zip(docs, library.encode_batch([t or "" for _, t in docs], add_special_tokens=False)):
        back = library.decode(e.ids, skip_special_tokens=False)
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (
            len(e.ids), hashlib.sha256(as_bytes(e.ids)).hexdigest(), hashlib.sha256(back.encode()).hexdigest())


def test_edge_rows(spark, library):
    rows = [(1, None, "x", b"1"), (1, None, "x", b"1"), (2, "", "x", None), (None, "a b", "y", None), (3, "long word " * 50000, "z", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, id string, ids binary")
    got = round_trip(df, PATH).collect()
    assert sorted((r["id"] or 0, r.n_tokens, len(r.decoded)) for r in got) == [
        (0, 2, 3), (1, 0, 0), (1, 0, 0), (2, 0, 0), (3, 100001, 500000)]
    assert all(r.decoded == (t or "") for r in got for i, t, _, _ in rows if i == r["id"])
    tokens = encode(df, PATH)
    assert tokens.columns == ["id", "n_tokens", "ids"]
    assert {(r["id"], r.decoded) for r in decode(tokens, PATH).collect()} == {(i, t or "") for i, t, _, _ in rows}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert round_trip(empty, PATH).count() == 0 and decode(encode(empty, PATH), PATH).count() == 0
