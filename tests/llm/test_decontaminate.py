"""FM-index and decontamination against brute force, and the defined edge cases."""

import random
import re

import numpy as np
import pytest
from conftest import SF_ORACLE

from vaultlens.llm.decontaminate import contamination, op9_benchmark_decontamination, words_of
from vaultlens.llm.fm_index import FmIndex, suffix_array

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute_words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    phrases = {}
    for name, text in items:
        w = brute_words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            phrases.setdefault(tuple(w[i:i + window]), set()).add("null" if name is None else str(name))
    sizes = {len(p) for p in phrases}
    out = []
    for i, text in docs:
        w, hit, found = brute_words(text), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if p := phrases.get(tuple(w[k:k + n])):
                    hit |= set(range(k, k + n))
                    found |= p
        out.append((i, len(w), len(hit), sorted(found)))
    return out


def rows_of(df):
    return [(r["id"], r.n_words, r.n_hit, r["items"]) for r in df.collect()]


@pytest.mark.parametrize("size,symbols", [(1, 1), (5, 1), (300, 1), (300, 2), (2000, 40), (3000, 5000)])
def test_index_finds_every_occurrence(size, symbols):
    rng = np.random.default_rng(size + symbols)
    seq = rng.integers(1, symbols + 1, size)
    full = list(map(int, seq)) + [0]
    assert suffix_array(np.array(full)).tolist() == sorted(range(size + 1), key=lambda i: full[i:])
    index = FmIndex(seq)
    for length in (1, 2, 4):
        if size < length:
            continue
        pats = np.array([seq[i:i + length] for i in rng.integers(0, size - length + 1, 20)]
                        + [rng.integers(1, symbols + 3, length) for _ in range(20)])
        low, high = index.search(pats)
        for p, a, b in zip(pats.tolist(), low, high):
            want = [i for i in range(size - length + 1) if full[i:i + length] == p]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_ORACLE}/benchmark.parquet").collect()]
    want = brute(docs, items)
    df = contamination(spark.read.parquet(f"{SF_ORACLE}/documents.parquet"), spark.read.parquet(f"{SF_ORACLE}/benchmark.parquet"))
    assert sorted(rows_of(df)) == sorted(want)
    assert sum(w[2] > 0 for w in want) > 5
    import hashlib
    got = {r.doc_id: r for r in op9_benchmark_decontamination(spark, SF_ORACLE).collect()}
    for i, n, hit, found in want:
        assert (got[i].n_words, got[i].n_hit, got[i].n_items, got[i].contaminated) == (n, hit, len(found), hit > 0)
        assert got[i].items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()


def fixture():
    rng = random.Random(4)
    vocab = ["the", "a", "Straße", "été", "x1", "42", "of", "日本"]
    items = [(k, " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 3, 9, 10, 14])))) for k in range(12)]
    items += [(3, "again The, a"), (50, None), (51, ""), (52, "?!"), (None, "unseen phrase here")]
    docs = [(i, " ".join(rng.choice(vocab + ["q", "r--s"]) for _ in range(rng.choice([0, 1, 5, 60])))) for i in range(40)]
    docs += [(90, None), (91, ""), (92, "..."), (93, "A " * 30000), (94, "Unseen PHRASE\nhere; unseen phrase here"), (94, "x1"), (94, "x1")]
    return docs, items


def test_the_index_holds_every_word(monkeypatch):
    """Also the words that no phrase has: one gap a document, nothing left out."""
    from vaultlens.llm import decontaminate as mod
    seen = []
    real = mod.FmIndex
    monkeypatch.setattr(mod, "FmIndex", lambda seq: seen.append(len(seq)) or real(seq))
    docs = [words_of(t.encode()) for t in ("a b c of its own", "", "none of the phrase words", "a b c " * 50)]
    out = mod.scan_shard(docs, mod.Phrases([("i", b"a b c")], 10))
    assert seen == [sum(map(len, docs)) + len(docs)]
    assert [(s, e) for s, e, _ in out] == [([0], [3]), ([], []), ([], []), ([0], [150])]


def test_broadcast_is_of_the_size_of_the_block():
    """Distinct words and a number a word, not a tuple a window."""
    import pickle
    from vaultlens.llm.decontaminate import Phrases
    rng = random.Random(3)
    vocab = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9))) for _ in range(20000)]
    items = [(f"item{k}", " ".join(rng.choices(vocab, k=4000)).encode()) for k in range(50)]
    phrases = Phrases(items, 10)
    assert len(pickle.dumps(phrases)) <= 1.2 * sum(len(b) for _, b in items)
    assert sum(len(p) for p, _, _ in phrases.groups) == 50 * 3991


@pytest.mark.parametrize("block_bytes,shard_words", [(1 << 20, 1 << 20), (64, 100)])
def test_edge_cases_and_blocks(spark, block_bytes, shard_words):
    docs, items = fixture()
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, id string, starts int")
    b = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, name string")
    got = rows_of(contamination(d, b, block_bytes=block_bytes, shard_words=shard_words, piece_words=3 if shard_words == 100 else 1 << 16))
    key = lambda r: (r[0], r[1], r[2], r[3])
    assert sorted(got, key=key) == sorted(brute(docs, items), key=key)


def test_words_match_the_pattern():
    for t in ("Ab-c_d 9é\x7fZ", "", "\x00\t", "ÀÉ straße x"):
        assert [w.decode() for w in words_of(t.encode())] == brute_words(t)


def test_empty_tables(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert contamination(d, b).count() == 0
    assert rows_of(contamination(some, b)) == [(1, 2, 0, [])]
    assert contamination(d, some.withColumnRenamed("doc_id", "item_id")).count() == 0
