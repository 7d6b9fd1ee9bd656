"""Spelling variants against a plain model, and the defined edge cases."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from vaultlens.llm import spelling
from vaultlens.llm.spelling import PositionIndex, op13_spelling_variants, variants, words_of

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute_words(rows, drop=31):
    out = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % drop == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, drop=31):
    n = brute_words(rows, drop)
    gaps = {}
    for w in n:       # one edit apart: equal, or equal with one letter out of each
        for key in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            gaps.setdefault(key, []).append(w)
    near = {w: {v for key in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))} for v in gaps[key] if one_edit(w, v)} for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])
    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n[form[w]] if form[w] else 0) for w in n)


def found(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in df.collect())


def corpus(seed, n_docs=60):
    rng = random.Random(seed)
    letters = "abcdeé÷ÿ"
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(7, 16))) for _ in range(40)]
    forms = list(base)
    for w in base * 4:
        i = rng.randrange(len(w) + 1)
        forms.append(rng.choice([w[:i] + rng.choice(letters) + w[i:], w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i + 1:]]))
    weights = [200 if i < 6 else 20 if i < 40 else 1 for i in range(len(forms))]
    rows = [(d, " ".join(w.title() if rng.random() < 0.1 else w for w in rng.choices(forms, weights, k=60))) for d in range(n_docs)]
    chain = ["waterfall"] * 300 + ["waterfalls"] * 25 + ["waterfills"] * 2
    return rows + [(800, " ".join(chain[:200])), (801, " ".join(chain[200:]))] + [(900, None), (901, ""), (None, "nullified nullified nullifled"), (902, "x" * 3000 + " " + "x" * 3000 + " " + "x" * 2999 + "y 中文nullified"),
                   (903, "x" * 2999 + "y"), (903, "x" * 2999 + "y")]


@pytest.mark.parametrize("chunk, drop", [(2048, 31), (16, 3), (1, 5)])
def test_matches_brute_force(spark, monkeypatch, chunk, drop):
    monkeypatch.setattr(spelling, "CHUNK", chunk)
    rows = corpus(chunk)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n long")
    want = brute(rows, drop)
    assert sum(1 for w in want if w[1]) > 5 and (drop < 31 or any(w[1] != w[2] for w in want if w[1]))
    assert found(variants(df, drop=drop)) == want


def test_query_matches_brute_force(spark):
    from conftest import SF_SMALL
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert found(op13_spelling_variants(spark, SF_SMALL)) == brute(rows)


def test_index_finds_exactly_the_pairs_one_edit_apart():
    rng = random.Random(6)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(1, 9))) for _ in range(150)})
    index = PositionIndex([w.encode() for w in words])
    a, b = index.near(np.arange(len(words)))
    got = list(zip(a.tolist(), b.tolist()))
    assert sorted(got) == [(i, j) for i, v in enumerate(words) for j, w in enumerate(words) if one_edit(v, w)]


def test_words_of_a_document():
    assert words_of(1, "Straße STRASSEN ÀÉÎÕÜ-façades ab 中文") == brute_like(1, "Straße STRASSEN ÀÉÎÕÜ-façades ab 中文")


def brute_like(doc_id, text):
    n = brute_words([(doc_id, text), (doc_id, text)])
    return Counter({w.encode("latin-1"): c // 2 for w, c in n.items()})


def test_empty_table(spark):
    assert variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert variants(spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")).count() == 0
