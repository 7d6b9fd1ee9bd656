"""Source divergence against a plain model, hash-consing, and the defined edge cases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from vaultlens.llm import divergence as mod
from vaultlens.llm.divergence import Forest, divergence, fixed_point, price, terms_of

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def words(text):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in TERM.findall(text or "")]


def brute(rows, min_docs):
    df, n, total = defaultdict(Counter), defaultdict(Counter), Counter()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        n[lang, source].update(words(text))
        df[lang].update(set(words(text)))
    out = []
    for lang in {g[0] for g in n}:
        kept = sorted(t for t, d in df[lang].items() if d >= min_docs)
        groups = {g[1]: c for g, c in n.items() if g[0] == lang}
        whole = sum(groups.values(), Counter())

        def p(c, t):
            return 1 + 10 ** 9 * (c[t] + 2) // (sum(c[k] for k in kept) + 2 * len(kept))

        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s, c in groups.items():
            mine = {t: p(c, t) for t in kept}
            pair = [(-sum(f(mine[t], p(o, t)) for t in kept), other) for other, o in groups.items() if other != s]
            term = [(-f(mine[t], p(whole, t)), t) for t in kept if c[t] and mine[t] > p(whole, t)]
            for part, items in (("pair", pair), ("term", sorted(term, key=lambda x: (x[0], x[1].encode()))[:10])):
                out += [(lang, s, part, i, -v, k) for k, (v, i) in enumerate(sorted(items, key=lambda x: (x[0], x[1].encode())), 1)]
    return sorted(out)


def made(n_rows, sources):
    rng = random.Random(4)
    vocab = [f"{a}{b}{'é' * (i % 3 == 0)}" for i, (a, b) in enumerate((x, y) for x in "bcdfgh" for y in "aeiou")]
    rows = []
    for _ in range(n_rows):
        s = rng.randrange(sources)
        text = " ".join(rng.choice(vocab[s % 7:s % 7 + 12]).title() for _ in range(rng.randrange(60)))
        rows.append((rng.choice(["en", "de", None]), f"s{s}" if s else None, text))
    return rows + [("xx", "a", "too rare"), ("xx", "b", None), ("xx", "c", ""), ("en", "empty", "12 34"), ("en", "long", "ba " * 50000)]


@pytest.mark.parametrize("leaves, tile", [(2048, 32), (4, 2), (1, 1)])
def test_matches_brute_force(spark, monkeypatch, leaves, tile):
    """Also with many ranges and many tiles of groups."""
    monkeypatch.setattr(mod, "LEAVES", leaves)
    monkeypatch.setattr(mod, "TILE", tile)
    rows = made(150, 6)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, source string, text string, n long, term string")
    assert sorted(tuple(r) for r in divergence(df, min_docs=3).collect()) == brute(rows, 3)


def test_terms_match_definition():
    text = "Ab-c ÄÖ'x9y z K L \x7f[q]{r}"
    assert [t.decode() for t in terms_of(text)] == words(text)
    assert terms_of(None) == terms_of("") == []


def test_forest_shares_equal_subtrees_and_prices_pairs_once():
    rng = np.random.default_rng(2)
    counts = np.tile(rng.integers(0, 3, (6, 16)), (1, 64))
    forest = Forest(counts)
    assert sum(len(left) for left, _ in forest.levels) <= 6 * 16 + 6 * 8
    calls = []

    def values(pair, a, b):
        calls.append(len(pair))
        return (a - b) ** 2

    i, j = np.triu_indices(6, 1)
    sums, _ = forest.walk(forest.roots[i], forest.roots[j], values)
    assert list(sums) == [int(((counts[x] - counts[y]) ** 2).sum()) for x, y in zip(i, j)]
    assert calls == [calls[0]] and calls[0] <= 9 * len(i)


def test_fixed_point_is_exact_for_large_totals():
    rng = random.Random(1)
    for _ in range(200):
        d = rng.randrange(4, 9 * 10 ** 15)
        c = rng.randrange(0, d - 1)
        assert fixed_point(np.array([c]), np.array([d]))[0] == 1 + 10 ** 9 * (c + 2) // d
    assert price(np.array([5]), np.array([5]))[0] == 0


def test_empty_table_and_repeated_rows(spark):
    schema = "lang string, source string, text string"
    assert divergence(spark.createDataFrame([], schema)).count() == 0
    rows = [("en", "a", "alpha beta")] * 12 + [("en", "b", "alpha")]
    assert sorted(tuple(r) for r in divergence(spark.createDataFrame(rows, schema)).collect()) == brute(rows, 10)
