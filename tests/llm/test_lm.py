"""Stupid-backoff scores against a plain computation, and the defined edge cases."""

import math
import random
from collections import Counter

import pytest
from conftest import SF_ORACLE

from vaultlens.llm.lm import lm_scores, op6_lm_scores, unigrams, word_counts


def brute(rows, vocabulary=None, alpha=0.4):
    """rows: (id, text) -> list of (id, n_words, n_backoff, score)"""
    docs = [(i, (t or "").encode().lower().split()) for i, t in rows]
    if vocabulary is not None:
        docs = [(i, [w if w in vocabulary else None for w in d]) for i, d in docs]
    uni = Counter(w for _, d in docs for w in d)
    bi = Counter(p for _, d in docs for p in zip(d, d[1:]))
    total, out = sum(uni.values()), []
    for i, d in docs:
        own = Counter(zip(d, d[1:]))
        score, back = (math.log(uni[d[0]] / total) if d else 0.0), 0
        for a, b in zip(d, d[1:]):
            n = own[a, b]
            if bi[a, b] > n:
                score += math.log((bi[a, b] - n) / (uni[a] - n))
            else:
                score, back = score + math.log(alpha * uni[b] / total), back + 1
        out.append((i, len(d), back, score))
    return out


def same(got, want):
    got = sorted(got, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    want = sorted(want, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(g[3] - w[3]) <= 1e-6 * max(1, abs(w[3])) for g, w in zip(got, want))


def rows_of(df):
    return [(r["id"], r.n_words, r.n_backoff, r.score) for r in df.collect()]


def test_query_matches_plain_computation(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()]
    got = [(r.doc_id, r.n_words, r.n_backoff, r.score) for r in op6_lm_scores(spark, SF_ORACLE).collect()]
    same(got, brute(rows))


@pytest.mark.parametrize("head", [1, 4, 512])
@pytest.mark.parametrize("vocabulary", [0, 7, 1000])
def test_vocabulary_and_head(spark, head, vocabulary):
    rng = random.Random(9)
    rows = [(i, " ".join(f"W{int(rng.expovariate(0.1))}é" for _ in range(rng.choice([0, 1, 2, 30])))) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    from pyspark.sql import functions as F
    model = unigrams(word_counts(df.select(F.col("text").cast("binary").alias("text"))), vocabulary)
    assert len(model.number) <= vocabulary
    same(rows_of(lm_scores(df, vocabulary=vocabulary, head=head)), brute(rows, set(model.number)))


def test_edge_rows(spark):
    rows = [(1, None), (1, None), (2, ""), (3, "a"), (4, "a a a a b"), (4, "a a a a b"), (None, "a b " * 40000), (5, " \n")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n int")
    got = lm_scores(df)
    same(rows_of(got), brute(rows))
    assert {r.mean_score for r in got.where("n_words = 0").collect()} == {None}
    assert lm_scores(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("head", [1, 4, 512])
@pytest.mark.parametrize("shared_words", [0, 7, 1000])
def test_scores_do_not_depend_on_where_counts_are_kept(spark, head, shared_words):
    rng = random.Random(10)
    rows = [(i, " ".join(f"W{int(rng.expovariate(0.05))}é" for _ in range(rng.choice([0, 1, 2, 30])))) for i in range(120)]
    rows += [(200, "twice twice rare"), (201, "rare twice twice twice rare"), (202, "lone"), (203, None), (None, "lone lone lone lone")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    same(rows_of(lm_scores(df, head=head, shared_words=shared_words)), brute(rows))


def test_every_word_of_a_large_vocabulary_is_its_own(spark):
    """More words than are broadcast: rare words keep their counts, alone and in bigrams."""
    rows = [(i, " ".join(f"w{k}" for k in range(1000 * i, 1000 * i + 1000))) for i in range(140)]
    rows += [(500, "w5 w6 w7 w139000 w9"), (501, "w139998 w139999 w139998 w139999")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    same(rows_of(lm_scores(df)), brute(rows))
