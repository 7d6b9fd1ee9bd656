"""Embedding near-duplicates against brute force, measured recall, and the defined edge cases."""

import numpy as np
import pytest

from vaultlens.llm import vectors
from vaultlens.llm.vectors import learn_tables, near_vectors, op11_embedding_near_dedup, substrings, unit_rows


def brute(x, threshold=0.95):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= threshold
    np.fill_diagonal(near, False)
    comp = np.arange(len(x))
    while True:
        low = np.array([min(comp[i], comp[near[i]].min(initial=len(x))) for i in range(len(x))])
        if (low == comp).all():
            return near, comp
        comp = low


def near_copies(rng, n, dim, groups, spread):
    x = rng.standard_normal((n, dim))
    for size in groups:
        at = rng.integers(0, n, size)
        x[at] = rng.standard_normal(dim) + spread * rng.standard_normal((size, dim))
    return x


def run(spark, x, **kw):
    df = spark.createDataFrame([(i, [float(c) for c in v], i % 3) for i, v in enumerate(x)], "vec_id long, embedding array<double>, node int")
    rows = sorted(near_vectors(df, **kw).collect())
    assert [r["id"] for r in rows] == list(range(len(x)))
    return np.array([r.n_links for r in rows]), np.array([r.component for r in rows])


@pytest.mark.parametrize("hot, block", [(1024, 1024), (20, 16)])
def test_links_and_components_match_brute_force(spark, monkeypatch, hot, block):
    """Also with balls and with many blocks a bucket; groups lie on both sides of a ball's radius."""
    monkeypatch.setattr(vectors, "HOT", hot)
    monkeypatch.setattr(vectors, "BLOCK", block)
    monkeypatch.setattr(vectors, "BUCKET", 8)
    rng = np.random.default_rng(3)
    x = near_copies(rng, 900, 24, [200, 60, 12, 5, 3, 2], 0.1)
    x[100:140] = x[99] + 0.2 * rng.standard_normal((40, 24))
    x[300:310] = x[299] * rng.uniform(0.1, 9, (10, 1))
    near, comp = brute(x)
    links, got = run(spark, x, recall=1.0)
    assert near.sum() > 5000
    assert links.sum() >= 0.995 * near.sum() and (links <= near.sum(axis=1)).all()
    assert (got == comp).mean() > 0.995


def test_low_rank_vectors_get_shorter_substrings():
    x = unit_rows(list(np.random.default_rng(1).standard_normal((400, 2)) @ np.ones((2, 2)) + 5), 2)
    model, width = learn_tables(x, 10**9, 0.95, recall=1.0)
    assert width < 2 and len(model) <= vectors.ROTATIONS


def test_recall_at_the_threshold():
    """Pairs with a cosine just above the threshold that the tables were not made from."""
    rng = np.random.default_rng(8)
    sample = unit_rows(list(rng.standard_normal((4000, 64)) + 0.3), 64)
    model, width = learn_tables(sample, 50_000, 0.95)
    a = unit_rows(list(rng.standard_normal((3000, 64)) + 0.3), 64)
    noise = rng.standard_normal(a.shape)
    noise -= (noise * a).sum(axis=1, keepdims=True) * a
    b = 0.951 * a + np.sqrt(1 - 0.951 ** 2) * noise / np.linalg.norm(noise, axis=1, keepdims=True)
    assert width == 7
    assert (substrings(a, model, width) == substrings(b, model, width)).any(axis=1).mean() >= 0.98


def test_query_recall_on_the_table(spark):
    from conftest import SF_ORACLE
    rows = spark.read.parquet(f"{SF_ORACLE}/embeddings.parquet").collect()
    near, _ = brute(np.array([r.embedding for r in rows], dtype=float))
    want = {r.vec_id: int(n) for r, n in zip(rows, near.sum(axis=1))}
    got = op11_embedding_near_dedup(spark, SF_ORACLE).collect()
    assert len(got) == len(rows)
    assert sum(r.n_links for r in got) >= 0.9 * sum(want.values()) and all(r.n_links <= want[r.vec_id] for r in got)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_no_link_below_the_threshold(spark):
    a = np.zeros((3, 8))
    a[:, 0] = 1
    a[1, 1] = np.tan(np.arccos(0.9501))
    a[2, 1] = -np.tan(np.arccos(0.9499))
    links, comp = run(spark, a, recall=1.0)
    assert list(links) == [1, 1, 0] and list(comp) == [0, 0, 2]


def test_odd_vectors_and_rows(spark):
    v, w = [1.0, 2.0, 3.0], [3.0, -1.0, 0.5]
    rows = [(5, v), (2, [2.0, 4.0, 6.0]), (5, v), (None, v), (None, w), (None, [1e200, 2e200, 3e200]), (7, None), (8, []),
            (9, [0.0, 0.0, 0.0]), (10, [1.0, None, 3.0]), (11, [float("nan")] * 3), (12, [float("inf"), 0.0, 0.0]),
            (13, [1.0, 2.0]), (14, [1.0, 2.0, 3.0, 0.0]), (15, [-0.0, 1.0]), (16, [0.0, 1.0])]
    df = spark.createDataFrame([(i, e, "x") for i, e in rows], "vec_id long, embedding array<double>, component string")
    got = sorted((r["id"] or 0, r.n_links, r.component or 0) for r in near_vectors(df, recall=1.0).collect())
    assert got == sorted([(5, 4, 2), (2, 4, 2), (5, 4, 2), (0, 4, 2), (0, 4, 2), (0, 0, 0), *((i, 0, i) for i in range(7, 15)),
                          (15, 1, 15), (16, 1, 15)])


def test_empty_tables(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert near_vectors(df).count() == 0
    nulls = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in near_vectors(nulls).collect()] == [(1, 0, 1)]
