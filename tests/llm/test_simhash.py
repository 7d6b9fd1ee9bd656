"""SimHash near-duplicates against brute force, and the defined edge cases."""

import random

import pytest
import xxhash

from vaultlens.llm import simhash
from vaultlens.llm.simhash import drop_near_duplicates, fingerprint, links, near_duplicates, op4_simhash_near_dedup


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hs) > len(hs))


def brute_components(rows, max_bits=3):
    fps = {i: brute_print(t) for i, t in rows}
    comp = {i: i for i in fps}
    changed = True
    while changed:
        changed = False
        for i in fps:
            low = min(comp[j] for j in fps if bin(fps[i] ^ fps[j]).count("1") <= max_bits)
            if low < comp[i]:
                comp[i], changed = low, True
    return comp


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(300)]
    rows = []
    for g in range(25):
        base = [rng.choice(vocab) for _ in range(rng.choice([1, 2, 3, 40, 400]))]
        for _ in range(rng.choice([1, 2, 6])):
            words = list(base)
            for _ in range(rng.choice([0, 1, 2])):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            rows.append((len(rows) + 1, " ".join(words)))
    return rows + [(900, None), (901, ""), (902, " \n\t"), (903, "Ärger A"), (904, "x " * 70000)]


def test_fingerprint_matches_definition(corpus):
    for _, t in corpus[:-1]:
        assert fingerprint(t) == brute_print(t)


def test_components_match_brute_force(spark, corpus):
    df = spark.createDataFrame([(i, t, i) for i, t in corpus], "doc_id long, text string, fp long")
    got = {r["id"]: r["component"] for r in near_duplicates(df).collect()}
    assert got == brute_components(corpus)
    assert got[900] == got[901] == got[902] == 900


@pytest.mark.parametrize("max_bits", [0, 1, 3, 5])
def test_links_find_every_pair(spark, max_bits):
    rng = random.Random(1)
    fps = {0, (1 << 64) - 1}
    for _ in range(30):
        base = rng.getrandbits(64)
        for k in range(8):
            x = base
            for b in rng.sample(range(64), k):
                x ^= 1 << b
            fps.add(x)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = {(r.fa, r.fb) for r in links(spark.createDataFrame([(f,) for f in signed], "fp long"), max_bits).collect()}
    mask = (1 << 64) - 1
    want = {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & mask).count("1") <= max_bits}
    assert got == want


def test_repeated_and_null_rows(spark):
    text = "one two three four five six"
    df = spark.createDataFrame([(1, text, "a"), (1, text, "a"), (None, text, "b"), (2, text, "c"), (7, None, None)],
                               "doc_id long, text string, id string")
    rows = near_duplicates(df).collect()
    assert sorted((r["id"] or 0, r["component"]) for r in rows) == [(0, 1), (1, 1), (1, 1), (2, 1), (7, 7)]
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r["id"] or "") for r in kept.collect()) == [(1, "a"), (7, "")]


def test_components_with_equal_or_no_ids_stay_apart(spark):
    """Unlinked texts without ids, or under one id, are components of their own; copies still collapse."""
    texts = ["one two three four five six", "red green blue yellow black white", "north south east west up down"]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (None, texts[2]), (5, texts[2]),
            (8, "Monday Tuesday Wednesday Thursday"), (8, "iron copper silver gold tin lead")]
    kept = drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted(
        [(0, texts[0]), (0, texts[1]), (5, texts[2]), *rows[5:]])


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(df).count() == 0 and drop_near_duplicates(df).count() == 0


def test_embedding_bounds_bit_distance(spark):
    from pyspark.sql import functions as F
    rng = random.Random(2)
    pairs = [(rng.getrandbits(63), rng.getrandbits(63)) for _ in range(200)]
    df = spark.createDataFrame(pairs, "a long, b long")
    bad = df.where(simhash.manhattan(F.col("a"), F.col("b")) > F.bit_count(F.col("a").bitwiseXOR(F.col("b"))))
    assert bad.count() == 0


def test_query_matches_brute_force(spark):
    """Every fingerprint and component of the registered query on a whole table."""
    from conftest import SF_SMALL
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    want = brute_components(rows)
    got = {r.doc_id: r for r in op4_simhash_near_dedup(spark, SF_SMALL).collect()}
    assert got.keys() == want.keys()
    for i, t in rows:
        assert (got[i].fingerprint, got[i].component_id) == (f"{brute_print(t):016x}", want[i])
    assert len(set(want.values())) < len(want)
