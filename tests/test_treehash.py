"""Tree hash against known values and a Python model."""

import hashlib
import random

from vaultlens.operators import treehash


def model(data: bytes, leaf: int) -> str:
    nodes = [hashlib.sha256(data[i:i + leaf]).digest() for i in range(0, max(len(data), 1), leaf)] or \
        [hashlib.sha256(b"").digest()]
    while len(nodes) > 1:
        nodes = [hashlib.sha256(nodes[i] + nodes[i + 1]).digest() if i + 1 < len(nodes) else nodes[i]
                 for i in range(0, len(nodes), 2)]
    return nodes[0].hex()


# --- fixed values: 2 MiB tree hashes with 1 MiB leaves
KNOWN = {
    0x00: "861890b487038d840e9d71d43bbc0fd4571453fb9d9b1f370caa3582a29b0ec7",
    0xFF: "f488590fadabfeba008495f83be1c35d95199ced95eff5096a4dfab76dd77abd",
}


def test_two_mib_known_values(spark):
    rows = [(str(b), bytes([b]) * (2 * 1024 * 1024)) for b in KNOWN]
    df = spark.createDataFrame(rows, "aid string, bytes binary")
    got = {r.aid: r.tree_hash for r in treehash.tree_hash(df).collect()}
    assert got == {str(b): h for b, h in KNOWN.items()}


def test_leaf_counts_match_model(spark):
    rnd = random.Random(3)
    leaf = 16
    rows = []
    for n_leaves in (1, 2, 3, 5, 33, 64, 65):
        for extra in (0, 5):
            size = max(0, n_leaves * leaf - (leaf - extra if extra else 0))
            rows.append((f"{n_leaves}-{extra}", bytes(rnd.getrandbits(8) for _ in range(size))))
    rows.append(("empty", b""))
    df = spark.createDataFrame(rows, "aid string, bytes binary")
    flat = {r.aid: r.tree_hash for r in treehash.tree_hash(df, leaf=leaf).collect()}
    two_level = {r.aid: r.tree_hash for r in treehash.tree_hash(df, leaf=leaf, leaves_per_chunk=4).collect()}
    want = {a: model(b, leaf) for a, b in rows}
    assert flat == want
    assert two_level == want


def test_many_chunk_digests(spark):
    """More chunk digests than any fixed number of levels used to allow."""
    n = (1 << 14) + 3
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    df = spark.range(n).selectExpr("'a' as aid", "id as part_no", "sha2(cast(id as string), 256) as digest")
    nodes = digests
    while len(nodes) > 1:
        nodes = [hashlib.sha256(nodes[i] + nodes[i + 1]).digest() if i + 1 < len(nodes) else nodes[i]
                 for i in range(0, len(nodes), 2)]
    assert treehash.multipart_tree_hash(df).first().tree_hash == nodes[0].hex()
