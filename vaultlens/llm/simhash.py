"""SimHash near-duplicates by segment-popcount embedding.

1. A 64-bit fingerprint per whole text: word shingles, XXH64, majority of each bit.
2. Equal fingerprints collapse to one row; copies are never expanded into pairs.
3. Each distinct fingerprint becomes a vector of set-bit counts of its 32 two-bit
   segments. The Manhattan distance of two vectors never exceeds the Hamming distance
   of the fingerprints.
4. Grid range-join: the vector is cut into groups of dimensions. Pairs within Manhattan
   distance ``d`` agree up to ``d // groups`` in some group, so a pair at distance 3 lies
   in the same or an adjacent unit cell of one of two 16-dimensional grids. Every
   fingerprint sits in its home cell of each grid and probes that cell and those one
   step up; the pair's other member covers the step down.
5. Candidates pass the Manhattan bound over all segments, then the exact bit distance.
6. Distributed union-find over the verified links.

Very long texts are hashed whole. A bit that exactly half of the hashes set stays 0.
Null and empty texts and texts without words have fingerprint zero and link like any
other. Rows may repeat; each keeps its own result row. A null id never names a
component unless all its members have null ids. An empty table gives an empty result.
Other columns of the input are neither read nor returned.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from vaultlens.llm.common import keep_rows, materialize, read_table, text_key
from vaultlens.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
SEGMENTS = 32          # two bits each, so a count is 0, 1 or 2
_BLOCK = 1 << 16       # shingle hashes unpacked at a time


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of one text. ``bytes.lower`` and ``bytes.split`` touch only
    ASCII letters and the white space \\x20 and \\x09-\\x0D."""
    tokens = text.encode("utf-8", "replace").lower().split() if text else []
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) < words:
        hashes = [xxh64_intdigest(joined, SEED)]
    else:
        starts = [0, *accumulate(len(t) + 1 for t in tokens)]
        hashes = [xxh64_intdigest(joined[s:e - 1], SEED) for s, e in zip(starts, starts[words:])]
    h = np.array(hashes, dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), _BLOCK):
        bits = np.unpackbits(h[i:i + _BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = SHINGLE_WORDS) -> DataFrame:
    """``id, tkey, fp`` (signed long) per row."""
    src = docs.select(F.col(f"`{id_col}`").alias("id"), text_key(f"`{text_col}`").alias("tkey"),
                      F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches):
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py(), words) for t in b.column(2)), dtype=np.uint64, count=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))],
                                             names=["id", "tkey", "fp"])

    id_type = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {id_type}, tkey long, fp long")


def _segment(fp: Column, s: int) -> Column:
    width = 64 // SEGMENTS
    return F.bit_count(F.shiftrightunsigned(fp, s * width).bitwiseAND(F.lit((1 << width) - 1)))


def manhattan(a: Column, b: Column) -> Column:
    """Manhattan distance of the two embeddings, a lower bound of the bit distance."""
    total = F.lit(0)
    for s in range(SEGMENTS):
        total = total + F.abs(_segment(a, s) - _segment(b, s))
    return total


def _groups(max_bits: int) -> list[list[int]]:
    """Dimension groups of the grids: so many that the distance left to one group is at most one."""
    n = max_bits // 2 + 1
    return [list(range(g * SEGMENTS // n, (g + 1) * SEGMENTS // n)) for g in range(n)]


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``fa, fb`` for each two distinct fingerprints of ``prints`` (column ``fp``) that
    differ in at most ``max_bits`` bits. ``prints`` must not repeat a fingerprint."""
    fp, homes, probes = F.col("fp"), [], []
    groups = _groups(max_bits)
    top = 64 // SEGMENTS
    for g, dims in enumerate(groups):
        unit = [(top + 1) ** i for i in range(len(dims))]
        cell = F.lit(0).cast("long")
        for u, s in zip(unit, dims):
            cell = cell + _segment(fp, s) * F.lit(u).cast("long")
        key = cell * F.lit(len(groups)).cast("long") + F.lit(g).cast("long")
        homes.append(key)
        probes.append(key)
        if max_bits // len(groups):
            probes += [F.when(_segment(fp, s) < top, key + F.lit(u * len(groups)).cast("long"))
                       for u, s in zip(unit, dims)]
    home = prints.select(fp.alias("fb"), F.explode(F.array(*homes)).alias("cell_b"))
    probe = prints.select(fp.alias("fa"), F.explode(F.array(*homes)).alias("cell_a"), F.lit(True).alias("same")) \
        .unionByName(prints.select(fp.alias("fa"), F.explode(F.array_compact(F.array(
            *[p for p in probes if not any(p is h for h in homes)] or [F.lit(None).cast("long")]))).alias("cell_a"),
            F.lit(False).alias("same")))
    a, b = F.col("fa"), F.col("fb")
    near = probe.join(home, (F.col("cell_a") == F.col("cell_b")) & (~F.col("same") | (a < b))
                      & (manhattan(a, b) <= max_bits) & (F.bit_count(a.bitwiseXOR(b)) <= max_bits))
    return near.select(F.least(a, b).alias("fa"), F.greatest(a, b).alias("fb")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``id, tkey, fp, n_links, component, root`` per row: the row's fingerprint, how many other
    distinct fingerprints it links to, the smallest id reachable through links, and the
    fingerprint that names the component: unlike the id, no two components share it."""
    rows = materialize(fingerprints(docs, id_col, text_col, words), "simhash")
    groups = materialize(rows.groupBy("fp").agg(F.min("id").alias("first_id")), "simhash-groups")
    pairs = materialize(links(groups, max_bits), "simhash-links")
    root = connected_components(pairs, "fa", "fb")
    degree = pairs.select(F.explode(F.array("fa", "fb")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    linked = root.join(groups, F.col("node") == F.col("fp")).select("node", "root", "first_id")
    label = linked.groupBy("root").agg(F.min("first_id").alias("component"))
    named = linked.join(label, "root").join(degree, "node").select("node", "root", "component", "n_links")
    # Written first, so that the last join reads two plain shuffles and AQE can split a hot print.
    by_print = materialize(groups.join(named, F.col("fp") == F.col("node"), "left").select(
        F.col("fp").alias("gfp"), F.coalesce("component", "first_id").alias("component"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("root", F.col("fp")).alias("root")), "simhash-labels")
    return rows.join(by_print, F.col("fp") == F.col("gfp")).select("id", "tkey", "fp", "n_links", "component", "root")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: the one whose id names it (of rows that
    repeat that id within the component, the one with the smallest text key)."""
    near = near_duplicates(docs, id_col, text_col, words, max_bits)
    kept = near.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "tkey")).alias("row"))
    return keep_rows(docs, kept.select("row.id", "row.tkey"), id_col, text_col)


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = near_duplicates(read_table(spark, sf_dir, "documents"))
    return near.select(F.col("id").alias("doc_id"),
                       F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                       F.col("component").alias("component_id"), "n_links")
