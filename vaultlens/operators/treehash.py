"""SHA-256 tree hashes with native expressions.

Leaves are SHA-256 digests of fixed-size blocks. Each level pairs adjacent
digests (SHA-256 of the 64 concatenated bytes); an odd last node moves up
unchanged. Digests travel as lowercase hex text, the form the status record
keeps.

Work is bounded per group: leaves are combined per chunk (at most
``leaves_per_chunk`` digests in one array), then chunk digests per archive
(at most the chunk count). Because a chunk holds a power-of-two number of
leaves, the two-level result equals the flat tree over all leaves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultlens.constants import CHUNK_SIZE, TREE_HASH_LEAF



def leaf_sha256(block: Column) -> Column:
    return F.sha2(block, 256)


def leaf_digests(payload: DataFrame, id_col: str = "aid", bytes_col: str = "bytes",
                 leaf: int = TREE_HASH_LEAF) -> DataFrame:
    """One row per leaf: ``leaf_no`` (0-based) and its hex digest.

    An empty object has a single leaf: the digest of no bytes.
    """
    n = F.greatest(F.ceil(F.octet_length(F.col(bytes_col)) / F.lit(float(leaf))), F.lit(1)).cast("bigint")
    return (payload.select(id_col, bytes_col, F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1)).alias("leaf_no"))
                   .select(id_col, "leaf_no",
                           leaf_sha256(F.substr(F.col(bytes_col), F.col("leaf_no") * leaf + 1, F.lit(leaf))).alias("digest")))


def _level(arr: Column) -> Column:
    """One tree level over an array of hex digests."""
    n = F.size(arr)
    half = F.sequence(F.lit(0), F.ceil(n / F.lit(2.0)).cast("int") - 1)
    return F.transform(half, lambda j: F.when(
        j * 2 + 1 < n,
        F.sha2(F.concat(F.unhex(F.get(arr, j * 2)), F.unhex(F.get(arr, j * 2 + 1))), 256)
    ).otherwise(F.get(arr, j * 2)))


def combine_array(df: DataFrame, arr_col: str, out: str) -> DataFrame:
    """Reduce an ordered digest array of any length to its tree hash: one fold over as many
    levels as this array has (a level over a single digest leaves it as it is)."""
    arr = F.col(arr_col).cast("array<string>")
    levels = F.greatest(F.ceil(F.log2(F.size(arr))), F.lit(1)).cast("int")
    top = F.aggregate(F.sequence(F.lit(1), levels), arr, lambda acc, _: _level(acc).cast("array<string>"))
    return df.withColumn(out, F.get(top, 0))


def _ordered_digests(df: DataFrame, keys: list[str], order_col: str, digest_col: str) -> DataFrame:
    agg = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"),
                                                                     F.col(digest_col).alias("d")))).alias("_vl_s"))
    return agg.withColumn("_vl_arr", F.transform("_vl_s", lambda x: x.getField("d"))).drop("_vl_s")


def chunk_tree_hash(leaves: DataFrame, id_col: str = "aid", leaves_per_chunk: int = CHUNK_SIZE // TREE_HASH_LEAF) -> DataFrame:
    """Per (archive, chunk): tree hash of its leaves. ``part_no`` is 1-based."""
    keyed = leaves.withColumn("part_no", (F.floor(F.col("leaf_no") / F.lit(leaves_per_chunk)) + 1).cast("int"))
    arr = _ordered_digests(keyed, [id_col, "part_no"], "leaf_no", "digest")
    return combine_array(arr, "_vl_arr", "digest").drop("_vl_arr")


def multipart_tree_hash(chunks: DataFrame, id_col: str = "aid", order_col: str = "part_no",
                        digest_col: str = "digest", out: str = "tree_hash") -> DataFrame:
    """Per archive: tree hash over its chunk digests in part order."""
    arr = _ordered_digests(chunks, [id_col], order_col, digest_col)
    return combine_array(arr.withColumn("n_parts", F.size("_vl_arr")), "_vl_arr", out).drop("_vl_arr")


def tree_hash(payload: DataFrame, id_col: str = "aid", bytes_col: str = "bytes", leaf: int = TREE_HASH_LEAF,
              leaves_per_chunk: int = CHUNK_SIZE // TREE_HASH_LEAF, out: str = "tree_hash") -> DataFrame:
    """Archive tree hash from its bytes (chunk level, then archive level)."""
    leaves = leaf_digests(payload, id_col, bytes_col, leaf)
    chunks = chunk_tree_hash(leaves, id_col, leaves_per_chunk)
    return multipart_tree_hash(chunks, id_col, "part_no", "digest", out)
