"""Distributed union-find over an edge table: alternating large-star and small-star rounds.

Every round is a group-by minimum and an equi-join; no component, neighbour list or
label table is ever gathered in one task or on the driver. The driver sees one count
and one checksum a round. A hub's edges meet one minimum, which is combined map-side,
and the join back on the hub is an inner join that AQE may split. Rounds go to tables
under ``spark.checkpoint.dir``, so a lost executor costs at most one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultlens.llm.common import discard, materialize


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for every node with a link; ``root`` is the smallest node of its component.

    Self links, repeated and reversed edges and edges with a null end are allowed and
    add nothing. No edges give no rows.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")) \
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct()
    e = materialize(e, "cc")
    seen = _sign(e)
    while seen[0]:
        old, e = e, materialize(_small_star(_large_star(e)), "cc")
        discard(old)
        now = _sign(e)
        if now == seen:
            break
        seen = now
    root = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(root)


def _sign(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(e: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest node it knows."""
    both = e.select(F.col("u").alias("x"), F.col("v").alias("y")) \
        .unionByName(e.select(F.col("v").alias("x"), F.col("u").alias("y")))
    low = both.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("lx"), F.least("x", "m").alias("m"))
    return both.where("y > x").join(low, F.col("x") == F.col("lx")) \
        .select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours and itself to the smallest of them."""
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(low.withColumnRenamed("u", "lu"), F.col("u") == F.col("lu")).where("v != m") \
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()
