"""Running state over ordered rows, as a parallel prefix scan.

A step that is more than a sum, such as ``t -> max(t + a, d)``, still composes: two steps
``(a, d)`` and ``(a', d')`` are the one step ``(a + a', max(d + a', d'))``. So the rows are
cut into blocks, each block is composed into one step, the blocks are scanned in the same way,
and each block's start state is joined back to its rows. No window spans more than a block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultlens.session import materialize

BLOCK = 4096


def maxplus_scan(df: DataFrame, pos: str, add: Column, at_least: Column, out: str, start: int = 0,
                 block: int = BLOCK) -> DataFrame:
    """Add ``out``: the state before each row, in order of ``pos`` (a unique whole number).

    The state is ``start`` before the first row; a row turns ``t`` into
    ``max(t + add, at_least)``, where a null ``at_least`` sets no bound.
    """
    before = Window.partitionBy("_vl_b").orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.select("*", F.floor(F.col(pos) / block).alias("_vl_b"), F.coalesce(add, F.lit(0)).cast("bigint").alias("_vl_a"),
                     at_least.cast("bigint").alias("_vl_d"))
    rows = rows.withColumn("_vl_c", F.coalesce(F.sum("_vl_a").over(before), F.lit(0)))
    # A bound, taken back to the start of the block.
    rows = rows.withColumn("_vl_m", F.col("_vl_d") - F.col("_vl_c") - F.col("_vl_a"))
    rows = materialize(rows.withColumn("_vl_l", F.max("_vl_m").over(before)), "scan")
    total = F.sum("_vl_a")
    blocks = materialize(rows.groupBy("_vl_b").agg(total.alias("_vl_ba"), (F.max("_vl_m") + total).alias("_vl_bd")), "scan-blocks")
    if blocks.limit(2).count() > 1:
        blocks = maxplus_scan(blocks.withColumnRenamed("_vl_b", "_vl_pos"), "_vl_pos", F.col("_vl_ba"), F.col("_vl_bd"),
                              "_vl_in", start, block).withColumnRenamed("_vl_pos", "_vl_b")
    else:
        blocks = blocks.withColumn("_vl_in", F.lit(start).cast("bigint"))
    inside = rows.join(blocks.select("_vl_b", "_vl_in"), "_vl_b")
    state = F.greatest(F.col("_vl_in") + F.col("_vl_c"), F.col("_vl_l") + F.col("_vl_c"))
    return inside.withColumn(out, state).select(*df.columns, out)


def suffix_min(df: DataFrame, key: str, pos: str, value: str, out: str, block: int) -> DataFrame:
    """Add ``out``: the minimum of ``value`` over this row and all with a larger ``pos`` of its
    ``key``, and ``{pos}_below``: the next smaller ``pos`` of the key (null for the smallest).

    Two levels: a block is a (key, range of ``block`` positions); the blocks' own minima and
    largest positions are scanned per key, one row a block, and carried in.
    """
    b = df.withColumn("_vl_b", F.floor(F.col(pos) / block))
    rest = Window.partitionBy(key, "_vl_b").orderBy(F.col(pos).desc())
    rows = materialize(b.withColumn("_vl_in", F.min(value).over(rest.rowsBetween(Window.unboundedPreceding, 0)))
                       .withColumn("_vl_next", F.lead(pos).over(rest)), "scan")
    blocks = rows.groupBy(key, "_vl_b").agg(F.min(value).alias("_vl_min"), F.max(pos).alias("_vl_top"))
    over = Window.partitionBy(key).orderBy(F.col("_vl_b").desc())
    carry = blocks.select(key, "_vl_b", F.min("_vl_min").over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("_vl_later"),
                          F.lead("_vl_top").over(over).alias("_vl_below"))
    return (rows.join(carry, [key, "_vl_b"])
                .withColumn(out, F.least("_vl_in", "_vl_later"))
                .withColumn(f"{pos}_below", F.coalesce("_vl_next", "_vl_below"))
                .select(*df.columns, out, f"{pos}_below"))
