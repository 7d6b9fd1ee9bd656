"""Stable global numbering without a single-task window.

``row_number() over (order by k)`` with no partition key runs in one task.
Here the rows are range-partitioned on the sort key (Spark samples the key and
binary-searches the bounds), sorted inside each partition, and numbered by
position plus the running count of all earlier partitions. The per-partition
count table has one row per range partition, so its broadcast is bounded by
the partition count we choose, not by the data.

The range bounds come from a sample seeded by the RDD id, so two evaluations
of the same range exchange may cut different ranges. The positioned rows are
therefore written once as a Parquet table in the shared ``spark.checkpoint.dir``
folder, and both the counts and the numbering read that copy. This also cuts
the lineage, so a lost executor never recomputes the sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultlens.session import materialize

_POS_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits


def _order_exprs(order_cols):
    out = []
    for c in order_cols:
        out.append(F.col(c).asc_nulls_first() if isinstance(c, str) else c)
    return out


def global_row_number(df: DataFrame, order_cols, out: str = "row_num",
                      num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based position of each row in ``order_cols`` order (bigint).

    Equal to ``row_number() over (order by order_cols)``; ties on the full key
    are numbered in an arbitrary order, as with the window. End the key with a
    unique column (archive id, object key): range partitioning can then split
    any hot leading value over many tasks, which it cannot do for equal keys.
    """
    keys = _order_exprs(order_cols)
    # Without an explicit count, AQE sizes the range partitions from the data
    # (coalescing contiguous ranges keeps the global order). Positions are read
    # only from the written copy, so the partition layout needs no stability.
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    ranged = materialize(ranged.sortWithinPartitions(*keys)
                               .withColumn("_vl_mid", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(F.col("_vl_mid"), _POS_BITS)
    pos = F.col("_vl_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    counts = (ranged.select(part.alias("_vl_p"), pos.alias("_vl_pos"))
                    .groupBy("_vl_p").agg((F.max("_vl_pos") + 1).alias("_vl_n")))
    before = Window.orderBy("_vl_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_vl_p", F.coalesce(F.sum("_vl_n").over(before), F.lit(0)).alias("_vl_off"))
    return (ranged.withColumn("_vl_p", part)
                  .join(F.broadcast(offsets), "_vl_p")
                  .withColumn(out, (F.col("_vl_off") + pos + 1).cast("bigint"))
                  .drop("_vl_p", "_vl_off", "_vl_mid"))


def batch_number(df: DataFrame, order_cols, size: int, out: str = "batch") -> DataFrame:
    """Number rows globally, then ``batch = floor(row_number / size)``.

    With 1-based numbering the first batch holds ``size - 1`` rows, the rest
    ``size`` each, which is how the delete batches are cut.
    """
    return (global_row_number(df, order_cols, out="_vl_rn")
            .withColumn(out, F.floor(F.col("_vl_rn") / F.lit(size)).cast("bigint"))
            .drop("_vl_rn"))
