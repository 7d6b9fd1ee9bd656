"""Global numbering equals the single-task window, also with a hot sort key."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from vaultlens.operators.numbering import batch_number, global_row_number
from vaultlens.plans import bindings as B


def _window(df):
    return df.withColumn("rn_ref", F.row_number().over(Window.orderBy(F.col("creationdate").asc_nulls_first(), "archiveid")))


def test_matches_window(spark):
    inv = B.inventory(spark, SF_ORACLE).select("archiveid", "creationdate")
    got = global_row_number(inv, ["creationdate", "archiveid"], num_partitions=16)
    j = got.join(_window(inv), ["archiveid", "creationdate"])
    assert j.where(F.col("row_num") != F.col("rn_ref")).count() == 0
    assert j.count() == inv.count()


def test_hot_key_and_nulls(spark):
    inv = B.inventory(spark, SF_ORACLE).select("archiveid", "creationdate")
    # a third of all rows share one creation date, a few have none
    hot = inv.withColumn("creationdate", F.when(F.substring("archiveid", 1, 2).isin("10", "11", "12"), F.lit(None))
                         .when(F.hash("archiveid") % 3 == 0, F.lit("2020-08-23"))
                         .otherwise(F.col("creationdate")))
    got = global_row_number(hot, ["creationdate", "archiveid"], num_partitions=8)
    j = got.join(_window(hot), "archiveid")
    assert j.where(F.col("row_num") != F.col("rn_ref")).count() == 0
    # the hot date is split over several range partitions, not one task
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" in plan  # only the per-partition count table is gathered
    sizes = (hot.repartitionByRange(8, F.col("creationdate").asc_nulls_first(), "archiveid")
                .groupBy(F.spark_partition_id().alias("p")).count().collect())
    assert max(r["count"] for r in sizes) < 0.25 * hot.count()


def test_delete_batches_999_then_1000(spark):
    keys = spark.range(1, 2501).select(F.format_string("k%05d", "id").alias("key"))
    b = batch_number(keys, ["key"], 1000).groupBy("batch").count().orderBy("batch").collect()
    assert [(r.batch, r["count"]) for r in b] == [(0, 999), (1, 1000), (2, 501)]


def test_data_sized_ranges_with_coalescing(spark):
    """No explicit count: AQE coalesces contiguous ranges; numbering stays exact."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "64")
    try:
        inv = B.inventory(spark, SF_ORACLE).select("archiveid", "creationdate")
        got = global_row_number(inv, ["creationdate", "archiveid"])
        j = got.join(_window(inv), ["archiveid", "creationdate"])
        assert j.where(F.col("row_num") != F.col("rn_ref")).count() == 0
    finally:
        spark.conf.set(key, before)
