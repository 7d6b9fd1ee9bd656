"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultlens import session

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back. The shuffle files of the
    write go when it ends: nothing reads them again, as later plans start from the table."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        return session.materialize(df, name)
    finally:
        conf.set(_CLEANUP, before)


def discard(*tables: DataFrame) -> None:
    """Delete materialized tables that no plan will read again."""
    for df in tables:
        files = df.inputFiles()
        if files:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep_rows(docs: DataFrame, kept: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` whose (id, text hash) is in ``kept`` (columns ``id``, ``tkey``), once each.

    Rows that repeat both id and text collapse to one. Null ids and null texts match
    null-safely. ``docs`` keeps its columns, whatever their names.
    """
    cols = docs.columns
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"),
                    F.col(f"`{id_col}`").alias("id"), text_key(f"`{text_col}`").alias("tkey"))
    k = kept.select(F.col("id").alias("kid"), F.col("tkey").alias("ktkey"))
    j = d.join(k, F.col("id").eqNullSafe(F.col("kid")) & (F.col("tkey") == F.col("ktkey")), "left_semi")
    return j.dropDuplicates(["id", "tkey"]).select("row.*")


def text_key(text: str | Column) -> Column:
    """64-bit key of a whole text; with the id it tells rows apart. Never null."""
    return F.xxhash64(F.col(text) if isinstance(text, str) else text)
