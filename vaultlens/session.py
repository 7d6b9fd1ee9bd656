"""Session construction and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_LOCAL_SCRATCH: str | None = None


def get_session(master: str | None = None, app: str = "vaultlens", shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Session with the settings every job assumes (UTC, AQE, no UI)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Streaming state (distinct parts, per-key counts) grows with the number of
        # archives; RocksDB keeps it off the JVM heap.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared (distributed) folder and
    is used as is. When it is unset, a local master gets a private folder; on a
    cluster that is an error, as executors would not see each other's files.
    """
    global _LOCAL_SCRATCH
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()   # always the qualified name: Arrow opens it on executors
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _LOCAL_SCRATCH is None:
        _LOCAL_SCRATCH = tempfile.mkdtemp(prefix="vaultlens-ckpt-")
    sc.setCheckpointDir(_LOCAL_SCRATCH)
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for a written table, under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/vaultlens-{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """The shuffle files of the plans run inside go when each plan ends, not when the driver
    next collects garbage: nothing reads them again once their rows are written."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def materialize(df, name: str):
    """Cut the lineage: write ``df`` as Parquet under the shared checkpoint folder and
    read it back (zstd: ids and digests in hex take half of what snappy makes of them). Later stages (and retries after a lost executor) read the files
    instead of recomputing the plan."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    with shuffles_dropped(spark):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df) -> None:
    """Delete the folder of a materialized table, alone in its plan, that no plan will read again."""
    if files := df.inputFiles():
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
