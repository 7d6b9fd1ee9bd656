"""Run the migration work on real inputs (files, not the test bindings).

    python -m vaultlens.cli partition --inventory inv.csv [--overrides filelist/] --out partitioned/
    python -m vaultlens.cli requests  --partitioned partitioned/ [--status status/] --out requests/
    python -m vaultlens.cli chunks    --status requests/ --out chunk-messages/
    python -m vaultlens.cli treehash  --objects staged/ --status requests/ --out routed/
    python -m vaultlens.cli progress  --changes changes/ --out points/
    python -m vaultlens.cli check     --inventory inv.csv [--partitioned partitioned/]
    python -m vaultlens.cli pacing    --partitioned partitioned/ [--throttle t/] [--elapsed e/] --out calendar/
    python -m vaultlens.cli release   --status validated/ --staging staged/ --destination archive/ --out release-messages/

Each command is one Spark job over whole inputs; outputs are Parquet (or JSON
text for work messages) under ``--out``.
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultlens.constants import DAILY_QUOTA_BYTES
from vaultlens.functions.sizing import chunk_count, iso_timestamp
from vaultlens.functions.text import uri_encode
from vaultlens.operators import inventory as invops
from vaultlens.operators import lifecycle, naming, progress, ranges, treehash
from vaultlens.session import get_session
from vaultlens.sources import files as io
from vaultlens.sources import ranges_io


def partition(spark: SparkSession, inventory: str, overrides: str | None, out: str,
              quota: int = DAILY_QUOTA_BYTES) -> DataFrame:
    """Inventory CSV (+ override list) -> partitioned Parquet; returns the partition plan."""
    inv = io.scan_inventory_csv(spark, inventory)
    ovr = io.scan_override_csv(spark, overrides) if overrides else None
    # A CSV source is parsed once into a staged Parquet copy (stage=True).
    parted = invops.partition_inventory(inv, ovr, quota, stage=True)
    io.write_partitioned_inventory(parted, out)
    back = io.scan_partitioned_inventory(spark, out)
    return back.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("size").cast("bigint").alias("bytes"),
                                    F.min("row_num").alias("lo"), F.max("row_num").alias("hi"))


def requests(spark: SparkSession, partitioned: str, status: str | None, out: str) -> DataFrame:
    """Partitioned inventory -> status records for every archive not yet requested.

    With ``status`` (earlier status records), each partition resumes after its
    last requested row and names collide with the recorded ones.
    """
    parted = naming.resolve_names(io.scan_partitioned_inventory(spark, partitioned))
    recorded = None
    if status:
        st = spark.read.parquet(status)
        last = st.groupBy(F.col("pid").alias("part")).agg(F.max("ifn").alias("max_ifn"))
        parted = (parted.join(last, "part", "left")
                        .where(F.col("row_num") > F.coalesce(F.col("max_ifn"), F.lit(0))).drop("max_ifn"))
        recorded = st.select("fname")
    named = naming.unique_names(parted, recorded=recorded)
    rows = named.select(
        F.col("archiveid").alias("aid"), F.col("row_num").alias("ifn"), F.col("part").alias("pid"),
        F.col("sha256treehash").alias("sha"), F.col("size").alias("sz"),
        F.col("archivedescription").alias("descr"), "fname", chunk_count("size").cast("int").alias("cc"),
        F.lit(0).alias("rc"), iso_timestamp(F.current_timestamp()).alias("cdt"))
    rows.write.mode("overwrite").parquet(out)
    return spark.read.schema(rows.schema).parquet(out)


def chunks(spark: SparkSession, status: str, out: str) -> None:
    """Status records not yet started -> copy tasks as JSON messages."""
    st = spark.read.parquet(status)
    if "psdt" in st.columns:
        st = st.where(F.col("psdt").isNull())
    plan = ranges.plan_copy_chunks(st.select("aid", "fname", "sz", "cc"))
    io.write_messages(io.to_messages(plan, ["aid", "fname", "part_no", "start_byte", "end_byte"]), out)


def verify(spark: SparkSession, objects: str, status: str, out: str) -> DataFrame:
    """Staged objects (``<objects>/<aid>``) -> tree hashes -> validated / retry / failed."""
    st = spark.read.parquet(status)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(objects) \
                  .select("path", F.col("length").alias("sz"),
                          F.regexp_extract("path", "([^/]+)$", 1).alias("aid"))
    plan = ranges.plan_hash_chunks(listed.withColumn("cc", chunk_count("sz").cast("int")))
    hashes = treehash.multipart_tree_hash(ranges_io.scan_byte_ranges(ranges_io.spread(plan)))
    routed = lifecycle.validate_hash(hashes, st.select("aid", "sha", "sz", "rc"))
    routed.write.mode("overwrite").partitionBy("route").parquet(out)
    return spark.read.parquet(out)


def progress_points(spark: SparkSession, changes: str, out: str, dimension: str = "vaultlens") -> DataFrame:
    """Status change records (Parquet with event_name, old, new) -> metric points."""
    ch = spark.read.parquet(changes)
    points = progress.progress_points(progress.counter_totals(
        progress.counter_deltas(progress.stage_counts(ch))))
    progress.write_metric_points(points, out, dimension, int(time.time()))
    return spark.read.parquet(out)


def check(spark: SparkSession, inventory: str, partitioned: str | None) -> DataFrame:
    """Inventory against the partitioned table: counts, and READY, PARTITION or FAIL."""
    inv = io.scan_inventory_csv(spark, inventory)
    parted = io.scan_partitioned_inventory(spark, partitioned) if partitioned else \
        spark.createDataFrame([], io.PARTITIONED_SCHEMA)
    return invops.consistency_check(inv, parted)


def pacing(spark: SparkSession, partitioned: str, throttle: str | None, elapsed: str | None, out: str,
           quota: int = DAILY_QUOTA_BYTES) -> DataFrame:
    """The request loop as a table. ``throttle`` (part, throttled_bytes, errors) and ``elapsed``
    (part, elapsed_s, optionally ready_s) are Parquet tables of what earlier partitions met."""
    read = lambda path: spark.read.parquet(path) if path else None
    calendar = invops.request_calendar(io.scan_partitioned_inventory(spark, partitioned), read(throttle), quota, read(elapsed))
    calendar.write.mode("overwrite").parquet(out)
    return spark.read.schema(calendar.schema).parquet(out)


def release(spark: SparkSession, status: str, staging: str, destination: str, out: str) -> DataFrame:
    """Validated status records -> copy tasks from the staging to the destination folder as JSON
    messages, without what is at the destination already. Returns validated objects that have
    no staged copy."""
    def keys(base):
        name = F.expr("substr(path, instr(path, prefix) + length(prefix))")
        root = F.lit(f"{base.rstrip('/')}/".replace("file://", ""))
        return io.list_objects(spark, base, [""]).withColumn("prefix", root).select(name.alias("key"))

    st = spark.read.parquet(status).where(F.col("vdt").isNotNull())
    plan = ranges.plan_release_chunks(st.select("aid", "fname", "sz", "cc", "vdt"), keys(destination))
    plan = plan.withColumn("copy_source", uri_encode(F.concat(F.lit(f"{staging.rstrip('/')}/"), F.col("fname"))))
    there = keys(staging).select(F.col("key").alias("fname"))
    io.write_messages(io.to_messages(plan.join(there, "fname", "left_semi"),
                                     ["aid", "fname", "part_no", "start_byte", "end_byte", "copy_source"]), out)
    return plan.join(there, "fname", "left_anti").select("aid", "fname").distinct()


def main(argv=None):
    ap = argparse.ArgumentParser(prog="vaultlens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("partition"); p.add_argument("--inventory", required=True)
    p.add_argument("--overrides"); p.add_argument("--out", required=True)
    p.add_argument("--dql", type=int, default=DAILY_QUOTA_BYTES)
    p = sub.add_parser("requests"); p.add_argument("--partitioned", required=True)
    p.add_argument("--status"); p.add_argument("--out", required=True)
    p = sub.add_parser("chunks"); p.add_argument("--status", required=True); p.add_argument("--out", required=True)
    p = sub.add_parser("treehash"); p.add_argument("--objects", required=True)
    p.add_argument("--status", required=True); p.add_argument("--out", required=True)
    p = sub.add_parser("progress"); p.add_argument("--changes", required=True); p.add_argument("--out", required=True)
    p = sub.add_parser("check"); p.add_argument("--inventory", required=True); p.add_argument("--partitioned")
    p = sub.add_parser("pacing"); p.add_argument("--partitioned", required=True); p.add_argument("--throttle")
    p.add_argument("--elapsed"); p.add_argument("--out", required=True)
    p.add_argument("--dql", type=int, default=DAILY_QUOTA_BYTES)
    p = sub.add_parser("release")
    for name in ("--status", "--staging", "--destination", "--out"):
        p.add_argument(name, required=True)
    a = ap.parse_args(argv)
    spark = get_session()
    if a.cmd == "partition":
        partition(spark, a.inventory, a.overrides, a.out, a.dql).show(20, truncate=False)
    elif a.cmd == "requests":
        print(requests(spark, a.partitioned, a.status, a.out).count(), "status records")
    elif a.cmd == "chunks":
        chunks(spark, a.status, a.out)
    elif a.cmd == "treehash":
        verify(spark, a.objects, a.status, a.out).groupBy("route").count().show()
    elif a.cmd == "progress":
        progress_points(spark, a.changes, a.out).show(truncate=False)
    elif a.cmd == "check":
        check(spark, a.inventory, a.partitioned).show()
    elif a.cmd == "pacing":
        pacing(spark, a.partitioned, a.throttle, a.elapsed, a.out, a.dql).orderBy("part").show(50)
    elif a.cmd == "release":
        print(release(spark, a.status, a.staging, a.destination, a.out).count(), "validated objects without a staged copy")


if __name__ == "__main__":
    main()
