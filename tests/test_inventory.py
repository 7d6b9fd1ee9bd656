"""Sizing, consistency, overrides, pacing, and partition pruning on the written table."""

import math

from pyspark.sql import functions as F

from conftest import SF_SMALL
from vaultlens.constants import DAILY_QUOTA_BYTES, TIB
from vaultlens.functions.sizing import consistency_state, partition_size, request_wait_seconds
from vaultlens.operators import inventory as inv_ops
from vaultlens.plans import bindings as B
from vaultlens.session import scratch_dir
from vaultlens.sources import files as io


def model_psize(count, vault):
    days = math.ceil(vault / DAILY_QUOTA_BYTES)
    return 10000 if days * 16 * 10000 < count else math.ceil(count / 16 / days)


def test_partition_size(spark):
    cases = [(1000, 0), (1, 1), (200000, 10 * TIB), (5_000_000, 10 * TIB), (161000, 60 * TIB), (160000, 60 * TIB),
             (3, 500 * TIB)]
    df = spark.createDataFrame(cases, "n long, v long")
    got = [r.p for r in df.select(partition_size("n", "v").alias("p")).collect()]
    assert got == [model_psize(n, v) for n, v in cases]


def test_consistency_states(spark):
    df = spark.createDataFrame([(0, None), (10, 4), (10, 10), (10, 0), (10, None)], "i long, p long")
    got = [r.s for r in df.select(consistency_state("i", "p").alias("s")).collect()]
    assert got == ["FAIL", "FAIL", "READY", "PARTITION", "PARTITION"]


def test_wait_seconds(spark):
    q = DAILY_QUOTA_BYTES
    df = spark.createDataFrame([(q, 0, 0), (q // 2, 0, 100), (0, 0, 0), (1, 5, 0), (q, 0, 90000)],
                               "b long, t long, e long")
    got = [r.w for r in df.select(request_wait_seconds("b", "t", "e").alias("w")).collect()]
    assert got == [86400, 43100, 0, 960, 0]


def test_override_dedup_and_apply(spark):
    ovr = spark.createDataFrame([("a", "  "), ("a", "x/y "), ("a", "b/c"), ("b", ""), ("b", None), ("c", None)],
                                "archiveid string, override string")
    d = {r.archiveid: r.override for r in inv_ops.dedup_overrides(ovr).collect()}
    assert d == {"a": "b/c", "b": "", "c": None}
    rows = spark.createDataFrame([("a", "orig", " keep spaces "), ("b", "orig", "  ")],
                                 "archiveid string, archivedescription string, override string")
    got = {r.archiveid: r.archivedescription for r in inv_ops.apply_override(rows).collect()}
    assert got == {"a": " keep spaces ", "b": "orig"}


def test_part_zero_is_one_short(spark):
    df = spark.createDataFrame([(f"a{i:03d}", "2020-01-01", 1, "h", "d") for i in range(40)],
                               "archiveid string, creationdate string, size long, sha256treehash string, archivedescription string")
    parted = inv_ops.partition_inventory(df)
    counts = {r.part: r.n for r in inv_ops.partition_stats(parted).collect()}
    psize = model_psize(40, 40)
    assert counts[0] == psize - 1 and sum(counts.values()) == 40


def test_written_table_prunes_on_part(spark):
    parted = inv_ops.partition_inventory(B.inventory(spark, SF_SMALL), B.overrides(spark, SF_SMALL))
    path = scratch_dir(spark, "test-parted")
    io.write_partitioned_inventory(parted, path)
    back = io.scan_partitioned_inventory(spark, path)
    one = inv_ops.read_partition(back, 1)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan and "= 1)" in plan
    want = parted.where(F.col("part") == 1).count()
    rows = one.collect()
    assert len(rows) == want and [r.row_num for r in rows] == sorted(r.row_num for r in rows)
    assert "BatchEvalPython" not in plan


def test_int_parse_and_iso(spark):
    from vaultlens.functions.sizing import int_parse, iso_timestamp
    df = spark.createDataFrame([("12",), ("x",), (None,)], "t string")
    assert [r.v for r in df.select(int_parse("t").alias("v")).collect()] == [12, None, None]
    r = spark.sql("select timestamp'2020-08-23 10:18:22' as ts").select(iso_timestamp("ts").alias("s")).first()
    assert r.s == "2020-08-23T10:18:22+00:00"


def test_written_table_has_a_folder_a_day(spark):
    """Files follow the days of the plan, not its parts, of which a large vault has hundreds of thousands; each
    part is whole in one of them, and a part without a number is kept."""
    row = lambda i, part: (f"a{i}", "d", "2020-01-01", 1, "h", i, part)
    rows = [row(i, i // 3) for i in range(300)] + [row(900, None)]
    path = scratch_dir(spark, "test-days")
    io.write_partitioned_inventory(spark.createDataFrame(rows, io.PARTITIONED_SCHEMA).repartition(5), path)
    back = io.scan_partitioned_inventory(spark, path)
    assert len(back.inputFiles()) == 8
    assert sorted(back.select(*io.PARTITIONED_SCHEMA.names).collect(), key=lambda r: r.row_num) == rows
    one = inv_ops.read_partition(back, 33)
    assert [r.row_num for r in one.collect()] == [99, 100, 101]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part_day" in plan and "= 2)" in plan


def test_hashes_packed_come_back(spark):
    digest = "0f" * 32
    rows = [(0, None), (1, digest), (2, digest.upper()), (3, digest + "\n"), (4, "h"), (5, ""), (6, digest[:-1])]
    df = spark.createDataFrame(rows, "i int, sha256treehash string")
    packed = inv_ops.packed(df)
    assert [len(r._vl_digest or b"") for r in packed.orderBy("i").collect()] == [0, 32, 0, 0, 0, 0, 0]
    assert sorted(tuple(r) for r in inv_ops.unpacked(packed).select("i", "sha256treehash").collect()) == rows


def test_staged_rows_are_written_in_order_without_a_shuffle(spark):
    inv, ovr = B.inventory(spark, SF_SMALL), B.overrides(spark, SF_SMALL)
    want = sorted(map(tuple, inv_ops.partition_inventory(inv, ovr).select(*io.PARTITIONED_SCHEMA.names).collect()))
    parted = inv_ops.partition_inventory(inv, ovr, stage=True, num_partitions=4)
    assert "hashpartitioning(part_day" not in parted._jdf.queryExecution().executedPlan().toString()
    path = scratch_dir(spark, "test-ordered")
    io.write_partitioned_inventory(parted, path, ordered=True)
    back = io.scan_partitioned_inventory(spark, path)
    assert sorted(map(tuple, back.select(*io.PARTITIONED_SCHEMA.names).collect())) == want
    one = [r.row_num for r in inv_ops.read_partition(back, 1).collect()]
    assert one == sorted(r[5] for r in want if r[6] == 1)
    days = back.select("part_day").distinct().count()
    assert days <= len(back.inputFiles()) <= days + 8   # a day more than once only where a range of numbers ends


def test_round_trip_keeps_one_copy_of_the_table(spark):
    """The staged and the numbered copy go as soon as the table is written."""
    import glob
    from vaultlens.plans.jobs import JOBS
    from vaultlens.session import ensure_checkpoint_dir
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    copies = lambda: set(glob.glob(f"{folder}/vaultlens-enriched-*") + glob.glob(f"{folder}/vaultlens-numbered-*"))
    before = copies()
    for name in ("partition_roundtrip", "consistency_check", "one_partition", "results_csv"):
        JOBS[name](spark, SF_SMALL).collect()
        assert copies() == before
