"""Real-input entry points: CSV inventory -> partitions -> requests -> tasks, hashes, points."""

import hashlib

from pyspark.sql import functions as F

from conftest import SF_SMALL
from vaultlens import cli
from vaultlens.operators import inventory as inv_ops
from vaultlens.plans import bindings as B
from vaultlens.session import scratch_dir
from vaultlens.sources import files as io
from vaultlens.plans import bindings
from test_treehash import model


def test_partition_requests_chunks(spark):
    inv_csv, ovr_csv = scratch_dir(spark, "t-inv"), scratch_dir(spark, "t-ovr")
    io.write_csv(B.inventory(spark, SF_SMALL), inv_csv, header=True)
    io.write_csv(B.overrides(spark, SF_SMALL), ovr_csv, header=False)
    parted_dir, req_dir, msg_dir = (scratch_dir(spark, n) for n in ("t-parted", "t-req", "t-msg"))
    stats = {r.part: (r.n, r.lo, r.hi) for r in cli.partition(spark, inv_csv, ovr_csv, parted_dir).collect()}
    want = inv_ops.partition_stats(inv_ops.partition_inventory(B.inventory(spark, SF_SMALL), B.overrides(spark, SF_SMALL)))
    assert stats == {r.part: (r.n, r.lo, r.hi) for r in want.collect()}
    req = cli.requests(spark, parted_dir, None, req_dir)
    assert req.count() == sum(v[0] for v in stats.values())
    assert req.select("fname").distinct().count() > 0
    # a second run with the first run's records requests nothing new
    assert cli.requests(spark, parted_dir, req_dir, scratch_dir(spark, "t-req2")).count() == 0
    cli.chunks(spark, req_dir, msg_dir)
    n_msgs = spark.read.text(msg_dir).count()
    assert n_msgs == req.select(F.greatest(F.when(F.col("cc") > 1, F.col("cc")), F.lit(1)).alias("k")).agg(F.sum("k")).first()[0]


def test_treehash_routes_staged_objects(spark):
    data = {"a": b"x" * 3000, "b": b"y" * 10, "c": b"z" * 2048}
    objs = spark.createDataFrame(list(data.items()), "aid string, bytes binary")
    base = scratch_dir(spark, "t-objs")
    bindings.stage_objects(objs, base).collect()
    status_dir = scratch_dir(spark, "t-status")
    sha = {"a": model(data["a"], 1024 * 1024), "b": "0" * 64, "c": "0" * 64}
    spark.createDataFrame([(k, sha[k], len(v), 0 if k == "b" else 3) for k, v in data.items()],
                          "aid string, sha string, sz long, rc int").write.parquet(status_dir)
    routed = cli.verify(spark, base, status_dir, scratch_dir(spark, "t-routed"))
    got = {r.aid: r.route for r in routed.collect()}
    assert got == {"a": "validated", "b": "retry", "c": "failed"}
    assert hashlib.sha256(data["b"]).hexdigest() == [r.tree_hash for r in routed.collect() if r.aid == "b"][0]


def test_check_pacing_and_release(spark):
    inv_csv, parted_dir = scratch_dir(spark, "t-inv"), scratch_dir(spark, "t-parted")
    io.write_csv(B.inventory(spark, SF_SMALL), inv_csv, header=True)
    assert cli.check(spark, inv_csv, None).first().state == "PARTITION"
    parts = cli.partition(spark, inv_csv, None, parted_dir).collect()
    assert cli.check(spark, inv_csv, parted_dir).first().state == "READY"

    elapsed, throttle = scratch_dir(spark, "t-elapsed"), scratch_dir(spark, "t-throttle")
    spark.createDataFrame([(p.part, 10 ** 6 if p.part == parts[0].part else 5) for p in parts], "part long, elapsed_s long").write.parquet(elapsed)
    spark.createDataFrame([(parts[0].part, 7, 1)], "part long, throttled_bytes long, errors int").write.parquet(throttle)
    cal = {r.part: r for r in cli.pacing(spark, parted_dir, throttle, elapsed, scratch_dir(spark, "t-cal")).collect()}
    assert len(cal) == len(parts) and cal[parts[0].part].wait_s == 960
    t = 0
    for p in sorted(cal):
        assert cal[p].start_s == t
        t += cal[p].elapsed_s + cal[p].wait_s

    base = scratch_dir(spark, "t-release")
    objs = spark.createDataFrame([("new name", b"x" * 9), ("done", b"y")], "aid string, bytes binary")
    bindings.stage_objects(objs, f"{base}/staging").collect()
    bindings.stage_objects(objs.where("aid = 'done'"), f"{base}/archive").collect()
    rows = [("1", "new name", 9, 1, "t"), ("2", "done", 1, 1, "t"), ("3", "lost", 4, 1, "t"), ("4", "early", 4, 1, None)]
    spark.createDataFrame(rows, "aid string, fname string, sz long, cc int, vdt string").write.parquet(f"{base}/status")
    lost = cli.release(spark, f"{base}/status", f"{base}/staging", f"{base}/archive", f"{base}/out")
    assert [tuple(r) for r in lost.collect()] == [("3", "lost")]
    msgs = [r.value for r in io.read_messages(spark, f"{base}/out").collect()]
    assert len(msgs) == 1 and '"aid":"1"' in msgs[0] and "new%20name" in msgs[0]
