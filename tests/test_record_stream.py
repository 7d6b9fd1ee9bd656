"""The source admitted by records: batch sizes, ranges, restarts, waiting."""

import datetime as dt
import time

from pyspark.sql import functions as F

from vaultlens.session import scratch_dir
from vaultlens.sources.record_stream import RecordReader, record_stream
from vaultlens.streaming import streams


def test_batches_of_1000_records_and_restart(spark):
    src, sink, ck = (scratch_dir(spark, n) for n in ("test-src", "test-sink", "test-ck"))
    rows = spark.range(10500).select("id", F.timestamp_seconds("id").alias("ts"), F.struct(F.timestamp_seconds("id").alias("t"), F.lit(None).cast("string").alias("s")).alias("old"))
    rows.repartition(3).write.parquet(src)

    def run():
        source = record_stream(spark, src, rows.schema, f"{ck}-progress", window_s=0)
        streams.admitted_batches(source, sink, ck, ["id", "ts", "old"])
        got = spark.read.parquet(sink)
        sizes = {r.batch_id: r["count"] for r in got.groupBy("batch_id").count().collect()}
        return [sizes[b] for b in sorted(sizes)], got

    sizes, got = run()
    assert sizes == [1000] * 10 + [500]
    assert got.select("id").distinct().count() == 10500
    assert got.where((F.unix_seconds("ts") != F.col("id")) | (F.col("old.t") != F.col("ts"))).isEmpty()
    spark.range(20000, 21700).select("id", F.timestamp_seconds("id").alias("ts"), F.struct(F.timestamp_seconds("id").alias("t"), F.lit("x").alias("s")).alias("old")) \
        .coalesce(1).write.mode("append").parquet(src)
    sizes, got = run()
    assert sizes == [1000] * 10 + [500, 1000, 700]
    assert got.select("id").distinct().count() == 12200 and got.count() == 12200
    assert got.agg(F.max("ts")).first()[0] == dt.datetime.fromtimestamp(21699, dt.timezone.utc).replace(tzinfo=None) \
        or got.agg(F.unix_seconds(F.max("ts"))).first()[0] == 21699


def test_a_small_batch_waits_for_its_window(spark, tmp_path):
    rows = spark.range(2100)
    src = f"{tmp_path}/src"
    rows.repartition(4).write.parquet(src)
    reader = RecordReader(rows.schema, {"path": src, "progress": f"{tmp_path}/p", "window_s": "0.4"})
    at = reader.initialOffset()
    seen = []
    for _ in range(2):
        end = reader.latestOffset()
        parts = reader.partitions(at, end)
        assert all(p.last - p.first <= 500 for p in parts) and sum(p.last - p.first for p in parts) == 1000
        seen += [v for p in parts for b in reader.read(p) for v in b.column(0).to_pylist()]
        at = end
    assert reader.latestOffset() == {"position": 2000}      # 100 records wait
    time.sleep(0.5)
    assert reader.latestOffset() == {"position": 2100}
    # A new reader of the same stream goes on where the last planned batch ended; the batch can be read again.
    again = RecordReader(rows.schema, {"path": src, "progress": f"{tmp_path}/p", "window_s": "0"})
    assert again.latestOffset() == {"position": 2100}
    parts = again.partitions({"position": 1000}, {"position": 2000}) + again.partitions({"position": 2000}, {"position": 2100})
    assert sorted(seen[:1000] + [v for p in parts for b in again.read(p) for v in b.column(0).to_pylist()]) == list(range(2100))


def test_waiting_batches_are_taken_at_once_and_kept_apart(spark):
    src, sink, ck = (scratch_dir(spark, n) for n in ("test-src", "test-sink", "test-ck"))
    rows = spark.range(10500)
    rows.repartition(3).write.parquet(src)

    def run():
        source = record_stream(spark, src, rows.schema, f"{ck}-progress", window_s=0, at_once=4)
        streams.admitted_batches(source, sink, ck, ["id", "admitted"])
        got = spark.read.parquet(sink)
        return got, [(r.batch_id, r.admitted, r["count"]) for r in got.groupBy("batch_id", "admitted").count().orderBy("batch_id", "admitted").collect()]

    sizes = [(b, a, 1000) for b, n in enumerate((4, 4, 2)) for a in range(n)] + [(3, 0, 500)]
    assert run()[1] == sizes
    spark.range(20000, 21700).coalesce(1).write.mode("append").parquet(src)
    got, seen = run()
    assert seen == sizes + [(4, 0, 1000), (5, 0, 700)]
    assert got.select("id").distinct().count() == 12200 and got.count() == 12200
