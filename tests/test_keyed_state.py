"""Keyed state: per-field records, Merkle forests and part bitmaps, on small hand-made deliveries."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultlens.session import scratch_dir
from vaultlens.sources.batches import batch_ids
from vaultlens.streaming import streams
from vaultlens.streaming.keyed_state import _covered, _join

FIELDS = T.StructType([T.StructField("cdt", T.StringType()), T.StructField("sgt", T.StringType()), T.StructField("sz", T.LongType())])
UPDATE = "aid string, seq array<long>, written array<string>, removed boolean, cdt string, sgt string, sz long"


def model(rows):
    out = {}
    for aid in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == aid]
        gone = max((r[1] for r in mine if r[3]), default=[])
        writes = sorted((r for r in mine if not r[3] and r[1] > gone), key=lambda r: r[1])
        rec = {}
        for r in writes:
            rec.update({f: r[4 + FIELDS.names.index(f)] for f in r[2]})
        if rec:
            out[aid] = tuple(rec.get(f) for f in FIELDS.names)
    return out


def test_field_updates_in_any_order_equal_the_log(spark):
    rng = random.Random(2)
    rows = []
    for i in range(120):
        fields = rng.sample(FIELDS.names, rng.choice([1, 1, 2]))
        value = {f: rng.choice([None, i if f == "sz" else f"v{i}"]) for f in fields}
        rows.append((f"a{rng.randrange(12)}", [i // 3, i], fields, rng.random() < 0.08, *[value.get(f) for f in FIELDS.names]))
    src, sink, ck = (scratch_dir(spark, n) for n in ("test-updates", "test-records", "test-ck"))

    def deliver(part):
        part = list(part)
        rng.shuffle(part)
        spark.createDataFrame(part, UPDATE).repartition(3).write.mode("append").parquet(src)
        source = spark.readStream.schema(UPDATE).option("maxFilesPerTrigger", 1).parquet(src)
        streams.field_upsert_stream(source, FIELDS, sink, ck)

    def state():
        st = spark.read.format("statestore").option("stateVarName", "record").load(ck)
        return sorted(map(str, st.select("key", "value").collect()))

    def records():
        return {r.aid: (r.cdt, r.sgt, r.sz) for r in streams.read_records(spark, sink, FIELDS).collect()}

    deliver(rows[40:])
    deliver(rows[:80])
    assert records() == model(rows)
    before, log = state(), spark.read.parquet(f"{sink}/log").count()
    deliver(rows)
    assert state() == before and spark.read.parquet(f"{sink}/log").count() == log   # redeliveries change nothing
    streams.compact_records(spark, sink, ck, FIELDS)
    assert records() == model(rows)
    assert streams.read_sink(spark, f"{sink}/log", T._parse_datatype_string("aid string")).count() == 0
    more = [("a1", [999, 1], ["sz"], False, None, None, 7), ("a2", [999, 2], [], True, None, None, None)]
    deliver(more)
    assert records() == model(rows + more)
    streams.compact_records(spark, sink, ck, FIELDS)
    assert records() == model(rows + more)
    assert len(batch_ids(spark, f"{sink}/snapshot")) == 1


def tree(digests):
    level = list(digests)
    while len(level) > 1:
        level = [hashlib.sha256(bytes.fromhex("".join(level[i:i + 2]))).hexdigest() if i + 1 < len(level) else level[i]
                 for i in range(0, len(level), 2)]
    return level[0]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 13, 100])
def test_forest_gives_the_tree_hash_in_any_order(n):
    digests = [hashlib.sha256(bytes([i])).hexdigest() for i in range(n)]
    for seed in range(3):
        order = list(range(n))
        random.Random(seed).shuffle(order)
        order = order if seed else list(range(n))
        nodes, roots, most = {}, [], 0
        for p in order:
            assert not _covered(nodes, p, n)
            roots.append(_join(nodes, p, digests[p], n))
            most = max(most, len(nodes))
            assert roots[-1] or _covered(nodes, p, n)
        assert roots[:-1] == [None] * (n - 1) and roots[-1] == tree(digests) and not nodes
        if seed == 0:
            assert most <= max(n.bit_length(), 1)     # in order: one subtree a level


def test_an_attempt_completes_once(spark):
    digests = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(5)]
    schema = "aid string, part_no int, digest string, rc int"
    src, ck = scratch_dir(spark, "test-digests"), scratch_dir(spark, "test-ck")
    sinks = {r: scratch_dir(spark, f"test-{r}") for r in ("validated", "retry", "failed")}

    def run(rows, rc):
        status = spark.createDataFrame([("a", 9, rc, tree(digests), 5), ("one", 1, rc, digests[0], 1)],
                                       "aid string, sz long, rc int, sha string, cc int")
        spark.createDataFrame(rows, schema).repartition(2).write.mode("append").parquet(src)
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        streams.hash_validation_stream(source, status, sinks, ck)
        out = T._parse_datatype_string("aid string, rc int")
        return {r: sorted((x.aid, x.rc) for x in streams.read_sink(spark, p, out).collect()) for r, p in sinks.items()}

    bad = [("a", i + 1, digests[(i + 1) % 5], 0) for i in (4, 2, 0, 1, 3)]
    good = [("a", i + 1, digests[i], 1) for i in (3, 0, 4, 2, 1)]
    one = [("one", 1, digests[0], 0)]
    assert run(bad + bad[:2] + one, 0) == {"validated": [("one", 0)], "retry": [("a", 0)], "failed": []}
    assert run(bad + one, 0) == {"validated": [("one", 0)], "retry": [("a", 0)], "failed": []}       # whole again
    assert run(good[:3] + bad, 1)["validated"] == [("one", 0)]                                       # old digests with the new
    assert run(good[3:], 1) == {"validated": [("a", 1), ("one", 0)], "retry": [("a", 0)], "failed": []}
    assert run(good + bad, 1) == {"validated": [("a", 1), ("one", 0)], "retry": [("a", 0)], "failed": []}
    st = spark.read.format("statestore").option("stateVarName", "forest").load(ck)
    assert {(r.key.aid, r.value.rc, r.value.done, len(r.value.digests)) for r in st.collect()} == {("a", 1, True, 0), ("one", 0, True, 0)}


def test_bitmaps_shrink_to_marks_and_go(spark):
    schema = "aid string, phase string, part_no int, hour int"
    src, sink, ck = (scratch_dir(spark, n) for n in ("test-parts", "test-sink", "test-ck"))
    counts = spark.createDataFrame([("a", 3), ("b", 300), ("c", 2)], "aid string, cc int")

    def run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        streams.chunk_completion_stream(source, counts, sink, ck, arrival=F.timestamp_seconds(F.col("hour") * 3600), keep_hours=5)
        st = spark.read.format("statestore").option("stateVarName", "parts").load(ck)
        return {r.key.aid: (r.value.n, r.value.done, len(r.value.bits)) for r in st.collect()}

    assert run([("a", "copied", p, 1) for p in (3, 1, 1)] + [("b", "copied", p, 1) for p in range(1, 300)]) \
        == {"a": (2, False, 1), "b": (299, False, 38)}
    assert run([("a", "copied", 2, 2), ("a", "copied", 9, 2), ("c", "copied", 7, 2), ("c", "copied", 8, 2)]) \
        == {"a": (4, True, 0), "b": (299, False, 38), "c": (2, True, 0)}     # parts beyond the count count, as in the batch
    assert run([("a", "copied", 2, 4)])["a"] == (4, True, 0)                 # a redelivery keeps the mark
    assert set(run([("b", "copied", 1, 9)])) == {"a", "b"}                   # event time 8: c's mark went at 7
    assert set(run([("b", "copied", 2, 12)])) == {"b"}
    assert sorted((r.aid, r.cc) for r in spark.read.parquet(sink).collect()) == [("a", 3), ("c", 2)]


def test_keyed_state_runs_in_a_session_with_the_default_state_store(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    hdfs = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    plain = spark.newSession()
    plain.conf.set(key, hdfs)
    rows = [("a", [1, 1], ["cdt"], False, "x", None, None), ("a", [2, 2], ["sz"], False, None, None, 7)]
    src, sink, ck = (scratch_dir(plain, n) for n in ("test-updates", "test-records", "test-ck"))
    plain.createDataFrame(rows, UPDATE).write.parquet(src)
    streams.field_upsert_stream(plain.readStream.schema(UPDATE).parquet(src), FIELDS, sink, ck)
    assert plain.conf.get(key) == hdfs
    assert [tuple(r) for r in streams.read_records(plain, sink, FIELDS).collect()] == [("a", "x", None, 7)]
    streams.compact_records(plain, sink, ck, FIELDS)
    assert [tuple(r) for r in streams.read_records(plain, sink, FIELDS).collect()] == [("a", "x", None, 7)]


def test_bitmaps_of_a_group_shrink_to_marks_and_go(spark):
    """The deliveries of the bitmaps by key, with two values for all keys."""
    schema = "aid string, phase string, part_no int, hour int"
    src, sink, ck = (scratch_dir(spark, n) for n in ("test-parts", "test-sink", "test-ck"))
    counts = spark.createDataFrame([("a", 3), ("b", 300), ("c", 2)], "aid string, cc int")

    def run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        streams.chunk_completion_stream(source, counts, sink, ck, arrival=F.timestamp_seconds(F.col("hour") * 3600), keep_hours=5, groups=2)
        st = spark.read.format("statestore").option("stateVarName", "groups").load(ck).collect()
        assert len(st) <= 2
        return {aid: (n, done, len(bits)) for r in st for aid, n, done, bits in zip(r.value.aid, r.value.n, r.value.done, r.value.bits)}

    assert run([("a", "copied", p, 1) for p in (3, 1, 1)] + [("b", "copied", p, 1) for p in range(1, 300)]) \
        == {"a": (2, False, 1), "b": (299, False, 38)}
    assert run([("a", "copied", 2, 2), ("a", "copied", 9, 2), ("c", "copied", 7, 2), ("c", "copied", 8, 2)]) \
        == {"a": (4, True, 0), "b": (299, False, 38), "c": (2, True, 0)}
    assert run([("a", "copied", 2, 4)])["a"] == (4, True, 0)
    assert set(run([("b", "copied", 1, 9)])) == {"a", "b"}                   # event time 8: c's mark went at 7
    assert set(run([("b", "copied", 2, 12)])) == {"b"}                       # a's, delivered again at 4, went at 9
    run([("b", "copied", 300, 13)])
    assert sorted((r.aid, r.cc) for r in spark.read.parquet(sink).collect()) == [("a", 3), ("b", 300), ("c", 2)]


def test_field_updates_of_groups_equal_the_log(spark):
    """As by key, with three values for all keys; texts, large numbers and cleared fields come back exactly."""
    rng = random.Random(5)
    rows = []
    for i in range(120):
        fields = rng.sample(FIELDS.names, rng.choice([1, 1, 2]))
        value = {f: rng.choice([None, 2 ** 62 + i if f == "sz" else f'v"{i}" ü']) for f in fields}
        rows.append((f"a{rng.randrange(12)}", [i // 3 - 20, i], fields, rng.random() < 0.08, *[value.get(f) for f in FIELDS.names]))
    src, sink, ck = (scratch_dir(spark, n) for n in ("test-updates", "test-records", "test-ck"))

    def deliver(part):
        part = list(part)
        rng.shuffle(part)
        spark.createDataFrame(part, UPDATE).repartition(3).write.mode("append").parquet(src)
        source = spark.readStream.schema(UPDATE).option("maxFilesPerTrigger", 1).parquet(src)
        streams.field_upsert_stream(source, FIELDS, sink, ck, groups=3)

    def records():
        return {r.aid: (r.cdt, r.sgt, r.sz) for r in streams.read_records(spark, sink, FIELDS).collect()}

    deliver(rows[40:])
    deliver(rows[:80])
    assert records() == model(rows)
    assert spark.read.format("statestore").option("stateVarName", "record").load(ck).count() <= 3
    log = spark.read.parquet(f"{sink}/log").count()
    deliver(rows)
    assert spark.read.parquet(f"{sink}/log").count() == log   # redeliveries change nothing
    streams.compact_records(spark, sink, ck, FIELDS)
    assert records() == model(rows)
    more = [("a1", [999, 1], ["sz"], False, None, None, 7), ("a2", [999, 2], [], True, None, None, None)]
    deliver(more)
    assert records() == model(rows + more)
    streams.compact_records(spark, sink, ck, FIELDS)
    assert records() == model(rows + more)


def test_fields_of_all_types_come_back_from_text(spark):
    t = T._parse_datatype_string("ts timestamp, b binary, a array<int>, d double, m decimal(20,3), n timestamp_ntz")
    df = spark.sql("select timestamp'1500-01-02 03:04:05.000007' ts, X'00ff' b, array(1, null) a, 0.1D + 0.2D d, "
                   "cast(-12345678901234567.125 as decimal(20,3)) m, timestamp_ntz'2300-01-01 00:00:00.000001' n").to(t)
    back = df.select(*[streams._from_text(f, streams._as_text(f)) for f in t.fields])
    assert back.schema.simpleString() == t.simpleString() and df.exceptAll(back).count() == 0
    none = df.select(*[F.when(F.lit(False), F.col(f.name)).alias(f.name) for f in t.fields])
    assert not any(v is not None and f != "a" for f, v in none.select(*[streams._from_text(f, streams._as_text(f)) for f in t.fields]).first().asDict().items())
