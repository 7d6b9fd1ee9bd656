"""Chunk bookkeeping against a sequential model; random range sizes against the loop model."""

import random

from pyspark.sql import functions as F

from vaultlens.constants import CHUNK_SIZE
from vaultlens.operators import lifecycle, ranges
from vaultlens.functions.sizing import chunk_count
from test_ranges import ceil_div, loop_model


def model(deliveries, counts):
    """Apply deliveries in sequence order; a later delivery of a part overwrites it."""
    latest = {}
    for aid, phase, part, value, seq in sorted(deliveries, key=lambda d: d[4]):
        latest[(aid, phase, part)] = value
    out = {}
    for (aid, phase, part), value in latest.items():
        out.setdefault((aid, phase), {})[part] = value
    res = {}
    for (aid, phase), parts in out.items():
        if aid not in counts:
            continue
        cc = counts[aid]
        res[(aid, phase)] = (len(parts) >= cc, ",".join(f"{p}:{parts[p]}" for p in sorted(parts)),
                             ", ".join(f"chunk{i}" for i in range(1, max(cc, 1) + 1)))
    return res


def test_chunk_completion_matches_model(spark):
    rnd = random.Random(11)
    counts = {f"a{i}": rnd.randint(1, 6) for i in range(30)}
    deliveries = []
    seq = 0
    for aid, cc in counts.items():
        for phase in ("copied", "hashed"):
            for part in range(1, cc + 1):
                for _ in range(rnd.choice([0, 1, 1, 2, 3])):   # missing, once, or redelivered
                    seq += 1
                    deliveries.append((aid, phase, part, f"v{rnd.randint(0, 99)}", rnd.randint(0, 10**6) * 1000 + seq))
    deliveries.append(("unknown", "copied", 1, "x", 1))
    df = spark.createDataFrame(deliveries, "aid string, phase string, part_no int, value string, seq long")
    cdf = spark.createDataFrame(list(counts.items()), "aid string, cc int")
    got = lifecycle.chunk_completion(lifecycle.latest_chunk_values(df, "seq"), cdf).collect()
    assert {(r.aid, r.phase): (r.complete, r.parts, r.chunk_list) for r in got} == model(deliveries, counts)
    r = [x for x in got if x.complete][0]
    assert len(r.part_map) == r.n_parts


def test_random_sizes_against_loop(spark):
    rnd = random.Random(5)
    sizes = [rnd.randint(0, 6 * CHUNK_SIZE) for _ in range(300)] + [k * CHUNK_SIZE + d for k in range(4) for d in (-1, 0, 1) if k * CHUNK_SIZE + d >= 0]
    df = spark.createDataFrame([(f"s{i}", s) for i, s in enumerate(sizes)], "aid string, sz long") \
              .withColumn("cc", chunk_count("sz").cast("int"))
    rows = {}
    for r in ranges.plan_hash_chunks(df).collect():
        rows.setdefault(r.aid, []).append((r.part_no, r.start_byte, r.end_byte))
    for i, s in enumerate(sizes):
        assert sorted(rows[f"s{i}"]) == loop_model(ceil_div(s, CHUNK_SIZE), s, CHUNK_SIZE)


def test_hot_archive_chunks(spark):
    # one archive gets a third of all deliveries (many redeliveries of its parts)
    rows = [("hot", "copied", 1 + i % 5, f"v{i}", i) for i in range(300)]
    rows += [(f"a{i}", "copied", 1, "x", 1000 + i) for i in range(600)]
    df = spark.createDataFrame(rows, "aid string, phase string, part_no int, value string, seq long")
    counts = spark.createDataFrame([("hot", 5)] + [(f"a{i}", 1) for i in range(600)], "aid string, cc int")
    out = lifecycle.chunk_completion(lifecycle.latest_chunk_values(df, "seq"), counts)
    hot = out.where(F.col("aid") == "hot").first()
    assert hot.complete and hot.n_parts == 5
    assert hot.parts == ",".join(f"{p}:v{295 + p - 1}" for p in range(1, 6))
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


def test_raw_chunk_attributes(spark):
    etag = '"' + "a" * 32 + '"'
    h = "b" * 64
    df = spark.createDataFrame([("x", {"chunk1": etag, "chunk2": h, "cc": "2", "fname": "f"})],
                               "aid string, attrs map<string,string>")
    got = sorted((r.part_no, r.kind) for r in lifecycle.chunk_rows_from_record(df).collect())
    assert got == [(1, "etag"), (2, "hashed")]


def test_written_null_clears_a_field(spark):
    log = spark.createDataFrame([("a", 1, "t1", "x", ["sgt", "psdt"]), ("a", 2, None, None, ["sgt"]), ("b", 1, "t2", None, ["sgt"])],
                                "aid string, seq int, sgt string, psdt string, written array<string>")
    got = {r.aid: (r.sgt, r.psdt) for r in lifecycle.latest_state(log, "aid", "seq", ["sgt", "psdt"], "written").collect()}
    assert got == {"a": (None, "x"), "b": ("t2", None)}
    img = {r.aid: (r.sgt, r.psdt) for r in lifecycle.latest_image(log, "aid", "seq", ["sgt", "psdt"]).collect()}
    assert img == {"a": (None, None), "b": ("t2", None)}
