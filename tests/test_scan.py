"""Prefix scans over blocks against sequential folds."""

import random

import pytest
from pyspark.sql import functions as F

from vaultlens.operators import inventory, progress
from vaultlens.operators.scan import maxplus_scan


@pytest.mark.parametrize("block", [3, 7, 4096])
def test_maxplus_scan_equals_the_fold(spark, block):
    rng = random.Random(block)
    rows = [(p, rng.randrange(-20, 40), rng.choice([None, None, rng.randrange(0, 900)])) for p in rng.sample(range(400), 150)]
    want, t = {}, 5
    for p, a, d in sorted(rows):
        want[p] = t
        t = t + a if d is None else max(t + a, d)
    df = spark.createDataFrame(rows, "p long, a long, d long").repartition(5)
    out = maxplus_scan(df, "p", F.col("a"), F.col("d"), "t", start=5, block=block)
    assert out.columns == ["p", "a", "d", "t"]
    assert {r.p: r.t for r in out.collect()} == want


def fold(parts, quota):
    """The request loop, one partition after another, with one throttling counter."""
    t, counter, out, arrivals = 0, 0, {}, {}
    for p in sorted(parts):
        size, elapsed, ready, hits = parts[p]
        for late, b in hits:
            arrivals.setdefault(p + late, []).append(b)
        counter += sum(arrivals.get(p, []))
        t = max(t, ready or 0)
        wait = max(0, int(86400 * (size + counter) / quota + 0.5) - elapsed)
        wait = 960 if counter > 0 and wait == 0 else wait
        out[p] = (counter, wait, t)
        counter = 0
        t += elapsed + wait
    return out


@pytest.mark.parametrize("ready", [False, True])
def test_request_calendar_equals_the_loop(spark, ready):
    rng = random.Random(4)
    parts = {p: (rng.randrange(1, 10 ** 6), rng.choice([0, 500, 90000, 200000]), rng.randrange(0, 3 * 10 ** 6) if ready and p % 3 == 0 else None,
                 [(rng.randrange(3), rng.randrange(1, 10 ** 5)) for _ in range(rng.choice([0, 0, 1, 3]))]) for p in range(1, 31)}
    inv = spark.createDataFrame([(p, v[0]) for p, v in parts.items()], "part long, size long")
    thr = spark.createDataFrame([(p + late, b, 1) for p, v in parts.items() for late, b in v[3]], "part long, throttled_bytes long, errors int")
    el = spark.createDataFrame([(p, v[1], v[2]) for p, v in parts.items()], "part long, elapsed_s long, ready_s long")
    cal = inventory.request_calendar(inv, thr, quota=10 ** 6, elapsed=el if ready else el.drop("ready_s"), block=4)
    got = {r.part: (r.throttled_bytes, r.wait_s, r.start_s) for r in cal.collect()}
    assert got == fold(parts, 10 ** 6)
    assert any(v[1] == 960 for v in got.values()) and any(v[1] == 0 for v in got.values())
    assert "Window" not in cal._jdf.queryExecution().optimizedPlan().toString()     # scanned in blocks, then written


def test_one_queue_spreads_over_its_days(spark):
    """Without a block a queue's periods would be one window task."""
    rng = random.Random(3)
    rows = [("q", s, rng.choice([None, s + rng.randrange(1, 3 * 10 ** 9)])) for s in (rng.randrange(0, 20 * 86400 * 10 ** 6) for _ in range(300))]
    df = spark.createDataFrame(rows, "queue string, sent_us long, done_us long")
    report = max(max(s, d or s) for _, s, d in rows)
    p = 3600 * 10 ** 6
    want = {}
    for _, s, d in rows:
        for k in range(-(-s // p), -(-(report if d is None else d) // p)):
            want[k * p] = max(want.get(k * p, 0), k * p - s)
    got = progress.oldest_message_age(df, 3600)
    assert {r.at_us: r.age_us for r in got.collect()} == want
    blocks = df.select(F.floor((F.ceil(F.coalesce("done_us", F.lit(report)) / p) - 1) / 24).alias("b")).distinct().count()
    assert blocks >= 15
