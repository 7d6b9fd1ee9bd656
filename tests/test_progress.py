"""Counters, metric points, log filter and queue age on small hand-made inputs."""

from vaultlens.operators import progress

CHANGE_SCHEMA = ("event_name string, old struct<cdt:string,sgt:string,vdt:string,cpt:string,sz:long>, "
                 "new struct<cdt:string,sgt:string,vdt:string,cpt:string,sz:long>")


def test_stage_counts_transitions(spark):
    rows = [
        ("INSERT", None, ("t", None, None, None, 10)),
        ("MODIFY", ("t", None, None, None, 10), ("t", "t", None, None, 10)),
        ("MODIFY", ("t", "t", None, None, 10), ("t", "t", None, None, 10)),   # no new stage
        ("REMOVE", ("t", "t", None, None, 10), ("t", "t", "t", "t", 10)),     # ignored
        ("MODIFY", (None, None, None, None, 7), ("t", "t", "t", "t", 7)),
    ]
    df = spark.createDataFrame(rows, CHANGE_SCHEMA)
    got = {r.stage: (r.n, r.bytes) for r in progress.stage_rows(progress.stage_counts(df)).collect()}
    assert got == {"requested": (2, 17), "staged": (2, 17), "validated": (1, 7), "copied": (1, 7)}


def _points(spark, counters):
    df = spark.createDataFrame(counters, "pk string, counter string, value long")
    return {r.metric: r.value for r in progress.progress_points(df).collect()}


def test_points_defaults_and_caps(spark):
    got = _points(spark, [("count", "requested", 5), ("count", "total", 3), ("volume", "staged", 100)])
    # a count total exists but no byte total: bytes are not capped
    assert got["ArchiveCountRequested"] == 3 and got["BytesStaged"] == 100
    assert got["ArchiveCountTotal"] == 3 and got["BytesTotal"] is None
    assert got["ArchiveCountCompleted"] == 0
    assert "ThrottledBytes" not in got and "FailedArchivesBytes" not in got
    got = _points(spark, [("throttling", "throttledBytes", 9), ("throttling", "errorCount", 2)])
    assert got["ThrottledBytes"] == 9 and got["ThrottledErrorCount"] == 2 and len(got) == 10


def test_counter_adds_and_get(spark):
    d = spark.createDataFrame([("count", "staged", 2), ("count", "staged", -1), ("volume", "staged", 5)],
                              "pk string, counter string, value long")
    t = progress.counter_totals(d)
    row = progress.counter_get(t, "count").collect()
    assert len(row) == 1 and row[0]["staged"] == 1
    assert progress.counter_get(t, "missing").count() == 0


def test_error_log_spellings(spark):
    msgs = ["an error here", "Error: x", "ERROR y", "eRRor z", "error ThrottlingException",
            "Error Idle connections will be closed", "fine"]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(msgs)], "ts long, message string")
    got = [r.message for r in progress.error_log(df).collect()]
    assert got == ["ERROR y", "Error: x", "an error here"]


def test_oldest_message_age(spark):
    p = 300_000_000
    df = spark.createDataFrame([("q", 10, 2 * p + 5), ("q", p + 1, p + 2), ("q", 100, 110)],
                               "queue string, sent_us long, done_us long")
    got = sorted((r.at_us, r.age_us) for r in progress.oldest_message_age(df).collect())
    assert got == [(p, p - 10), (2 * p, 2 * p - 10)]


def test_oldest_message_age_against_model(spark):
    import random
    rnd, p = random.Random(7), 100_000_000
    rows = [(rnd.choice("ab"), s := rnd.randint(0, 40 * p), rnd.choice([None, s + rnd.randint(0, 9 * p)])
             if rnd.random() < 0.1 else s + rnd.randint(0, 3 * p)) for _ in range(300)]
    report = max(max(s, d or s) for _, s, d in rows)
    want = {}
    for q, s, d in rows:
        for k in range(-(-s // p), -(-(d or report) // p)):
            want[q, k * p] = max(want.get((q, k * p), 0), k * p - s)
    df = spark.createDataFrame(rows, "queue string, sent_us long, done_us long")
    got = {(r.queue, r.at_us): r.age_us for r in progress.oldest_message_age(df, 100).collect()}
    assert got == want


def test_throttle_is_drained(spark):
    t = spark.createDataFrame([(0, 5, 1), (0, 7, 1), (1, 11, 1)], "part int, throttled_bytes long, errors int")
    both = progress.throttle_deltas(t).unionByName(progress.throttle_deltas(t.where("part = 0"), drain=True))
    assert {r.counter: r.value for r in progress.counter_totals(both).collect()} == {"throttledBytes": 11, "errorCount": 1}
