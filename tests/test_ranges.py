"""Range planners against a model of the migrated loops, at boundary sizes."""

from vaultlens.constants import CHUNK_SIZE, GIB, INVENTORY_PART_SIZE, OVERRIDE_PART_SIZE
from vaultlens.functions.sizing import chunk_count
from vaultlens.operators import ranges


def loop_model(cc, size, unit):
    """parts 1..cc-1 are full units, the last one ends at size-1 (at least one part)."""
    out, i = [], 1
    while i < cc:
        out.append((i, (i - 1) * unit, (i - 1) * unit + unit - 1))
        i += 1
    out.append((i, (i - 1) * unit, size - 1))
    return out


def ceil_div(a, b):
    return -(-a // b)


def sizes(c):
    return [0, 1, c - 1, c, c + 1, 2 * c - 1, 2 * c, 2 * c + 1]


def collect(df):
    rows = {}
    for r in df.collect():
        rows.setdefault(r.aid, []).append((r.part_no, r.start_byte, r.end_byte))
    return {k: sorted(v, key=lambda t: (t[0] is None, t)) for k, v in rows.items()}


def test_copy_and_hash_plans(spark):
    rows = [(f"s{s}", s) for s in sizes(CHUNK_SIZE)]
    df = spark.createDataFrame(rows, "aid string, sz long").withColumn("cc", chunk_count("sz").cast("int"))
    copy = collect(ranges.plan_copy_chunks(df))
    hashes = collect(ranges.plan_hash_chunks(df))
    for aid, s in rows:
        cc = ceil_div(s, CHUNK_SIZE)
        assert hashes[aid] == loop_model(cc, s, CHUNK_SIZE)
        assert copy[aid] == ([(None, None, None)] if cc <= 1 else loop_model(cc, s, CHUNK_SIZE))


def test_inconsistent_count_fixture(spark):
    df = spark.createDataFrame([("a", 50, 10)], "aid string, sz long, cc int")
    got = collect(ranges.plan_copy_chunks(df))["a"]
    assert len(got) == 10 and got[-1] == (10, 38654705664, 49)
    assert all(e - s + 1 == CHUNK_SIZE for _, s, e in got[:-1])


def test_download_part_rules(spark):
    for unit, plan, single in [(INVENTORY_PART_SIZE, ranges.plan_inventory_parts, lambda s, u: s <= u),
                               (OVERRIDE_PART_SIZE, ranges.plan_override_parts, lambda s, u: s < u)]:
        rows = [(f"s{s}", s) for s in sizes(unit)]
        df = spark.createDataFrame(rows, "aid string, size long")
        got = collect(plan(df))
        for aid, s in rows:
            want = [(None, None, None)] if single(s, unit) else loop_model(ceil_div(s, unit), s, unit)
            assert got[aid] == want, (unit, s)


def test_chunk_count_zero_and_exact(spark):
    df = spark.createDataFrame([(0,), (1,), (4 * GIB,), (4 * GIB + 1,)], "s long")
    assert [r.c for r in df.select(chunk_count("s").alias("c")).collect()] == [0, 1, 1, 2]


def test_release_needs_validation(spark):
    st = spark.createDataFrame([("a", "f1", 5, 1, "t"), ("b", "f2", 5, 1, None), ("c", "f3", 5, 1, "t")],
                               "aid string, fname string, sz long, cc int, vdt string")
    dest = spark.createDataFrame([("f3",), ("f1.bak",)], "key string")
    assert [r.aid for r in ranges.plan_release_chunks(st, dest).collect()] == ["a"]


def test_sizes_below_zero_are_not_planned(spark):
    df = spark.createDataFrame([("a", -5), ("b", None), ("c", 0), ("d", 7)], "aid string, sz long")
    got = [(r.aid, r.start_byte, r.end_byte) for r in ranges.plan_ranges(df, "sz", 4).orderBy("aid", "part_no").collect()]
    assert got == [("c", 0, -1), ("d", 0, 3), ("d", 4, 6)]
