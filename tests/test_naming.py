"""Description parsing: golden rows, malformed inputs, and the collision fixpoint."""

import random

from pyspark.sql import functions as F

from vaultlens.functions.text import normalise_name, parse_description
from vaultlens.operators.naming import unique_names

# --- fixed values: golden inputs and outputs of the migrated parser's tests
GOLDEN_PARSE = [
    ('"<ArchiveMetadata>           <Path>       UkVOREVSRkFSTTUvQjovb25lL3R3by90aHJlZS9jaDAxX3NlcTAwNF9zaDAwMTAuMjA0NC5kcHg=   </Path></ArchiveMetadata>"',
     "RENDERFARM5/B:/one/two/three/ch01_seq004_sh0010.2044.dpx"),
    ("<ArchiveMetadata>           <Path>       UkVOREVSRkFSTTUvQjovb25lL3R3by90aHJlZS9jaDAxX3NlcTAwNF9zaDAwMTAuMjA0NC5kcHg=   </Path></ArchiveMetadata>",
     "RENDERFARM5/B:/one/two/three/ch01_seq004_sh0010.2044.dpx"),
    ('"       <m><v>4</v><p>RlgxNTAvQ0JCX2ZpZ3VyZS9lZTRjM2MxOS00OTBkLTQwN2UtOGJlNy04ODliZTQxYjQ4YmIuY2Ji </p><lm>20190121T085242Z       </lm>        </m>"',
     "FX150/CBB_figure/ee4c3c19-490d-407e-8be7-889be41b48bb.cbb"),
    ('{"Path":"CB+F8-M5/B:/c01/q004/s0010/c01+AF8-s00+A8-s0010+F8/h01.1094.dpx","UTCDateModified":"20100310T110623Z"}',
     "CB+F8-M5/B:/c01/q004/s0010/c01+AF8-s00+A8-s0010+F8/h01.1094.dpx"),
]
GOLDEN_NAME = [
    ("AAAQQQ", '{"Path":"   ","UTCDateModified":"20100310T110623Z"}', "00undefined/AAAQQQ"),
    ("AAAQQQ", "             ", "00undefined/AAAQQQ"),
    ("AAAQQQ", "aaa\\bbb\\ccc", "aaa/bbb/ccc"),
]


def test_parse_golden(spark):
    df = spark.createDataFrame(GOLDEN_PARSE, "d string, expected string")
    got = df.select(parse_description("d").alias("p"), "expected").collect()
    assert [r.p for r in got] == [r.expected for r in got]


def test_normalise_golden(spark):
    df = spark.createDataFrame(GOLDEN_NAME, "aid string, d string, expected string")
    got = df.select(normalise_name("aid", "d").alias("n"), "expected").collect()
    assert [r.n for r in got] == [r.expected for r in got]


def test_malformed_json_falls_back(spark):
    cases = [
        ('"{\\"Path\\":\\"twice/encoded\\"}"', "twice/encoded"),
        ('{"NoPath":"x"}', '{"NoPath":"x"}'),
        ("{'Path':'single'}", "{'Path':'single'}"),
        ('{"Path":"a"} trailing', '{"Path":"a"} trailing'),
        ('{"Path":"first","Path":"last"}', "last"),
        ('{"Path":', '{"Path":'),
        ("<m><v>4</v></m>", ""),
        ('{"Path":"a"}}', '{"Path":"a"}}'),
        ('{"Path":"a"} {"x":1}', '{"Path":"a"} {"x":1}'),
        ('{"Path":"a"},{"Path":"b"}', '{"Path":"a"},{"Path":"b"}'),
        ("<m><p>abcde</p></m>", "i\ufffd\u001d"),
        ("<m><p>6Q==</p></m>", "\ufffd"),
        ("<m><p>aGVs bG8!</p></m>", "hello"),
        ("<m><p></p></m>", ""),
    ]
    df = spark.createDataFrame(cases, "d string, expected string")
    got = df.select(parse_description("d").alias("p"), "expected").collect()
    assert [r.p for r in got] == [r.expected for r in got]


def test_urlsafe_and_padding(spark):
    import base64
    raw = "dir/é~file?.bin"
    b64 = base64.urlsafe_b64encode(raw.encode()).decode()
    df = spark.createDataFrame([(f"\t<m><p>\t {b64}\t </p></m>\n",)], "d string")
    assert df.select(normalise_name(F.lit("x"), "d").alias("n")).first().n == raw
    # '.' does not cross a line break in the detection pattern: such text stays as is.
    df = spark.createDataFrame([(f"<m><p>\n{b64}\n</p></m>",)], "d string")
    assert df.select(normalise_name(F.lit("x"), "d").alias("n")).first().n == f"<m><p>\n{b64}\n</p></m>"


def _sequential(rows, recorded):
    used = set(recorded)
    out = {}
    for rn, name, date in sorted(rows):
        fname = name + "-" + date if name in used else name
        used.add(fname)
        out[rn] = fname
    return out


def test_unique_names_matches_sequential_fold(spark):
    rnd = random.Random(7)
    for trial in range(4):
        rows, names = [], ["a", "b", "c"]
        for rn in range(1, 120):
            if rnd.random() < 0.3 and rows:
                prev = rnd.choice(rows)
                name = prev[1] + "-" + prev[2]   # a base equal to an earlier suffixed name
            else:
                name = rnd.choice(names)
            rows.append((rn, name, rnd.choice(["d1", "d2"])))
        rnd.shuffle(rows)
        recorded = [rnd.choice(names)] if trial % 2 else []
        df = spark.createDataFrame(rows, "row_num long, fname string, creationdate string")
        rec = spark.createDataFrame([(r,) for r in recorded], "fname string") if recorded else None
        got = {r.row_num: r.fname for r in unique_names(df, recorded=rec).collect()}
        assert got == _sequential(rows, recorded)


def test_hot_base_name(spark):
    """A base shared by a third of all rows: same result as the fold, and no
    window over the name (which would put that third in one task)."""
    rnd = random.Random(2)
    rows = []
    for rn in range(1, 301):
        name = "hot" if rn % 3 == 0 else f"n{rnd.randint(0, 60)}"
        rows.append((rn, name, f"d{rnd.randint(0, 3)}"))
    rows.append((301, "hot-d1", "d9"))   # collides with a suffixed hot name
    df = spark.createDataFrame(rows, "row_num long, fname string, creationdate string")
    out = unique_names(df)
    assert {r.row_num: r.fname for r in out.collect()} == _sequential(rows, [])
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


def test_seven_bit_mode(spark):
    import base64
    raw = "dir/é.txt"
    b64 = base64.b64encode(raw.encode()).decode()
    df = spark.createDataFrame([(f"<m><p>{b64}</p></m>",)], "d string")
    utf8 = df.select(parse_description("d").alias("p")).first().p
    seven = df.select(parse_description("d", ascii7=True).alias("p")).first().p
    assert utf8 == raw
    want = "".join(chr(b & 0x7F) for b in raw.encode())
    assert seven == want and seven.startswith("dir/") and seven.endswith(".txt")


def test_chain_of_dependent_names_doubles(spark, monkeypatch):
    """A chain of 200 first rows, each suffixed because the one before is, in at most 10 rounds;
    a second chain without a seed keeps its names."""
    from vaultlens.operators import naming
    rounds = []
    real = naming.materialize
    monkeypatch.setattr(naming, "materialize", lambda df, name: rounds.append(name) or real(df, name))
    rows = [(1, "a"), (2, "a")] + [(3 + i, "a" + "-d" * (i + 1)) for i in range(200)] + [(500 + i, "b" + "-d" * i) for i in range(50)]
    rows += [(900, "a" + "-d" * 40)]
    seen, want = set(), {}
    for k, base in rows:
        want[k] = base if base not in seen else f"{base}-d"
        seen.add(want[k])
    df = spark.createDataFrame([(k, b, "d") for k, b in rows], "row_num long, fname string, creationdate string").repartition(4)
    got = {r.row_num: r.fname for r in naming.unique_names(df).collect()}
    assert got == want
    assert rounds.count("names-round") <= 10
