"""Secrets: base patterns, and character Markov models of random strings and ordinary identifiers.

Built-in column functions only. Two first-order Markov models over the characters of
``ALPHABET`` are counted in Spark from labelled samples: strings that the base patterns
prove to be secrets, and identifiers of the same rows that they do not touch. A candidate
token is reported as ``random`` when the log-likelihood ratio of the two models, summed over
its character pairs, reaches ``MIN_RATIO`` and it overlaps no base span.

The sample is the ``SAMPLE_ROWS`` rows of ``labels`` and documents with the smallest hash of
their id, a documented bound; scanning covers every text. The trained model is one table of
fixed size, |ALPHABET| squared.

Defined cases: very long texts are searched whole; a null or empty text has no spans; a sample without secrets or identifiers
leaves smoothed, nearly uniform models; repeated rows each get their result; an empty table
gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultlens.llm.common import read_table, text_key
from vaultlens.llm.spans import with_spans

BASE = ("assign", "access", "hex")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SAMPLE_ROWS = 2_000
SMOOTHING = 0.5       # added to each pair's count
MIN_RATIO = 12.0      # natural logarithm; odds of about 160,000 to 1
MIN_TOKEN = 16        # characters of a candidate
CONTEXT = 0

_ASSIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
PATTERNS = {
    "assign": _ASSIGN + "([A-Za-z0-9+/_.=-]+)",
    "access": r"AKIA[A-Z0-9]++",
    "hex": r"(?<![0-9a-f])[0-9a-f]{24,}+",
    "token": rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{MIN_TOKEN},}}+",
}


def _value(s: Column) -> Column:
    """Group 2 of an assignment."""
    return F.regexp_extract(s["value"], "^" + PATTERNS["assign"], 1)


def _base_spans(src: DataFrame) -> DataFrame:
    d = with_spans(src, "text", PATTERNS, CONTEXT)
    return d.withColumns({
        "assign": F.filter("assign", lambda s: F.length(_value(s)) >= 6),
        "access": F.filter("access", lambda s: F.length(s["value"]) >= 20)})


def _overlaps(s: Column) -> Column:
    return F.exists(F.concat(*BASE), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))


def labelled_samples(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     rows: int = SAMPLE_ROWS) -> DataFrame:
    """``word, secret``: strings labelled by the base patterns (true) and identifiers that no base
    span touches (false), of the ``rows`` labelled documents with the smallest hash of their id."""
    named_ids = labels.select(F.col(f"`{id_col}`").alias("lid")).where("lid is not null").distinct() \
        .orderBy(F.xxhash64("lid"), "lid").limit(rows)
    src = docs.select(F.col(f"`{id_col}`").alias("id"),
                      F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")) \
        .join(named_ids, F.col("id") == F.col("lid"), "left_semi")
    d = _base_spans(src)
    secret = d.select(F.explode(F.concat(F.transform("assign", _value), F.transform("access", lambda s: s["value"]),
                                         F.transform("hex", lambda s: s["value"]))).alias("word"), F.lit(True).alias("secret"))
    masked = F.regexp_replace(F.regexp_replace(F.col("text"), PATTERNS["assign"], " "),
                              f"{PATTERNS['access']}|{PATTERNS['hex']}", " ")
    plain = d.select(F.explode(F.regexp_extract_all(masked, F.lit("[A-Za-z][A-Za-z0-9_-]{3,}"), F.lit(0))).alias("word"),
                     F.lit(False).alias("secret"))
    return secret.unionByName(plain)


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio of each pair of alphabet characters, row-major. ``samples``: word, secret."""
    n = len(ALPHABET)
    pair = samples.select("secret", F.col("word"), F.explode(F.sequence(F.lit(1), F.greatest(F.length("word") - 1, F.lit(1)))).alias("i")) \
        .select("secret", F.substr("word", "i", F.lit(2)).alias("pair")).where(F.length("pair") == 2)
    count = pair.groupBy("secret", "pair").agg(F.count("*").alias("c")) \
        .where(F.col("pair").rlike(r"^[A-Za-z0-9+/_=-]{2}$"))
    seen = {(r.secret, r.pair): r.c for r in count.collect()}   # at most 2 * |ALPHABET|^2 rows
    logs = {}
    for secret in (True, False):
        for a in ALPHABET:
            total = sum(seen.get((secret, a + b), 0) for b in ALPHABET) + SMOOTHING * n
            for b in ALPHABET:
                logs[secret, a, b] = math.log((seen.get((secret, a + b), 0) + SMOOTHING) / total)
    return [round(logs[True, a, b] - logs[False, a, b], 3) for a in ALPHABET for b in ALPHABET]


def ratio(word: Column, model: list[float]) -> Column:
    """Summed log-likelihood ratio of the word's character pairs, random against ordinary."""
    n = len(ALPHABET)
    table = F.split(F.lit(" ".join(map(str, model))), " ").cast("array<double>")
    at = F.transform(F.filter(F.split(word, ""), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    return F.aggregate(F.arrays_zip(F.slice(at, 1, F.size(at) - 1).alias("a"), F.slice(at, 2, F.size(at) - 1).alias("b")),
                       F.lit(0.0), lambda total, p: total + F.get(table, p["a"] * n + p["b"]))


def secret_spans(docs: DataFrame, model: list[float], id_col: str = "doc_id", text_col: str = "text",
                 min_ratio: float = MIN_RATIO) -> DataFrame:
    """``id, tkey`` and ``assign``, ``access``, ``hex``, ``random``: arrays of struct(start, end, value)."""
    src = docs.select(F.col(f"`{id_col}`").alias("id"), text_key(f"`{text_col}`").alias("tkey"),
                      F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    d = _base_spans(src)
    random = F.filter("token", lambda s: ~_overlaps(s) & (ratio(s["value"], model) >= min_ratio))
    d = d.withColumn("random", random)
    return d.select("id", "tkey", *[F.transform(k, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"))).alias(k) for k in (*BASE, "random")])


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = train(labelled_samples(docs, read_table(spark, sf_dir, "labels")))
    d = secret_spans(docs, model)

    def ranked(rank, kind):
        return F.transform(kind, lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"),
            F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")).alias("name")))

    def listed(kinds):
        placed = F.concat(*[ranked(i, k) for i, k in enumerate(kinds)])
        return F.array_join(F.transform(F.array_sort(placed), lambda s: s["name"]), ",")

    return d.select(F.col("id").alias("doc_id"), *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
                    F.sha2(listed(BASE).cast("binary"), 256).alias("base_sha256"),
                    listed((*BASE, "random")).alias("spans"), F.size("random").cast("long").alias("n_random"))
