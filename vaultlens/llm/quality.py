"""Quality rules: per-document counts and the frequency of lines across a host's documents.

Built-in column functions only. One pass computes each text's counts and its line
hashes; that narrow table is written once. A line is normalised (white space runs to
one space, digit runs to ``0``, lower case) and hashed. It is *frequent* on a host when
it stands in at least ``min_docs`` distinct documents of that host and in more than
``max_share`` of them; exact copies of a text count as one document. Frequent lines are
removed. A document is *depleted* when less than ``min_share`` of its words are left.

Hot hosts and lines: counts are combined map-side; the join back of lines to the
frequent ones is salted by the text, so a line in a third of all documents spreads over
``SALTS`` tasks and AQE may split those further.

Defined cases: very long texts are counted whole, in one row; a null text has no words and no
lines; a null host is a host of its own;
repeated rows each get their result; an empty table gives an empty result. Other columns
of the input do not matter, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultlens.llm.common import materialize, read_table, text_key

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
MIN_WORDS = 10           # base rule
REPEAT_PERCENT = 20      # base rule
WINDOW = 5               # words in a repeat window
MIN_DOCS = 10            # a line in fewer documents of a host is never frequent
MAX_SHARE = 0.05         # of a host's distinct documents
MIN_KEPT_SHARE = 0.3
SALTS = 16


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def normalised(line: Column) -> Column:
    flat = F.regexp_replace(F.regexp_replace(line, SPACE, " "), "[0-9]+", "0")
    return F.lower(F.trim(flat))


def _lines(text: Column) -> Column:
    """The text's lines with a word, in order."""
    return F.filter(F.split(text, "\n", -1), lambda l: l.rlike(WORD))


def _longs(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def with_counts(rows: DataFrame, text_col: str) -> DataFrame:
    """``rows`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) and
    ``lines``, the lines' hashes and word counts. Every array that a lambda reads by
    position is a column of its own, so it is built once a row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = rows.withColumn("_words", _words(text)).withColumn("_lines", _lines(text))
    d = d.withColumn("_hash", F.transform("_words", lambda w: F.xxhash64(w)))
    n = F.size("_hash")
    window = F.transform(F.sequence(F.lit(0), n - WINDOW),
                         lambda i: F.xxhash64(*[F.get(F.col("_hash"), i + k) for k in range(WINDOW)]))
    d = d.withColumn("_win", F.when(n > WINDOW, window))
    # Only texts with a repeated window go on; the others stop at one hash set.
    d = d.withColumn("_win", F.when(F.size(F.array_distinct("_win")) < F.size("_win"), F.col("_win")))
    d = d.withColumn("_at", F.sort_array(F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    at = F.col("_at")
    d = d.withColumn("_hit", F.sort_array(F.array_compact(F.transform(at, lambda x, j: F.when(
        (F.get(at, j - 1)["h"] == x["h"]) | (F.get(at, j + 1)["h"] == x["h"]), x["i"])))))
    hit = F.col("_hit")
    covered = F.transform(hit, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(hit, j + 1) - p, F.lit(WINDOW))))
    return d.select(
        *rows.columns,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(_longs(covered), F.lit(0).cast("long")).alias("n_repeat_words"),
        F.transform("_lines", lambda l: F.struct(
            F.xxhash64(normalised(l)).alias("h"), F.regexp_count(l, F.lit(WORD)).alias("w"))).alias("lines"))


def frequent_lines(texts: DataFrame, min_docs: int, max_share: float) -> DataFrame:
    """``host, line, n_docs`` of the lines above both limits. ``texts``: host, tkey, lines, each text once a host."""
    docs = texts.groupBy("host").agg(F.count("*").alias("host_docs"))
    seen = texts.select("host", F.explode(F.array_distinct(F.transform("lines", lambda l: l["h"]))).alias("line")) \
        .groupBy("host", "line").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") >= min_docs)
    limit = docs.select(F.col("host").alias("lhost"), (F.col("host_docs") * max_share).alias("most"))
    return seen.join(limit, F.col("host").eqNullSafe(F.col("lhost")) & (F.col("n_docs") > F.col("most"))) \
        .select("host", "line", "n_docs")


def line_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
               min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE,
               min_share: float = MIN_KEPT_SHARE) -> DataFrame:
    """One row per input row: id, tkey, host, the base counts, base_failed, ``n_removed_lines``,
    ``n_kept_words``, ``removed`` (hashes of the frequent lines the text has) and ``kept``."""
    src = docs.select(F.col(f"`{id_col}`").alias("id"), text_key(f"`{text_col}`").alias("tkey"),
                      F.col(f"`{host_col}`").alias("host"), F.col(f"`{text_col}`").alias("text"))
    base = materialize(with_counts(src, "text").drop("text"), "quality-base")
    texts = materialize(base.select("host", "tkey", "lines").dropDuplicates(["host", "tkey"]), "quality-texts")
    often = frequent_lines(texts, min_docs, max_share).select(
        F.col("host").alias("fhost"), F.col("line").alias("fline"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("fsalt"))
    line = texts.select("host", "tkey", F.pmod("tkey", F.lit(SALTS)).cast("int").alias("salt"),
                        F.explode("lines").alias("l")).select("host", "tkey", "salt", "l.h", "l.w")
    found = line.join(often, F.col("host").eqNullSafe(F.col("fhost")) & (F.col("h") == F.col("fline"))
                      & (F.col("salt") == F.col("fsalt")))
    lost = found.groupBy("host", "tkey").agg(
        F.count("*").alias("n_removed_lines"), F.sum("w").alias("removed_words"), F.collect_set("h").alias("removed")) \
        .select(F.col("host").alias("lhost"), F.col("tkey").alias("ltkey"), "n_removed_lines", "removed_words", "removed")
    zero = F.lit(0).cast("long")
    out = base.drop("lines").join(
        lost, F.col("host").eqNullSafe(F.col("lhost")) & (F.col("tkey") == F.col("ltkey")), "left").select(
        "id", "tkey", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"),
        F.coalesce("n_removed_lines", zero).alias("n_removed_lines"),
        (F.col("n_words") - F.coalesce("removed_words", zero)).alias("n_kept_words"), "removed")
    depleted = F.col("n_kept_words") < min_share * F.col("n_words")
    return out.withColumn("kept", ~F.col("base_failed") & ~depleted)


def clean_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                    **limits) -> DataFrame:
    """``docs`` without the rejected rows, and without the frequent lines in the texts of the
    others. Columns and row count per kept row stay as they are."""
    ruled = line_rules(docs, id_col, text_col, host_col, **limits).where("kept") \
        .groupBy(F.col("host").alias("khost"), F.col("tkey").alias("ktkey")).agg(F.first("removed").alias("removed"))
    cols = docs.columns
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"),
                    F.col(f"`{host_col}`").alias("host"), text_key(f"`{text_col}`").alias("tkey"))
    j = d.join(ruled, F.col("host").eqNullSafe(F.col("khost")) & (F.col("tkey") == F.col("ktkey")))
    text = F.col("row").getField(text_col)
    removed = F.col("removed")
    cleaned = F.array_join(F.filter(F.split(text, "\n", -1), lambda l: ~(
        l.rlike(WORD) & F.array_contains(removed, F.xxhash64(normalised(l))))), "\n")
    return j.select(*[(F.when(removed.isNull(), text).otherwise(cleaned) if c == text_col
                       else F.col("row").getField(c)).alias(c) for c in cols])


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = line_rules(read_table(spark, sf_dir, "documents"))
    return rules.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        "n_repeat_words", "base_failed", "kept", "n_removed_lines", "n_kept_words")
