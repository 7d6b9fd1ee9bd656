"""Language-model scores: stupid backoff over word bigrams, computed relationally.

The model covers every text and every word: words (lower-cased A-Z, cut at white space) and
bigrams are counted each for itself. Where the counts are kept:

* Unigrams: words whose count reaches the lowest threshold that leaves at most
  ``SHARED_WORDS`` words are numbered and broadcast. All others (*rare* words) are keyed by a
  63-bit hash, and their counts stay in the partitions of the shuffle below. The bound moves
  words from one place to the other; scores do not depend on it.
* Bigrams of two words among the ``HEAD`` most frequent: counted into a table of at most
  ``HEAD`` squared rows and broadcast. These are the only bigrams that a large share of all
  documents can have, so no key of the shuffle is hot.
* All others: documents are exploded into (row, bigram, occurrences) and shuffled by the
  bigram, or by its rare word. Each partition's count tables are joined to its rows as windows
  over the sorted keys: a rare word's group has all bigrams that end in it and the documents
  that start with it, so their sum is its count. A bigram of two rare words goes to both
  groups; the first word's scores it if others have it, the second word's backs off if not.
  The sums per document follow.

``vocabulary``, if a caller gives it, makes all but that many words one word ``<unk>``; the
query does not.

Score of a word after another: ``(c(w1 w2) - own) / (c(w1) - own)`` if that is above zero,
else ``ALPHA * c(w2) / N``; ``own`` are the document's own occurrences of the bigram, which
are left out so that a text is not its own evidence. The first word scores ``c(w) / N``. A
document's score is the sum of natural logarithms.

Defined cases: very long texts are scored whole; a null or empty text has no words, score 0 and a null mean; repeated rows are
documents of their own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from vaultlens.llm.common import materialize, read_table

ALPHA = 0.4
SHARED_WORDS = 1 << 17   # words whose counts are broadcast
HEAD = 512            # word numbers below it, <unk> included
UNK = 0
PAIR, SECOND, FIRST, DOCUMENT = range(4)   # exploded rows: no rare word; by the rare second; by the rare first; a document's own
TASK_WORDS = 300_000  # different words a task counts before it passes them on
_PER_OCTAVE = 8       # threshold steps: count bounds grow by 2 ** (1 / 8)


def words_of(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def word_counts(texts: DataFrame) -> DataFrame:
    """``word`` (binary), ``n`` over all texts (column ``text``, binary); summed in each task first,
    for ``TASK_WORDS`` different words at a time."""
    def run(batches):
        seen = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(seen), type=pa.binary()), pa.array(list(seen.values()), type=pa.int64())],
                                             names=["word", "n"])
            seen.clear()
            return out

        for b in batches:
            for t in b.column(0):
                seen.update(words_of(t.as_py()))
                if len(seen) > TASK_WORDS:
                    yield flush()
        yield flush()
    return texts.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def rare_id(word: bytes) -> int:
    """Negative 63-bit key of a word without a number."""
    return (xxh64_intdigest(word) >> 1) - (1 << 63)


class Unigrams:
    """Word numbers and counts. Number 0 is ``<unk>``; the others follow by falling count, then word."""

    def __init__(self, rows: list[tuple[bytes, int]], total: int):
        rows = sorted(rows, key=lambda r: (-r[1], r[0]))
        self.number = {w: i + 1 for i, (w, _) in enumerate(rows)}
        self.count = np.array([total - sum(n for _, n in rows)] + [n for _, n in rows], dtype=np.int64)
        self.total = total

    def ids(self, words: list[bytes], rare: bool) -> np.ndarray:
        """Numbers of the words; one without a number is ``<unk>``, or its negative key if ``rare``."""
        get = self.number.get
        ids = np.fromiter((get(w, UNK) for w in words), dtype=np.int64, count=len(words))
        if rare:
            for i in np.flatnonzero(ids == UNK).tolist():
                ids[i] = rare_id(words[i])
        return ids


def unigrams(counts: DataFrame, vocabulary: int = SHARED_WORDS) -> Unigrams:
    step = F.floor(F.log2("n") * _PER_OCTAVE).cast("int")
    steps = {r.step: r for r in counts.groupBy(step.alias("step")).agg(   # a few hundred rows at most
        F.count("*").alias("words"), F.sum("n").alias("n")).collect()}
    room, lowest = vocabulary, None
    for s in sorted(steps, reverse=True):
        room -= steps[s].words
        if room < 0:
            break
        lowest = s
    rows = [] if lowest is None else [(bytes(r.word), r.n) for r in counts.where(step >= lowest).collect()]
    return Unigrams(rows, sum(r.n for r in steps.values()))


def _bigrams(ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of the bigrams of numbered words."""
    a, b = ids[:-1], ids[1:]
    numbered = (a >= 0) & (b >= 0)
    return np.unique(a[numbered] * size + b[numbered], return_counts=True)


def _rare_bigrams(row: int, ids: np.ndarray, size: int) -> np.ndarray:
    """``row, part, other, role`` of each bigram with a rare word, and of a rare first word (after ``size``)."""
    a, b = np.concatenate([[size], ids[:-1]]), ids
    second, first = b < 0, a < 0
    rows = np.empty((4, second.sum() + first.sum()), dtype=np.int64)
    rows[0], rows[1], rows[2] = row, np.concatenate([b[second], a[first]]), np.concatenate([a[second], b[first]])
    rows[3] = np.repeat([SECOND, FIRST], [second.sum(), first.sum()])
    return rows


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct columns of a matrix, and how often each occurs."""
    rows = rows[:, np.lexsort(rows)]
    start = np.flatnonzero(np.concatenate([[True], (rows[:, 1:] != rows[:, :-1]).any(axis=0)])) if rows.shape[1] else np.zeros(0, dtype=np.int64)
    return rows[:, start], np.diff(start, append=rows.shape[1])


def head_counts(texts: DataFrame, shared, head: int) -> dict[int, int]:
    """Counts of the bigrams of two head words, by key; at most ``head`` squared."""
    def run(batches):
        model, rare = shared.value
        size = len(model.count)
        seen = Counter()
        for b in batches:
            ids = [model.ids(words_of(t.as_py()), False) for t in b.column(0)]
            keys = np.concatenate([x[:-1] * size + x[1:] for x in ids] or [np.zeros(0, dtype=np.int64)])
            keys = keys[(keys // size < head) & (keys % size < head)]
            if rare:   # number 0 stands for words that are no head words then
                keys = keys[(keys // size != UNK) & (keys % size != UNK)]
            key, n = np.unique(keys, return_counts=True)
            for k, c in zip(key.tolist(), n.tolist()):
                seen[k] += c
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), type=pa.int64()), pa.array(list(seen.values()), type=pa.int64())],
                                         names=["key", "n"])
    rows = texts.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).collect()
    return {r.key: r.n for r in rows}


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alpha: float = ALPHA,
              vocabulary: int | None = None, head: int = HEAD, shared_words: int = SHARED_WORDS) -> DataFrame:
    """``id, n_words, n_backoff, score, mean_score`` per row; counts come from all rows of ``docs``."""
    spark = docs.sparkSession
    src = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"),
                      F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))
    rare = vocabulary is None
    model = unigrams(materialize(word_counts(src), "lm-words"), shared_words if rare else vocabulary)
    shared = spark.sparkContext.broadcast((model, rare))
    heads = head_counts(src, shared, head)
    shared_heads = spark.sparkContext.broadcast((np.array(sorted(heads), dtype=np.int64),
                                                 np.array([heads[k] for k in sorted(heads)], dtype=np.int64)))

    def run(batches):
        (uni, rare), (head_keys, head_n) = shared.value, shared_heads.value
        size, count = len(uni.count), uni.count
        for b in batches:
            for s in range(0, b.num_rows, 500):
                part = b.slice(s, 500)
                rows, keys, ns, rares, first = [], [], [], [np.zeros((4, 0), dtype=np.int64)], []
                for row, text in zip(part.column(0).to_pylist(), part.column(2)):
                    ids = uni.ids(words_of(text.as_py()), rare)
                    local, back = 0.0, 0
                    if len(ids):
                        key, n = _bigrams(ids, size)
                        inside = (key // size < head) & (key % size < head)
                        k, m = key[inside], n[inside]
                        if len(k):
                            near_n = head_n[np.searchsorted(head_keys, k)] - m
                            near = near_n > 0
                            local += float((m * np.where(near, np.log(np.maximum(near_n, 1) / np.maximum(count[k // size] - m, 1)),
                                                         np.log(alpha * count[k % size] / uni.total))).sum())
                            back = int(m[~near].sum())
                        if ids[0] >= 0:
                            local += math.log(count[ids[0]] / uni.total)
                        keys.append(key[~inside])
                        ns.append(n[~inside])
                        rows.append(np.full(len(keys[-1]), row))
                        if (ids < 0).any():
                            rares.append(_rare_bigrams(row, ids, size))
                    first.append((row, local, back, len(ids)))
                pairs = sum(map(len, keys))
                lone, lone_n = _distinct(np.concatenate(rares, axis=1))
                m = pairs + len(lone_n)
                own = lambda i: np.array([f[i] for f in first], dtype=np.int64)
                joined = lambda *parts: pa.array(np.concatenate(parts))
                ident = part.column(1).take(pa.concat_arrays([pa.array(range(part.num_rows), type=pa.int64()), pa.nulls(m, type=pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [joined(own(0), *rows, lone[0]), joined(own(0), *keys, lone[1]),
                     joined(own(3), np.zeros(pairs, dtype=np.int64), lone[2]),
                     joined(np.repeat(np.array([DOCUMENT, PAIR], dtype=np.int8), [len(first), pairs]), lone[3].astype(np.int8)),
                     joined(own(2), *ns, lone_n).cast(pa.int32()), ident,
                     pa.concat_arrays([pa.array([f[1] for f in first], type=pa.float64()), pa.nulls(m, type=pa.float64())])],
                    names=["row", "part", "other", "role", "n", "id", "local"])

    id_type = src.schema["id"].dataType.simpleString()
    # A document's own row has its words as ``other`` and its back-offs so far as ``n``.
    exploded = src.mapInArrow(run, f"row long, part long, other long, role byte, n int, id {id_type}, local double")
    size = len(model.count)
    table = spark.createDataFrame([(i, c) for i, c in enumerate(model.count.tolist())], "w long, c long")   # at most SHARED_WORDS + 1 rows
    role, n, other, others = F.col("role"), F.col("n"), F.col("other"), F.col("others")
    counted = exploded.repartition("part") \
        .withColumn("others", F.sum("n").over(Window.partitionBy("part", "other", "role")) - n)
    # Reads ``others``, which is never negative, so that Spark plans it second and both windows share one sort.
    counted = counted.withColumn("rare_n", F.sum(F.when((role == SECOND) & (others >= 0), n)).over(Window.partitionBy("part")))
    near = others > 0
    # The one word whose count a row needs: the first if other documents have the bigram, else the second.
    need = F.when(role == PAIR, F.when(near, F.floor(F.col("part") / size).cast("long")).otherwise(F.col("part") % size)) \
        .when((role == SECOND) == near, F.when(other >= 0, other))
    placed = counted.withColumn("need", need).join(F.broadcast(table), F.col("need") == F.col("w"), "left")
    begins = (role == SECOND) & (other == size)
    elsewhere = (other < 0) & ((role == SECOND) == near)   # the row in the other rare word's group has it
    of = F.when((role == PAIR) | ((role == SECOND) == near), F.col("c")).otherwise(F.col("rare_n"))
    total = F.lit(max(model.total, 1))
    value = F.when(role == DOCUMENT, F.col("local")).when(begins, F.log(F.col("rare_n") / total)).when(elsewhere, 0.0) \
        .otherwise(n * F.when(near, F.log(others / (of - n))).otherwise(F.log(F.lit(alpha) * of / total)))
    back = F.when(role == DOCUMENT, n).when(begins | elsewhere | near, 0).otherwise(n)
    sums = placed.groupBy("row").agg(F.max("id").alias("id"), F.max(F.when(role == DOCUMENT, other)).alias("n_words"),
                                     F.sum(back).alias("n_backoff"), F.sum(value).alias("score"))
    return sums.select("id", "n_words", "n_backoff", F.round("score", 6).alias("score"),
                       F.when(F.col("n_words") > 0, F.round(F.col("score") / F.col("n_words"), 6)).alias("mean_score"))


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
