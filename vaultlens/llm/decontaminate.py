"""Benchmark decontamination: an FM-index per training shard, searched for every test phrase.

The phrases are all windows of ``WINDOW`` consecutive words of each benchmark item; a
shorter item is one phrase. Each task gathers documents to shards of a bounded number of
words (a longer document is a shard of its own), numbers all words of the shard, builds an
FM-index over them, document after document, maps the phrases to the shard's numbers,
searches them backwards through wavelet ranks, locates every occurrence through sampled
suffix positions, and merges the covered words to removal spans.

The benchmark is the stated query set. Its items are cut into pieces of ``PIECE_WORDS``
windows and read in blocks of about ``BLOCK_BYTES``; each block is one pass over the documents,
and only a block is ever broadcast: its words once, and a 4-byte number for each word of an
item. The phrases are made from these on the executors.

Defined cases: a null or empty text has no words and no spans; items without words have no
phrases; items that repeat an id count once; a null item id is named ``null``; repeated
document rows each get their result; an empty benchmark marks nothing. Other columns of
either table are not read.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultlens.llm.common import materialize, read_table, text_key
from vaultlens.llm.fm_index import FmIndex

WINDOW = 10
SHARD_WORDS = 1 << 20
BLOCK_BYTES = 8 << 20
PIECE_WORDS = 1 << 16

# ASCII letters to lower case; every other ASCII character but digits to a space.
_FOLD = bytes(c if c >= 0x80 or chr(c).isdigit() or "a" <= chr(c) <= "z" else c + 32 if 65 <= c <= 90 else 32
              for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


class Numbers(dict):
    """Numbers words from ``first`` on, in the order in which they come up."""

    def __init__(self, first: int):
        super().__init__()
        self.first = first

    def __missing__(self, word):
        self[word] = n = len(self) + self.first
        return n


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All integers of the intervals, and the interval of each."""
    size = high - low
    owner = np.repeat(np.arange(len(low)), size)
    return np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + low[owner], owner


class Phrases:
    """One block of pieces of items, as it is broadcast: words, word numbers of all pieces, item names."""

    def __init__(self, pieces: list[tuple[str, bytes | None]], window: int):
        numbers, names = Numbers(0), Numbers(0)
        self.window = window
        found = [(names[name], words_of(body)) for name, body in pieces]
        self.owner = np.array([o for o, _ in found], dtype=np.uint32)
        self.size = np.array([len(w) for _, w in found], dtype=np.int64)
        self.text = np.concatenate([np.fromiter(map(numbers.__getitem__, w), dtype=np.uint32, count=len(w)) for _, w in found]
                                   or [np.zeros(0, dtype=np.uint32)])
        self.words, self.names = list(numbers), list(names)

    @cached_property
    def groups(self) -> list:
        """``(patterns, item offsets, items)`` for each length of phrases: distinct patterns, one a row,
        and the items that have each. Made once in a worker process."""
        out, begin = [], np.cumsum(self.size) - self.size
        for length in np.unique(np.minimum(self.size, self.window)).tolist():
            if not length:
                continue
            of = np.flatnonzero(np.minimum(self.size, self.window) == length)
            at, piece = _spread(begin[of], begin[of] + self.size[of] - length + 1)
            patterns, which = np.unique(np.lib.stride_tricks.sliding_window_view(self.text, length)[at], axis=0, return_inverse=True)
            pair = np.unique(np.stack([which.ravel(), self.owner[of][piece].astype(np.int64)], axis=1), axis=0)
            out.append((patterns, np.searchsorted(pair[:, 0], np.arange(len(patterns) + 1)), pair[:, 1]))
        return out


def scan_shard(docs: list[list[bytes]], phrases: Phrases) -> list[tuple[list[int], list[int], list[str]]]:
    """Span starts, span ends (in words, end exclusive) and item names of each document of a shard."""
    sizes = np.array([len(d) for d in docs])
    first = np.concatenate([[0], np.cumsum(sizes + 1)])    # a gap, number 1, after every document
    ids = np.ones(first[-1], dtype=np.int64)
    numbers = Numbers(2)
    for words, at in zip(docs, first):
        ids[at:at + len(words)] = np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words))
    covered = np.zeros(len(ids) + 1, dtype=np.int64)
    found = []
    if len(numbers) and phrases.words:
        index = FmIndex(ids)
        here = np.array([numbers.get(w, 0) for w in phrases.words])    # 0: not in this shard
        for patterns, offset, items in phrases.groups:
            mapped = here[patterns]
            able = np.flatnonzero((mapped > 0).all(axis=1))
            low, high = index.search(mapped[able])
            hit = np.flatnonzero(high > low)
            rows, owner = _spread(low[hit], high[hit])
            begin = index.locate(rows)
            np.add.at(covered, begin, 1)
            np.add.at(covered, begin + patterns.shape[1], -1)
            doc = np.searchsorted(first, begin, side="right") - 1
            pair = np.unique(np.stack([doc, able[hit[owner]]], axis=1), axis=0)
            entry, which = _spread(offset[pair[:, 1]], offset[pair[:, 1] + 1])
            found.append(np.stack([pair[which, 0], items[entry]], axis=1))
    inside = np.concatenate([[False], np.cumsum(covered)[:-1] > 0, [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    owner = np.searchsorted(first, starts, side="right") - 1
    out = [([], [], []) for _ in docs]
    for s, e, d in zip(starts.tolist(), ends.tolist(), owner.tolist()):
        out[d][0].append(s - int(first[d]))
        out[d][1].append(e - int(first[d]))
    if found:
        for d, i in np.unique(np.concatenate(found), axis=0).tolist():
            out[d][2].append(phrases.names[i])
    return out


def _pieces(items: DataFrame, window: int, piece_words: int) -> DataFrame:
    """``name, piece, body``: items cut so that each of their windows is in one piece."""
    def run(batches):
        for b in batches:
            out = []
            for name, body in zip(b.column(0).to_pylist(), b.column(1)):
                words = words_of(body.as_py())
                out += [(name, k, b" ".join(words[at:at + piece_words + window - 1]))
                        for k, at in enumerate(range(0, max(1, len(words) - window + 1), piece_words))]
            cols = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.binary()))],
                                             names=["name", "piece", "body"])

    return items.mapInArrow(run, "name string, piece int, body binary")


_SPANS = "n_words long, starts array<long>, ends array<long>, items array<string>"


def _pass(rows: DataFrame, phrases: Phrases, last: bool, shard_words: int) -> DataFrame:
    """One block's spans, united with those of the passes before it."""
    shared = rows.sparkSession.sparkContext.broadcast(phrases)
    keep = ["id", "tkey"] + ([] if last else ["text"])
    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, tkey long, {'' if last else 'text binary, '}{_SPANS}"

    def flush(shard, before):
        for words, prior, (s, e, items) in zip(shard, before, scan_shard(shard, shared.value)):
            if prior[0]:
                merged = []
                for a, b in sorted(zip(s + prior[0], e + prior[1])):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(b, merged[-1][1])
                    else:
                        merged.append([a, b])
                s, e = [a for a, _ in merged], [b for _, b in merged]
            yield len(words), s, e, sorted(set(items) | set(prior[2]))

    def run(batches):
        for b in batches:
            at = 0
            while at < b.num_rows:
                shard, before, total, begin = [], [], 0, at
                while at < b.num_rows and (not shard or total < shard_words):
                    shard.append(words_of(b.column("text")[at].as_py()))
                    before.append([b.column(c)[at].as_py() or [] for c in ("starts", "ends", "items")])
                    total += len(shard[-1])
                    at += 1
                cols = list(zip(*flush(shard, before)))
                part = b.slice(begin, at - begin)
                types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in keep] + [pa.array(c, type=t) for c, t in zip(cols, types)],
                    names=keep + ["n_words", "starts", "ends", "items"])

    return rows.mapInArrow(run, schema)


def removal_spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES, shard_words: int = SHARD_WORDS,
                  piece_words: int = PIECE_WORDS) -> DataFrame:
    """``id, tkey, n_words, starts, ends, items`` per row of ``docs``: merged spans of covered words
    (end exclusive) and the sorted names of the items with an occurring phrase."""
    items = benchmark.select(F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("null")).alias("name"),
                             F.col(f"`{item_text_col}`").cast("string").cast("binary").alias("body"))
    items = materialize(_pieces(items, window, piece_words), "phrases")
    size = items.agg(F.sum(F.octet_length("body") + F.octet_length("name"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    none = F.array().cast("array<long>")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_key(f"`{text_col}`").alias("tkey"),
                       F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"),
                       none.alias("starts"), none.alias("ends"), F.array().cast("array<string>").alias("items"))
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("name", "piece"), F.lit(blocks)) == k) if blocks > 1 else items
        phrases = Phrases([(r["name"], r["body"] and bytes(r["body"])) for r in block.collect()], window)
        rows = _pass(rows, phrases, k == blocks - 1, shard_words)
    return rows


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Per row: id, tkey, n_words, n_hit, n_items, items, starts, ends, contaminated."""
    d = removal_spans(docs, benchmark, **options)
    hit = F.aggregate(F.zip_with("starts", "ends", lambda s, e: e - s), F.lit(0).cast("long"), lambda a, x: a + x)
    return d.select("id", "tkey", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                    "items", "starts", "ends", (F.size("starts") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      **options) -> DataFrame:
    """``docs`` without the rows in which a phrase occurs; other rows and all columns stay."""
    bad = removal_spans(docs, benchmark, id_col, text_col, **options).where(F.size("starts") > 0) \
        .select(F.col("id").alias("bid"), F.col("tkey").alias("btkey")).distinct()
    cols = docs.columns
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"),
                    F.col(f"`{id_col}`").alias("id"), text_key(f"`{text_col}`").alias("tkey"))
    return d.join(bad, F.col("id").eqNullSafe(F.col("bid")) & (F.col("tkey") == F.col("btkey")), "left_anti") \
        .select("row.*")


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return d.select(F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items",
                    F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")
