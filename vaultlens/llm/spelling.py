"""Spelling variants: words one edit apart, and the frequent form each rare one stands for.

1. Words are runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased. Where the CRC-32 of
   ``<doc_id>:<run>`` is a multiple of ``DROP``, the document's run loses one code point
   (at ``crc % length``). Words of ``MIN_CHARS`` code points and ``MIN_COUNT`` occurrences count.
2. The vocabulary is cut into parts that lose no pair. An edit changes one of ``PIECES``
   stretches of a word and leaves the rest, so two words one edit apart agree outside one
   stretch. For the length ``c`` of the shorter word, both have the same key ``(c, stretch,
   rest)``; a word has keys for its own length and for one less. A part holds different words
   that agree in about two thirds of their characters, so no single frequent word makes it large.
3. Bit-sliced position index over a run of parts (at least ``CHUNK`` words): for each (position,
   letter) a bitset of the words with that letter there. All words of the run are looked up
   at once: while a query is read letter by letter, four bitsets a query track the words read
   with no error, and those with one replaced, one more or one letter less so far; the latter two
   use the index shifted by one position. One step is a few word-parallel operations.
4. A pair counts in the first stretch whose key it shares, so it counts once. Each word's near
   words are summed up and its most frequent one kept, in Spark.
5. Forms are followed to their root by pointer doubling, as written tables; a form is at least
   ``FACTOR`` times as frequent as its word, so the rounds are few.

Defined cases: a null or empty text has no words; a null id is read as the empty text in the
key of the CRC; repeated rows are occurrences of their own; ties between forms go to the
smallest word in code-point order; words of any length take part whole; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultlens.llm.common import discard, materialize, read_table

DROP = 31
MIN_CHARS = 7
MIN_COUNT = 2
FACTOR = 10
PIECES = 3
CHUNK = 2048           # words of a run of parts, and queries looked up together
RUN_CHARS = 64         # a run with longer words than these on average is cut earlier
TASK_WORDS = 300_000   # different words a task counts before it passes them on

# In Latin-1, one byte a code point: the letters stay, A-Z are lower-cased, all else separates.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def runs_of(text: str | None) -> list[bytes]:
    """The lower-cased runs, in Latin-1. Characters beyond it separate, as all other non-letters do."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split() if text else []


def words_of(doc_id, text: str | None, min_chars: int = MIN_CHARS, drop: int = DROP) -> Counter:
    """The document's words (Latin-1) and their occurrences."""
    out = Counter()
    start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(w for w in runs_of(text) if len(w) >= min_chars).items():
        h = crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % drop == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        if len(run) >= min_chars:
            out[run] += n
    return out


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, drop: int = DROP) -> DataFrame:
    """``word, n`` over all documents; counted in each task first, ``TASK_WORDS`` words at a time."""
    def run(batches):
        seen = Counter()

        def flush():
            words = pa.array([w.decode("latin-1") for w in seen], type=pa.string())
            out = pa.RecordBatch.from_arrays([words, pa.array(list(seen.values()), type=pa.int64())], names=["word", "n"])
            seen.clear()
            return out

        for b in batches:
            for doc_id, text in zip(b.column(0), b.column(1)):
                seen.update(words_of(doc_id.as_py(), text.as_py(), min_chars, drop))
                if len(seen) > TASK_WORDS:
                    yield flush()
        yield flush()

    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return src.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _keys(word: Column, c: Column) -> Column:
    """The key of each stretch for pairs whose shorter word has ``c`` characters (hashes; equal
    hashes of different rests only put words into one part that are then found not to be near)."""
    edge = [F.floor(c * i / PIECES).cast("int") for i in range(PIECES + 1)]
    return F.array(*[F.xxhash64(c, F.lit(i), F.substring(word, F.lit(1), edge[i]),
                                F.right(word, c - edge[i + 1])) for i in range(PIECES)])


def _bits(rows: np.ndarray, cols: np.ndarray, n_rows: int, n_cols: int) -> np.ndarray:
    """Bitsets (one a row, 64 columns a word) with the given places set."""
    out = np.zeros((n_rows, (n_cols + 63) // 64), dtype=np.uint64)
    np.bitwise_or.at(out, (rows, cols >> 6), np.uint64(1) << (cols & 63).astype(np.uint64))
    return out


class PositionIndex:
    """Bitsets over a list of Latin-1 words, per (position, letter) and per length."""

    def __init__(self, words: list[bytes]):
        self.len = np.array([len(w) for w in words], dtype=np.int64)
        self.n, self.longest = len(words), int(self.len.max())
        letters = np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int64)
        word = np.repeat(np.arange(self.n), self.len)
        place = np.arange(len(letters)) - np.repeat(np.cumsum(self.len) - self.len, self.len)
        self.letters = np.zeros((self.n, self.longest), dtype=np.uint8)
        self.letters[word, place] = letters
        self.known, row = np.unique(place * 256 + letters, return_inverse=True)
        # One row more, empty, stands for all that no word has.
        self.at = _bits(row, word, len(self.known) + 1, self.n)
        self.length = _bits(self.len, np.arange(self.n), self.longest + 2, self.n)
        # Words with a letter at position p: those longer than p.
        self.longer = np.bitwise_or.accumulate(self.length[::-1], axis=0)[::-1]
        self.longer = np.concatenate([self.longer[1:], np.zeros_like(self.longer[:2])])

    def rows(self, place: int, letters: np.ndarray) -> np.ndarray:
        key = place * 256 + letters.astype(np.int64)
        i = np.searchsorted(self.known, key)
        hit = (i < len(self.known)) & (self.known[np.minimum(i, len(self.known) - 1)] == key)
        return self.at[np.where(hit, i, len(self.known))]

    def near(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(query, word)`` numbers of all pairs that differ by exactly one edit."""
        q = queries[np.argsort(self.len[queries], kind="stable")]
        length, letters = self.len[q], self.letters[q]
        shape = (len(q), self.at.shape[1])
        same = np.broadcast_to(np.bitwise_or.reduce(self.length, axis=0), shape).copy()   # no error so far
        swap = np.zeros(shape, dtype=np.uint64)                                           # one letter replaced
        more = np.broadcast_to(self.longer[0], shape).copy()                              # the word has one more
        less = np.zeros(shape, dtype=np.uint64)                                           # the word has one less
        out = np.zeros(shape, dtype=np.uint64)
        done = 0
        for i in range(int(length[-1])):
            c = letters[done:, i]
            here, after = self.rows(i, c), self.rows(i + 1, c)
            s = same[done:]
            less[done:] = s | (less[done:] & self.rows(i - 1, c) if i else np.uint64(0))
            swap[done:] = (swap[done:] & here) | (s & ~here & self.longer[i])
            same[done:] = s & here
            more[done:] = (more[done:] & after) | (same[done:] & self.longer[i + 1])
            end = int(np.searchsorted(length, i + 1, side="right"))
            if end > done:
                f = slice(done, end)
                out[f] = (swap[f] & self.length[i + 1]) | (less[f] & self.length[i]) | (
                    more[f] & (self.length[i + 2] if i + 2 < len(self.length) else np.uint64(0)))
                done = end
        a, w = np.nonzero(out)
        bits = np.unpackbits(out[a, w].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        k, bit = np.nonzero(bits)
        return q[a[k]], w[k] * 64 + bit


def _run_links(f: pd.DataFrame):
    """The near pairs of a run of parts, summed up per word: ``word, n_near, n, form``."""
    f = f[f["part"].duplicated(keep=False)]     # a part of one word has no pair
    if not len(f):
        return
    text = f["word"].to_numpy(dtype=object)
    words = [w.encode("latin-1") for w in text]
    part, piece, n, c = (f[x].to_numpy() for x in ("part", "piece", "n", "c"))
    keys = np.stack(f["keys"].to_numpy())
    index = PositionIndex(words)
    rank = np.argsort(np.argsort(np.array(words, dtype=object)))    # Latin-1 words in byte order are in code-point order
    for lo in range(0, len(words), CHUNK):
        a, b = index.near(np.arange(lo, min(lo + CHUNK, len(words))))
        ok = (part[a] == part[b]) & (np.minimum(index.len[a], index.len[b]) == c[a])
        a, b = a[ok], b[ok]
        shared = (keys[a] == keys[b]) & (np.arange(PIECES) < piece[a][:, None])
        a, b = a[~shared.any(axis=1)], b[~shared.any(axis=1)]
        if not len(a):
            continue
        order = np.lexsort((rank[b], -n[b], a))
        a, b = a[order], b[order]
        first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
        yield pd.DataFrame({"word": text[a[first]], "n_near": np.diff(np.r_[first, len(a)]), "n": n[b[first]], "form": text[b[first]]})


def _runs(f: pd.DataFrame):
    """The rows (whole parts, shorter words first) in runs of at least ``CHUNK`` rows; long words
    make shorter runs, so that a run's table of letters stays small."""
    part, c = f["part"].to_numpy(), f["c"].to_numpy()
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    lo = 0
    for s in starts[1:].tolist():
        if s - lo >= CHUNK or (s - lo) * int(c[s]) > CHUNK * RUN_CHARS:
            yield f.iloc[lo:s]
            lo = s
    yield f.iloc[lo:]


def _part_links(frames):
    """Rows sorted by part -> the links of runs of whole parts."""
    held = None
    for f in frames:
        f = f if held is None else pd.concat([held, f], ignore_index=True)
        part = f["part"].to_numpy()
        cut = int(np.argmax(part == part[-1])) if len(part) else 0     # the last part may go on
        if cut >= CHUNK:
            for run in _runs(f.iloc[:cut]):
                yield from _run_links(run)
            f = f.iloc[cut:]
        held = f
    if held is not None and len(held):
        for run in _runs(held):
            yield from _run_links(run)


def near_words(vocab: DataFrame) -> DataFrame:
    """``word, n_near, best`` for the words of ``vocab`` (``word, n``) that have near words; ``best`` is the
    most frequent one, as ``(-n, form)``."""
    size = F.length("word")
    own = vocab.select("word", "n", F.explode(F.array(size, size - 1)).alias("c"))
    keyed = own.select("word", "n", "c", _keys(F.col("word"), F.col("c")).alias("keys"))
    parts = keyed.select("word", "n", "c", "keys", F.posexplode("keys").alias("piece", "part"))
    dealt = parts.repartition("part").sortWithinPartitions("c", "part")
    links = dealt.select("word", "n", "c", "keys", "piece", "part").mapInPandas(_part_links, "word string, n_near long, n long, form string")
    return links.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("n")).alias("n"), "form")).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form`` (one form a word, no cycles), by pointer doubling: each
    round a word takes over the form of its form, until no form has one."""
    at = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = materialize(at.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                               F.col("next").isNotNull().alias("moved")), "roots")
        discard(at)
        if new.where("moved").isEmpty():
            return new.select("word", "root")
        at = new.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
             min_count: int = MIN_COUNT, factor: int = FACTOR, drop: int = DROP) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the vocabulary."""
    vocab = materialize(vocabulary(docs, id_col, text_col, min_chars, min_count, drop), "vocabulary")
    near = near_words(vocab).select(F.col("word").alias("near_of"), "n_near", (-F.col("best.n")).alias("best_n"), "best.form")
    stands = F.coalesce(F.col("best_n") >= factor * F.col("n"), F.lit(False))
    words = materialize(vocab.join(near, F.col("word") == F.col("near_of"), "left").select(
        "word", F.when(stands, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(stands, F.col("best_n")).alias("form_n")), "variants")
    root = roots(words.where(F.col("form").isNotNull())).select(F.col("word").alias("root_of"), "root")
    out = words.join(root, F.col("word") == F.col("root_of"), "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(read_table(spark, sf_dir, "documents"))
