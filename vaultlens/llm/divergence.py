"""How a source's use of terms diverges from the other sources of its language.

1. Terms are counted per (language, source) in each task, then summed. A language keeps the
   terms that at least ``MIN_DOCS`` of its documents have; they are numbered in UTF-8 order.
2. The counts of a group over its language's term ids are the leaves of a segment tree. The
   ids are cut into aligned ranges of ``LEAVES``; a task has one range of the trees of two
   tiles of ``TILE`` groups each, so no task holds a whole tree, or all groups of a language.
3. The subtrees of a task are hash-consed: level by level from the leaves, a subtree is known
   by its pair of children, and equal ones are one node, in whichever group or place.
4. Two groups' trees are walked at the same time from their roots, all pairs of groups of the
   task together. A (pair of groups, node, node) that came up already is not walked again;
   a pair of leaves is priced once, and the prices are added up along the same way back.
5. The sums over ranges are the divergence of the two groups; a walk of a group against the
   whole language gives the group's own leading terms in the same way.

Probabilities are fixed-point whole numbers, ``p = 1 + floor(SCALE * (count + 2) / (N + 2 V))``
with the group's total N and the language's V kept terms, and the price of two counts is
``floor((p - q)^2 / (p + q))``. All arithmetic is exact for totals up to 9e15.

Defined cases: null texts, languages and sources are read as ''. Every group that occurs has
its rows, also without terms; a language without kept terms gives value 0 for each pair.
Repeated rows are documents of their own. Very long texts are counted whole. Ties in rank go
by the item's UTF-8 bytes. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vaultlens.llm.common import discard, materialize, read_table
from vaultlens.operators.numbering import global_row_number

MIN_DOCS = 10
SCALE = 10 ** 9
TOP = 10
LEAVES = 1 << 11     # term ids of a range
TILE = 32            # groups of a tile
TASK_ENTRIES = 300_000   # (language, source, term) entries a task counts before it passes them on

# ASCII other than letters separates terms; only A-Z are lower-cased.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_TERM_BYTES).split() if text else []


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs`` (columns ``lang, source, text``); a row with a null term and
    the number of documents for every group."""
    def run(batches):
        seen = defaultdict(dict)
        size = 0

        def flush():
            for (lang, source), g in seen.items():
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(g), type=pa.string()), pa.array([source] * len(g), type=pa.string()), pa.array(list(g), type=pa.binary()),
                    pa.array([v >> 32 for v in g.values()], type=pa.int64()), pa.array([v & 0xFFFFFFFF for v in g.values()], type=pa.int64())],
                    names=["lang", "source", "term", "n", "docs"])
            seen.clear()

        for b in batches:
            langs, sources = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lang, source, text in zip(langs, sources, b.column(2)):
                g = seen[lang, source]      # occurrences in the upper bits, documents in the lower 32
                size -= len(g)
                g[None] = g.get(None, 0) + 1
                for t, n in Counter(terms_of(text.as_py())).items():
                    g[t] = g.get(t, 0) + (n << 32 | 1)
                size += len(g)
                if size > TASK_ENTRIES:
                    yield from flush()
                    size = 0
        yield from flush()

    part = docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term binary, n long, docs long")
    return part.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def fixed_point(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``1 + floor(SCALE * (count + 2) / total)``, by long division so that nothing overflows."""
    whole, rest = np.divmod(count + 2, total)
    for _ in range(3):   # three decimal digits at a time
        digit, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digit
    return whole + 1


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


class Forest:
    """Hash-consed segment trees of count rows; ``roots`` has each row's root node."""

    def __init__(self, counts: np.ndarray):
        self.leaves, ids = np.unique(counts, return_inverse=True)
        self.ids = ids = ids.reshape(counts.shape)
        n = len(self.leaves)
        self.levels = []   # from the leaves up: the children (left, right) of each node
        while ids.shape[1] > 1:
            nodes, ids_up = np.unique(ids[:, 0::2] * n + ids[:, 1::2], return_inverse=True)
            ids = ids_up.reshape(len(counts), -1)
            self.levels.append((nodes // n, nodes % n))
            n = len(nodes)
        self.roots = ids[:, 0]

    def walk(self, a: np.ndarray, b: np.ndarray, leaf_values) -> tuple:
        """Walks the trees with roots ``a[i]`` and ``b[i]`` together, for every pair ``i``. Returns the
        sums per pair, and the visited leaf pairs as ``(pair, leaf of a, leaf of b, value)``;
        ``leaf_values(pair, count, count)`` prices them. Equal triples are visited once."""
        pair, way = np.arange(len(a)), []
        for left, right in reversed(self.levels):
            n = max(int(left.max()), int(right.max())) + 1
            key = np.concatenate([(pair * n + left[a]) * n + left[b], (pair * n + right[a]) * n + right[b]])
            key, back = np.unique(key, return_inverse=True)
            way.append(back)
            pair, a, b = key // (n * n), key // n % n, key % n
        value = leaf_values(pair, self.leaves[a], self.leaves[b])
        sums = value
        for back in reversed(way):
            half = len(back) // 2
            sums = sums[back[:half]] + sums[back[half:]]
        return sums, (pair, a, b, value)


def _range_sums(f: pd.DataFrame) -> pd.DataFrame:
    """One range of the trees of two tiles: ``part, sid, other, offset, value``; ``part`` 0 is the
    sum for two groups, 1 a leading term of one group. Rows with offset -1 name a group and carry its total."""
    head = f[f["offset"] < 0].drop_duplicates("sid").sort_values("sid")
    sid, tile, total = (head[c].to_numpy() for c in ("sid", "tile", "n"))
    width = int(f["width"].iloc[0])
    counts = np.zeros((len(sid), 1 << max(0, width - 1).bit_length()), dtype=np.int64)
    counts[:, width:] = -1    # past the language's last term: worth nothing
    leaf = f[f["offset"] >= 0]
    counts[np.searchsorted(sid, leaf["sid"].to_numpy()), leaf["offset"].to_numpy()] = leaf["n"].to_numpy()
    forest = Forest(counts)

    def priced(i, j):
        def values(pair, a, b):
            p, q = fixed_point(a, total[i][pair]), fixed_point(b, total[j][pair])
            return np.where((a < 0) | (b < 0), 0, price(p, q))
        return forest.walk(forest.roots[i], forest.roots[j], values)

    ti, tj = int(f["ti"].iloc[0]), int(f["tj"].iloc[0])
    own = sid >= 0     # -1 is the whole language
    i, j = (x.ravel() for x in np.meshgrid(np.flatnonzero(own & (tile == ti)), np.flatnonzero(own & (tile == tj)), indexing="ij"))
    i, j = (i[i < j], j[i < j]) if ti == tj else (i, j)
    out = []
    if len(i):
        sums, _ = priced(i, j)
        out.append(pd.DataFrame({"part": 0, "sid": sid[i], "other": sid[j], "offset": -1, "value": sums}))
    if ti == tj and own.any():
        i = np.flatnonzero(own)
        j = np.zeros(len(i), dtype=np.int64)     # the language sorts first
        _, (pair, a, b, value) = priced(i, j)
        more = fixed_point(forest.leaves[a], total[i][pair]) > fixed_point(forest.leaves[b], total[j][pair])
        lead = (forest.leaves[a] > 0) & more
        floor = _floors(pair[lead], value[lead], len(i))
        n = len(forest.leaves)
        for k, g in enumerate(i):
            # The leaf pairs that can lead, from the memo; their terms are where the two leaves stand.
            sel = lead & (pair == k) & (value >= floor[k])
            pairs, v = a[sel] * n + b[sel], value[sel]     # sorted, as the walk leaves them
            here = forest.ids[g] * n + forest.ids[0]
            at = np.flatnonzero(np.isin(here, pairs))
            v = v[np.searchsorted(pairs, here[at])]
            best = np.lexsort((at, -v))[:TOP]
            out.append(pd.DataFrame({"part": 1, "sid": sid[g], "other": -1, "offset": at[best], "value": v[best]}))
    keys = {c: f[c].iloc[0] for c in ("lang", "block")}
    rows = pd.concat(out) if out else pd.DataFrame({c: [] for c in ("part", "sid", "other", "offset", "value")}, dtype="int64")
    return rows.assign(**keys)[["lang", "block", "part", "sid", "other", "offset", "value"]]


def _floors(pair: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Per pair, the TOP-th largest of the values (below it no term can lead), or 0."""
    order = np.lexsort((-value, pair))
    pair, value = pair[order], value[order]
    start = np.searchsorted(pair, np.arange(n))
    place = np.arange(len(pair)) - start[pair] if len(pair) else pair
    out = np.zeros(n, dtype=np.int64)
    nth = place == TOP - 1
    out[pair[nth]] = value[nth]
    return out


def divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
               min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every group (see the module's text)."""
    read = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    counts = materialize(term_counts(docs.select(read(lang_col).alias("lang"), read(source_col).alias("source"),
                                                 F.col(f"`{text_col}`").cast("string").alias("text"))), "terms")
    known = counts.where(F.col("term").isNotNull())
    kept = known.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all")).where(F.col("docs") >= min_docs)
    # One number over all languages in (language, term) order; a language's ids start at its first.
    numbered = materialize(global_row_number(kept.select("lang", "term", "all"), ["lang", "term"], out="row"), "kept-terms")
    # A language's facts are joined to its vocabulary and groups only; counts get them from there.
    per_lang = materialize(numbered.groupBy("lang").agg(F.min("row").alias("first"), F.count("*").alias("v"), F.sum("all").alias("total")), "languages")
    ids = materialize(numbered.join(per_lang.select("lang", "first", "v"), "lang")
                      .select("lang", "term", "all", (F.col("row") - F.col("first")).alias("id"), "v"), "term-ids")
    leaf = materialize(known.join(ids.select("lang", "term", "id", "v"), ["lang", "term"]).select("lang", "source", "id", "n", "v"), "leaves")
    groups = counts.where(F.col("term").isNull()).select("lang", "source")
    sums = leaf.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    by_group = groups.join(sums, ["lang", "source"], "left").select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"))
    by_group = global_row_number(by_group, ["lang", "source"], out="row")
    first = by_group.groupBy("lang").agg(F.min("row").alias("first"), F.count("*").alias("groups"))
    sid = materialize(by_group.join(first, "lang").select("lang", "source", "n", (F.col("row") - F.col("first")).alias("sid"), "groups"), "groups")

    shape = per_lang.select("lang", "v", "total", F.ceil(F.col("v") / LEAVES).alias("blocks"))
    base = sid.join(shape, "lang").select("lang", "sid", "groups", (F.col("n") + 2 * F.col("v")).alias("d"), "v", "blocks")
    whole = base.where("sid = 0").join(shape.select("lang", "total"), "lang").select(
        "lang", F.lit(-1).cast("long").alias("sid"), "groups", (F.col("total") + 2 * F.col("v")).alias("d"), "v", "blocks")
    heads = base.unionByName(whole).select(
        "lang", "sid", "groups", "v", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
        F.lit(-1).alias("offset"), F.col("d").alias("n"))
    own = leaf.join(sid.select("lang", "source", "sid", "groups"), ["lang", "source"]).select("lang", "sid", "groups", "id", "n", "v")
    of_all = ids.join(sid.where("sid = 0").select("lang", "groups"), "lang")
    own = own.unionByName(of_all.select("lang", F.lit(-1).cast("long").alias("sid"), "groups", "id", F.col("all").alias("n"), "v"))
    leaves = own.select(
        "lang", "sid", "groups", "v", F.floor(F.col("id") / LEAVES).alias("block"), (F.col("id") % LEAVES).cast("int").alias("offset"), "n")
    rows = heads.unionByName(leaves).withColumn("tile", F.floor(F.col("sid") / TILE))
    last = F.floor((F.col("groups") - 1) / TILE)
    # A group meets every tile once, as the tile pair (smaller, larger); the whole language each tile by itself.
    rows = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("with"))
    mine = F.when(F.col("sid") < 0, F.col("with")).otherwise(F.col("tile"))
    rows = rows.select("lang", "block", F.least(mine, "with").alias("ti"), F.greatest(mine, "with").alias("tj"), "sid", "tile",
                       "offset", "n", F.least(F.lit(LEAVES), F.col("v") - F.col("block") * LEAVES).cast("int").alias("width"))
    found = materialize(rows.groupBy("lang", "block", "ti", "tj").applyInPandas(
        _range_sums, "lang string, block long, part int, sid long, other long, offset long, value long"), "range-sums")

    names = sid.select("lang", "sid", "source")
    a, b = (names.select(F.col("lang"), F.col("sid").alias(x), F.col("source").alias(y)) for x, y in (("a", "source"), ("b", "item")))
    both = found.where("part = 0").groupBy("lang", F.col("sid").alias("a"), F.col("other").alias("b")).agg(F.sum("value").alias("value"))
    both = both.unionByName(both.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    # A language without kept terms has no range; its pairs are worth 0.
    bare = sid.join(shape.select("lang"), "lang", "left_anti")
    none = bare.select("lang", F.col("sid").alias("a"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("b"),
                       F.lit(0).cast("long").alias("value")).where("a <> b")
    pair = both.unionByName(none).join(a, ["lang", "a"]).join(b, ["lang", "b"]).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value")
    by_value = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    pair = pair.withColumn("rank", F.row_number().over(by_value))
    word = ids.select(F.col("lang"), F.col("id"), F.decode("term", "UTF-8").alias("item"))
    # Ids are in UTF-8 order, so the leading ids are the leading terms.
    by_id = Window.partitionBy("lang", "sid").orderBy(F.col("value").desc(), "id")
    lead = found.where("part = 1").select("lang", "sid", (F.col("block") * LEAVES + F.col("offset")).alias("id"), "value") \
        .withColumn("rank", F.row_number().over(by_id)).where(F.col("rank") <= TOP)
    term = lead.join(names, ["lang", "sid"]).join(word, ["lang", "id"]).select(
        "lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    out = materialize(pair.unionByName(term), "divergence")
    discard(counts, leaf, found)
    return out


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(read_table(spark, sf_dir, "documents"))
