"""Embedding near-duplicates: iterative quantisation, multi-index Hamming tables, exact rerank.

1. Equal vectors collapse to one representative with a weight.
2. Iterative quantisation (ITQ) on the ``SAMPLE`` representatives with the smallest hashes, a
   documented bound: the centred sample is turned to its principal axes, then a rotation is
   learned by alternating between the binary codes ``sign(VR)`` and the rotation that brings
   ``VR`` closest to them, so the bits are balanced. One rotation gives at most 64 bits.
3. Multi-index Hamming tables: the codes are cut into substrings of about ``log2(n / BUCKET)``
   bits, one table each. Two vectors meet in a table if their substrings are equal, so with
   ``t`` tables every pair that differs in fewer than ``t`` bits meets. Rotations are added
   until, of pairs made from the sample with a cosine of exactly the threshold, ``RECALL``
   meet; pairs above the threshold meet more often.
4. Dense groups: in buckets of more than ``HOT`` vectors a pivot (the mean) is taken. Vectors
   within half the threshold's angle of one pivot form a ball; by the triangle inequality any
   two of them are linked, so a ball of any size costs one count and one star of edges, not
   its pairs. A vector joins the largest ball it fits in.
5. Rerank: the other pairs of a bucket are compared by their original vectors in double
   precision, in blocks of about ``BLOCK`` vectors on all executors. A pair counts in the
   first table in which it meets. A block pair gives out one row per linked vector (its
   number of links, and the smallest vector of its component there), never the pairs.
6. Distributed union-find over these rows.

Nothing depends on labels. A link below the threshold is never made; links are lost only
where a pair meets in no table.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite component link
with nothing. Vectors of different lengths do not link. Repeated rows are rows of their own
and link like equal vectors. A null id never names a component unless all its members have
null ids; ``kept`` compares null-safely. Other columns are neither read nor returned. An
empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultlens.llm.common import discard, materialize, read_table
from vaultlens.llm.components import connected_components

THRESHOLD = 0.95
SAMPLE = 8192      # vectors that the rotations are learned from
RECALL = 0.995     # share of the pairs at the threshold that must meet
ROTATIONS = 50     # if so many do not reach RECALL, the substrings become one bit shorter
BUCKET = 256       # vectors an even table has in a bucket: larger ones need fewer tables, so less is shuffled
HOT = 1024         # a bucket with more vectors may have a ball
BLOCK = 1024       # vectors of a block
SLICE = 64         # vectors of a block that are compared with the other block at a time
ITERATIONS = 30
_SLACK = 1e-9      # a ball's radius stays this much (cosine) inside the bound


def unit_rows(vectors: list[np.ndarray], width: int) -> np.ndarray:
    """The vectors as rows of length one, filled up with zeros to ``width``."""
    x = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        x[i, :len(v)] = v
    x /= np.maximum(np.abs(x).max(axis=1, initial=0.0, keepdims=True), np.finfo(float).tiny)   # no overflow in the squares
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), np.finfo(float).tiny)


def learn_rotation(x: np.ndarray, bits: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """ITQ: ``mean, R`` such that the code of ``v`` is ``(v - mean) @ R > 0``."""
    mean = x.mean(axis=0)
    _, axes = np.linalg.eigh((x - mean).T @ (x - mean))
    axes = axes[:, ::-1][:, :bits]
    v = (x - mean) @ axes
    r = np.linalg.qr(rng.standard_normal((v.shape[1], v.shape[1])))[0]
    for _ in range(ITERATIONS):
        u, _, w = np.linalg.svd(v.T @ np.where(v @ r > 0, 1.0, -1.0))
        r = u @ w
    return mean, axes @ r


def substrings(x: np.ndarray, model: list, width: int) -> np.ndarray:
    """One column per table: the number that the table's bits of each row's codes make up."""
    out = []
    for mean, r in model:
        bits = (x - mean) @ r > 0
        if not width:                                   # one bucket for all
            return np.zeros((len(x), 1), dtype=np.int64)
        for s in range(0, bits.shape[1] - width + 1, width):
            out.append(bits[:, s:s + width] @ (1 << np.arange(width, dtype=np.int64)))
    return np.stack(out, axis=1)


def learn_tables(sample: np.ndarray, n: int, threshold: float, recall: float = RECALL, seed: int = 11) -> tuple[list, int]:
    """Rotations and the substring width for ``n`` vectors (see the module's text, 2 and 3)."""
    rng = np.random.default_rng(seed)
    bits = min(64, sample.shape[1])
    width = min(bits, int(math.log2(max(n / BUCKET, 1))))
    noise = rng.standard_normal(sample.shape) * (sample != 0)   # the zeros that fill short vectors up stay
    noise -= (noise * sample).sum(axis=1, keepdims=True) * sample
    noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-12)
    other = threshold * sample + math.sqrt(1 - threshold ** 2) * noise
    model, met = [], np.zeros(len(sample), dtype=bool)
    while met.mean() < recall:
        if len(model) == ROTATIONS:
            model, met, width = [], np.zeros(len(sample), dtype=bool), width - 1
        model.append(learn_rotation(sample, bits, rng))
        met |= (substrings(sample, model[-1:], width) == substrings(other, model[-1:], width)).any(axis=1)
    return model, width


def _usable(v) -> "F.Column":
    """No null, NaN or infinite component, and one that is not zero."""
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return F.coalesce(finite, F.lit(False)) & F.exists(v, lambda c: c != 0)


def _array(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.zeros((0, 0))


def _coded(reps: DataFrame, model: list, width: int, dim: int) -> DataFrame:
    """``node, weight, len, unit, keys``: the unit vector and its bucket in every table."""
    def run(frames):
        for f in frames:
            v = [np.asarray(e, dtype=float) for e in f["embedding"]]
            x = unit_rows(v, dim)
            yield pd.DataFrame({"node": f["node"], "weight": f["weight"], "len": [len(e) for e in v],
                                "unit": list(x), "keys": list(substrings(x, model, width))})

    return reps.select("node", "weight", "embedding").mapInPandas(
        run, "node long, weight long, len int, unit array<double>, keys array<long>")


def _balls(coded: DataFrame, threshold: float) -> DataFrame:
    """``node, ball`` for the vectors that lie in a ball; a ball is named by its smallest node."""
    at = coded.select("node", "len", F.posexplode("keys").alias("t", "key"))
    hot = at.groupBy("len", "t", "key").agg(F.count("*").alias("n")).where(F.col("n") > HOT)
    inside = materialize(at.join(hot, ["len", "t", "key"]).select("node", "t", "key", "len"), "itq-hot")
    parts = inside.join(coded.select("node", "unit"), "node").select(
        "len", "t", "key", F.posexplode("unit").alias("axis", "x"))
    pivot = (parts.groupBy("len", "t", "key", "axis").agg(F.sum("x").alias("x"))
             .groupBy("len", "t", "key").agg(F.array_sort(F.collect_list(F.struct("axis", "x"))).alias("s"))   # one entry an axis
             .select("len", "t", "key", F.col("s.x").alias("pivot")))
    # The pivot of a bucket meets its members; both sides are shuffled, so a hot bucket can be split.
    near = inside.join(materialize(pivot, "itq-pivots"), ["len", "t", "key"]).join(coded.select("node", "unit"), "node")
    limit = math.cos(math.acos(threshold) / 2) + _SLACK

    def fits(frames):
        for f in frames:
            u, p = _array(f["unit"]), _array(f["pivot"])
            ok = (u * p).sum(axis=1) >= limit * np.linalg.norm(p, axis=1) if len(f) else np.zeros(0, dtype=bool)
            yield f.loc[ok, ["node", "len", "t", "key"]]

    fit = materialize(near.select("node", "len", "t", "key", "unit", "pivot").mapInPandas(
        fits, "node long, len int, t int, key long"), "itq-fits")
    size = fit.groupBy("len", "t", "key").agg(F.count("*").alias("size"))
    best = materialize(fit.join(size, ["len", "t", "key"]).groupBy("node").agg(
        F.max(F.struct("size", "len", "t", "key")).alias("b")), "itq-best")
    name = best.groupBy("b").agg(F.min("node").alias("ball"))
    out = materialize(best.join(name, "b").select("node", "ball"), "itq-balls")
    discard(inside, fit)
    return out


def _block_links(frames, threshold: float):
    """Rows sorted by block pair -> ``node, links, root`` of the block pair's linked vectors."""
    held = None
    cols = ["group", "side", "node", "weight", "t", "ball", "unit", "keys"]
    for f in frames:
        f = f[cols]
        if held is not None:
            f = pd.concat([held, f], ignore_index=True)
        if not len(f):
            continue
        g = f["group"].to_numpy()
        cut = int(np.searchsorted(g == g[-1], True)) if g[0] != g[-1] else 0
        held = f.iloc[cut:]
        yield _linked(f.iloc[:cut], threshold)
    if held is not None and len(held):
        yield _linked(held, threshold)


def _linked(f: pd.DataFrame, threshold: float) -> pd.DataFrame:
    out = []
    if len(f):
        units, keys = _array(f["unit"]), _array(f["keys"])
        group, side = f["group"].to_numpy(), f["side"].to_numpy()
        node, weight, table, ball = (f[c].to_numpy() for c in ("node", "weight", "t", "ball"))
        edges = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])
        for lo, hi in zip(edges, edges[1:]):
            a = np.arange(lo, hi)[side[lo:hi] != 2]     # 0: both blocks are the same one; 1 and 2: the two blocks
            b = a if side[lo] == 0 else np.arange(lo, hi)[side[lo:hi] == 2]
            links, root = np.zeros(hi - lo, dtype=np.int64), node[lo:hi].copy()
            for s in range(0, len(a), SLICE):
                i, j = np.nonzero(units[a[s:s + SLICE]] @ units[b].T >= threshold)
                i, j = a[s:s + SLICE][i], b[j]
                t = table[lo]
                ok = ((i < j) | (side[i] == 1)) & ((ball[i] < 0) | (ball[i] != ball[j])) & (keys[i, t] == keys[j, t])
                i, j = i[ok], j[ok]
                first = ~(keys[i, :t] == keys[j, :t]).any(axis=1)
                i, j = i[first], j[first]
                np.add.at(links, i - lo, weight[j])
                np.add.at(links, j - lo, weight[i])
                while len(i):                             # joins the components of this slice's pairs
                    ri, rj = root[i - lo], root[j - lo]
                    apart = ri != rj
                    if not apart.any():
                        break
                    # The larger root of a pair becomes the smaller one everywhere it names a component.
                    big, small = np.maximum(ri, rj)[apart], np.minimum(ri, rj)[apart]
                    names, at = np.unique(big, return_inverse=True)
                    low = np.full(len(names), np.iinfo(np.int64).max)
                    np.minimum.at(low, at, small)
                    place = np.minimum(np.searchsorted(names, root), len(names) - 1)
                    root = np.where(names[place] == root, low[place], root)
            has = links > 0
            out.append((node[lo:hi][has], links[has], root[has]))
    parts = [np.concatenate(c) for c in zip(*out)] or [np.zeros(0, dtype=np.int64)] * 3
    return pd.DataFrame(dict(zip(("node", "links", "root"), parts)))


def _blocked(coded: DataFrame, balls: DataFrame) -> DataFrame:
    """Vectors dealt to the block pairs of their buckets. A bucket's blocks hold vectors of one
    ball, or of none; blocks of the same ball are not paired."""
    rows = coded.join(balls, "node", "left")
    at = rows.select("node", "len", F.posexplode("keys").alias("t", "key"), "ball")
    bucket = ["len", "t", "key"]
    sizes = at.groupBy(*bucket, "ball").agg(F.count("*").alias("n"))
    blocks = sizes.select(*bucket, "ball", "n", F.ceil(F.col("n") / BLOCK).cast("int").alias("k"))
    ball_no = F.coalesce("ball", F.lit(-1).cast("long"))
    # Buckets of one vector, and of one ball alone, have nothing to compare.
    listed = blocks.groupBy(*bucket).agg(
        F.sum("n").alias("total"), F.count("*").alias("kinds"), F.max(F.col("ball").isNull()).alias("free"),
        F.array_sort(F.collect_list(F.struct(ball_no.alias("ball"), "k"))).alias("kinds_of"))
    listed = listed.where((F.col("total") > 1) & ((F.col("kinds") > 1) | F.col("free"))).drop("total", "kinds", "free")
    place = at.select("node", *bucket, ball_no.alias("ball")).join(materialize(listed, "itq-buckets"), bucket)
    mine = F.element_at(F.filter("kinds_of", lambda s: s["ball"] == F.col("ball")), 1)["k"]
    place = place.withColumn("block", F.pmod(F.xxhash64("node"), mine).cast("int"))
    others = F.flatten(F.transform("kinds_of", lambda s: F.when(
        (s["ball"] == -1) | (s["ball"] != F.col("ball")),
        F.transform(F.sequence(F.lit(0), s["k"] - 1), lambda b: F.struct(s["ball"].alias("ball"), b.alias("block"))))
        .otherwise(F.array().cast("array<struct<ball:bigint,block:int>>"))))
    dealt = place.select("node", *bucket, "ball", "block", F.explode(others).alias("o"))
    own = F.struct(F.col("ball"), F.col("block"))
    side = F.when(own == F.col("o"), 0).when(own < F.col("o"), 1).otherwise(2)
    group = F.xxhash64(*bucket, F.least(own, F.col("o")), F.greatest(own, F.col("o")))
    return dealt.select(group.alias("group"), side.alias("side"), "node", "t", "ball").join(
        coded.select("node", "weight", "unit", "keys"), "node")


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                 threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``id, n_links, component`` per row: the other rows linked directly, and the smallest id
    reachable through links, the own one included."""
    src = rows.select(F.col(f"`{id_col}`").alias("id"),
                      F.transform(F.col(f"`{vec_col}`"), lambda c: c.cast("double")).alias("embedding")) \
        .withColumn("usable", F.coalesce(_usable(F.col("embedding")), F.lit(False)))
    reps = src.where("usable").groupBy("embedding").agg(F.count("*").alias("weight"), F.min("id").alias("first_id"))
    reps = materialize(reps.withColumn("node", F.monotonically_increasing_id()), "itq-vectors")
    size = reps.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("dim")).first()
    own = F.col("id").alias("component")
    alone = src.where(~F.col("usable")).select("id", F.lit(0).cast("long").alias("n_links"), own)
    if not size.n:
        return alone
    sample = [np.asarray(r.embedding) for r in
              reps.select("embedding").orderBy(F.xxhash64("embedding"), "embedding").limit(SAMPLE).collect()]
    model, width = learn_tables(unit_rows(sample, size.dim), size.n, threshold, recall)
    coded = materialize(_coded(reps, model, width, size.dim), "itq-codes")
    balls = _balls(coded, threshold)
    dealt = _blocked(coded, balls)
    found = materialize(dealt.repartition("group").sortWithinPartitions("group", "side").mapInPandas(
        lambda frames: _block_links(frames, threshold), "node long, links long, root long"), "itq-links")
    held = coded.select("node", "weight").join(balls, "node")
    total = materialize(held.groupBy("ball").agg(F.sum("weight").alias("all")), "itq-ball")
    in_ball = held.join(total, "ball").select("node", (F.col("all") - F.col("weight")).alias("links"), F.col("ball").alias("root"))
    each = found.unionByName(in_ball)
    degree = each.groupBy("node").agg(F.sum("links").alias("links"))
    root = connected_components(each.select("node", F.col("root").alias("to")), "node", "to")
    named = reps.select("node", "first_id").join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    label = named.groupBy("root").agg(F.min("first_id").alias("component"))
    by_node = materialize(named.join(label, "root").join(degree, "node", "left").select(
        "node", "component", F.coalesce("links", F.lit(0)).alias("links")), "itq-labels")
    # Written first, so that the last join reads two plain shuffles and AQE can split a hot vector.
    labels = materialize(reps.join(by_node, "node").select("embedding", "weight", "component", "links"), "itq-by-vector")
    linked = src.where("usable").join(labels, "embedding").select(
        "id", (F.col("links") + F.col("weight") - 1).alias("n_links"), "component")
    discard(coded, found)
    return linked.unionByName(alone)


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = near_vectors(read_table(spark, sf_dir, "embeddings"))
    return near.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
                       F.col("id").eqNullSafe(F.col("component")).alias("kept"))
