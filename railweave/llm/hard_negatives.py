"""Hard-negative mining on quantised vectors, filtered by rotated one-bit codes.

Each usable row's components become ``floor(256 * x)``; scores are exact integer inner products.
Anchors (``vec_id`` divisible by ``every``) are a stated query set met by all rows in blocks:
rows are dealt to shards of about ``SHARD_ROWS``, anchors to blocks of about ``ANCHOR_BLOCK``, and
each (shard, block) pair meets in one task, which holds the shard's rows and streams the block.

Inside a task every row has a one-bit code of its rotated vector ``u = R v`` (R a fixed random
rotation): the signs of u, packed into words, and its alignment ``alpha = |u|_1 / sqrt(d)``, the
length of v along its code.  An anchor's rotated vector is cut into four bit planes of 4-bit
levels, so ``<R a, code>`` comes from popcounts.  The estimate's error is bounded without any
sampling: Cauchy-Schwarz gives ``|<a, residual>| <= |a| |residual|`` with
``|residual|^2 = |v|^2 - alpha^2``, and the 4-bit levels add at most ``alpha / sqrt(d)`` times
their L1 error.  Every candidate thus has an interval that surely holds its score; only those
whose interval can still decide the result are scored exactly in integers.

Two passes: the 5 best other rows of the anchor's label (positives), then per positive the 5 best
rows of other labels whose score lies within [0.8, 1] of the positive's.  Each task keeps its
local best; the few per anchor (and positive) are merged by a window.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import parts, store

SHARD_ROWS = 16_384
ANCHOR_BLOCK = 512
LEVELS = 4  # bit planes of an anchor's rotated vector
TOP = 5


def usable_rows(table: DataFrame, relabel_every: int = 7) -> DataFrame:
    """``vec_id, label, dim, q``: rows with an id, a label and a vector of finite components.

    Where ``vec_id`` is divisible by ``relabel_every`` the label becomes ``(label + 1) % 10``.
    Of rows that repeat an id the least (label, vector) counts.
    """
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) != F.lit(float("inf"))))
    ok = table.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & finite)
    label = F.when(F.col("vec_id") % relabel_every == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    q = F.transform(x, lambda v: F.floor(v.cast("double") * 256).cast("long"))
    made = ok.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("int").alias("label"), q.alias("q"))
    least = made.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("m"))
    return least.select("vec_id", "m.label", F.size("m.q").alias("dim"), "m.q")


@lru_cache(maxsize=8)
def rotation(dim: int) -> np.ndarray:
    gauss = np.random.default_rng(7919 + dim).standard_normal((dim, dim))
    r, _ = np.linalg.qr(gauss)
    return r


class Codes:
    """One-bit codes of a shard's rows and the intervals they give for anchors' scores."""

    def __init__(self, q: np.ndarray):
        self.q, self.dim = q, q.shape[1]
        v = q.astype(np.float64)
        u = v @ rotation(self.dim).T
        self.bits = np.packbits(u >= 0, axis=1)
        self.ones = np.bitwise_count(self.bits).sum(1).astype(np.float64)
        self.alpha = np.abs(u).sum(1) / math.sqrt(self.dim)
        self.norm = np.sqrt((v * v).sum(1))
        self.resid = np.sqrt(np.maximum(self.norm ** 2 - self.alpha ** 2, 0))

    def interval(self, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of ``q @ a`` for every row; they hold the exact score."""
        w = rotation(self.dim) @ a.astype(np.float64)
        lo, span = w.min(), w.max() - w.min()
        step = span / (2 ** LEVELS - 1) if span > 0 else 1.0
        k = np.clip(np.floor((w - lo) / step), 0, 2 ** LEVELS - 1).astype(np.int64)
        wq = lo + step * k
        dot = lo * self.ones
        for j in range(LEVELS):
            plane = np.packbits((k >> j) & 1 == 1)
            dot += step * (1 << j) * np.bitwise_count(self.bits & plane).sum(1)
        est = self.alpha / math.sqrt(self.dim) * (2 * dot - wq.sum())
        a_norm = float(np.sqrt((a.astype(np.float64) ** 2).sum()))
        bound = a_norm * self.resid + self.alpha / math.sqrt(self.dim) * np.abs(w - wq).sum() + 1e-9 * a_norm * self.norm + 1.0
        return est - bound, est + bound

    def exact(self, idx: np.ndarray, a: np.ndarray) -> np.ndarray:
        return self.q[idx] @ a


def _best(ids: np.ndarray, scores: np.ndarray, top: int) -> np.ndarray:
    """Positions of the ``top`` highest scores, ties by smaller id, best first."""
    order = np.lexsort((ids, -scores))
    return order[:top]


def _cut(lower: np.ndarray, upper: np.ndarray, sure: np.ndarray, top: int) -> np.ndarray:
    """Mask of candidates that may still be among the ``top`` best: an upper bound below the
    ``top``-th best lower bound of surely valid candidates cannot be."""
    if sure.sum() < top:
        return np.ones(len(lower), bool)
    floor = np.partition(lower[sure], -top)[-top]
    return upper >= floor


def positives_of(codes: Codes, ids, labels, anchor: dict, top: int = TOP):
    a = np.asarray(anchor["q"], np.int64)
    cand = np.flatnonzero((labels == anchor["label"]) & (ids != anchor["vec_id"]))
    if len(cand) == 0:
        return []
    lower, upper = codes.interval(a)
    keep = cand[_cut(lower[cand], upper[cand], np.ones(len(cand), bool), top)]
    scores = codes.exact(keep, a)
    return [(int(ids[keep[i]]), int(scores[i])) for i in _best(ids[keep], scores, top)]


def negatives_of(codes: Codes, ids, labels, anchor: dict, top: int = TOP):
    a = np.asarray(anchor["q"], np.int64)
    cand = np.flatnonzero(labels != anchor["label"])
    if len(cand) == 0 or not anchor["positives"]:
        return []
    lower, upper = codes.interval(a)
    lower, upper = lower[cand], upper[cand]
    wanted = np.zeros(len(cand), bool)
    for p in anchor["positives"]:
        ps = p["score"]
        may = (100 * upper >= 80 * ps) & (100 * lower <= 100 * ps)
        sure = (100 * lower >= 80 * ps) & (100 * upper <= 100 * ps)
        wanted |= may & _cut(lower, upper, sure, top)
    keep = cand[wanted]
    scores = codes.exact(keep, a)
    out = []
    for p in anchor["positives"]:
        ps = p["score"]
        inside = np.flatnonzero((80 * ps <= 100 * scores) & (100 * scores <= 100 * ps))
        for i in _best(ids[keep[inside]], scores[inside], top):
            out.append((p["vec_id"], ps, int(ids[keep[inside[i]]]), int(scores[inside[i]])))
    return out


def meet(rows: DataFrame, anchors: DataFrame, find, schema: str, shard_rows: int, block_rows: int) -> DataFrame:
    """Every anchor against every row of its dimension, by (shard, block) tasks; ``find(codes,
    ids, labels, anchor)`` gives the output tuples of one anchor against one shard."""
    n_rows, n_anchors = rows.count(), anchors.count()
    shards, blocks = max(1, math.ceil(n_rows / shard_rows)), max(1, math.ceil(n_anchors / block_rows))
    dealt = rows.select(F.lit(0).alias("kind"), "dim", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"),
                        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "vec_id", "label", "q",
                        F.lit(None).cast("array<struct<vec_id:long,score:long>>").alias("positives"))
    asked = anchors.select(F.lit(1).alias("kind"), "dim", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
                           F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), "vec_id", "label", "q", "positives")
    names = [c.split()[0] for c in schema.split(", ")]
    types = {"long": pa.int64(), "int": pa.int32()}
    kinds = [types[c.split()[1]] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, codes = None, [], None
        for batch in batches:
            tags = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("dim", "shard", "block", "kind")])
            starts = np.flatnonzero(np.r_[True, (tags[:, 1:] != tags[:, :-1]).any(0)])
            out = []
            for s, e in zip(starts, [*starts[1:], batch.num_rows]):
                dim, shard, block, kind = (int(t) for t in tags[:, s])
                if (dim, shard, block) != key:
                    key, held, codes = (dim, shard, block), [], None
                part = batch.slice(s, e - s)
                if kind == 0:
                    q = part.column("q").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(e - s, dim)
                    held.append((part.column("vec_id").to_numpy(zero_copy_only=False), part.column("label").to_numpy(zero_copy_only=False), q))
                    continue
                if not held:
                    continue
                if codes is None:
                    ids, labels = np.concatenate([h[0] for h in held]).astype(np.int64), np.concatenate([h[1] for h in held]).astype(np.int64)
                    codes = Codes(np.concatenate([h[2] for h in held]))
                for anchor in part.select(["vec_id", "label", "q", "positives"]).to_pylist():
                    out += [(anchor["vec_id"], *t) for t in find(codes, ids, labels, anchor)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    both = dealt.unionByName(asked).repartition(parts(rows), "dim", "shard", "block").sortWithinPartitions("dim", "shard", "block", "kind")
    return both.mapInArrow(run, schema)


def mine(table: DataFrame, every: int = 100, top: int = TOP, shard_rows: int = SHARD_ROWS, block_rows: int = ANCHOR_BLOCK) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for
    ``vec_id, embedding, label`` (other columns are not read).

    Rows with a null id, label or vector, or a null or non-finite component, take no part; an
    anchor meets rows of its own dimension only.  An anchor's positives are its ``top`` best
    other rows of its label; for each, the ``top`` best rows of another label scoring between
    0.8 and 1 times the positive's score (integer test ``80 p <= 100 n <= 100 p``).  Higher
    scores first, ties by smaller id.  Anchors without positives or negatives give no rows; an
    empty table gives none.  Scores must stay within 64-bit integers.
    """
    rows = store(usable_rows(table), "negatives-rows")
    anchors = rows.where(F.col("vec_id") % every == 0).withColumn("positives", F.lit(None).cast("array<struct<vec_id:long,score:long>>"))
    local = meet(rows, anchors, lambda c, i, l, a: positives_of(c, i, l, a, top), "anchor_id long, vec_id long, score long", shard_rows, block_rows)
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    pos = local.withColumn("r", F.row_number().over(best)).where(F.col("r") <= top)
    listed = store(pos.groupBy("anchor_id").agg(F.collect_list(F.struct("vec_id", "score")).alias("positives")), "negatives-positives")
    asked = anchors.drop("positives").join(listed.withColumnRenamed("anchor_id", "vec_id"), "vec_id")
    found = meet(rows, asked, lambda c, i, l, a: negatives_of(c, i, l, a, top),
                 "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long", shard_rows, block_rows)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
