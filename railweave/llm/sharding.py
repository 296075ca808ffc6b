"""Sharding by a k-d tree over metadata, with DataFrame functions only.

A node that stands for ``n`` shards is cut along its widest dimension at the weighted
quantile n//2 : n - n//2 (the median where n is even) until each leaf is one shard of the
target bytes.  All nodes of a level are cut together.  A quantile is found by histogram
passes: bytes per (node, bin), then only inside the bin that the quantile falls into, until
one value is left.  No rows move; the driver sees one bin per node and pass.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import number_rows, store, utf8_size

BINS = 4096
TOP = (1 << 62) - 1
CUT = "node long, dim int, c0 long, c1 long, c2 long, c3 long"
RANGE = "node long, dim int, level int, lo long, width long, hi long, goal double, base double, e0 long, e1 long, e2 long"


def _key(value: Column) -> Column:
    """A hash in 0 .. 2^62 - 1."""
    return F.shiftrightunsigned(F.xxhash64(value), 2)


def _frame(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A table of at most one row per shard, so its size is bounded by the shard count."""
    fields = [f.split() for f in schema.split(", ")]
    picked = ", ".join(f"CAST(c{i} AS {kind}) AS {name}" for i, (name, kind) in enumerate(fields))
    values = ", ".join("(" + ", ".join("NULL" if v is None else repr(v) for v in r) + ")" for r in rows)
    return F.broadcast(spark.sql(f"SELECT {picked} FROM VALUES {values} AS t({', '.join(f'c{i}' for i in range(len(fields)))})"))


def _keys(dim: Column) -> list[Column]:
    """Order along a dimension: its value, then the text, the row's id and its number."""
    return [F.element_at("dims", dim + 1), F.col("same"), F.col("one"), F.col("uid")]


def _descend(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    joined = rows.join(cuts, "node", "left")
    k, c = _keys(F.col("dim")), [F.col(f"c{i}") for i in range(4)]
    left = k[3] < c[3]
    for i in (2, 1, 0):
        left = (k[i] < c[i]) | ((k[i] == c[i]) & left)
    node = F.when(F.col("dim").isNull(), F.col("node")).otherwise(F.col("node") * 2 + F.when(left, 0).otherwise(1))
    return joined.select("uid", "dims", "same", "one", "size", node.alias("node"))


def _find(rows: DataFrame, nodes: dict[int, dict], slack: float) -> list[tuple]:
    """Cut keys of each node: rows whose key is smaller go left."""
    spark, done, open_ = rows.sparkSession, [], dict(nodes)
    while open_:
        ranges = [(n, s["dim"], len(s["eq"]), s["lo"], (s["hi"] - s["lo"]) // BINS + 1, s["hi"], s["goal"], s["base"], *(s["eq"] + [None] * 3)[:3]) for n, s in open_.items()]
        at = rows.join(_frame(spark, ranges, RANGE), "node")
        k, level = _keys(F.col("dim")), F.col("level")
        v = F.when(level == 0, k[0]).when(level == 1, k[1]).when(level == 2, k[2]).otherwise(k[3])
        for i in range(3):
            at = at.where((level <= i) | (k[i] == F.col(f"e{i}")))
        at = at.select("node", "size", "lo", "width", "goal", "base", v.alias("v")).where((F.col("v") >= F.col("lo")) & (v <= F.col("hi")))
        bins = at.groupBy("node", F.expr("(v - lo) div width").alias("bin")).agg(
            F.sum("size").alias("w"), F.min("v").alias("mn"), F.max("v").alias("mx"), F.first("goal").alias("goal"), F.first("base").alias("base"))
        upto = F.col("base") + F.sum("w").over(Window.partitionBy("node").orderBy("bin"))
        found = bins.withColumn("upto", upto).where((F.col("upto") >= F.col("goal")) & (F.col("upto") - F.col("w") < F.col("goal"))).collect()
        seen = set()
        for r in found:
            seen.add(r.node)
            s = open_[r.node]
            s["base"] = r.upto - r.w
            if r.mn != r.mx:
                s["lo"], s["hi"] = r.mn, r.mx
                continue
            s["eq"] = s["eq"] + [r.mn]
            whole = len(s["eq"]) == 2 and r.w <= slack
            if whole or len(s["eq"]) == 4:
                # the whole group goes to the nearer side
                right = s["goal"] - s["base"] < r.upto - s["goal"]
                rest = [-1 if right else TOP + 1] * (4 - len(s["eq"]))
                key = s["eq"] + rest if rest else s["eq"][:3] + [s["eq"][3] + (0 if right else 1)]
                done.append((r.node, s["dim"], *key))
                del open_[r.node]
            else:
                s["lo"], s["hi"] = 0, TOP
        for n in set(open_) - seen:  # an empty node
            done.append((n, open_.pop(n)["dim"], TOP + 1, 0, 0, 0))
    return done


def kd_shards(df: DataFrame, dims: dict[str, Column], text: Column, row_id: Column, shards: int | None = None,
              target_bytes: int | None = None, extra: dict[str, Column] | None = None, keep_whole: float = 0.02) -> DataFrame:
    """One row per input row: row_id, size, ``extra`` columns, shard, slot.

    ``dims`` are whole numbers from 0 to 2^62 - 1; null counts as 0.  Give ``shards`` or
    ``target_bytes`` per shard.  Size is the UTF-8 length of the text plus 16, so null and
    empty texts weigh 16.  Ties on a dimension are cut by text, then id, then row number:
    sizes stay equal whatever repeats.  A group of equal texts that a cut falls into moves to
    one side if it weighs at most ``keep_whole`` of a shard; with dims that depend on the text
    alone such groups are never separated.  Larger groups, repeated rows among them, are cut.
    An empty table gives no rows.
    """
    extra = extra or {}
    narrow = store(df.select(
        F.monotonically_increasing_id().alias("uid"), row_id.alias("row_id"), (utf8_size(text) + 16).alias("size"),
        F.array(*(F.coalesce(d.cast("long"), F.lit(0).cast("long")) for d in dims.values())).alias("dims"),
        _key(text).alias("same"), _key(row_id).alias("one"), *(c.alias(n) for n, c in extra.items())), "kd-rows")
    spark = df.sparkSession
    rows = narrow.select("uid", "dims", "same", "one", "size", F.lit(1).cast("long").alias("node"))
    stats = [F.count(F.lit(1)).alias("n"), F.sum("size").alias("w")]
    for i in range(len(dims)):
        stats += [F.min(F.col("dims")[i]).alias(f"mn{i}"), F.max(F.col("dims")[i]).alias(f"mx{i}")]
    root = rows.agg(*stats).first()
    total = root.w or 0
    if shards is None:
        shards = max(1, math.ceil(total / target_bytes))
    spread = [max(1, (root[f"mx{i}"] or 0) - (root[f"mn{i}"] or 0)) for i in range(len(dims))]
    slack = keep_whole * total / shards
    leaf = {1: (0, shards)}  # node: first shard, number of shards
    while any(n > 1 for _, n in leaf.values()):
        seen = {r.node: r for r in rows.groupBy("node").agg(*stats).collect()}
        nodes = {}
        for node, (_, n) in leaf.items():
            if n == 1:
                continue
            r = seen.get(node)
            width = [(r[f"mx{i}"] - r[f"mn{i}"]) / spread[i] if r else 0 for i in range(len(dims))]
            dim = width.index(max(width))
            lo, hi = (r[f"mn{dim}"], r[f"mx{dim}"]) if r else (0, 0)
            nodes[node] = {"dim": dim, "lo": lo, "hi": hi, "goal": float(r.w * (n // 2)) / n if r else 0.0, "base": 0.0, "eq": []}
        rows = store(_descend(rows, _frame(spark, _find(rows, nodes, slack), CUT)), "kd-nodes")
        for node in nodes:
            first, n = leaf.pop(node)
            leaf[2 * node], leaf[2 * node + 1] = (first, n // 2), (first + n // 2, n - n // 2)
    shard = _frame(spark, [(node, first) for node, (first, _) in leaf.items()], "node long, shard int")
    slots = number_rows(rows.join(shard, "node").select("uid", "shard"), ["shard"], "uid", root.n or 0, "slot")
    return narrow.join(slots, "uid").select("row_id", "size", *extra, "shard", "slot")


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """``documents`` under the law ``bytes``; the dimensions depend on the text alone, so copies stay together."""
    text = F.col("text")
    chars = F.coalesce(F.char_length(text), F.lit(0)).cast("long")
    out = kd_shards(docs, {"chars": chars, "density": F.coalesce(utf8_size(text) * 1000 / F.greatest(chars, F.lit(1)), F.lit(0)).cast("long"),
                           "content": F.crc32(F.coalesce(text, F.lit("")))},
                    text, F.col("doc_id"), shards=shards, extra={"text_crc32": F.crc32(F.coalesce(text, F.lit("")))})
    return out.select(F.col("row_id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
