"""Exact removal of long repeated byte strings with a logarithmic family of suffix arrays.

Equal windows of ``length`` bytes share the 64-byte string of least hash inside them, their
anchor, at the same offset.  So suffixes are dealt to index shards by anchor:

1. anchors of all texts are counted; only those that occur twice go on,
2. each leaves its segment: the windows that it is the anchor of, equal segments once,
3. each shard takes its segments in batches: a batch gets a suffix array, is merge-scanned
   against every level of the index for matches of ``length`` bytes, and becomes a level;
   levels of equal size merge, so a suffix is merged log times,
4. marks go back to the texts and become spans of bytes.

An anchor with very many different segments (a passage that a third of all texts share, with
different surroundings) is not gathered in one shard: its windows are counted by digest.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import rolling
from .common import store

LENGTH = 200
GRAM = 64
SHARD_SEGMENTS = 1_000
HOT_SEGMENTS = 2_000
BATCH_SEGMENTS = 128
CHUNK = 1 << 22  # window starts looked at together; a longer text is walked in overlapping chunks


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per run of windows with one anchor: the anchor's hash, first and last window start."""
    hashes, lows, highs = [], [], []
    for begin in range(0, len(data) - length + 1, CHUNK):
        own = data[begin:begin + CHUNK + length - 1]
        h = rolling.Prefix(own).every(gram)
        width, n = length - gram + 1, len(own) - length + 1
        # hash in front, place behind: the leftmost of equals wins
        key = np.full(-(-len(h) // width) * width, np.iinfo(np.uint64).max, np.uint64)
        key[:len(h)] = (h & ~np.uint64(0xFFFFFF)) | np.arange(len(h), dtype=np.uint64)
        block = key.reshape(-1, width)
        ahead = np.minimum.accumulate(block, 1).ravel()
        behind = np.minimum.accumulate(block[:, ::-1], 1)[:, ::-1].ravel()
        at = (np.minimum(behind[:n], ahead[width - 1:width - 1 + n]) & np.uint64(0xFFFFFF)).astype(np.int64)
        low = np.flatnonzero(np.diff(at, prepend=-1))
        hashes.append(h[at[low]].view(np.int64))
        lows.append(low + begin)
        highs.append(np.append(low[1:], n) - 1 + begin)
    if not hashes:
        return (np.zeros(0, np.int64),) * 3
    return np.concatenate(hashes), np.concatenate(lows), np.concatenate(highs)


def _bytes(text) -> np.ndarray:
    return np.frombuffer(text or b"", np.uint8)


def _anchor_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                batch = whole.slice(at, 200)
                hashes, counts, digests = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
                for digest, text in zip(batch.column("digest").to_pylist(), batch.column("bytes").to_pylist()):
                    h, n = np.unique(anchors(_bytes(text), length)[0], return_counts=True)
                    hashes.append(h)
                    counts.append(n)
                    digests += [digest] * len(h)
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(np.concatenate(hashes)), pa.array(np.minimum(np.concatenate(counts), 2).astype(np.int32))],
                                                 ["digest", "anchor", "n"])

    return run


def _segment_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                batch = whole.slice(at, 200)
                rows = []
                for digest, text, wanted in zip(*(batch.column(c) for c in ("digest", "bytes", "anchors"))):
                    raw = text.as_py()
                    h, low, high = anchors(_bytes(raw), length)
                    hit = np.isin(h, np.asarray(wanted.values))
                    own: dict[bytes, tuple[int, bytes, list[int]]] = {}
                    for a, lo, hi in zip(h[hit].tolist(), low[hit].tolist(), high[hit].tolist()):
                        segment = raw[lo:hi + length]
                        own.setdefault(hashlib.md5(segment).digest(), (a, segment, []))[2].append(lo)
                    name = digest.as_py()
                    rows += [(name, key, a, segment, starts) for key, (a, segment, starts) in own.items()]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64())))],
                                                     ["digest", "key", "anchor", "segment", "starts"])

    return run


class Level:
    """A suffix array: window starts in the order of the ``length`` bytes that follow them."""

    def __init__(self, keys: np.ndarray, marks: np.ndarray):
        self.keys, self.marks, self.size = keys, marks, len(keys)  # sorted suffixes, the mark each one has


class Family:
    """Suffix arrays of geometrically growing sizes; ``add`` marks every suffix that has an equal."""

    def __init__(self, length: int):
        self.length, self.levels, self.marked = length, [], []

    def suffixes(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        text = np.frombuffer(b"".join(segments), np.uint8)
        sizes = np.array([len(s) for s in segments])
        starts = np.cumsum(sizes) - sizes
        windows = sizes - self.length + 1
        at = np.repeat(starts - (np.cumsum(windows) - windows), windows) + np.arange(int(windows.sum()))
        keys = np.ones((len(at), self.length + 1), np.uint8)  # the closing 1 keeps zero bytes at the end
        keys[:, :-1] = np.lib.stride_tricks.sliding_window_view(text, self.length)[at]
        return keys.view(f"S{self.length + 1}").ravel(), windows

    def add(self, segments: list[bytes], twice: np.ndarray) -> None:
        """``twice``: segments that are known to occur more than once."""
        keys, windows = self.suffixes(segments)
        base = sum(map(len, self.marked))
        self.marked.append(np.repeat(twice, windows))
        order = np.argsort(keys, kind="stable")
        keys, marks = keys[order], order + base
        same = np.flatnonzero(keys[1:] == keys[:-1])
        found = [marks[same], marks[same + 1]]
        for level in self.levels:
            # both sides ascend: each suffix of the batch meets its equals of the level
            first, last = np.searchsorted(level.keys, keys, "left"), np.searchsorted(level.keys, keys, "right")
            met = last > first
            found += [marks[met], *(level.marks[f:t] for f, t in set(zip(first[met].tolist(), last[met].tolist())))]
        flat = np.concatenate(self.marked)
        flat[np.concatenate(found)] = True
        self.marked = [flat]
        new = Level(keys, marks)
        while self.levels and self.levels[-1].size <= 2 * new.size:
            old = self.levels.pop()
            keys = np.concatenate([old.keys, new.keys])
            order = np.argsort(keys, kind="stable")
            new = Level(keys[order], np.concatenate([old.marks, new.marks])[order])
        self.levels.append(new)


def _shard(length: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("key")
        family, segments, total = Family(length), group["segment"].tolist(), group["total"].to_numpy()
        for at in range(0, len(segments), BATCH_SEGMENTS):
            family.add(segments[at:at + BATCH_SEGMENTS], total[at:at + BATCH_SEGMENTS] > 1)
        flat = family.marked[0]
        ends = np.cumsum([len(s) - length + 1 for s in segments])
        marks = np.split(flat, ends[:-1])
        out = [(key, np.flatnonzero(m).tolist()) for key, m in zip(group["key"], marks) if m.any()]
        return pd.DataFrame(out, columns=["key", "windows"])

    return run


def _spans(length: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        starts = np.unique(np.concatenate([(np.asarray(s)[:, None] + np.asarray(w)[None, :]).ravel() for s, w in zip(group["starts"], group["windows"])]))
        new = np.flatnonzero(np.diff(starts, prepend=starts[0] - length - 2) > length)
        last = np.append(new[1:], len(starts)) - 1
        return pd.DataFrame({"digest": [group["digest"].iloc[0]], "begins": [starts[new].tolist()], "ends": [(starts[last] + length).tolist()]})

    return run


def repeated_spans(texts: DataFrame, length: int = LENGTH, shard_segments: int = SHARD_SEGMENTS, hot_segments: int = HOT_SEGMENTS) -> DataFrame:
    """``digest, begins, ends``: maximal runs of repeated bytes of each distinct text that has any.

    ``texts`` has ``digest, bytes``; rows with equal digests are copies.
    """
    size = F.octet_length("bytes")
    copies = texts.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max(size).alias("n_bytes")).where((F.col("n") > 1) & (F.col("n_bytes") >= length))
    copies = store(copies.select("digest", F.array(F.lit(0).cast("long")).alias("begins"), F.array(F.col("n_bytes").cast("long")).alias("ends")), "suffix-copies")
    long = texts.where(size >= length)
    found = store(long.mapInArrow(_anchor_rows(length), "digest binary, anchor long, n int"), "suffix-anchors")
    twice = found.groupBy("anchor").agg(F.max("n").alias("n"), F.min("digest").alias("a"), F.max("digest").alias("b")).where((F.col("n") > 1) | (F.col("a") != F.col("b")))
    twice = store(twice.select("anchor"), "suffix-twice")
    wanted = found.join(twice, "anchor", "left_semi").groupBy("digest").agg(F.collect_set("anchor").alias("anchors"))
    wanted = store(wanted, "suffix-wanted")
    # copies leave the same segments: any one of them is read
    spots = store(long.join(wanted, "digest").mapInArrow(_segment_rows(length), "digest binary, key binary, anchor long, segment binary, starts array<long>")
                  .withColumn("n", F.size("starts")), "suffix-spots")
    once = spots.groupBy("key", "digest").agg(F.max("n").alias("n")).groupBy("key").agg(F.sum("n").alias("total"))
    segments = spots.select("key", "anchor", "segment").dropDuplicates(["key"])
    segments = store(segments.join(once, "key"), "suffix-segments")
    many = store(segments.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_segments).select("anchor"), "suffix-hot")
    shards = max(1, math.ceil(segments.count() / shard_segments))
    usual = segments.join(many, "anchor", "left_anti").withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    marks = usual.groupBy("shard").applyInPandas(_shard(length), "key binary, windows array<long>")
    starts = F.sequence(F.lit(0), F.octet_length("segment") - length)
    window = segments.join(many, "anchor", "left_semi").select("key", "total", "segment", F.explode(starts).alias("at"))
    window = store(window.select("key", "total", "at", F.unhex(F.md5(F.substring("segment", F.col("at") + 1, F.lit(length)))).alias("window")), "suffix-windows")
    seen = store(window.groupBy("window").agg(F.sum("total").alias("n")).where("n > 1").select("window"), "suffix-seen")
    counted = window.join(seen, "window", "left_semi").groupBy("key").agg(F.collect_list(F.col("at").cast("long")).alias("windows"))
    marks = store(marks.unionByName(counted), "suffix-marks")
    once_each = spots.dropDuplicates(["digest", "key"]).select("digest", "key", "starts")
    spans = once_each.join(marks, "key").groupBy("digest").applyInPandas(_spans(length), "digest binary, begins array<long>, ends array<long>")
    return store(spans.join(copies, "digest", "left_anti").unionByName(copies), "suffix-spans")




def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, **bounds) -> DataFrame:
    """Add ``kept`` (the remaining bytes), ``n_bytes``, ``n_removed`` and ``n_spans`` to each row, without ``text``.
    Columns of these names are replaced.

    Every byte covered by a string of ``length`` bytes that starts anywhere else too goes, in
    all places; matches never cross rows and are judged on the input.  A text that occurs
    twice is a match of itself.  Null and empty texts stay empty; no rows give no rows.
    """
    rest = [c for c in docs.columns if c not in (text, "kept", "n_bytes", "n_removed", "n_spans")]
    rows = docs.select(*(F.col(c).alias(f"_{i}") for i, c in enumerate(rest)), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("bytes"))
    rows = rows.withColumn("digest", F.unhex(F.md5("bytes")))
    spans = repeated_spans(rows.select("digest", "bytes"), length, **bounds)
    own = [f"_{i}" for i in range(len(rest))]
    joined = rows.select(*own, "digest", "bytes").join(spans, "digest", "left").drop("digest")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw, begins, ends in zip(*(batch.column(c).to_pylist() for c in ("bytes", "begins", "ends"))):
                kept, at = [], 0
                for b, e in zip(begins or [], ends or []):
                    kept.append(raw[at:b])
                    at = e
                kept.append(raw[at:])
                data = b"".join(kept)
                out.append((data, len(raw), len(raw) - len(data), len(begins or [])))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), *(pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 4, (pa.binary(), pa.int64(), pa.int64(), pa.int64())))],
                                             [*own, "kept", "n_bytes", "n_removed", "n_spans"])

    kinds = ", ".join([f"{n} {t}" for n, t in joined.select(*own).dtypes] + ["kept binary, n_bytes long, n_removed long, n_spans long"])
    made = joined.mapInArrow(cut, kinds)
    return made.select(*(F.col(o).alias(c) for o, c in zip(own, rest)), "kept", "n_bytes", "n_removed", "n_spans")


def dedup_documents(docs: DataFrame, **bounds) -> DataFrame:
    out = remove_repeats(docs.select("doc_id", "text"), **bounds)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
