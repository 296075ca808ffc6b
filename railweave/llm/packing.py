"""Packing token sequences into windows by non-negative least squares.

Documents longer than a window are cut into full windows and a rest.  Rests are grouped into
length classes (exact up to 64 tokens, then 32 classes per doubling, rounded up).  Shallow
combinations of up to three distinct classes, each possibly repeated, that fill a window are
enumerated; non-negative least squares finds how often to use each so that the histogram of
classes is used up; counts are rounded down.  Pieces get their place by rank inside their
class, so no piece list is ever gathered.  What rounding leaves is packed greedily in cells
of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from .common import number_rows, store

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
WINDOW = 4096
END = 2
CELL_PIECES = 2_000
CACHED_WORDS = 1_000_000  # a memory bound of the lookup of words met before, nothing else
SLICE_BYTES = 4 << 20  # texts are split and looked up in runs of about this size


class _Words:
    """Ids of every word met so far, end to end in one array, and the place of each word in it."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their spellings inside a text are ordinary text
        self.clear()

    def clear(self) -> None:
        self.place, self.ids, self.ends = {}, np.zeros(0, "<u4"), np.zeros(1, np.int64)

    def places(self, words: np.ndarray) -> np.ndarray:
        """Number k of each of the distinct ``words``: its ids are ``ids[ends[k]:ends[k + 1]]``."""
        at = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(at < 0)
        if len(self.place) + len(new) > CACHED_WORDS:
            self.clear()
            new = np.arange(len(words))
        at[new] = np.arange(len(new)) + len(self.place)
        for i in range(0, len(new), 20_000):
            part = words[new[i:i + 20_000]].tolist()
            got = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            sizes = np.fromiter(map(len, got), np.int64, len(got))
            self.place.update(zip(part, range(len(self.place), len(self.place) + len(part))))
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(got), "<u4", int(sizes.sum()))])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        return at


@lru_cache(maxsize=2)
def _load(path: str):
    known = _Words(path)
    return known.tokenizer, known


def _slices(text: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``SLICE_BYTES`` of text, or of one longer text."""
    run = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(text)]
    return ((a, b) for a, b in zip(cuts, cuts[1:]) if a < b)


def _encoded(text: pa.Array, known: _Words, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts end to end, each text closed by ``end``, and the number of ids of each."""
    words = pc.split_pattern(pc.replace_substring(text, "\n", " "), " ")
    coded = words.flatten().dictionary_encode()
    at = known.places(coded.dictionary.to_numpy(zero_copy_only=False))[coded.indices.to_numpy()]
    first, sizes = known.ends[at], known.ends[at + 1] - known.ends[at]
    before = np.concatenate([[0], np.cumsum(sizes)])
    ids = known.ids[np.repeat(first - before[:-1], sizes) + np.arange(before[-1])]
    stops = before[np.cumsum(pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64))]
    return np.insert(ids, stops, end), np.diff(stops, prepend=0) + 1


def pieces(docs: DataFrame, path: str = VOCABULARY, window: int = WINDOW, end: int = END) -> DataFrame:
    """``doc_id, start, length, ids, doc_tokens``: each text's ids and ``end``, cut at multiples of ``window``.

    ``ids`` holds little-endian unsigned 32-bit numbers.  A null or empty text is ``end`` alone.
    The tokenizer drops white space and never joins across it, so the words between plain
    spaces and line feeds are encoded once each and looked up after that, once for all their
    places in a run of texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, known = _load(path)
        for whole in batches:
            for a, b in _slices(whole.column("text")):
                batch = whole.slice(a, b - a)
                ids, n = _encoded(batch.column("text"), known, end)
                many = -(-n // window)
                of = np.repeat(np.arange(len(n)), many)
                start = (np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)) * window
                length = np.minimum(window, n[of] - start)
                doc, upto = batch.column("doc_id").take(pa.array(of)), np.concatenate([[0], np.cumsum(length)])
                # pieces lie end to end in ids; a batch stays below the 2 GB that its offsets can name
                step = max(1, (1 << 28) // window)
                for i in range(0, len(of), step):
                    j = min(i + step, len(of))
                    own = ids[upto[i]:upto[j]].astype("<u4")
                    cut = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer((4 * (upto[i:j + 1] - upto[i])).astype(np.int32)), pa.py_buffer(own)])
                    yield pa.RecordBatch.from_arrays([doc[i:j], pa.array(start[i:j]), pa.array(length[i:j]), cut, pa.array(n[of[i:j]])],
                                                     ["doc_id", "start", "length", "ids", "doc_tokens"])

    schema = StructType([StructField(n, BinaryType() if n == "ids" else LongType()) for n in ("doc_id", "start", "length", "ids", "doc_tokens")])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def classes(window: int) -> np.ndarray:
    """Upper bounds of the length classes, ascending."""
    bounds, at = [], 0
    while at < window:
        at += 1 if at < 64 else 1 << (at.bit_length() - 6)
        bounds.append(min(at, window))
    return np.array(bounds)


def combinations(bounds: np.ndarray, window: int) -> np.ndarray:
    """Rows (class, repeats) x 3 that fill the window up to its last sixty-fourth."""
    under = np.searchsorted(bounds, np.arange(window + 1), "right") - 1  # largest class of at most so many tokens
    found = set()
    for a, size in enumerate(bounds):
        repeats = range(1, window // size + 1) if size > window // 64 else {1, 2, window // size // 2, window // size}
        for k in repeats:
            left = window - k * size
            if left < 0 or not k:
                continue
            thirds = [(b, m) for b in range(min(a, under[left] + 1)) for m in {1, left // bounds[b]}] if k <= 2 else []
            for b, m in thirds + ([(under[left], left // bounds[under[left]])] if under[left] >= 0 else []):
                rest = left - m * bounds[b]
                c = under[rest]
                n = rest // bounds[c] if c >= 0 else 0
                if rest - n * (bounds[c] if c >= 0 else 0) > window // 64:
                    continue
                counts: dict[int, int] = {}
                for x, times in ((a, k), (int(b), int(m)), (int(c), int(n))):
                    if times:
                        counts[x] = counts.get(x, 0) + times
                found.add(tuple(sorted(counts.items())))
            if not left:
                found.add(((a, k),))
    return np.array([[v for pair in (*f, *[(0, 0)] * (3 - len(f))) for v in pair] for f in sorted(found)], int).reshape(-1, 6)


def nnls(combos: np.ndarray, counts: np.ndarray, rounds: int = 2_000) -> np.ndarray:
    """Active-set non-negative least squares: how often to use each combination."""
    n = len(combos)
    scale = max(1.0, counts.max())
    h = counts / scale
    at, times = combos[:, 0::2], combos[:, 1::2].astype(float)
    x, used = np.zeros(n), []

    def matrix(cols: list[int]) -> np.ndarray:
        a = np.zeros((len(h), len(cols)))
        for j in range(3):
            np.add.at(a, (at[cols, j], np.arange(len(cols))), times[cols, j])
        return a

    residual, barred = h.copy(), set()
    for _ in range(rounds):
        gain = (residual[at] * times).sum(1) / np.sqrt((times**2).sum(1))
        gain[used] = -1
        gain[list(barred)] = -1
        best = int(gain.argmax()) if n else 0
        if not n or gain[best] < 1e-7:
            break
        used.append(best)
        while True:
            a = matrix(used)
            s = np.linalg.solve(a.T @ a + 1e-10 * np.eye(len(used)), a.T @ h)
            if s.min() > 0:
                break
            bad = s <= 0
            now = x[used]
            step = np.min(now[bad] / np.maximum(now[bad] - s[bad], 1e-300))
            x[used] = np.maximum(now + step * (s - now), 0)
            keep = [c for c in used if x[c] > 1e-12]
            x[[c for c in used if c not in keep]] = 0
            if best not in keep:
                barred.add(best)
            used = keep
            if not used:
                break
        if used:
            x[used] = s
            residual = h - a @ s
        else:
            residual = h.copy()
    return x * scale


def plan(counts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """``(combination, repeats)`` with whole repeats that never use more pieces than there are."""
    combos = combinations(classes(window), window)
    wanted, left, out = nnls(combos, counts), counts.astype(int).copy(), []
    for c in np.argsort(-wanted, kind="stable"):
        if wanted[c] < 1:
            break
        own = [(i, t) for i, t in zip(combos[c, 0::2], combos[c, 1::2]) if t]
        repeats = min(int(wanted[c] + 1e-6), *(int(left[i] // t) for i, t in own))
        if repeats:
            for i, t in own:
                left[i] -= repeats * t
            out.append((own, repeats))
    return out


def pack(df: DataFrame, length: str = "length", window: int = WINDOW) -> DataFrame:
    """Add ``sequence_id`` and ``offset``; ``length`` is 1 to ``window``.

    The driver sees the histogram of lengths: at most ``window`` rows.  ``df`` must give the
    same rows each time it is read (a stored table).  Extra columns stay, columns of the new
    names are replaced; an empty table gives no rows; equal rows are separate pieces.
    """
    kept = F.struct(*(c for c in df.columns if c not in ("sequence_id", "offset"))).alias("_row")
    own = store(df.select(kept, F.col(length).cast("long").alias("_length"), F.monotonically_increasing_id().alias("_uid")), "pack-pieces")
    bounds = classes(window)
    of = np.searchsorted(bounds, np.arange(window + 1))  # class of each length
    lengths = own.groupBy("_length").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = np.zeros(len(bounds), np.int64)
    for r in lengths:
        counts[of[r["_length"]]] += r.n
    first, used, slots = 0, np.zeros(len(bounds), np.int64), []
    for combo, repeats in plan(counts, window):
        for c, times in combo:
            slots.append((int(c), int(used[c]), int(used[c] + repeats * times), int(times), first))
            used[c] += repeats * times
        first += repeats
    edges = F.array(*(F.lit(int(b)) for b in bounds))
    # a class is found by rule: the index of the first bound that is not smaller
    cls = F.size(F.filter(edges, lambda b: b < F.col("_length")))
    narrow = own.select("_uid", "_length", cls.alias("_class"))
    ranked = number_rows(narrow, ["_class"], "_uid", int(counts.sum()), "_rank")
    spans = own.sparkSession.createDataFrame(slots or [(-1, 0, 0, 1, 0)], "_class int, _from long, _to long, _times long, _first long")
    # at most three rows per combination and one combination per class: a few hundred rows
    hit = ranked.join(F.broadcast(spans), "_class", "left").where(F.col("_from").isNull() | F.col("_rank").between(F.col("_from"), F.col("_to") - 1))
    placed = hit.where(F.col("_from").isNotNull()).select("_uid", "_length", (F.col("_first") + F.floor((F.col("_rank") - F.col("_from")) / F.col("_times"))).cast("long").alias("sequence_id"))
    ends = F.element_at(F.array(*(F.lit(int(u)) for u in used)), F.col("_class") + 1)
    rest = ranked.where(F.col("_rank") >= ends)
    cells = max(1, math.ceil(int((counts - used).sum()) / CELL_PIECES))
    greedy = rest.select("_uid", "_length", F.pmod(F.xxhash64("_uid"), F.lit(cells)).alias("_cell")).groupBy("_cell").applyInPandas(
        lambda g: _best_fit(g, window, first), "_uid long, _length long, sequence_id long")
    order = Window.partitionBy("sequence_id").orderBy(F.desc("_length"), "_uid")
    offsets = placed.unionByName(greedy).withColumn("offset", F.sum("_length").over(order) - F.col("_length")).select("_uid", "sequence_id", "offset")
    return own.join(offsets, "_uid").select("_row.*", "sequence_id", "offset")


def _best_fit(cell: pd.DataFrame, window: int, first: int) -> pd.DataFrame:
    """Longest first, each into the fullest open sequence that still has room."""
    cell = cell.sort_values(["_length", "_uid"], ascending=[False, True])
    room: list[list[int]] = [[] for _ in range(window + 1)]  # open sequences by free tokens
    free, ids, n = np.zeros(window + 1, bool), [], 0
    for size in cell["_length"]:
        at = size + int(free[size:].argmax())
        if at <= window and free[at]:
            seq = room[at].pop()
            free[at] = bool(room[at])
        else:
            seq, at, n = n, window, n + 1
        room[at - size].append(seq)
        free[at - size] = True
        ids.append(seq)
    base = first + (int(cell["_cell"].iloc[0]) << 24)
    return pd.DataFrame({"_uid": cell["_uid"].to_numpy(), "_length": cell["_length"].to_numpy(), "sequence_id": base + np.array(ids, np.int64)})


def pack_documents(docs: DataFrame) -> DataFrame:
    """Per piece of a document: its place, and a checksum of its ids."""
    cut = pieces(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return pack(cut).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
