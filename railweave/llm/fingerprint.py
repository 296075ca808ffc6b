"""Document fingerprints by locally consistent parsing.

A text is cut into phrases by deterministic coin tossing: each symbol is compared with the
one before it, four tosses bring the labels down to six values, and a phrase begins at each
local maximum.  Runs of one symbol are collapsed first.  Phrase names are hashes of what they
hold and are the symbols of the next level.  A cut depends on a few symbols around it only,
so equal substrings have equal phrases inside, wherever they stand.  The fingerprint keeps
the smallest names of levels 2 and 3 (phrases of about 10 and 40 characters).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import parts

LEVELS = (2, 3)
KEPT = 32
CHUNK = 1 << 17  # characters parsed side by side; a longer text is parsed alone

_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_TOSS = np.zeros((256, 256), np.uint8)
for _a in range(256):
    for _b in range(256):
        if _a != _b:
            _low = ((_a ^ _b) & -(_a ^ _b)).bit_length() - 1
            _TOSS[_a, _b] = 2 * _low + (_b >> _low & 1)
_TOSS = _TOSS.ravel()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def _phrases(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The next level: phrase names, and which of them begin a text."""
    keep = np.empty(len(names), bool)
    keep[0] = True
    np.not_equal(names[1:], names[:-1], out=keep[1:])
    keep |= first
    if not keep.all():
        at = np.flatnonzero(keep)
        runs = np.diff(at, append=len(names)).astype(np.uint64)
        own = names[at]
        names, first = np.where(runs > 1, _mix(own + runs * _B), own), first[at]
    starts = np.flatnonzero(first)
    before = np.empty_like(names)
    before[1:] = names[:-1]
    before[starts] = names[starts] ^ np.uint64(1)
    low = names ^ before
    low &= ~low + np.uint64(1)
    bit = ((low.astype(np.float64).view(np.int64) >> 52) - 1023).astype(np.uint8)
    label = 2 * bit + ((names & low) != 0)
    for _ in range(3):
        pair = np.empty(len(label), np.uint16)
        pair[1:] = label[:-1]
        pair[starts] = label[starts] ^ 1
        pair <<= 8
        pair |= label
        label = _TOSS[pair]
    cut = first.copy()
    cut[1:-1] |= (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:]) & ~first[2:]
    at = np.flatnonzero(cut)
    place = np.arange(len(names), dtype=np.uint64) - np.repeat(at, np.diff(at, append=len(names))).astype(np.uint64)
    return _mix(np.add.reduceat(_mix(names + (place + np.uint64(1)) * _A), at)), first[at]


def _sketches(texts: list[str]) -> list[list[list[int]]]:
    """Per text and level: the smallest distinct 32-bit names, ascending."""
    sizes = np.array([len(t) for t in texts])
    out: list[list[list[int]]] = [[[] for _ in LEVELS] for _ in texts]
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    names = _mix(np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + _A)
    first = np.zeros(len(names), bool)
    first[np.concatenate([[0], np.cumsum(sizes[full])[:-1]])] = True
    for level in range(1, max(LEVELS) + 1):
        names, first = _phrases(names, first)
        if level not in LEVELS:
            continue
        key = np.unique((np.cumsum(first).astype(np.uint64) - np.uint64(1)) << np.uint64(32) | names >> np.uint64(32))
        doc = (key >> np.uint64(32)).astype(np.int64)
        begins = np.searchsorted(doc, np.arange(len(full) + 1))
        values = (key & np.uint64(0xFFFFFFFF)).tolist()
        for i, d in enumerate(full):
            out[d][LEVELS.index(level)] = values[begins[i]:min(begins[i + 1], begins[i] + KEPT)]
    return out


def sketches(texts: list[str]) -> list[list[list[int]]]:
    out, i = [], 0
    while i < len(texts):
        j, n = i, 0
        while j < len(texts) and (j == i or n + len(texts[j]) <= CHUNK):
            n += len(texts[j])
            j += 1
        out += _sketches(texts[i:j])
        i = j
    return out


def to_text(sketch: list[list[int]]) -> str:
    """Eight hex digits per name, a dot between levels; the empty text has the empty fingerprint."""
    return ".".join("".join(f"{v:08x}" for v in level) for level in sketch) if sketch[0] else ""


def likeness(a: list[list[int]], b: list[list[int]]) -> float:
    """Mean over the levels of the estimated share of common names; two empty texts are alike."""
    total = 0.0
    for x, y in zip(a, b):
        if not x and not y:
            total += 1
            continue
        x, y = set(x), set(y)
        smallest = sorted(x | y)[:KEPT]
        total += len(x & y & set(smallest)) / len(smallest)
    return total / len(LEVELS)


def fingerprints(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of ``text`` (a column of that name is replaced); null counts as empty."""
    df = df.drop(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                got = [to_text(s) for s in sketches([t or "" for t in batch.column(text).to_pylist()])]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.string())], [*batch.schema.names, out])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(out, StringType())]))


def in_order(docs: DataFrame) -> DataFrame:
    """``doc_id, text, guest`` by cells of ascending id, each a sorted partition whose last row, the
    guest, is the first row of the cell after it (after the last: of the first).

    Null ids come first; equal ids follow their texts.  The driver sees one id per cell, and
    there are as many cells as shuffle partitions.
    """
    n = parts(docs)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long")).alias("_key"))
    cuts = rows.agg(F.percentile_approx("_key", [i / n for i in range(1, n)] or [0.5], 100 * n)).first()[0] or []
    cell = F.size(F.filter(F.array(*(F.lit(c).cast("long") for c in sorted(set(cuts)))), lambda c: c <= F.col("_key"))) if cuts else F.lit(0)
    rows = rows.withColumn("_cell", cell)
    heads = rows.groupBy("_cell").agg(F.min("_key").alias("_key")).orderBy("_cell").collect()  # one row per cell
    if not heads:
        return rows.select("doc_id", "text", F.lit(False).alias("guest"))
    to = {h["_cell"]: heads[i - 1]["_cell"] for i, h in enumerate(heads)}
    first = rows.where(F.col("_key").isin([h["_key"] for h in heads])).groupBy("_cell", "_key").agg(F.min("text").alias("text"), F.first("doc_id").alias("doc_id"))
    goes = F.element_at(F.create_map(*(F.lit(x) for pair in to.items() for x in pair)), F.col("_cell"))
    guests = first.select("doc_id", "text", "_key", goes.alias("_cell"), F.lit(True).alias("guest"))
    dealt = rows.withColumn("guest", F.lit(False)).unionByName(guests).repartitionById(n, "_cell")
    return dealt.sortWithinPartitions("guest", "_key", "text").select("doc_id", "text", "guest")


COMPARED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Each document beside its edited text (second half from the next document) and the next document.

    Null texts are empty.  A single document is its own next one.  No rows give no rows.
    """

    def pairs(ids: list, texts: list[str], guests: list[bool]):
        """All but the last row are results; each has its next beside it."""
        edited = [t[:len(t) - len(t) // 2] + u[:len(t) // 2] for t, u in zip(texts, texts[1:])]
        own, changed = sketches(texts), sketches(edited)
        out = [(i, len(t), hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest(), to_text(s), to_text(c), likeness(s, c), likeness(s, after))
               for i, t, e, s, c, after, guest in zip(ids, texts, edited, own, changed, own[1:], guests) if not guest]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 7, kinds)], [f.split()[0] for f in COMPARED.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, guests = [], [], []
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                ids += batch.column("doc_id").to_pylist()
                texts += batch.column("text").to_pylist()
                guests += batch.column("guest").to_pylist()
                if len(ids) > 1:
                    yield pairs(ids, texts, guests)
                    ids, texts, guests = ids[-1:], texts[-1:], guests[-1:]

    return in_order(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).mapInArrow(run, COMPARED)
