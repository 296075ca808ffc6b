"""Near-duplicate documents: BagMinHash signatures of word-shingle multisets, banded and verified.

The weight of a shingle is its count.  Weights are cut into unit levels, grouped in dyadic
blocks [0,1) [1,2) [2,4) [4,8) ...; each (shingle, block) is a Poisson process of points in
time, whose points fall on a level of the block and a component of the signature.  Points
on levels below the weight count.  The first point per component is its value, so two
components agree with the probability of the weighted Jaccard similarity.  A process ends
when it is later than all components, so a document needs little more than one point per
shingle.

Documents with equal multisets are one node.  Each node is first compared, exactly,
with the least node it shares a band with, and joined to its class; a band whose members are
then still in different classes goes on with pivots, one at first and four times as many each
round, which meet the members of other classes, until only one class of the band has members
that were no pivot.  So every pair of a band is either compared, surely not similar or
already in one class, and a group of thousands of copies costs one comparison per member.

Most pairs of a crowded band are edits of one text that resemble it, but not each other.  A bitmap
per node holds, per bit, whether an odd number of its shingles (a repeated one counts each time,
under its own number) fall on that bit.  What two nodes have in common cancels in the exclusive or
of their bitmaps, so its bits are never more than the shingles they differ in: a pair with too
many is surely not similar, and is settled by the join that finds it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import rolling
from .common import parts, store

WORDS = 5
SIMILAR = 0.8
BANDS, ROWS = 69, 8  # a pair of similarity 0.8 shares no band once in 300,000 times; at 0.3 it shares one in 220
SALT_PAIRS = 64
BATCH_CHARS = 2_000_000
ODD_WORDS = 16  # of 64 bits; longer texts fill them, and more of their pairs are left to the exact comparison
_STEP = np.uint64(0x9E3779B97F4A7C15)


def bags(texts: list[str | None], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted 48-bit shingle hashes of the texts after one another, their counts, and where each text's end.

    Words are runs without ASCII white space, A-Z in lower case.  A text of fewer words than
    a shingle is one shingle; a text without words has none.
    """
    raw = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    starts, ends = rolling.words(data)
    word = rolling.Prefix(data).hash(starts, ends)
    upto = np.searchsorted(starts, np.cumsum([len(r) + 1 for r in raw]))
    doc = np.repeat(np.arange(len(raw)), np.diff(upto, prepend=0))
    last = upto[doc]  # the end of the text each word belongs to
    first = np.concatenate([[0], upto])[doc]
    gram = np.zeros(len(word), np.uint64)
    place = np.arange(len(word))
    for j in range(words):
        inside = place + j < last
        gram[inside] = rolling.mix(gram[inside] + word[(place + j)[inside]] + _STEP)
    whole = (place + words <= last) | ((place == first) & (last - first < words))
    key = doc[whole].astype(np.uint64) << np.uint64(48) | gram[whole] >> np.uint64(16)
    key, counts = np.unique(key, return_counts=True)
    return key & np.uint64((1 << 48) - 1), counts, np.searchsorted(key >> np.uint64(48), np.arange(len(raw)), "right")


def signatures(keys: np.ndarray, counts: np.ndarray, ends: np.ndarray, size: int = BANDS * ROWS) -> np.ndarray:
    """First point in time per text and component; infinite for a text without shingles."""
    doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    best = np.full((len(ends), size), np.inf)
    owner, seed, low, width, weight = [], [], [], [], []
    begin, span = 0, 1  # dyadic blocks of levels
    on = np.arange(len(keys))
    while len(on):
        owner.append(doc[on])
        seed.append(rolling.mix(keys[on] * np.uint64(3) + np.uint64((begin + 1) * int(_STEP) % (1 << 64))))
        low.append(np.full(len(on), begin))
        width.append(np.full(len(on), span))
        weight.append(counts[on])
        begin, span = begin + span, max(1, begin + span)
        on = on[counts[on] > begin]
    owner, seed, low, width, weight = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (owner, seed, low, width, weight))
    time = np.zeros(len(owner))
    seed = seed.astype(np.uint64)
    while len(owner):
        seed = seed + _STEP
        r = rolling.mix(seed)
        time = time - np.log(((r >> np.uint64(11)).astype(np.float64) + 1) / float(1 << 53)) / (width * size)
        r = rolling.mix(r)
        component = (r >> np.uint64(32)).astype(np.int64) * size >> 32
        level = low + ((r & np.uint64(0xFFFFFFFF)).astype(np.int64) * width >> 32)
        hit = level < weight
        np.minimum.at(best, (owner[hit], component[hit]), time[hit])
        going = np.flatnonzero(time <= best.max(1)[owner])
        owner, seed, low, width, weight, time = (x[going] for x in (owner, seed, low, width, weight, time))
    return best


def band_keys(best: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    value = best.view(np.uint64).reshape(len(best), bands, rows)
    key = np.tile(np.arange(1, bands + 1, dtype=np.uint64) * _STEP, (len(best), 1))
    for j in range(rows):
        key = rolling.mix(key + value[:, :, j])
    return key.view(np.int64)


def odd_bits(keys: np.ndarray, counts: np.ndarray, ends: np.ndarray, words: int = ODD_WORDS) -> np.ndarray:
    """Per text and bit, whether an odd number of its shingles fall on it; the i-th of equal shingles is one of its own."""
    doc = np.repeat(np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0)), counts)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    element = rolling.mix(np.repeat(keys, counts) + number.astype(np.uint64) * _STEP)
    fallen = np.zeros((len(ends), 64 * words), np.uint8)  # wraps at an even number
    np.add.at(fallen, (doc, ((element >> np.uint64(32)) * np.uint64(64 * words) >> np.uint64(32)).astype(np.int64)), 1)
    return np.packbits(fallen & 1, 1).view(np.int64)


def _may_be_similar(similar: float, n: str, odd: str, other_n: str, other_odd: str) -> Column:
    """False only where the weighted Jaccard similarity is surely below ``similar``.

    With s shingles in both and d in which they differ, it is (s - d) / (s + d).
    """
    apart = sum((F.bit_count(F.col(odd)[i].bitwiseXOR(F.col(other_odd)[i])) for i in range(1, ODD_WORDS)), F.bit_count(F.col(odd)[0].bitwiseXOR(F.col(other_odd)[0])))
    return apart * (1 + similar) <= (F.col(n) + F.col(other_n)) * (1 - similar + 1e-9)


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(texts):
        end, chars = at, 0
        while end < len(texts) and (end == at or chars + len(texts[end] or "") <= BATCH_CHARS):
            chars += len(texts[end] or "")
            end += 1
        yield at, end
        at = end


def _digests(keys, counts, ends) -> list[bytes]:
    raw, n = keys.astype("<u8"), counts.astype("<u8")
    return [hashlib.md5(raw[b:e].tobytes() + n[b:e].tobytes()).digest() for b, e in zip([0, *ends[:-1]], ends)]


def signed(docs: DataFrame) -> DataFrame:
    """``doc_id, text_md5, node, bands, n, odd`` of each row; ``node`` is the digest of its multiset of ``n`` shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for at, end in _chunks(texts):
                keys, counts, ends = bags(texts[at:end])
                band = band_keys(signatures(keys, counts, ends))
                part = batch.slice(at, end - at)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, band.size + 1, BANDS), pa.int32()), pa.array(band.ravel(), pa.int64()))
                n = np.diff(np.concatenate([[0], np.cumsum(counts)])[ends], prepend=0)
                odd = odd_bits(keys, counts, ends)
                odds = pa.ListArray.from_arrays(pa.array(np.arange(0, odd.size + 1, ODD_WORDS), pa.int32()), pa.array(odd.ravel(), pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_md5"), pa.array(_digests(keys, counts, ends), pa.binary()), lists, pa.array(n, pa.int64()), odds],
                                                 ["doc_id", "text_md5", "node", "bands", "n", "odd"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_md5"), "text")
    return store(rows.mapInArrow(run, "doc_id long, text_md5 string, node binary, bands array<long>, n long, odd array<long>"), "minhash-signed")


def _bags_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, keys, counts`` (packed) of the wanted nodes, from one document of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for at, end in _chunks(texts):
                keys, counts, ends = bags(texts[at:end])
                cuts = list(zip([0, *ends[:-1]], ends))
                yield pa.RecordBatch.from_arrays([pa.array(_digests(keys, counts, ends), pa.binary()), pa.array([keys[b:e].tobytes() for b, e in cuts], pa.binary()),
                                                  pa.array([counts[b:e].astype("<i4").tobytes() for b, e in cuts], pa.binary())], ["node", "keys", "counts"])

    no_id = F.lit(-(1 << 63)).cast("long")
    rows = docs.select(F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_md5"), F.coalesce(F.col("doc_id").cast("long"), no_id).alias("doc_id"), "text")
    one = wanted.select("text_md5", F.coalesce("doc_id", no_id).alias("doc_id"))
    # the pair of keys spreads copies of one text; rows that repeat both yield equal bags
    found = rows.join(one, ["text_md5", "doc_id"], "left_semi").select("text").mapInArrow(run, "node binary, keys binary, counts binary")
    return store(found.dropDuplicates(["node"]), "minhash-bags")


def _verify(pairs: DataFrame, bag: DataFrame) -> DataFrame:
    """``a, b, similarity``, exact.  A pivot with many partners is spread over salted groups."""
    many = store(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / SALT_PAIRS).alias("salts")), "minhash-pivots")
    salted = store(pairs.join(many, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("salts")).alias("salt")), "minhash-salted")
    other = salted.join(bag.withColumnRenamed("node", "b"), "b").select("a", "salt", "b", "keys", "counts")
    own = salted.select("a", "salt").distinct().join(bag.withColumnRenamed("node", "a"), "a").select("a", "salt", F.lit(None).cast("binary").alias("b"), "keys", "counts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, keys, counts = None, None, None
        for batch in batches:
            out = []
            for a, b, k, c in zip(*(batch.column(n).to_pylist() for n in ("a", "b", "keys", "counts"))):
                k, c = np.frombuffer(k, np.uint64), np.frombuffer(c, "<i4")
                if b is None:
                    pivot, keys, counts = a, k, c
                    continue
                assert a == pivot
                _, i, j = np.intersect1d(keys, k, True, True)
                common = int(np.minimum(counts[i], c[j]).sum())
                total = int(counts.sum()) + int(c.sum()) - common
                out.append((a, b, common / total if total else 1.0))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.binary(), pa.binary(), pa.float64()))], ["a", "b", "similarity"])

    dealt = own.unionByName(other).repartition(parts(pairs), "a", "salt").sortWithinPartitions("a", "salt", "b")
    return store(dealt.mapInArrow(run, "a binary, b binary, similarity double"), "minhash-verified")


def components(links: DataFrame) -> DataFrame:
    """``node, label``: the least node of each linked set, by label exchange and pointer jumping."""
    both = store(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "minhash-links")
    label = store(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("label")), "minhash-labels")
    while True:
        near = both.join(label.select(F.col("node").alias("b"), F.col("label").alias("other")), "b").groupBy(F.col("a").alias("node")).agg(F.min("other").alias("other"))
        down = store(label.join(near, "node").select("node", "label", F.least("label", "other").alias("new")), "minhash-labels")
        jump = down.select(F.col("node").alias("new"), F.col("new").alias("root"))
        # a label is a linked node itself, so the jump always finds it
        after = store(down.join(jump, "new").select("node", F.col("root").alias("label"), (F.col("root") != F.col("label")).alias("moved")), "minhash-labels")
        label = after.select("node", "label")
        if after.where("moved").isEmpty():
            return label


def _joined(label: DataFrame | None, new: DataFrame) -> DataFrame:
    """``label`` after more links: only the labels that a new link brings together are followed."""
    if label is None:
        return components(new)
    known = label.select("node", "label")
    ends = store(new.join(known.select(F.col("node").alias("a"), F.col("label").alias("la")), "a", "left").join(
        known.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b", "left").select(
        "a", "b", F.coalesce("la", "a").alias("la"), F.coalesce("lb", "b").alias("lb")), "minhash-ends")
    bridges = ends.where("la != lb").select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct()
    if bridges.isEmpty():
        return label
    moved = components(bridges).select(F.col("node").alias("label"), F.col("label").alias("new"))
    added = ends.select(F.col("a").alias("node"), F.col("la").alias("label")).unionByName(ends.select(F.col("b").alias("node"), F.col("lb").alias("label"))).distinct()
    every = known.unionByName(added.join(known, "node", "left_anti"))
    return store(every.join(moved, "label", "left").select("node", F.coalesce("new", "label").alias("label")), "minhash-labels")


def classes(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """``doc_id, text_md5, class_id, class_size, class_key`` per row of ``doc_id, text``.

    ``class_id`` is the least doc_id of the class (null if it has none), ``class_key`` its
    node in hexadecimal.  Null and empty texts are copies of each other, as are texts without
    words; repeated rows are copies.  No rows give no rows.
    """
    sig = signed(docs)
    one = F.min(F.struct("text_md5", "doc_id")).alias("one")
    nodes = sig.groupBy("node").agg(one, *(F.first(c).alias(c) for c in ("bands", "n", "odd")))
    nodes = store(nodes.select("node", F.col("one.text_md5").alias("text_md5"), F.col("one.doc_id").alias("doc_id"), "bands", "n", "odd"), "minhash-nodes")
    band = nodes.select("node", F.explode("bands").alias("band"))
    full = store(nodes.select(F.explode("bands").alias("band")).groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("band"), "minhash-full")
    member = store(band.join(full, "band"), "minhash-members")
    # first each node with the least pivot of its bands: that settles groups of copies at one pair a member
    pivot = store(member.groupBy("band").agg(F.min("node").alias("pivot")), "minhash-least")
    pairs = member.join(pivot, "band").groupBy("node").agg(F.min("pivot").alias("a")).where("a != node")
    pairs = store(pairs.select("a", F.col("node").alias("b")), "minhash-pairs")
    bag = _bags_of(docs, nodes.select("node", "text_md5", "doc_id").join(member.select("node").distinct(), "node", "left_semi"))
    tested = label = shape = None
    used, count = member.select("band", "node").limit(0), 1
    while True:
        if not pairs.isEmpty():
            new = _verify(pairs, bag).where(F.col("similarity") >= similar).select("a", "b")
            tested = pairs if tested is None else tested.unionByName(pairs)
            label = _joined(label, new)
        if label is None:
            break  # no two nodes share a band
        # members by class; a band is open while its members that were no pivot are of two classes
        now = member.select("band", "node").join(label, "node", "left").select("band", "node", F.coalesce("label", "node").alias("label"))
        now = store(now, "minhash-now")
        idle = now.join(used, ["band", "node"], "left_anti")
        open_ = store(idle.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high").select("band"), "minhash-open")
        if open_.isEmpty():
            break
        # labels only ever merge, so a settled band stays settled: the rest goes on
        now = store(now.join(open_, "band", "left_semi"), "minhash-open-members")
        member = now.select("band", "node")
        if shape is None:  # later rounds meet some of the same nodes
            shape = store(nodes.select("node", "n", "odd").join(member.select("node").distinct(), "node", "left_semi"), "minhash-shape")
        idle = now.join(used, ["band", "node"], "left_anti")
        # the next pivots of an open band: its first idle members, as many as the round allows
        turn = F.row_number().over(Window.partitionBy("band").orderBy("node"))
        pivots = store(idle.withColumn("turn", turn).where(F.col("turn") <= count).select("band", F.col("node").alias("p"), F.col("label").alias("own")), "minhash-next")
        used = store(used.unionByName(pivots.select("band", F.col("p").alias("node"))), "minhash-used")
        first = pivots.join(shape.select(F.col("node").alias("p"), F.col("n").alias("p_n"), F.col("odd").alias("p_odd")), "p")
        meet = now.join(shape, "node").join(first, "band").where(F.col("label") != F.col("own")).where(_may_be_similar(similar, "n", "odd", "p_n", "p_odd"))
        fresh = meet.select(F.least("node", "p").alias("x"), F.greatest("node", "p").alias("y"), F.col("p").alias("a"), F.col("node").alias("b"))
        done = tested.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"))
        pairs = store(fresh.join(done, ["x", "y"], "left_anti").dropDuplicates(["x", "y"]).select("a", "b"), "minhash-pairs")
        count *= 4
    found = sig.select("doc_id", "text_md5", "node")
    if label is not None:
        found = found.join(label, "node", "left")
    else:
        found = found.withColumn("label", F.col("node"))
    found = store(found.select("doc_id", "text_md5", F.coalesce("label", "node").alias("class")), "minhash-classes")
    sums = store(found.groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size")), "minhash-sums")
    return found.join(sums, "class").select("doc_id", "text_md5", "class_id", "class_size", F.lower(F.hex("class")).alias("class_key"))


def keep_one(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """The rows of ``docs``, one of each class: the least doc_id, then the least text digest."""
    kept = classes(docs, similar).groupBy("class_key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_md5")).alias("_kept"))
    kept = store(kept.select(F.col("_kept.doc_id").alias("_kept_id"), F.col("_kept.text_md5").alias("_kept_md5")).distinct(), "minhash-kept")
    rows = docs.withColumn("_row_md5", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    return rows.join(kept, rows["doc_id"].cast("long").eqNullSafe(kept["_kept_id"]) & (rows["_row_md5"] == kept["_kept_md5"]), "left_semi").dropDuplicates(["doc_id", "_row_md5"]).drop("_row_md5")


def dedup_documents(docs: DataFrame) -> DataFrame:
    return classes(docs).select("doc_id", "class_id", "class_size")
