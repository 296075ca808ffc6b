"""Exact deduplication by content-defined chunk recipes.

A text is first normalised in Spark: null counts as empty, and each run of ``[\\x20\\x09-\\x0D]``
becomes one space.  Inside tasks a gear hash over a window of 32 bytes cuts the UTF-8 bytes
into chunks wherever the hash's top bits are zero (at least ``MIN_CHUNK``, at most
``MAX_CHUNK`` bytes, about ``2 ** MASK_BITS`` on average), so equal content cuts alike wherever
it stands.  Each chunk is named by its SHA-256.

Names are verified before they are trusted: the distinct (name, bytes) pairs travel once, with
map-side combining, and a name seen with two byte strings is a clash.  Clashing names are
replaced by the chunk bytes themselves, so a recipe is always exact.  A document's recipe is the
ordered list of its chunk names; two documents are equal exactly when their recipes are.  After
chunking only recipes move, never the documents.  Groups of equal recipes are counted in two
levels over a salt of the row, so a group holding a third of all rows is spread over ``SALTS``
tasks instead of one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store

WINDOW = 32  # bytes that decide one gear hash
MASK_BITS = 11
MIN_CHUNK, MAX_CHUNK = 256, 8192
SALTS = 64
#: clashing names are looked up by broadcast while there are at most this many, else joined
BROADCAST_CLASHES = 100_000
_GEAR = np.random.default_rng(20_240_613).integers(0, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)
_TOP = np.uint32(((1 << MASK_BITS) - 1) << (32 - MASK_BITS))


#: The same result in DuckDB SQL.  Rows that tie on the least doc_id of a group are equal in
#: every column but ``kept``, so which of them stays does not change the rows.
ORACLE = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
FROM n
"""


def normalised(text: Column) -> Column:
    """Null as empty; each run of space, tab, line feed, vertical tab, form feed or return as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def cuts(data: bytes, min_chunk: int = MIN_CHUNK, max_chunk: int = MAX_CHUNK) -> list[int]:
    """Ends of the chunks of ``data``, the last one ``len(data)``; none for empty data.

    The gear hash of position i sums ``GEAR[data[i - j]] << j`` for j below the window, so it
    depends on those 32 bytes only and equal content gives equal candidate ends.
    """
    n = len(data)
    if n == 0:
        return []
    raw = np.frombuffer(data, np.uint8)
    gear = _GEAR[raw]
    h = np.zeros(n, np.uint32)
    for j in range(min(WINDOW, n)):
        h[j:] += gear[: n - j] << np.uint32(j)
    candidates = (np.flatnonzero((h & _TOP) == 0) + 1).tolist()
    ends, last = [], 0
    for end in candidates + [n]:
        while end - last > max_chunk:
            last += max_chunk
            ends.append(last)
        if end - last >= min_chunk or end == n:
            if end > last:
                ends.append(end)
            last = end
    return ends


def chunked(docs: DataFrame, name_bytes: int = 32, with_bytes: bool = True) -> DataFrame:
    """``_row, doc_id, text_sha256, names`` for ``_row, doc_id, norm``: the chunk names of each text, in
    order, and with ``with_bytes`` the ``chunks`` they stand for.

    ``name_bytes`` shortens the SHA-256 names; tests use it to provoke clashes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, names, chunks = [], [], []
            for text in batch.column("norm").to_pylist():
                data = text.encode("utf-8")
                pieces, start = [], 0
                for end in cuts(data):
                    pieces.append(data[start:end])
                    start = end
                chunks.append(pieces if with_bytes else None)
                names.append([hashlib.sha256(p).digest()[:name_bytes] for p in pieces])
                digests.append(hashlib.sha256(data).hexdigest())
            columns = [batch.column("_row"), batch.column("doc_id"), pa.array(digests, pa.string()), pa.array(names, pa.list_(pa.binary()))]
            fields = ["_row", "doc_id", "text_sha256", "names"]
            if with_bytes:
                columns, fields = [*columns, pa.array(chunks, pa.list_(pa.binary()))], [*fields, "chunks"]
            yield pa.RecordBatch.from_arrays(columns, fields)

    schema = "_row long, doc_id long, text_sha256 string, names array<binary>" + (", chunks array<binary>" if with_bytes else "")
    return docs.select("_row", "doc_id", "norm").mapInArrow(run, schema)


def recipes(rows: DataFrame, name_bytes: int = 32) -> DataFrame:
    """``_row, doc_id, text_sha256, recipe``: verified names of each text's chunks in order.

    Distinct (name, bytes) pairs are counted per name; a name with more than one byte string
    clashes and is replaced by the bytes it stands for in every recipe that holds it.  Only that
    check needs the bytes, so without a clash the recipes come from names alone.
    """
    made = chunked(rows, name_bytes)
    pairs = made.select(F.explode(F.arrays_zip("names", "chunks")).alias("c")).select(F.col("c.names").alias("name"), F.col("c.chunks").alias("chunk"))
    clashes = pairs.distinct().groupBy("name").count().where(F.col("count") > 1).select(F.col("name").alias("clash"))
    found = clashes.count()
    own = ["_row", "doc_id", "text_sha256"]
    if found == 0:
        return chunked(rows, name_bytes, with_bytes=False).select(*own, F.col("names").alias("recipe"))
    lookup = F.broadcast(clashes) if found <= BROADCAST_CLASHES else clashes
    each = made.select(*own, F.posexplode(F.arrays_zip("names", "chunks")).alias("pos", "c"))
    fixed = each.join(lookup, each["c.names"] == lookup["clash"], "left").select(
        *own, "pos", F.when(F.col("clash").isNull(), F.col("c.names")).otherwise(F.col("c.chunks")).alias("id"))
    listed = fixed.groupBy(*own).agg(F.sort_array(F.collect_list(F.struct("pos", "id"))).alias("l"))
    plain = made.where(F.size("names") == 0).select(*own, F.col("names").alias("recipe"))
    return listed.select(*own, F.col("l.id").alias("recipe")).unionByName(plain)


def exact_groups(docs: DataFrame, salts: int = SALTS, name_bytes: int = 32) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not read.  Null text is empty
    text; all empty texts form one group.  Of equal texts the row of least ``doc_id`` stays;
    a null ``doc_id`` comes after all others, and rows that repeat the least id are settled
    by their place in the input, so exactly one row of each group has ``kept`` true.  A
    dropped row's ``keep_id`` is the ``doc_id`` of the row that stays (null if that id is
    null).  Very long texts are chunked whole.  An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("norm")) \
        .withColumn("_row", F.monotonically_increasing_id())
    # the recipes are read twice below and cost a pass over all texts: they are stored, narrow
    keyed = store(recipes(rows, name_bytes), "recipes").withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(salts)))
    first = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("_row").alias("r"))
    part = keyed.groupBy("recipe", "_salt").agg(F.count(F.lit(1)).alias("_n"), F.min(first).alias("_first"))
    total = part.groupBy("recipe").agg(F.sum("_n").alias("group_size"), F.min("_first").alias("_keep"))
    stats = part.join(total, "recipe").select("recipe", "_salt", "group_size", "_keep")
    out = keyed.join(stats, ["recipe", "_salt"])
    return out.select("doc_id", F.col("_keep.d").alias("keep_id"), F.col("group_size").cast("long").alias("group_size"),
                      (F.col("_row") == F.col("_keep.r")).alias("kept"), "text_sha256")
