"""WARC archives: written by Spark's text writer, read back by boundary-chain verification.

Reading splits archives at the record magic wherever it occurs, payloads included, so large
files are read by many tasks.  Each piece is a candidate record and knows where its successor
would begin.  Pointer jumping from the start of each file keeps the candidates that the chain
reaches, in log2(records of a file) rounds of joins; magic inside payloads is never reached.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from .common import store

MAGIC = b"WARC/1.0\r\n"
LINE = "\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 SHA-1 of a string's UTF-8 bytes: four times ten hex digits to eight letters."""
    digest = F.sha1(data.cast("binary"))
    groups = [F.lpad(F.conv(F.substring(digest, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def records(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """One column ``value``: a record per row, without the two line ends that close it.

    Rows with equal payloads of at least ``least_bytes`` bytes: the largest id is the
    response, the others revisit it.  A null payload is empty; a null id is the smallest; rows
    that repeat both id and payload are all written alike.  Line ends in a url are escaped.
    """
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(F.col(page_id).cast("long").alias("id"), F.regexp_replace(F.col(url), "[\r\n]", "%0A").alias("url"), body.alias("body"),
                        F.octet_length(body).cast("long").alias("bytes"), base32_sha1(body).alias("digest"))
    first = rows.where(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.max("id").alias("largest"))
    rows = rows.join(first, "digest", "left")
    revisit = (F.col("bytes") >= least_bytes) & ~F.col("id").eqNullSafe(F.col("largest"))

    def urn(of: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(of.cast("string"), F.lit("none")), F.lit(":"), F.col("digest"), F.lit(">"))

    def field(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(LINE)), F.lit(""))

    head = F.concat(
        F.lit(MAGIC.decode()), field("WARC-Type", F.when(revisit, "revisit").otherwise("response")), field("WARC-Record-ID", urn(F.col("id"))),
        field("WARC-Date", F.lit(date)), field("WARC-Target-URI", F.col("url")), field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(revisit, field("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(""),
        F.when(revisit, field("WARC-Refers-To", urn(F.col("largest")))).otherwise(""), field("X-Page-Id", F.col("id")),
        F.when(revisit, field("X-Refers-To-Page", F.col("largest"))).otherwise(""), field("X-Payload-Bytes", F.col("bytes")),
        field("Content-Type", F.lit("text/html; charset=utf-8")), field("Content-Length", F.when(revisit, 0).otherwise(F.col("bytes"))), F.lit(LINE))
    return rows.select(F.concat(head, F.when(revisit, "").otherwise(F.col("body"))).alias("value"))


def write(pages: DataFrame, path: str, records_per_file: int = 4096, **names) -> None:
    records(pages, **names).write.option("lineSep", LINE * 2).option("maxRecordsPerFile", records_per_file).text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What stands between two magics, in the order of each file block."""
    lines = spark.read.option("lineSep", MAGIC.decode()).text(path)
    return lines.select(F.col("value").cast("binary").alias("piece"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _parse(piece: bytes) -> tuple[int, dict[bytes, bytes]] | None:
    end = piece.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in piece[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    return (end + 4, fields) if fields.get(b"content-length", b"").isdigit() and b"warc-type" in fields else None


INDEX = StructType([
    StructField("file", StringType()), StructField("block", LongType()), StructField("number", LongType()), StructField("before", LongType()), StructField("bytes", LongType()),
    StructField("candidate", BooleanType()), StructField("head_bytes", LongType()), StructField("content_bytes", LongType()), StructField("complete", BooleanType()),
    StructField("record_type", StringType()), StructField("page_id", LongType()), StructField("refers_to", LongType()), StructField("stated_bytes", LongType()),
    StructField("stated_digest", StringType()), StructField("digest", StringType())])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, int, bytes]]:
    """file, block, number in the block, bytes of the block before it, piece."""
    at: tuple | None = None
    number = before = 0
    for batch in batches:
        for file, block, piece in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), batch.column("piece")):
            if (file, block) != at:
                at, number, before = (file, block), 0, 0
            data = piece.as_py()
            yield file, block, number, before, data
            number, before = number + 1, before + len(data) + len(MAGIC)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []

    def whole(fields, name):
        value = fields.get(name, b"")
        return int(value) if value.lstrip(b"-").isdigit() else None

    for file, block, number, before, piece in _walk(batches):
        row = [file, block, number, before, len(piece)]
        if (parsed := _parse(piece)) is None:
            rows.append((*row, False, *[None] * 9))
        else:
            head, fields = parsed
            size = int(fields[b"content-length"])
            complete = len(piece) == head + size + 4
            digest = base64.b32encode(hashlib.sha1(piece[head:head + size]).digest()).decode() if complete else None
            rows.append((*row, True, head, size, complete, fields[b"warc-type"].decode("utf-8", "replace"), whole(fields, b"x-page-id"), whole(fields, b"x-refers-to-page"),
                         whole(fields, b"x-payload-bytes"), fields.get(b"warc-payload-digest", b"").decode("utf-8", "replace").removeprefix("sha1:"), digest))
        if len(rows) >= 5000:
            yield _batch(rows)
            rows = []
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {LongType(): pa.int64(), StringType(): pa.string(), BooleanType(): pa.bool_()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[f.dataType]) for c, f in zip(zip(*rows), INDEX.fields)], INDEX.names)


def index(spark: SparkSession, path: str) -> DataFrame:
    """Every candidate record of the archives with its place in the file and its successor's."""
    found = store(_pieces(spark, path).mapInArrow(_index, INDEX), "warc-index")
    start = F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n")
    blocks = found.groupBy("file", "block").agg(F.sum(F.col("bytes") + len(MAGIC)).alias("n")).select("file", "block", start.alias("start"))
    at = F.col("start") + F.col("before") - len(MAGIC)
    return store(found.join(blocks, ["file", "block"]).select("*", at.alias("offset")).withColumn("successor", F.when(
        F.col("candidate"), F.col("offset") + len(MAGIC) + F.col("head_bytes") + F.col("content_bytes") + 4)).drop("start", "before"), "warc-offsets")


def reached(candidates: DataFrame) -> DataFrame:
    """``file, offset`` of the candidates that the chain from offset 0 of their file reaches.

    Each round doubles both the steps a pointer spans and the part of the chain that is marked.
    """
    nodes = store(candidates.where("candidate").select("file", "offset", F.col("successor").alias("next"), (F.col("offset") == 0).alias("hit")), "warc-chain")
    longest = nodes.groupBy("file").count().agg(F.max("count")).first()[0] or 0
    for _ in range(math.ceil(math.log2(longest)) if longest > 1 else 0):
        marked = nodes.where("hit").select("file", F.col("next").alias("offset"), F.lit(True).alias("_new")).dropna().distinct()
        further = nodes.select("file", F.col("offset").alias("next"), F.col("next").alias("_next"))
        nodes = store(nodes.join(marked, ["file", "offset"], "left").join(further, ["file", "next"], "left").select(
            "file", "offset", F.col("_next").alias("next"), (F.col("hit") | F.col("_new").isNotNull()).alias("hit")), "warc-chain")
    return nodes.where("hit").select("file", "offset")


def payloads(spark: SparkSession, path: str, found: DataFrame, kept: DataFrame) -> DataFrame:
    """``file, offset, payload`` of reached records whose payload holds magic: their pieces joined again."""
    all_ = found.join(kept.withColumn("hit", F.lit(True)), ["file", "offset"], "left")
    whose = Window.partitionBy("file").orderBy("offset")
    last = F.last(F.when(F.col("hit"), F.struct("offset", "complete", "head_bytes", "content_bytes")), ignorenulls=True).over(whose)
    owned = all_.select("file", "block", "number", last.alias("of")).where(~F.col("of.complete"))
    owned = owned.select("file", "block", "number", F.col("of.offset").alias("offset"), F.col("of.head_bytes").alias("head"), F.col("of.content_bytes").alias("size"))

    def bodies(batches):
        rows = []
        for file, block, number, _, piece in _walk(batches):
            rows.append((file, block, number, piece))
            if len(rows) == 500:
                yield made(rows)
                rows = []
        if rows:
            yield made(rows)

    def made(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.binary()))], ["file", "block", "number", "piece"])

    def glue(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["block", "number"])
        data, one = MAGIC.join(group["piece"]), group.iloc[0]
        return pd.DataFrame({"file": [one["file"]], "offset": [one["offset"]], "payload": [data[one["head"]:one["head"] + one["size"]]]})

    again = _pieces(spark, path).mapInArrow(bodies, "file string, block long, number long, piece binary")
    return again.join(owned, ["file", "block", "number"]).groupBy("file", "offset").applyInPandas(glue, "file string, offset long, payload binary")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per record: file, offset, page_id, record_type, refers_to, payload_bytes, payload_digest.

    Length and digest of a response are taken from the payload read, those of a revisit from
    its header.  A file that does not begin with a record yields none; an empty folder of
    archives yields no rows.
    """
    found = index(spark, path)
    kept = reached(found)
    rows = found.join(kept, ["file", "offset"])
    if not rows.where(~F.col("complete")).isEmpty():
        spread = payloads(spark, path, found, kept).select("file", "offset", base32_sha1(F.col("payload")).alias("_digest"))
        rows = rows.join(spread, ["file", "offset"], "left").withColumn("digest", F.coalesce("_digest", "digest"))
    revisit = F.col("record_type") == "revisit"
    return rows.select("file", "offset", "page_id", "record_type", "refers_to", F.when(revisit, F.col("stated_bytes")).otherwise(F.col("content_bytes")).alias("payload_bytes"),
                       F.when(revisit, F.col("stated_digest")).otherwise(F.col("digest")).alias("payload_digest"))


ORACLE = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS n, sha1(body) AS h FROM p),
b AS (SELECT page_id, n, array_to_string([substr('{BASE32}', (1 + ((CAST('0x' || substr(h, 1 + 10 * (x // 8), 10) AS BIGINT) >> (35 - 5 * (x % 8))) & 31))::INT, 1)
      FOR x IN range(32)], '') AS digest FROM d),
w AS (SELECT digest, max(page_id) AS largest FROM b GROUP BY digest)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = largest THEN NULL ELSE largest END AS refers_to
FROM b JOIN w USING (digest)
"""
