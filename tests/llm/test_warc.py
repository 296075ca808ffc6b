import base64
import hashlib

from railweave.llm import warc
from railweave.session import scratch_path

PAGES = "page_id long, url string, html string, value string, file string"
FAKE = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\nX-Page-Id: 99\r\n\r\nabc\r\n\r\n"


def read_back(spark, rows, **names):
    path = scratch_path(spark, "warc-test")
    warc.write(spark.createDataFrame(rows, PAGES), path, records_per_file=7, **names)
    return warc.read(spark, path).collect()


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def rows():
    texts = ["<p>é</p>", None, "", FAKE, "x" + FAKE * 3, "WARC/1.0\r\n", "\r\n\r\n", "a\r\nWARC/1.0\r\nb", "é" * 20_000 + FAKE + "z" * 50_000]
    out = [(i, None if i == 3 else f"http://h/{i}\r\nX-Page-Id: 5", texts[i % len(texts)], "v", "f") for i in range(40)]
    return out + [(100 + i, "u", f"page {i} " + "y" * (37 * i), None, None) for i in range(60)] + [(200, "u", "twice", "", "")] * 2


def test_round_trip_rejects_magic_in_payloads(spark):
    small = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        given, got = rows(), read_back(spark, rows())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", small)
    assert sorted(r.page_id for r in got) == sorted(r[0] for r in given)
    text, last = {r[0]: r[2] or "" for r in given}, {}
    for i, t in text.items():
        last[t] = max(i, last.get(t, i))
    for r in got:
        t = text[r.page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(t.encode()), digest(t))
        assert (r.record_type, r.refers_to) == (("response", None) if last[t] == r.page_id else ("revisit", last[t]))


def test_small_payloads_and_no_rows(spark):
    given = [(1, "u", "ab", "", ""), (2, "u", "ab", "", ""), (3, "u", "abcdef", "", ""), (4, "u", "abcdef", "", ""), (None, None, "abcdef", "", "")]
    got = {r.page_id: r.record_type for r in read_back(spark, given, least_bytes=3)}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response", None: "revisit"}
    assert read_back(spark, []) == []


def test_garbage_before_the_first_record(spark):
    path = scratch_path(spark, "warc-test")
    spark.createDataFrame([("junk" + FAKE,)], "value string").write.option("lineSep", "\r\n\r\n").text(path)
    assert warc.read(spark, path).collect() == []
