import random
import zlib

from pyspark.sql import functions as F

from railweave.llm import sharding

DOCS = "doc_id long, text string, size string, shard int"


def corpus():
    r = random.Random(5)
    rows = [(i, "".join(r.choice("abcé ") for _ in range(r.choice((5, 60, 300)))), "s", 7) for i in range(700)]
    rows += [(1000 + i, "one hot text " * 4, None, None) for i in range(400)]  # a third of all rows
    rows += [(2000 + i, f"small group {i // 3} " * 3, "", 1) for i in range(60)]
    return rows + [(3000, None, "", 1), (3001, "", "", 1), (3002, "repeated", "", 1), (3002, "repeated", "", 1), (None, "no id", "", 1)]


def test_bytes_are_even_slots_have_no_gaps_and_small_groups_stay_whole(spark):
    rows = corpus()
    got = sharding.shard_documents(spark.createDataFrame(rows, DOCS).repartition(3), shards=9).collect()
    assert len(got) == len(rows)
    text = {r[0]: r[1] or "" for r in rows}
    shards, groups = {}, {}
    for r in got:
        raw = text[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        shards.setdefault(r.shard, []).append(r)
        groups.setdefault(text[r.doc_id], set()).add(r.shard)
    assert sorted(shards) == list(range(9))
    mean = sum(r.size for r in got) / 9
    for own in shards.values():
        assert abs(sum(r.size for r in own) - mean) < 0.05 * mean
        assert sorted(r.slot for r in own) == list(range(len(own)))
    assert sum(len(s) > 1 for t, s in groups.items() if t.startswith("small group")) == 0


def test_target_bytes_few_rows_and_none(spark):
    rows = spark.createDataFrame([(1, "abc", "", 1), (2, None, "", 1)], DOCS)
    got = sharding.shard_documents(rows, shards=40).collect()
    assert len(got) == 2 and all(r.slot == 0 for r in got) and len({r.shard for r in got}) == 2
    assert sharding.shard_documents(rows.limit(0)).count() == 0
    table = spark.createDataFrame([(i, "x" * 84, "", 1) for i in range(64)], DOCS)
    whole = sharding.kd_shards(table, {"id": F.col("doc_id")}, F.col("text"), F.col("doc_id"), target_bytes=800, extra={"text_bytes": F.length("text")}).collect()
    assert len({r.shard for r in whole}) == 8
    spans = sorted((min(r.row_id for r in whole if r.shard == s), max(r.row_id for r in whole if r.shard == s)) for s in range(8))
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))  # one dimension: ranges of it
