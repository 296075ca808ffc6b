"""Wide rows and many keys: a merge moves only what its reader asks for, streams hold keys in buckets."""

from __future__ import annotations

import datetime as dt

import pandas as pd

from railweave.operators import cdc
from railweave.sources.schemas import BUSINESS_KEY
from railweave.streaming import jobs

SCHEMA = ("tenant_id string, source_system string, source_transaction_id string, _cdc_timestamp timestamp, _cdc_sequence_id string, "
          "ingestion_ts timestamp, event_id string, _cdc_operation string, amount int, note string")


def change(key, day, op, amount):
    at = dt.datetime(2024, 1, day)
    return ("T", "core", key, at, "1", at, f"{key}{day}", op, amount, "x" * 50)


def test_a_merge_moves_only_the_columns_its_reader_takes(spark, tmp_path):
    """A checkpoint of the whole batch inside the merge kept every column of it."""
    sides = {"target": [change("a", 2, "I", 1), change("b", 2, "I", 2), change("c", 2, "I", 3), change("d", 2, "I", 4)],
             "batch": [change("a", 3, "U", 10), change("b", 1, "U", 20), change("c", 1, "D", 30), change("e", 1, "I", 50), change("f", 1, "D", 60)]}
    for name, rows in sides.items():
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/{name}")
    target, batch = (spark.read.parquet(f"{tmp_path}/{name}") for name in sides)
    for guard, left in ((False, {"a": 10, "b": 2, "d": 4, "e": 50}), (True, {"a": 10, "b": 2, "c": 3, "d": 4, "e": 50})):
        merged = cdc.merge_cdc(target, batch, guard_deletes=guard).select(*BUSINESS_KEY, "amount")
        assert {r.source_transaction_id: r.amount for r in merged.collect()} == left
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "note" not in plan and "ExistingRDD" not in plan


def test_requests_pair_in_buckets_not_one_state_per_key(spark, tmp_path):
    """Two deliveries; answers on time, late, before the request, to a repeated key, and none."""
    hour = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    ask = "tenant_id string, payment_type string, request_key string, request_id string, requested_ts timestamp, expiry_ts timestamp"
    answer = "tenant_id string, payment_type string, request_key string, answer_id string, answered_ts timestamp"
    asked = [("T", "RTP", f"k{i}", f"q{i}", hour(10), hour(14) if i % 5 else None) for i in range(100)]
    asked += [("T", "RTP", "k1", "again", hour(11), hour(13)), ("T", "RTP", "end", "end", hour(200), hour(300))]
    answered = [("T", "RTP", f"k{i}", f"a{i}", hour((12, 16, 9, 14)[i % 4])) for i in range(0, 80)]
    feeds = {"ask": (ask, asked[:60], asked[60:]), "answer": (answer, answered[:30], answered[30:])}
    queries = []
    for part in (0, 1):
        sides = []
        for name, (schema, *parts) in feeds.items():
            spark.createDataFrame(parts[part], schema).write.mode("append").parquet(f"{tmp_path}/{name}")
            sides.append(spark.readStream.schema(schema).parquet(f"{tmp_path}/{name}"))
        query = jobs.start(jobs._pair(*sides, "1 day", buckets=8), jobs.batch_sink(f"{tmp_path}/out"), f"{tmp_path}/ckpt")
        query.awaitTermination()
        queries.append(query)
    assert all(p.stateOperators[0].numRowsTotal <= 8 for q in queries for p in q.recentProgress)
    found = spark.read.parquet(f"{tmp_path}/out").collect()
    late = dt.timedelta(days=30)
    pairs = {(q[3], a[3]) for q in asked for a in answered if q[2] == a[2] and q[4] <= a[4] <= (q[5] or q[4] + late)}
    assert sorted((r.request_id, r.answer_id) for r in found if r.answer_id) == sorted(pairs)
    met = {q for q, _ in pairs}
    assert sorted(r.request_id for r in found if not r.answer_id) == sorted(q[3] for q in asked if q[5] and q[5] < hour(176) and q[3] not in met)
    assert {(r.requested_ts, r.expiry_ts) for r in found if r.request_id == "q1"} == {(hour(10), hour(14))}


def test_aggregated_newest_change_packs_only_the_named_columns(spark):
    rows = spark.createDataFrame([change("a", 1, "I", 1), change("a", 2, "U", 2), change("b", 1, "D", 3)], SCHEMA)
    newest = cdc.latest_changes_agg(rows, columns=["source_transaction_id", "amount"])
    assert sorted(map(tuple, newest.collect())) == [("a", 2), ("b", 3)]
    assert cdc.latest_changes_agg(rows).columns == rows.columns
    assert "note" not in newest._jdf.queryExecution().optimizedPlan().toString().split("LogicalRDD")[0]


def test_what_a_bucket_waits_for_is_stored_in_one_piece():
    """As SQL structs every waiting request was converted field by field, on the way in and out of every batch."""

    class Held:
        exists, value, wake = False, None, None

        @property
        def get(self):
            return self.value

        def update(self, value):
            self.exists, self.value = True, value

        def remove(self):
            self.exists, self.value = False, None

        def getCurrentWatermarkMs(self):
            return 0

        def setTimeoutTimestamp(self, at):
            self.wake = at

    settle, state = jobs._settler(jobs.OPEN_FOR), Held()
    at = lambda hour: pd.Timestamp(2024, 1, 1, hour)
    names = [*jobs.REQUEST, "ts", "request_id", "expiry_ts", "answer_id"]
    asked = pd.DataFrame([("T", "RTP", f"k{i}", at(1), f"r{i}", at(5), None) for i in range(50)], columns=names)
    assert list(settle((0,), iter([asked]), state)) == []
    assert len(state.value) == 1 and isinstance(state.value[0], bytes) and jobs.OPEN == "open binary"
    answers = pd.DataFrame([("T", "RTP", "k7", at(4), None, pd.NaT, "a7"), ("T", "RTP", "k8", at(6), None, pd.NaT, "a8")], columns=names)
    found, = settle((0,), iter([answers]), state)
    assert found[["request_id", "answer_id"]].values.tolist() == [["r7", "a7"]]


def test_dq_batch_is_flagged_once_and_replayed_in_place(spark):
    """One write serves both folders, nothing is cached, and a replay replaces what it left."""
    from pyspark.sql import functions as F
    from railweave.session import scratch_path
    from railweave.streaming import jobs
    feed, good, bad = (scratch_path(spark, label) for label in ("feed", "good", "bad"))
    spark.range(20).select(F.col("id").alias("n"), F.lit("x").alias("s")).write.parquet(feed)
    rules = {"odd": F.col("n") % 2 == 1}
    arriving = spark.readStream.schema("n long, s string").parquet(feed)
    for again in range(2):  # another checkpoint: the same batch number comes again
        jobs.start_dq(arriving, good, bad, f"{good}-ckpt{again}", rules).awaitTermination()
    clean, broken = spark.read.parquet(good), spark.read.parquet(bad)
    assert sorted(r.n for r in clean.collect()) == list(range(0, 20, 2))
    assert sorted((r.n, r.dq_flags_json) for r in broken.collect()) == [(n, '["odd"]') for n in range(1, 20, 2)]
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(good)
    names = [f.getPath().getName() for f in root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(root)]
    assert names == ["batch=0"]
    assert "persist" not in __import__("inspect").getsource(jobs.start_dq)
    # a batch without broken rows still leaves a folder that can be read
    jobs.start_dq(arriving, good + "2", bad + "2", good + "2-ckpt", {"never": F.lit(False)}).awaitTermination()
    assert spark.read.parquet(bad + "2").count() == 0 and spark.read.parquet(good + "2").count() == 20


def test_velocity_keeps_hours_not_windows(spark):
    """State is a row per bucket of parties, not one per party and window; the counts are those of every closed window."""
    import datetime as dt
    from collections import Counter
    from pyspark.sql import functions as F
    from railweave.session import scratch_path
    from railweave.streaming import jobs
    feed, out = scratch_path(spark, "feed"), scratch_path(spark, "velocity")
    begin, seen = dt.datetime(2024, 1, 1), []
    schema = "tenant_id string, originator_party_id string, transaction_ts timestamp"
    for day in range(2):
        rows = [("t", f"p{i % 5}" if i % 7 else None, begin + dt.timedelta(days=2 * day, minutes=37 * i)) for i in range(60)]
        seen += rows
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(feed)
        query = jobs.start(jobs.stream_velocity(spark.readStream.schema(schema).parquet(feed), buckets=3), jobs.batch_sink(out), out + "-ckpt")
        query.awaitTermination()
        assert max(p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators) <= 3
    closed = max(ts for *_, ts in seen) - dt.timedelta(days=1)
    want = Counter()
    for tenant, party, ts in seen:
        hour = ts.replace(minute=0, second=0, microsecond=0)
        for back in range(24):
            start = hour - dt.timedelta(hours=back)
            if start + dt.timedelta(hours=24) <= closed:
                want[tenant, party, str(start)] += 1
    found = spark.read.parquet(out).select("tenant_id", "originator_party_id", F.col("window_start").cast("string"), "txn_count").collect()
    assert len(found) == len(want) and {tuple(r)[:3]: r.txn_count for r in found} == dict(want)
