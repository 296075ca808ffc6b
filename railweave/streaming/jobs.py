"""Structured Streaming jobs: CDC upsert, deduplication, rolling flow, sessions, pairing, resolution, quality.

Functions named ``stream_*`` take and return streaming DataFrames; ``start_*`` start a
query whose sink is idempotent per batch, so a replayed batch changes nothing.
"""

from __future__ import annotations

import datetime as dt
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.money import is_inflow, is_outflow, sum_if
from ..operators import cdc, identity
from ..operators.quality import Rules, attach_dq_flags
from ..session import scratch
from ..sources.schemas import BUSINESS_KEY
from ..sources import versioned
from ..sources.storage import has_files, move_folder, remove_folder, write_silver, write_version

PARTY = ["tenant_id", "originator_party_id"]
#: Request keys are paired (and parties counted) in this many buckets: one Python call and one state row per
#: bucket and batch instead of one per key.  Raise it where a bucket's open requests outgrow a state row.
PAIR_BUCKETS = 1024


def batch_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Write every batch to its own folder, replacing what an earlier attempt left."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return write


def snapshot_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Keep the newest complete result; ``read_version`` reads it."""
    def write(df: DataFrame, batch_id: int) -> None:
        write_version(df, path)
    return write


def start(sdf: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append",
          available_now: bool = True) -> StreamingQuery:
    writer = sdf.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def start_cdc(spark: SparkSession, changes: DataFrame, silver: str, checkpoint: str, guard_deletes: bool = False,
              period: str = "day", available_now: bool = True) -> StreamingQuery:
    """Upsert a change stream into stored silver; deletes are remembered beside it.

    An older change never overwrites a newer row: the merge compares timestamps and
    sequences itself, and merging a batch twice equals merging it once.
    """
    graves = silver.rstrip("/") + "-graves"

    def upsert(batch: DataFrame, batch_id: int) -> None:
        if has_files(spark, silver):
            cdc.merge_cdc_incremental(spark, silver, batch, guard_deletes, period, graves)
        else:
            with scratch(spark) as keep:
                newest = cdc.newest_stored(keep(batch, "batch"), keep)
                write_version(newest.filter(F.col("_cdc_operation") == "D"), graves)
                write_silver(newest.filter(F.col("_cdc_operation").isin(*cdc.UPSERT)), silver, period=period)

    return start(changes, upsert, checkpoint, available_now=available_now)


def start_cdc_logged(spark: SparkSession, changes: DataFrame, silver: str, checkpoint: str, guard_deletes: bool = False,
                     period: str = "day", horizon: dt.timedelta | None = None, available_now: bool = True) -> StreamingQuery:
    """Upsert a change stream into versioned silver: one commit per micro-batch.

    Each batch reads the index buckets and periods its keys touch, never all of silver.  A batch
    lost before its commit leaves the previous version readable and is merged again on restart
    (merging twice equals merging once).  With ``horizon``, tombstones older than the batch's
    newest change minus ``horizon`` are compacted as buckets are rewritten.
    """

    def upsert(batch: DataFrame, batch_id: int) -> None:
        with scratch(spark) as keep:
            if versioned.manifest(spark, silver) is None:
                newest = cdc.newest_stored(keep(batch, "batch"), keep)
                versioned.create(newest.filter(F.col("_cdc_operation").isin(*cdc.UPSERT)), silver, period)
                batch = newest.filter(F.col("_cdc_operation") == "D")
                if batch.isEmpty():
                    return
            until = None
            if horizon is not None:
                last = batch.agg(F.max("_cdc_timestamp")).first()[0]
                until = last - horizon if last is not None else None
            cdc.merge_cdc_logged(spark, silver, batch, guard_deletes, horizon=until)

    return start(changes, upsert, checkpoint, available_now=available_now)


def dedup_stream(sdf: DataFrame, delay: str = "1 day") -> DataFrame:
    """Drop replays of a change; the watermark bounds the remembered keys."""
    return sdf.withWatermark("_cdc_timestamp", delay).dropDuplicatesWithinWatermark([*BUSINESS_KEY, "_cdc_sequence_id"])


def stream_flow(sdf: DataFrame, delay: str = "1 day") -> DataFrame:
    """Daily inflow and outflow per tenant and rail."""
    return sdf.withWatermark("transaction_ts", delay).groupBy(F.window("transaction_ts", "1 day").alias("w"), "tenant_id", "payment_type").agg(
        F.count_if(is_inflow()).alias("inbound_count"), sum_if(is_inflow(), "amount").alias("inbound_amount"),
        F.count_if(is_outflow()).alias("outbound_count"), sum_if(is_outflow(), "amount").alias("outbound_amount")).select(
        "tenant_id", F.to_date("w.start").alias("period_date"), "payment_type", "inbound_count", "inbound_amount", "outbound_count", "outbound_amount")


HOUR = 3_600_000_000
WINDOW_HOURS = 24
VELOCITY = "tenant_id string, originator_party_id string, start_hour long, txn_count long"
# what is not closed yet: parties, their hourly counts, and the watermark up to which windows went out, pickled
HOURLY = "hourly binary"


def _hourly(hours: int):
    """What runs on the executors is one closure: it needs no module of this package there."""
    chunk = 1 << 20

    def count(bucket: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """Hourly counts per party of one bucket, and the windows that the watermark has closed since."""
        parties, of, at, n, done = pickle.loads(state.get[0]) if state.exists else ([], *(np.empty(0, np.int64) for _ in range(3)), None)
        index = {p: i for i, p in enumerate(parties)}
        new = [(np.array([index.setdefault(p, len(index)) for p in zip(b["tenant_id"].tolist(), b["originator_party_id"].tolist())], np.int64),
                b["hour"].to_numpy(np.int64)) for b in batches]
        parties, of, at = list(index), np.concatenate([of, *(o for o, _ in new)]), np.concatenate([at, *(h for _, h in new)])
        n = np.concatenate([n, np.ones(len(at) - len(n), np.int64)])
        order = np.lexsort((at, of))
        of, at, n = of[order], at[order], n[order]
        first = np.flatnonzero(np.diff(of, prepend=-1) | np.diff(at, prepend=at[:1])) if len(at) else np.empty(0, np.int64)
        of, at, n = of[first], at[first], np.add.reduceat(n, first) if len(first) else n
        now = state.getCurrentWatermarkMs() * 1000 // 3_600_000_000  # windows up to this hour are over
        yet = at.min() if done is None and len(at) else done or 0
        # a few parties at a time: each hour counts in the windows that end 1 to ``hours`` hours after it began
        cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
        lo = 0
        for c, hi in enumerate(cuts[1:], 1):
            if hi <= lo or (hi < len(of) and (cuts[c + 1] - lo) * hours <= chunk):
                continue
            base = at[lo:hi].min()
            span = int(at[lo:hi].max() - base) + hours + 1
            cell = (np.repeat((of[lo:hi] - of[lo]) * span + at[lo:hi] - base, hours).reshape(-1, hours) + np.arange(1, hours + 1)).ravel()
            cells, where = np.unique(cell, return_inverse=True)
            counts = np.bincount(where, np.repeat(n[lo:hi], hours)).astype(np.int64)
            who, end = cells // span + of[lo], cells % span + base
            out = np.flatnonzero((end > yet) & (end <= now))
            if len(out):
                names = who[out]
                yield pd.DataFrame({
                    "tenant_id": np.array([t for t, _ in parties], object)[names], "originator_party_id": np.array([p for _, p in parties], object)[names],
                    "start_hour": end[out] - hours, "txn_count": counts[out]})
            lo = hi
        open_ = at + hours > now
        if open_.any():
            used, of = np.unique(of[open_], return_inverse=True)
            at, n = at[open_], n[open_]
            state.update((pickle.dumps(([parties[i] for i in used.tolist()], of.astype(np.int64), at, n, max(now, yet)), pickle.HIGHEST_PROTOCOL),))
            wake = max(int(at.min()), int(now)) + 1
            state.setTimeoutTimestamp(max(wake * 3_600_000 - 1, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()

    return count


def stream_velocity(sdf: DataFrame, delay: str = "1 day", buckets: int = PAIR_BUCKETS) -> DataFrame:
    """Transactions per party in every 24 hours, stepping by the hour.

    State holds one count per party and hour, in buckets of parties, and a window is summed when
    the watermark closes it: a row is not copied into its 24 windows on the way.  A late row still
    counts in those of its windows that are open.
    """
    hour = F.floor(F.unix_micros("transaction_ts") / F.lit(HOUR)).cast("long")
    # a row is too late when its last window is closed, so that is the event time state goes by
    closes = F.timestamp_micros((hour + WINDOW_HOURS) * HOUR).alias("closes", metadata={"spark.watermarkDelayMs": 0})
    rows = sdf.withWatermark("transaction_ts", delay).where("transaction_ts is not null").select(
        *PARTY, hour.alias("hour"), closes, F.pmod(F.xxhash64(*PARTY), F.lit(buckets)).cast("int").alias("bucket"))
    counted = rows.groupBy("bucket").applyInPandasWithState(_hourly(WINDOW_HOURS), VELOCITY, HOURLY, "append", GroupStateTimeout.EventTimeTimeout)
    start = lambda back: F.timestamp_micros((F.col("start_hour") + back) * HOUR)
    return counted.select(*PARTY, start(0).alias("window_start"), start(WINDOW_HOURS).alias("window_end"), "txn_count")


def stream_sessions(sdf: DataFrame, gap: str = "30 minutes", delay: str = "1 day") -> DataFrame:
    """Bursts of activity per party, closed by ``gap`` of silence."""
    return sdf.withWatermark("transaction_ts", delay).groupBy(F.session_window("transaction_ts", gap).alias("w"), *PARTY).agg(
        F.count("*").alias("txn_count"), F.sum("amount").alias("amount")).select(
        *PARTY, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "txn_count", "amount")


REQUEST = ["tenant_id", "payment_type", "request_key"]
PAIRED = ("tenant_id string, payment_type string, request_key string, request_id string, requested_ts timestamp, expiry_ts timestamp, "
          "answer_id string, answered_ts timestamp")
# requests (key, id, asked, expiry, until, answered) and answers (key, id, at), instants in microseconds, pickled
# by the one function that reads them: as SQL structs every field would be converted twice a row and batch
OPEN = "open binary"
#: A request without expiry takes answers for this long after it was made; then it leaves state
#: without counting as expired.
OPEN_FOR = dt.timedelta(days=30)
STAMPS = ("requested_ts", "expiry_ts", "answered_ts")


def _settler(open_for: dt.timedelta):
    """What runs on the executors is one closure: it needs no module of this package there."""
    wait = open_for // dt.timedelta(microseconds=1)

    def micros(stamps: pd.Series) -> list[int | None]:
        values = stamps.astype("datetime64[us]")
        return [None if gone else v for v, gone in zip(values.astype("int64").tolist(), values.isna().tolist())]

    def settle(bucket: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """Pair the request keys of one bucket: what waits is open requests and answers that may still meet one."""
        requests, answers = pickle.loads(state.get[0]) if state.exists else ([], [])
        old_requests, old_answers, out = len(requests), len(answers), []
        for batch in batches:
            keys = [batch[c].tolist() for c in REQUEST]
            for *key, ts, request, expiry, answer in zip(*keys, micros(batch["ts"]), batch["request_id"].tolist(),
                                                         micros(batch["expiry_ts"]), batch["answer_id"].tolist()):
                if answer is None:
                    until = expiry if expiry is not None else ts + wait if ts is not None else None
                    requests.append([*key, request, ts, expiry, until, False])
                else:
                    answers.append([*key, answer, ts])
        asked: dict[tuple, list[int]] = {}
        for i, r in enumerate(requests):
            if r[4] is not None and r[6] is not None:
                asked.setdefault(tuple(r[:3]), []).append(i)
        # pairs of an old request and an old answer went out before
        fresh = {tuple(r[:3]) for r in requests[old_requests:]}
        for j, (*key, answer, at) in enumerate(answers):
            if at is None or (j < old_answers and tuple(key) not in fresh):
                continue
            for i in asked.get(tuple(key), ()):
                r = requests[i]
                if (i >= old_requests or j >= old_answers) and r[4] <= at <= r[6]:
                    out.append((*r[:6], answer, at))
                    r[7] = True
        now = state.getCurrentWatermarkMs() * 1000
        out += [(*r[:6], None, None) for r in requests if r[6] is not None and r[6] < now and not r[7] and r[5] is not None]
        requests = [r for r in requests if r[6] is not None and r[6] >= now]
        answers = [a for a in answers if a[4] is not None and a[4] >= now]  # a request yet to come is later than these
        if requests or answers:
            state.update((pickle.dumps((requests, answers), pickle.HIGHEST_PROTOCOL),))
            wake = min([r[6] for r in requests] + [a[4] for a in answers])
            state.setTimeoutTimestamp(max(wake // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        if out:
            found = pd.DataFrame(out, columns=[f.split()[0] for f in PAIRED.split(", ")])
            for c in STAMPS:
                found[c] = pd.to_datetime(found[c].astype("Int64"), unit="us")
            yield found

    return settle


def _pair(requests: DataFrame, responses: DataFrame, delay: str, open_for: dt.timedelta = OPEN_FOR, buckets: int = PAIR_BUCKETS) -> DataFrame:
    """Requests with each answer up to their own expiry, and without answer once that has passed.

    The bound is the expiry of each request, so state is held per bucket of request keys and a
    request leaves when the watermark passes its expiry; timestamps are in UTC.  A request without
    expiry is held ``open_for`` after it was made, takes the answers of that time and never counts
    as expired.
    """
    none = lambda kind: F.lit(None).cast(kind)
    asked = requests.select(*REQUEST, F.col("requested_ts").alias("ts"), "request_id", "expiry_ts", none("string").alias("answer_id"))
    answered = responses.select(*REQUEST, F.col("answered_ts").alias("ts"), none("string").alias("request_id"), none("timestamp").alias("expiry_ts"), "answer_id")
    events = asked.unionByName(answered).withWatermark("ts", delay)
    bucket = F.pmod(F.xxhash64(*REQUEST), F.lit(buckets)).cast("int")
    return events.withColumn("bucket", bucket).groupBy("bucket").applyInPandasWithState(
        _settler(open_for), PAIRED, OPEN, "append", GroupStateTimeout.EventTimeTimeout)


def stream_rfp(requests: DataFrame, responses: DataFrame, delay: str = "1 day", open_for: dt.timedelta = OPEN_FOR) -> DataFrame:
    """Requests for payment with the answers that came before expiry (or within ``open_for`` when
    a request has none); both inputs deduplicated."""
    return _pair(requests, responses, delay, open_for).filter("answer_id is not null")


def stream_expiry(requests: DataFrame, responses: DataFrame, delay: str = "1 day") -> DataFrame:
    """Requests that ran out unanswered, emitted when the watermark passes their expiry."""
    return _pair(requests, responses, delay).filter("answer_id is null").select(
        *REQUEST, "request_id", "requested_ts", "expiry_ts", F.lit("EXPIRED").alias("status"))


def rfp_expired(requests: DataFrame, as_of) -> DataFrame:
    """Batch twin: requests whose expiry has passed and whose status is still open."""
    return requests.filter(F.col("rfp_expiry_timestamp").isNotNull() & (F.col("rfp_expiry_timestamp") <= F.lit(as_of).cast("timestamp"))
                           & F.col("status").isin("INITIATED", "PENDING"))


def start_resolution(queue: DataFrame, parties: DataFrame, accounts: DataFrame, out: str, checkpoint: str,
                     available_now: bool = True) -> StreamingQuery:
    """Resolve arriving rows against the identity snapshot of each batch."""
    sink = batch_sink(out)

    def decide(batch: DataFrame, batch_id: int) -> None:
        sink(identity.resolve(identity.open_roles(batch), parties, accounts), batch_id)

    return start(queue, decide, checkpoint, available_now=available_now)


def start_dq(sdf: DataFrame, good: str, bad: str, checkpoint: str, rules: Rules | None = None,
             available_now: bool = True) -> StreamingQuery:
    """Split arriving rows into clean and quarantined folders.

    A batch is read and flagged once: one write deals its rows to two folders beside the sink,
    which then take the place of what an earlier attempt at the batch left.
    """
    sides = {"false": good, "true": bad}

    def split(batch: DataFrame, batch_id: int) -> None:
        staged = f"{good}/_staged={batch_id}"  # Spark's readers pass over names that begin so
        flagged = attach_dq_flags(batch, rules)
        flagged.withColumn("_broken", F.col("dq_flags_json").isNotNull()).write.mode("overwrite").option("compression", "zstd").partitionBy("_broken").parquet(staged)
        for value, out in sides.items():
            if not move_folder(batch.sparkSession, f"{staged}/_broken={value}", f"{out}/batch={batch_id}"):
                batch_sink(out)(batch.sparkSession.createDataFrame([], flagged.schema), batch_id)
        remove_folder(batch.sparkSession, staged)

    return start(sdf, split, checkpoint, available_now=available_now)
