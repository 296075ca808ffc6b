"""Change data capture: newest change per key, merge, history and lag."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.timeline import HOT_ROWS, SLOTS, neighbour
from ..session import cut_lineage, scratch
from ..sources.schemas import BUSINESS_KEY as KEY
from ..sources.schemas import CHANGE_ORDER
from ..sources import versioned
from ..sources.places import FILE, ROW, chosen, marks, placed
from ..sources.storage import period_start, read_version, write_silver, write_version

UPSERT = ("I", "U")


def latest_changes(changes: DataFrame, keys: list[str] = KEY, order: list[str] = CHANGE_ORDER) -> DataFrame:
    """Newest change per key.

    Spark cuts each task's rows to one per key before the shuffle (window group
    limit), so a key with many changes does not gather in one task.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(o) for o in order])
    return changes.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn")


def latest_changes_agg(changes: DataFrame, keys: list[str] = KEY, order: list[str] = CHANGE_ORDER,
                       columns: list[str] | None = None) -> DataFrame:
    """The same by aggregation with map-side combine.

    The row travels packed in the aggregate, where unused columns cannot be pruned: name the
    ``columns`` wanted and no other moves.
    """
    columns = changes.columns if columns is None else columns
    best = F.max_by(F.struct(*[c for c in columns if c not in keys]), F.struct(*order)).alias("_best")
    return changes.groupBy(*keys).agg(best).select(*keys, "_best.*").select(*columns)


def is_newer(s: str = "_s", t: str = "_t", numeric_sequence: bool = False) -> Column:
    """Is the staged row newer than the target row: by timestamp, then by sequence.

    Sequences compare as text; ``numeric_sequence`` compares them as numbers.
    A missing side is never newer.
    """
    st, tt = F.col(f"{s}._cdc_timestamp"), F.col(f"{t}._cdc_timestamp")
    ss, ts = F.col(f"{s}._cdc_sequence_id"), F.col(f"{t}._cdc_sequence_id")
    if numeric_sequence:
        ss, ts = ss.cast("bigint"), ts.cast("bigint")
    return F.coalesce((st > tt) | ((st == tt) & (ss > ts)), F.lit(False))


def tombstones(changes: DataFrame) -> DataFrame:
    """Newest delete per key; feed them to later merges so that an older insert stays out."""
    return latest_changes(changes).filter(F.col("_cdc_operation") == "D")


def merge_cdc(target: DataFrame, changes: DataFrame, guard_deletes: bool = False,
              graves: DataFrame | None = None, deduplicated: bool = False) -> DataFrame:
    """Target after the change batch.

    Matched delete removes the row, matched newer insert or update replaces it, an
    unmatched one is added, everything else keeps the target.  Deletes apply whatever
    their age unless ``guard_deletes``; ``graves`` adds remembered deletes to the batch.

    The target is the left side of an outer join and of a semi join on bare keys: with
    a small batch both broadcast it and the target does not move; with a large batch
    both shuffle on the key, which AQE splits where skewed.  The result is lazy and every
    column is chosen by itself, so a reader of a few columns moves only those; a batch that
    is costly to derive is better stored and deduplicated by the caller (``deduplicated``).
    """
    batch = changes.unionByName(graves) if graves is not None else changes
    staged = batch if deduplicated else latest_changes(batch)
    columns = target.columns
    same_key = reduce(and_, (F.col(f"_t.{k}") == F.col(f"_s.{k}") for k in KEY))
    joined = target.alias("_t").join(staged.alias("_s"), same_key, "left")
    op = F.col("_s._cdc_operation")
    gone = (op == "D") & (is_newer() if guard_deletes else F.lit(True))
    replaced = op.isin(*UPSERT) & is_newer()
    kept = joined.filter(~F.coalesce(gone, F.lit(False))).select(
        *[F.when(replaced, F.col(f"_s.`{c}`")).otherwise(F.col(f"_t.`{c}`")).alias(c) for c in columns])
    known = target.select(*KEY).join(staged.select(*KEY), KEY, "left_semi")
    added = staged.filter(F.col("_cdc_operation").isin(*UPSERT)).join(known, KEY, "left_anti").select(*columns)
    return kept.unionByName(added)


def merge_actions(target: DataFrame, changes: DataFrame, guard_deletes: bool = False) -> DataFrame:
    """What ``merge_cdc`` with the same ``guard_deletes`` does with each key, from the key and order columns only."""
    order = ["_cdc_timestamp", "_cdc_sequence_id"]
    staged = latest_changes(changes.select(*KEY, *CHANGE_ORDER, "_cdc_operation")).select(
        *KEY, F.struct(*order, "_cdc_operation").alias("_s"))
    pairs = target.select(*KEY, F.struct(*order).alias("_t")).join(staged, KEY, "full_outer")
    op, here, there = F.col("_s._cdc_operation"), F.col("_t").isNotNull(), F.col("_s").isNotNull()
    action = (
        F.when(here & ~there, "KEEP")
        .when(here & (op == "D"), F.when(is_newer() | F.lit(not guard_deletes), "DELETE").otherwise("STALE_DELETE"))
        .when(here, F.when(is_newer(), "UPDATE").otherwise("STALE"))
        .when(op == "D", "IGNORED_DELETE").otherwise("INSERT"))
    return pairs.select(*KEY, action.alias("action"))


def merge_audit(target: DataFrame, changes: DataFrame, guard_deletes: bool = False) -> DataFrame:
    return merge_actions(target, changes, guard_deletes).groupBy("tenant_id", "action").agg(F.count("*").alias("key_count"))


def merge_cdc_incremental(spark: SparkSession, path: str, changes: DataFrame, guard_deletes: bool = False,
                          period: str = "day", graves: str | None = None) -> None:
    """Merge a batch into stored silver, rewriting only partitions touched on either side.

    With ``graves``, deletes are remembered in that folder, so that an older insert that
    arrives after its delete stays out.

    An update may move a row to another day, so both the old and the new day count.
    Which rows stay and which changes enter is decided on keys and places (``sources/places.py``);
    the wide rows move once, in the write, which replaces its own input files when it commits.
    """
    target = spark.read.parquet(path)
    columns = [c for c in target.columns if c != "txn_date"]
    batch = changes.select(*columns)
    if graves and (dead := read_version(spark, graves)) is not None:
        batch = batch.unionByName(dead.select(*columns))
    with scratch(spark) as keep:
        raw = keep(batch, "batch")
        staged = keep(_newest_places(raw), "newest")
        # a row without period is in no partition that can be touched
        dated = target.where("txn_date is not null").withColumn("_period", F.col("txn_date"))
        pairs = keep(_pairs(dated, staged.withColumn("_allowed", F.lit(True)), guard_deletes), "pairs")
        old = pairs.where(_here()).select(F.col("_t._period").alias("txn_date"))
        new = staged.filter(F.col("_cdc_operation").isin(*UPSERT)).select(
            period_start(F.to_date("transaction_ts"), period).alias("txn_date"))
        touched = cut_lineage(old.union(new).distinct())
        days = [r[0] for r in touched.dropna().collect()]  # one entry per period touched
        part = target.where(F.col("txn_date").isin(days)).select(*columns)
        buried = chosen(raw, marks(staged.where(F.col("_cdc_operation") == "D"), keep)) if graves else None
        write_silver(_applied(part, raw, pairs, keep), path, touched, period)
        if graves:
            write_version(buried, graves)


def _here() -> Column:
    """In ``_pairs``: the key has a stored row."""
    return F.col(f"_t.{FILE}").isNotNull()


def _newest_places(raw: DataFrame) -> DataFrame:
    """Place, key, order and period columns of the newest change per key of a stored batch."""
    return latest_changes(placed(raw).select(*KEY, *CHANGE_ORDER, "_cdc_operation", "transaction_ts", FILE, ROW))


def newest_stored(raw: DataFrame, keep: Callable[..., DataFrame]) -> DataFrame:
    """``latest_changes`` of a stored batch without moving its wide rows."""
    return chosen(raw, marks(_newest_places(raw), keep))


def _pairs(target: DataFrame | None, staged: DataFrame, guard_deletes: bool) -> DataFrame:
    """What ``merge_cdc`` does with each pair of a staged change and a stored row of its key, by places.

    ``staged`` has one row per key (``_newest_places``) and ``_allowed``; ``target`` is read from
    files, or None where there are none, and has ``_period``.  ``_out``: the row leaves; ``_in``: the change enters.  A change
    without a row is one pair whose ``_t`` is null.
    """
    order = ["_cdc_timestamp", "_cdc_sequence_id"]
    none = staged.where(F.lit(False)).withColumn("_period", F.to_date("transaction_ts"))
    rows = (none if target is None else placed(target)).select(*KEY, F.struct(*order, "_period", FILE, ROW).alias("_t"))
    changes = staged.select(*KEY, F.struct(*order, "_cdc_operation", "transaction_ts", FILE, ROW).alias("_s"), "_allowed")
    op = F.col("_s._cdc_operation")
    gone = (op == "D") & (is_newer() if guard_deletes else F.lit(True))
    upsert = op.isin(*UPSERT)
    allowed = F.col("_allowed")
    return changes.join(rows, KEY, "left").select(
        *KEY, "_s", "_t", F.coalesce(allowed & _here() & (gone | (upsert & is_newer())), F.lit(False)).alias("_out"),
        F.coalesce(allowed & upsert & (~_here() | is_newer()), F.lit(False)).alias("_in"))


def _applied(target: DataFrame | None, raw: DataFrame, pairs: DataFrame, keep: Callable[..., DataFrame]) -> DataFrame:
    """Rows of ``target`` that stay and rows of ``raw`` that enter, read where they lie."""
    place = lambda side, which: pairs.where(which).select(f"{side}.{FILE}", f"{side}.{ROW}")
    entering = place("_s", "_in")
    merged = chosen(raw, marks(entering, keep))
    if target is not None:
        merged = merged.unionByName(chosen(target, marks(place("_t", "_out"), keep), marked=False).select(*raw.columns))
    # a key stored several times: the change takes the place of every one of its rows
    again = keep(entering.groupBy(FILE, ROW).agg(F.count("*").alias("_n")).where("_n > 1"), "again")
    if not again.isEmpty():
        merged = merged.unionByName(placed(raw).join(again, [FILE, ROW]).withColumn(
            "_copy", F.explode(F.sequence(F.lit(2), F.col("_n").cast("int")))).select(*raw.columns))
    return merged


def merge_cdc_logged(spark: SparkSession, path: str, changes: DataFrame, guard_deletes: bool = False,
                     horizon: dt.datetime | None = None, fail_before_commit: bool = False) -> dict:
    """Merge a batch into versioned silver (``sources/versioned.py``) and publish the next commit.

    The batch's keys are looked up in the index buckets they hash to; the periods to rewrite
    are those the index names for them and those their new rows fall in, so silver is read
    only in those periods and never scanned for keys.  Deleted keys leave tombstones in the
    index, and an older insert that arrives after its delete stays out.

    ``horizon`` compacts: tombstones older than it are dropped from every bucket this merge
    rewrites, and the commit remembers the horizon.  From then on a change older than the
    horizon whose key has no row is refused as late, so an old insert stays out although its
    tombstone is gone.  Nothing is visible until the commit file is renamed into place; with
    ``fail_before_commit`` the merge stops just before that (tests of a lost job).
    Returns the new commit.
    """
    state = versioned.manifest(spark, path)
    if state is None:
        raise FileNotFoundError(f"no commit at {path}; create the first version with versioned.create")
    period, buckets, version = state["period"], state["buckets"], state["version"] + 1
    declared = versioned.data_schema(state).fields
    columns = [f.name for f in declared]
    with scratch(spark) as keep:
        raw = keep(changes.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in declared)), "batch")
        staged = keep(_newest_places(raw), "newest")
        wanted = sorted(r[0] for r in staged.select(versioned.bucket_of(buckets=buckets)).distinct().collect())
        bucket_rows = versioned.read_index(spark, path, state, wanted)  # a commit's files never change
        hits = keep(bucket_rows.join(staged.select(*KEY), KEY, "left_semi"), "hits")
        living = hits.where(~F.col("dead"))
        start = period_start(F.to_date("transaction_ts"), period)
        old_days = {versioned.day_name(r[0]) for r in living.select("txn_date").distinct().collect()}
        new_days = {versioned.day_name(r[0]) for r in staged.where(F.col("_cdc_operation").isin(*UPSERT)).select(start).distinct().collect()}
        touched = sorted(old_days | new_days)
        target = versioned.read_days(spark, path, state, touched).select(*columns).withColumn("_period", start) \
            if set(touched) & set(state["days"]) else None
        graves = hits.where(F.col("dead")).select(*KEY, *CHANGE_ORDER, F.lit("D").alias("_cdc_operation"))
        pairs = keep(_pairs(target, _admitted(staged, hits, state.get("horizon")), guard_deletes), "pairs")
        stamp = versioned.token(version)
        days = versioned.write_days(_applied(target, raw, pairs, keep), path, stamp, period)
        # the batch's keys get fresh entries: their row's period, or a tombstone when they end without a row
        entered = pairs.where("_in").select(*KEY, period_start(F.to_date("_s.transaction_ts"), period).alias("txn_date"))
        stayed = pairs.where(_here() & ~F.col("_out")).select(*KEY, F.col("_t._period").alias("txn_date"))
        rows_now = entered.unionByName(stayed).dropna(subset=KEY).select(
            *KEY, "txn_date", F.lit(False).alias("dead"), *(F.lit(None).cast(staged.schema[c].dataType).alias(c) for c in CHANGE_ORDER))
        deaths = latest_changes(staged.where(F.col("_cdc_operation") == "D").select(*KEY, *CHANGE_ORDER, "_cdc_operation")
                                .unionByName(graves)).join(rows_now.select(*KEY), KEY, "left_anti")
        kept_horizon = max(filter(None, [state.get("horizon"), horizon.isoformat(sep=" ") if horizon else None]), default=None)
        if kept_horizon:
            deaths = deaths.where(F.col("_cdc_timestamp") >= F.lit(kept_horizon).cast("timestamp"))
        tombs = deaths.select(*KEY, F.lit(None).cast("date").alias("txn_date"), F.lit(True).alias("dead"), *CHANGE_ORDER)
        others = bucket_rows.join(staged.select(*KEY), KEY, "left_anti")
        if horizon is not None:
            others = others.where(~F.col("dead") | (F.col("_cdc_timestamp") >= F.lit(kept_horizon).cast("timestamp")))
        index = versioned.write_index(others.unionByName(rows_now).unionByName(tombs), path, stamp, buckets)
    new_state = dict(state, version=version, horizon=kept_horizon,
                     days={**{d: f for d, f in state["days"].items() if d not in touched}, **days},
                     index={**{b: f for b, f in state["index"].items() if b not in {f"bucket={w}" for w in wanted}}, **index})
    if fail_before_commit:
        raise RuntimeError("stopped before the commit")
    versioned.publish(spark, path, new_state)
    return new_state


def _admitted(staged: DataFrame, hits: DataFrame, horizon: str | None) -> DataFrame:
    """``staged`` with ``_allowed``: not older than the key's tombstone, nor late (before the ``horizon``)
    without a row.  ``hits`` holds the index entries of the batch's keys.

    A tombstone's key has no row, so all a tombstone can do is hold back an older insert or update.
    """
    order = F.struct(*CHANGE_ORDER)
    known = hits.groupBy(*KEY).agg(F.max(F.when(F.col("dead"), order)).alias("_died"), F.max(~F.col("dead")).alias("_here"))
    allowed = F.col("_died").isNull() | (order > F.col("_died"))
    if horizon:
        late = (F.col("_cdc_timestamp") < F.lit(horizon).cast("timestamp")) & F.col("_cdc_operation").isin(*UPSERT)
        allowed = allowed & (~F.coalesce(late, F.lit(True)) | F.coalesce("_here", F.lit(False)))
    return staged.join(known, KEY, "left").withColumn("_allowed", allowed).drop("_died", "_here")


def compact_tombstones(spark: SparkSession, path: str, horizon: dt.datetime) -> dict:
    """Rewrite every index bucket without tombstones older than ``horizon`` and publish it.

    Silver is not touched.  Changes older than the horizon for keys without a row are refused
    by later merges.
    """
    state = versioned.manifest(spark, path)
    stamp_of = horizon.isoformat(sep=" ")
    kept = max(filter(None, [state.get("horizon"), stamp_of]))
    rows = versioned.read_index(spark, path, state, list(range(state["buckets"])))
    rows = rows.where(~F.col("dead") | (F.col("_cdc_timestamp") >= F.lit(kept).cast("timestamp")))
    version = state["version"] + 1
    index = versioned.write_index(rows, path, versioned.token(version), state["buckets"])
    new_state = dict(state, version=version, horizon=kept, index=index)
    versioned.publish(spark, path, new_state)
    return new_state


def snapshot_as_of(log: DataFrame, moment: dt.datetime) -> DataFrame:
    """State at ``moment`` by replaying the log."""
    seen = log.filter(F.col("_cdc_timestamp") <= F.lit(moment))
    return latest_changes(seen).filter(F.col("_cdc_operation") != "D")


def status_history(log: DataFrame, hot_rows: int = HOT_ROWS, slots: int = SLOTS) -> DataFrame:
    """Validity interval of every status a key went through; repeats extend the interval."""
    order = ["_cdc_timestamp", "_cdc_sequence_id", "event_id"]
    slots = {"hot_rows": hot_rows, "slots": slots}
    rows = neighbour(log.select(*KEY, *order, "status"), KEY, order, ["status"], **slots)
    turns = rows.filter(~F.col("prev_status").eqNullSafe(F.col("status"))).select(*KEY, *order, "status")
    ends = neighbour(turns, KEY, order, ["_cdc_timestamp"], following=True, **slots)
    return ends.select(*KEY, "status", F.col("_cdc_timestamp").alias("valid_from"),
                       F.col("next__cdc_timestamp").alias("valid_to"),
                       F.col("next__cdc_timestamp").isNull().alias("is_current"), "event_id")


def cdc_lag(df: DataFrame) -> DataFrame:
    """Whole minutes from source change to raw load and to silver, by source.

    Minute grain keeps the percentile state to one counter per distinct lag.
    """
    load = F.timestamp_diff("MINUTE", F.col("_cdc_timestamp"), F.col("_cdc_load_timestamp"))
    silver = F.timestamp_diff("MINUTE", F.col("_cdc_timestamp"), F.col("ingestion_ts"))
    rows = df.select("source_system", load.alias("load_min"), silver.alias("silver_min"))
    pick = lambda c, p: F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {c})").cast("double")
    return rows.groupBy("source_system").agg(
        F.count("*").alias("change_count"), pick("load_min", 0.5).alias("load_p50"), pick("load_min", 0.95).alias("load_p95"),
        pick("silver_min", 0.5).alias("silver_p50"), pick("silver_min", 0.95).alias("silver_p95"), F.max("silver_min").alias("silver_max"))
