"""Ordered work per key that survives a key holding a large part of all rows.

A plain window sends one key to one task, and a sliding range frame re-reads its
whole span for every row.  Here keys above ``hot_rows`` are cut into ``slots`` time slots of
about equal row count, bounded by quantiles of the key's timestamps from a mergeable sketch
(so a busy day of one key spreads over slots as well as a quiet year):
slots are ordered among themselves by one small row each, and the answer of a row is
its answer inside the slot combined with what earlier slots carry over.  Sliding
sums are differences of running sums, so their cost does not grow with the span.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

HOT_ROWS = 1_000_000
SLOTS = 256
MICROS = 1_000_000


def micros(stamp: str) -> Column:
    return F.unix_micros(F.col(stamp).cast("timestamp"))


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int, at: Column | None = None, slots: int = SLOTS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows (at most ``count(df) / hot_rows`` of them), each with
    ``_bounds``: the ``slots - 1`` quantiles of ``at`` that cut it into slots of about equal rows.

    The quantile sketch is merged from partial sketches, so a hot key is never gathered.
    Without ``at`` the keys come with no bounds (one slot each).
    """
    hot = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > hot_rows).select(*keys)
    if at is None or slots <= 1:
        return hot.select(*keys, F.lit(True).alias("_hot"), F.array().cast("array<bigint>").alias("_bounds"))
    fractions = [i / slots for i in range(1, slots)]
    bounds = df.select(*keys, at.alias("_t")).join(hot, keys, "left_semi").groupBy(*keys).agg(
        F.percentile_approx("_t", fractions, 10_000).alias("_bounds"))
    return bounds.select(*keys, F.lit(True).alias("_hot"), "_bounds")


def _slot(at: Column) -> Column:
    """Slot of a hot key's instant: how many bounds lie at or before it; NULL keeps an ordinary key whole.

    Bounds are values, so rows of one instant share a slot and slots keep the order of time.
    """
    return F.when(F.col("_hot"), F.size(F.filter("_bounds", lambda b: b <= at)).cast("bigint"))


def neighbour(df: DataFrame, keys: list[str], order: list[str], values: list[str], following: bool = False,
              hot_rows: int = HOT_ROWS, slots: int = SLOTS) -> DataFrame:
    """Add ``prev_<v>`` (or ``next_<v>``): the values of the adjacent row of the same key.

    ``order`` is total within a key and starts with a timestamp; keys are not NULL.
    """
    prefix = "next" if following else "prev"
    rows = df.join(hot_keys(df, keys, hot_rows, micros(order[0]), slots), keys, "left").withColumn("_slot", _slot(micros(order[0])))
    packed = F.struct(*[F.col(v).alias(f"{prefix}_{v}") for v in values])
    direction = [F.desc(o) if following else F.asc(o) for o in order]
    rows = rows.withColumn("_near", F.lag(packed).over(Window.partitionBy(*keys, "_slot").orderBy(*direction)))
    edge_of = F.min_by if following else F.max_by
    edges = rows.filter("_slot is not null").groupBy(*keys, "_slot").agg(edge_of(packed, F.struct(*order)).alias("_edge"))
    slot_order = F.desc("_slot") if following else F.asc("_slot")
    carried = edges.select(*keys, "_slot", F.lag("_edge").over(Window.partitionBy(*keys).orderBy(slot_order)).alias("_carried"))
    near = F.coalesce("_near", "_carried")
    return rows.join(carried, [*keys, "_slot"], "left").select(
        *df.columns, *[near[f"{prefix}_{v}"].alias(f"{prefix}_{v}") for v in values])


def latest_before(df: DataFrame, keys: list[str], stamp: str, value: str, hot_rows: int = HOT_ROWS,
                  slots: int = SLOTS) -> DataFrame:
    """Add ``latest``: the newest non-NULL ``value`` struct of the key at or before each row."""
    rows = df.join(hot_keys(df, keys, hot_rows, micros(stamp), slots), keys, "left").withColumn("_slot", _slot(micros(stamp)))
    inside = Window.partitionBy(*keys, "_slot").orderBy(micros(stamp)).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = F.when(F.col(value).isNotNull(), F.struct(F.col(stamp).alias("_at"), F.col(value).alias("_v")))
    rows = rows.withColumn("_mine", F.max(ranked).over(inside))
    ends = rows.filter("_slot is not null").groupBy(*keys, "_slot").agg(F.max(ranked).alias("_end"))
    past = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*keys, "_slot", F.max("_end").over(past).alias("_carried"))
    return rows.join(carried, [*keys, "_slot"], "left").select(
        *df.columns, F.coalesce("_mine", "_carried")["_v"].alias("latest"))


@dataclass(frozen=True)
class Frame:
    """Sum of ``measure`` over the ``seconds`` up to a row.

    ``closed`` includes a row exactly ``seconds`` old; ``now`` includes rows of this instant.
    """

    measure: str
    seconds: int
    closed: bool = True
    now: bool = True

    @property
    def back(self) -> int:
        return self.seconds * MICROS + (1 if self.closed else 0)


def trailing(df: DataFrame, keys: list[str], row_id: str, stamp: str, measures: dict[str, Column],
             frames: dict[str, Frame], hot_rows: int = HOT_ROWS, slots: int = SLOTS) -> DataFrame:
    """Per row (identified by unique ``row_id``) the sums of the named frames; zero when empty."""
    backs = sorted({f.back for f in frames.values()})
    at = micros(stamp)
    base = df.join(hot_keys(df, keys, hot_rows, at, slots), keys, "left").select(
        *keys, row_id, "_hot", "_bounds", at.alias("_at"), *[m.alias(name) for name, m in measures.items()])
    marks = F.array(*[F.struct(F.lit(back).alias("back"), (F.col("_at") - back).alias("at")) for back in [0, *backs]])
    # a mark asks for the running sum at an earlier instant and adds nothing itself
    events = base.select(*keys, row_id, "_hot", "_bounds", F.explode(marks).alias("_mark"), *measures).select(
        *keys, row_id, F.col("_mark.back").alias("_back"), F.col("_mark.at").alias("_at"), _slot(F.col("_mark.at")).alias("_slot"),
        *[F.when(F.col("_mark.back") == 0, F.col(m)).alias(m) for m in measures])
    spot = Window.partitionBy(*keys, "_slot").orderBy("_at")
    upto = spot.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    before = spot.rangeBetween(Window.unboundedPreceding, -1)
    early = {f.measure for f in frames.values() if not f.now}
    running = events.select(
        *keys, "_slot", row_id, "_back",
        *[F.sum(m).over(upto).alias(f"{m}_upto") for m in measures],
        *[F.sum(m).over(before).alias(f"{m}_before") for m in sorted(early)])
    slots = events.filter("_slot is not null").groupBy(*keys, "_slot").agg(*[F.sum(m).alias(m) for m in measures])
    past = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slots.select(*keys, "_slot", *[F.sum(m).over(past).alias(f"{m}_past") for m in measures])

    def total(part: str, m: str) -> Column:
        zero = F.lit(0)
        return F.coalesce(f"{m}_{part}", zero) + F.coalesce(f"{m}_past", zero)

    sums = running.join(offsets, [*keys, "_slot"], "left").select(
        row_id, "_back", *[total("upto", m).alias(f"{m}_upto") for m in measures],
        *[total("before", m).alias(f"{m}_before") for m in sorted(early)])
    picked = [F.max(F.when(F.col("_back") == b, F.col(f"{m}_upto"))).alias(f"{m}_{b}") for m in measures for b in [0, *backs]]
    picked += [F.max(F.when(F.col("_back") == 0, F.col(f"{m}_before"))).alias(f"{m}_before") for m in sorted(early)]
    wide = sums.groupBy(row_id).agg(*picked)
    return wide.select(row_id, *[
        (F.col(f"{f.measure}_{0 if f.now else 'before'}") - F.col(f"{f.measure}_{f.back}")).alias(name)
        for name, f in frames.items()])


def ordered_rank(df: DataFrame, group: str, order: list[Column], slices: int = 0) -> DataFrame:
    """Add ``rank`` (1, 2, ...) and ``rank_of`` (group size) without sorting a group in one task.

    Rows are range-partitioned by the full order; each slice numbers its own rows and
    starts after the rows of earlier slices.  The slices are checkpointed because
    range bounds are sampled anew whenever a plan runs again.
    """
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = cut_lineage(df.repartitionByRange(slices, F.asc(group), *order).withColumn("_slice", F.spark_partition_id()))
    sizes = sliced.groupBy(group, "_slice").agg(F.count("*").alias("_size"))
    whole = Window.partitionBy(group)  # one row per slice
    starts = sizes.select(
        group, "_slice",
        F.coalesce(F.sum("_size").over(whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"),
        F.sum("_size").over(whole).alias("rank_of"))
    local = F.row_number().over(Window.partitionBy(group, "_slice").orderBy(*order))
    return sliced.withColumn("_local", local).join(starts, [group, "_slice"]).withColumn(
        "rank", F.col("_start") + F.col("_local")).drop("_slice", "_local", "_start")


def ntile(rank: Column, size: Column, buckets: int) -> Column:
    """Bucket number as SQL ``ntile`` assigns it: earlier buckets take the remainder."""
    small, extra = F.floor(size / buckets), size % buckets
    big_rows = extra * (small + 1)
    return F.when(rank <= big_rows, F.floor((rank - 1) / (small + 1)) + 1).otherwise(
        extra + F.floor((rank - big_rows - 1) / F.greatest(small, F.lit(1))) + 1).cast("int")
