"""Readers and writers: raw rails, staging, silver, gold and quarantine as Parquet."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from .schemas import CDC_COLUMNS, RAW_CLUSTERED_BY, RAW_DATED_BY, raw_schema, silver_schema


def _dated(schema: StructType, column: str) -> StructType:
    return StructType(schema.fields + [StructField(column, DateType())])


def period_start(day, period: str = "day"):
    """Partition value of a date: the day, or the first day of its month or year for thin feeds."""
    return day if period == "day" else F.trunc(day, period)


def _first(day: dt.date | None, period: str) -> dt.date | None:
    if day is None or period == "day":
        return day
    return day.replace(day=1) if period == "month" else day.replace(month=1, day=1)


def _between(column: str, date_from: dt.date | None, date_to: dt.date | None):
    if date_from is None or date_to is None:
        raise ValueError(f"both bounds of {column} are required; an unbounded scan reads every partition")
    return F.col(column).between(F.lit(date_from), F.lit(date_to))


def read_raw(spark: SparkSession, rail: str, path: str, date_from: dt.date | None = None,
             date_to: dt.date | None = None, undated: bool = False, period: str = "day") -> DataFrame:
    """A raw rail by its declared schema; the date bound prunes partitions.

    ``undated`` also keeps rows whose dating timestamp is missing (cards without
    authorisation), which live in the null partition.
    """
    rows = spark.read.schema(_dated(raw_schema(rail), "raw_date")).parquet(path)
    keep = _between("raw_date", _first(date_from, period), date_to) & _within(RAW_DATED_BY[rail], date_from, date_to)
    return rows.filter(keep | F.col("raw_date").isNull() if undated else keep)


def _within(stamp: str, date_from: dt.date, date_to: dt.date):
    after = date_to + dt.timedelta(days=1)
    return (F.col(stamp) >= F.lit(date_from).cast("timestamp")) & (F.col(stamp) < F.lit(after).cast("timestamp"))


def write_raw(df: DataFrame, rail: str, path: str, period: str = "day") -> None:
    """Append a change feed to its landing zone, typed as declared."""
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns
             else F.lit(None).cast(f.dataType).alias(f.name) for f in raw_schema(rail)]
    rows = df.select(*typed).withColumn(
        "raw_date", period_start(F.to_date(RAW_DATED_BY[rail]), period))
    _write_days(rows, path, "raw_date", RAW_CLUSTERED_BY[rail], "append")


def read_staging(spark: SparkSession, path: str) -> DataFrame:
    """Change rows waiting for the merge."""
    return spark.read.schema(silver_schema()).parquet(path)


def tenant_scan(df: DataFrame, tenant_id: str) -> DataFrame:
    """Every tenant-facing read goes through this equality, which reaches the scan."""
    if not tenant_id:
        raise ValueError("tenant_id is required")
    return df.filter(F.col("tenant_id") == F.lit(tenant_id))


def scan_silver(df: DataFrame, date_from: dt.date | None, date_to: dt.date | None, period: str = "day") -> DataFrame:
    """Silver rows of a date range; both bounds are mandatory.

    A stored fact also prunes on its partition column ``txn_date``.
    """
    pruned = _between("txn_date", _first(date_from, period), date_to)
    rows = df.filter(pruned) if "txn_date" in df.columns else df
    return rows.filter(_within("transaction_ts", date_from, date_to))


def _write_days(df: DataFrame, path: str, day: str, cluster: list[str], mode: str) -> None:
    """Rebalance by day so that a heavy day spreads over tasks and light days share one."""
    (
        df.hint("rebalance", day)
        .sortWithinPartitions(day, *cluster)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(day)
        .parquet(path)
    )


def _emptied(df: DataFrame, day: str, days: DataFrame) -> list:
    """Partitions of ``days`` that have no row left in ``df``; dynamic overwrite never sees them.

    The list is one entry per calendar day touched, so it may visit the driver.
    """
    left = df.select(day).distinct()
    return [r[0] for r in days.toDF(day).distinct().join(left, day, "left_anti").collect()]


def _drop(spark: SparkSession, path: str, day: str, gone: list) -> None:
    if gone:
        jvm = spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(path)
        fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for value in gone:
            fs.delete(jvm.org.apache.hadoop.fs.Path(root, f"{day}={value}"), True)


def has_files(spark: SparkSession, path: str) -> bool:
    """Has anything been stored there yet."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(root) and any(f.isDirectory() for f in fs.listStatus(root))


def remove_folder(spark: SparkSession, path: str) -> None:
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)


def move_folder(spark: SparkSession, source: str, target: str) -> bool:
    """Put the folder ``source`` in the place of ``target``; False when there is no ``source``."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    old, new = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    here, there = old.getFileSystem(conf), new.getFileSystem(conf)
    there.delete(new, True)
    if not here.exists(old):
        return False
    there.mkdirs(new.getParent())
    if here.getUri().equals(there.getUri()):
        moved = here.rename(old, new)
    else:
        moved = jvm.org.apache.hadoop.fs.FileUtil.copy(here, old, there, new, True, conf)
    if not moved:
        raise OSError(f"could not move {source} to {target}")
    return True


def _versions(spark: SparkSession, path: str) -> tuple[list[int], object, object]:
    """Numbers of the complete versions stored at ``path``, and its file system and root."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return [], fs, root
    names = [f.getPath().getName() for f in fs.listStatus(root)]
    done = [int(n[1:]) for n in names if n[0] == "v" and n[1:].isdigit() and fs.exists(jvm.org.apache.hadoop.fs.Path(root, f"{n}/_SUCCESS"))]
    return sorted(done), fs, root


def write_version(df: DataFrame, path: str) -> None:
    """Store a whole small table as a new version; the ones before the last go afterwards.

    A reader sees the old version until the new one is complete, and a crash leaves the old.
    """
    spark = df.sparkSession
    done, fs, root = _versions(spark, path)
    df.write.mode("overwrite").parquet(f"{path}/v{(done or [0])[-1] + 1}")
    for n in done[:-1]:
        fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, f"v{n}"), True)


def read_version(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest complete version; none stored yet gives None."""
    done, _, _ = _versions(spark, path)
    return spark.read.parquet(f"{path}/v{done[-1]}") if done else None


def write_silver(df: DataFrame, path: str, days: DataFrame | None = None, period: str = "day") -> None:
    """Replace the partitions present in ``df``; with ``days``, also clear those now empty.

    ``df`` holds every row of the partitions it touches; it may read them from ``path`` itself,
    whose files are replaced when the write commits.
    """
    rows = df.withColumn("txn_date", period_start(F.to_date("transaction_ts"), period))
    gone = [] if days is None else _emptied(rows, "txn_date", days.toDF("d").select(period_start(F.col("d"), period).alias("txn_date")))
    _write_days(rows, path, "txn_date", ["tenant_id", "payment_type", "status"], "overwrite")
    _drop(df.sparkSession, path, "txn_date", gone)


def write_gold(df: DataFrame, path: str, days: DataFrame | None = None, updated_at: dt.datetime | None = None,
               period: str = "day") -> None:
    """Replace whole partitions idempotently and stamp them.  Thin tables may store months, in ``part_date``."""
    stamp = F.lit(updated_at) if updated_at else F.current_timestamp()
    part = "period_date" if period == "day" else "part_date"
    rows = df.withColumn("updated_at", stamp.cast("timestamp"))
    if period != "day":
        rows = rows.withColumn(part, period_start(F.col("period_date"), period))
    gone = [] if days is None else _emptied(rows, part, days.toDF("d").select(period_start(F.col("d"), period).alias(part)))
    _write_days(rows, path, part, ["tenant_id"], "overwrite")
    _drop(df.sparkSession, path, part, gone)


def write_quarantine(df: DataFrame, path: str, period: str = "day") -> None:
    """Rejected rows with their flags, by transaction date."""
    rows = df.withColumn("txn_date", period_start(F.to_date("transaction_ts"), period))
    _write_days(rows, path, "txn_date", ["tenant_id"], "append")


__all__ = ["CDC_COLUMNS", "read_raw", "write_raw", "read_staging", "tenant_scan", "scan_silver",
           "write_silver", "write_gold", "write_quarantine"]
