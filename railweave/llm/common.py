"""Reading, storing and row identity shared by the training-data operators."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a given table; whatever else the table holds is not read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def store(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def utf8_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def doc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds).cast("int")


def number_rows(df: DataFrame, keys: list[str], uid: str, rows: int, name: str) -> DataFrame:
    """Number the rows of each key from 0 without gaps.

    A key is spread over about sqrt(rows) buckets, so neither a hot key nor the table of
    bucket sizes grows with more than the square root of the input.  ``df`` must be stable.
    """
    buckets = max(1, math.isqrt(rows))
    spread = df.withColumn("_bucket", F.pmod(F.xxhash64(uid), F.lit(buckets)))
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_bucket")) - F.col("_n")
    starts = spread.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n")).select(*keys, "_bucket", before.alias("_start"))
    inside = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(uid))
    return spread.withColumn("_inside", inside).join(starts, [*keys, "_bucket"]).withColumn(name, F.col("_start") + F.col("_inside") - 1).drop("_bucket", "_inside", "_start")
