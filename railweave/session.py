"""Session defaults and the two shared-storage helpers every job uses."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for the jobs in this package.  On a cluster the deploy
# configuration sets executors, memory and spark.checkpoint.dir.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # wide projections over JSON text compile to methods of tens of kB, which the JVM never turns
    # into machine code (its bound is 8,000 bytes); above this Spark generates smaller ones instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # shuffle files go when their write or action ends; otherwise those of every step of a job stay on
    # disk until the driver's JVM happens to collect the plans that made them
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def build_session(master: str | None = None, app: str = "railweave", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local master may fall back to a temporary folder: on a cluster such a
    folder would be lost with its machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="railweave-")
        context.setCheckpointDir(folder)
    elif not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return context.getCheckpointDir() or folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/railweave-{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint; iterative jobs call it so plans do not grow per round."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str = "stored") -> DataFrame:
    """Write once to the shared folder as compressed Parquet and read back.

    For wide tables: a checkpoint keeps whole rows uncompressed, and every reader of it
    takes all columns.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """``stored`` for tables that nobody reads after the block: their files go when it ends."""
    paths = []

    def keep(df: DataFrame, label: str = "stored") -> DataFrame:
        paths.append(scratch_path(spark, label))
        df.write.option("compression", "zstd").parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        yield keep
    finally:
        for path in paths:
            root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)
