"""Registration helper: a query over the given tables and its checking SQL."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import DEFAULTS
from ..sources import fixtures

#: Session defaults that every query sets itself, because sessions may come from elsewhere.
PER_QUERY = ("spark.sql.session.timeZone", "spark.sql.codegen.hugeMethodLimit", "spark.sql.classic.shuffleDependency.fileCleanup.enabled")

AS_OF = dt.date(2001, 11, 4)
ACTIVITY_AS_OF = dt.date(2024, 1, 31)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
FAMILY: dict[str, str] = {}
BODIES: dict[str, Callable] = {}


class Tables:
    """Attribute access to given and derived tables, e.g. ``t.txn``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return fixtures.table(self.spark, self.sf_dir, name)


class StoredTables(Tables):
    """The same tables, each derived once and stored: what a deployment reads."""

    def __init__(self, spark: SparkSession, sf_dir: str, folder: str):
        super().__init__(spark, sf_dir)
        self.folder, self.stored = folder, set()

    def __getattr__(self, name: str) -> DataFrame:
        if name in fixtures.GIVEN:
            return fixtures.table(self.spark, self.sf_dir, name)
        path = f"{self.folder}/{name}"
        if name not in self.stored:
            fixtures.table(self.spark, self.sf_dir, name).write.mode("overwrite").parquet(path)
            self.stored.add(name)
        return self.spark.read.parquet(path)


def portable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates, times and arrays as text, so engines compare alike."""
    out = []
    for name, kind in df.dtypes:
        col = F.col(f"`{name}`")
        if kind.startswith("decimal"):
            col = col.cast("double")
        elif kind in ("date", "timestamp", "timestamp_ntz"):
            col = col.cast("string")
        elif kind.startswith("array"):
            col = F.array_join(col.cast("array<string>"), ",")
        out.append(col.alias(name))
    return df.select(*out)


def case(name: str, tables: str = "", sql: str | None = None):
    """Register ``fn(t)`` under ``name``; ``sql`` reads the derived ``tables``."""

    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            for key in PER_QUERY:
                spark.conf.set(key, DEFAULTS[key])
            return portable(fn(Tables(spark, sf_dir)))

        assert name not in QUERIES, name
        QUERIES[name], BODIES[name] = run, fn
        FAMILY[name] = fn.__module__.rsplit('.', 1)[-1]
        if sql is not None:
            ORACLES[name] = fixtures.oracle(tables, sql)
        return fn

    return add
