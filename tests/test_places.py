"""Merges that decide on places: what they return for repeated keys, and what they leave on disk."""

import os

from pyspark.sql import functions as F

from railweave.operators import cdc
from railweave.session import DEFAULTS, scratch, scratch_path, shared_dir
from railweave.sources import places, storage
from railweave.workload import registry
from railweave.workload.cdc_cases import SCENES, SHOW

SMALL = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.select(*SHOW).collect()), key=str)


def folders(spark):
    return set(os.listdir(shared_dir(spark).removeprefix("file:")))


def test_marked_rows_are_those_named_by_place(spark):
    path = scratch_path(spark, "places")
    spark.range(100_000).withColumn("v", F.concat(F.lit("v"), "id")).repartition(3).write.parquet(path)
    stored = spark.read.parquet(path)
    with scratch(spark) as keep:
        bits = places.marks(places.placed(stored).where("id % 7 = 0").select("_file", "_row"), keep)
        assert {r.id for r in places.chosen(stored, bits).collect()} == set(range(0, 100_000, 7))
        assert {r.id for r in places.chosen(stored, bits, marked=False).collect()} == {i for i in range(100_000) if i % 7}
        assert places.chosen(stored, bits).columns == stored.columns


def test_a_merge_leaves_no_scratch_and_replaces_every_row_of_a_key(spark):
    txn = registry.Tables(spark, SMALL).txn
    target = cdc.latest_changes(txn.filter(SCENES["interleaved"][0])).filter("_cdc_operation <> 'D'")
    target = target.unionByName(target.where(F.col("source_transaction_id").endswith("-1")))  # keys stored twice
    changes = txn.filter(SCENES["interleaved"][1])
    path = scratch_path(spark, "merge")
    storage.write_silver(target, path, period="year")
    expected = rows(cdc.merge_cdc(target, changes))
    before = folders(spark)
    cdc.merge_cdc_incremental(spark, path, changes, period="year", graves=path + "-graves")
    assert rows(spark.read.parquet(path)) == expected
    left = {f for f in folders(spark) - before if f.startswith("railweave-")}
    assert left == {os.path.basename(path) + "-graves"}


def test_queries_give_shuffle_files_back_when_a_step_ends():
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert DEFAULTS[key] == "true" and key in registry.PER_QUERY
