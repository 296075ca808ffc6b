"""Settings every query brings along."""

from railweave.workload import registry


def test_queries_keep_generated_methods_compilable(spark, tmp_path):
    """A wide projection over JSON text must not end up in methods that the JVM only interprets."""
    held = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    try:
        run = registry.QUERIES["rail_capability"]
        spark.createDataFrame([(1, 2)], "o_orderkey bigint, o_custkey bigint").write.parquet(f"{tmp_path}/orders.parquet")
        assert run(spark, str(tmp_path)).count() == 1
        assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", held)
