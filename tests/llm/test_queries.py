import duckdb

import __spark_entry__ as entry
from railweave.llm import queries

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator_and_the_pipeline():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.ORACLES) <= set(queries.QUERIES)
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


def test_warc_matches_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    rel = con.sql(queries.ORACLES["op3_warc_chain"])
    mine = queries.QUERIES["op3_warc_chain"](spark, SF).select(*rel.columns).collect()
    assert sorted(map(tuple, mine)) == sorted(rel.fetchall())


def test_exact_dedup_matches_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    rel = con.sql(queries.ORACLES["op13_chunk_recipes"])
    mine = queries.QUERIES["op13_chunk_recipes"](spark, SF).select(*rel.columns).collect()
    assert sorted(map(tuple, mine), key=str) == sorted(rel.fetchall(), key=str)
