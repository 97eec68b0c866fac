"""Every query with SQL equals it, over the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from loomline.oracle import ORACLES
from loomline.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "labels", "conversations")


def rows(df) -> list[str]:
    df = df[sorted(df.columns)]
    return sorted("|".join(map(str, r)) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(con.execute(ORACLES[name]).df())


@pytest.mark.parametrize("name", ["stratified_sample_quota", "pipeline_end_to_end"])
def test_samples_equal_sql_beyond_the_default_reservoir(spark, tmp_path, name):
    """Over 200,000 segments of overflow, and buckets that can't fill their quotas."""
    line = "concat('Line ', x, ' of document ', id, repeat(' and more words', int(x % 7)))"
    spark.range(2200).selectExpr("id as doc_id", f"array_join(transform(sequence(1, 110), x -> {line}), '\n') as text").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert rows(QUERIES[name](spark, str(tmp_path)).toPandas()) == rows(con.execute(ORACLES[name]).df())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
