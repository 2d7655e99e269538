"""The registered batch queries against their SQL on the smallest data."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from verify_queries import compare, connect

SMALL = "/root/testdata/sf0.001"
# Covered by the stream, table and model tests.
SLOW = {
    "ingest_metadata", "bronze_stream", "stream_restart", "schema_drift",
    "silver_stream", "stream_dedup", "late_data", "gold_stream", "stream_metrics",
    "gold_build", "time_travel", "table_history", "schema_evolution", "compact",
    "expire",
}


@pytest.fixture(scope="module")
def db():
    return connect(SMALL)


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) - SLOW))
def test_query_equals_its_sql(spark, db, name):
    rows = queries()[name](spark, SMALL).toPandas()
    assert compare(rows, db.execute(oracle_sql()[name]).df()) == "ok"


def test_entry(spark):
    assert entry(spark).count() == 923
