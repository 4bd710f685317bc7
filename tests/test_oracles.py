"""Every registered query against its SQL on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from textmill.registry import all_oracles, all_queries  # noqa: E402
from tools.check_oracles import TABLES, compare  # noqa: E402

QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def con(sf):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, sf, key):
    ok, note = compare(spark, con, key, QUERIES[key], ORACLES.get(key), sf)
    assert ok, note
