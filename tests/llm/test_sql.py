"""The queries that SQL can express against DuckDB, on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from pricefold.llm.queries import QUERIES
from pricefold.llm.sql import ORACLES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, sf_dir, name):
    database = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "embeddings", "conversations"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    relation = database.execute(ORACLES[name])
    columns = [column[0] for column in relation.description]
    frame = QUERIES[name](spark, sf_dir)
    assert sorted(frame.columns) == sorted(columns)
    found = sorted(map(repr, map(tuple, frame.select(*columns).collect())))
    assert found == sorted(map(repr, relation.fetchall()))
