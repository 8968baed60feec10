"""Corpus queries that have SQL give the rows of their SQL."""

import duckdb
import pytest
from noticeloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, sf, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    made, want = queries.QUERIES[name](spark, sf), con.execute(queries.ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(made.columns)
    assert sorted(map(repr, map(tuple, made.select(*names).collect()))) == sorted(map(repr, want.fetchall()))
