"""Every registered query with an oracle gives the oracle's rows."""

import math

import duckdb
import pytest
from noticeloom.plans import queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, duck, sf, name):
    df = queries.QUERIES[name](spark, sf)
    want = duck.execute(queries.ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, map(tuple, df.collect())) == rows(names, want.fetchall())


def test_sample_is_one_of_each_and_repeats(spark, sf):
    a, b = (queries.smoke_sample(spark, sf).collect() for _ in range(2))
    assert sorted(a) == sorted(b)
    assert len({(r["p_brand"], r["p_type"]) for r in a}) == len(a)
