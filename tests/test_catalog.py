"""Every query with an oracle gives DuckDB's rows on the smallest tables."""

import math
import os

import duckdb
import pytest

from linkweave.catalog import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")


def plain(rows):
    show = lambda v: "null" if v is None or (isinstance(v, float) and math.isnan(v)) else f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted(tuple(map(show, r)) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


def test_every_oracle_has_a_query():
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    columns = sorted(got.columns)
    want = duck.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert plain(tuple(r) for r in got.select(*columns).collect()) == plain(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_without_oracle(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0
