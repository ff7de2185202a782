"""Candidates worked out a query at a time give what rows of all pairs give."""

import duckdb
import numpy as np
import pytest

from linkweave import catalog
from linkweave.operators import fused, fusion
from linkweave.oracle import ORACLE_SQL
from test_catalog import DATA, plain, pytestmark  # noqa: F401


@pytest.fixture(scope="module")
def sides(spark):
    word = np.random.default_rng(7).integers(0, 9, (90, 8))
    rows = [(1 + i % 3, f"S{1 + i % 3}-{i}", " ".join(f"n{w}" for w in r[:4]), " ".join(f"a{w}" for w in r[4:]), "AB"[i % 5 == 0]) for i, r in enumerate(word)]
    df = spark.createDataFrame([*rows, rows[4], (2, None, "n1 n2", "a1", "A")], "src int, entity_id string, name string, address string, country string").persist()
    return df.where("src = 1"), df.where("src > 1")


def test_ids_are_placed_in_their_order(sides):
    ids, rows = fused.placed(sides[1])
    found = sorted(ids.collect())
    assert len({r["at"] for r in found}) == len(found)
    assert [r["entity_id"] for r in found] == sorted({r[0] for r in sides[1].select("entity_id").collect()} - {None})
    assert rows.count() == sides[1].count()


@pytest.mark.parametrize("policy", ["agreement", "by_hits", "core_first"])
def test_pruned_as_over_all_pairs(sides, policy, monkeypatch):
    monkeypatch.setattr(catalog, "LIMITS", catalog.token_block.Limits(0.4, 5000, 1.0, 5000, 1.0, 5000, fallback=5))
    pairs = fusion.POLICIES[policy](fusion.fold(fusion.stack(*catalog._blocked(*sides))), catalog.CAP, catalog.QUOTA)
    got = catalog._pruned(policy, *sides)
    assert got.columns == pairs.columns
    assert plain(got.collect()) == plain(pairs.collect())


def test_ranked_query_cuts_no_lsh_candidates(spark, monkeypatch):
    monkeypatch.setattr(fusion, "P2_MOST", 1)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{DATA}/documents.parquet')")
    want = con.execute(f"SELECT s1_id, cand_id, rank, mask, score FROM ({ORACLE_SQL['prune_ranked']})").fetchall()
    assert plain(catalog.QUERIES["prune_ranked"](spark, DATA).select("s1_id", "cand_id", "rank", "mask", "score").collect()) == plain(want)


def test_first_breaks_ties_by_id():
    primary, at = np.array([3, 1, 3, 3]), np.array([5, 6, 7, 9])
    assert sorted(fused.first(primary, at, 2)) == [0, 2] and sorted(fused.first(primary, at, 2, later=True)) == [2, 3]
    assert sorted(fused.first(primary << 40, at, 2)) == [0, 2, 3]
