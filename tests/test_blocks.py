"""Pairs are made, counted, ranked and pruned in their query's block: only keys, lists and ids are shuffled."""

import re

import pytest

from linkweave.operators import fusion, lsh
from linkweave.operators.token_block import Limits, hybrid_block, hybrid_in_blocks
from linkweave.sources.tables import candidate_lists

SCHEMA = "entity_id string, name string, address string, country string"


def exchanges(df):
    told = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", told)


@pytest.fixture(scope="module")
def records(spark):
    return spark.createDataFrame([(f"S-{i}", f"w{i % 3} v{i % 2}", f"x{i % 4}", "A") for i in range(24)], SCHEMA)


def test_lsh_pairs_are_not_shuffled(records):
    found = lsh.lsh_block(records, records)
    assert not [x for x in exchanges(found) if "cand_id" in x or "s1_id" in x]
    assert found.where("s1_id = cand_id AND hits = 21").count() == 24


def test_token_pairs_are_not_shuffled(records):
    assert not [x for x in exchanges(hybrid_block(records, records, Limits(1.0, fallback=2))) if "cand_id" in x]


def test_fusion_and_lists_stay_in_blocks(records):
    p1, p2 = hybrid_in_blocks(records, records, Limits(1.0, fallback=2)), lsh.lsh_in_blocks(records, records).withColumnRenamed("hits", "score")
    own = lambda df: [x for x in exchanges(df) if "cand_id" in x or x.startswith("s1_id")]
    before = len(own(p1))  # those that find S1 records with few candidates
    for policy in fusion.POLICIES:
        assert len(own(fusion.prune(policy, p1, p2, None, 5, 0.3))) == before
    assert len(own(candidate_lists(p1, records, "cand_id"))) == before
