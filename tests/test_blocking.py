import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkweave.operators import knn, lsh
from linkweave.operators.token_block import Limits, TokenIndex, hybrid_block, key_table, limit
from linkweave.plans.resolution import normalized
from linkweave.sources.tables import candidate_lists

POOL = [
    ("S2-1", "Apple Technologies Pvt Ltd", "India"), ("S2-2", "Generic Store Inc", "India"), ("S2-3", "Rocky Piedmont Clinic", "US"), ("S2-4", "Rocky Clinic", "US"),
    ("S3-1", "Apple Technology Private Limited", "India"), ("S3-2", "Unrelated Bakery", "India"), ("S3-3", "Rocky Piedmont Giant Clinic", "US"),
]
S1 = [("S1-1", "Apple Technologies Pvt Ltd", "India"), ("S1-2", "Rocky Piedmont Giant Clinic", "US"), ("S1-3", "Totally Unmatched Entity Zzz", "France")]
OPEN = Limits(token_share=1.0, token_cap=5000, fallback=50)


@pytest.fixture(scope="module")
def sides(spark):
    make = lambda rows: normalized(spark.createDataFrame([(a, b, "x", c) for a, b, c in rows], "entity_id string, business_name string, business_address string, country string")).persist()
    return make(S1), make(POOL)


def test_golden_lists(sides):
    s1, pool = sides
    rows = candidate_lists(hybrid_block(s1, pool, OPEN), s1, "cand_id").collect()
    assert {r[0]: r[1] for r in rows} == {"S1-1": "S2-1,S3-1", "S1-2": "S2-3,S2-4,S3-3", "S1-3": ""}


def test_golden_scores(sides):
    rows = hybrid_block(*sides, OPEN).collect()
    assert {(r["s1_id"], r["cand_id"]): r["score"] for r in rows} == {("S1-1", "S2-1"): 100, ("S1-1", "S3-1"): 1, ("S1-2", "S3-3"): 100, ("S1-2", "S2-3"): 3, ("S1-2", "S2-4"): 2}
    assert TokenIndex.build(*sides, OPEN).pairs.count() == 0


def test_fallback_only_for_few_candidates(sides):
    s1, pool = sides
    rows = hybrid_block(s1, pool, Limits(token_share=1.0, fallback=1)).collect()
    assert {r["score"] for r in rows if r["s1_id"] == "S1-2"} == {2, 3, 4}


def test_pairs_stand_in_for_dropped_tokens(sides):
    s1, pool = sides
    rows = hybrid_block(s1, pool, Limits(token_share=0.0, token_cap=1, fallback=50)).collect()
    scores = {(r["s1_id"], r["cand_id"]): (r["token_hits"], r["pair_hits"], r["score"]) for r in rows}
    # giant is the only token of one document; clinic, piedmont and rocky are in two or three
    assert scores[("S1-2", "S2-3")] == (0, 3, 30)
    assert scores[("S1-2", "S3-3")] == (1, 6, 160)


@pytest.mark.parametrize(("n", "share", "cap", "want"), [(1000, 0.01, 5, 5), (1000, 0.01, 0, 10), (0, 0.01, 5, 5), (1000, 0.0, 7, 7)])
def test_limits(spark, n, share, cap, want):
    assert spark.createDataFrame([(n,)], "n long").select(limit(F.col("n"), share, cap)).first()[0] == want


def test_index_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(30)]
    make = lambda p, n: [(f"{p}-{i}", " ".join(rng.choice(words, rng.integers(1, 5))), "AB"[int(rng.integers(2))]) for i in range(n)]
    left, right = make("S1", 40), make("S2", 60)
    s1, pool = (spark.createDataFrame([(a, b, "", c) for a, b, c in rows], "entity_id string, name string, address string, country string") for rows in (left, right))
    limits = Limits(token_share=0.2, token_cap=6, fallback=0)
    got = {(r["s1_id"], r["cand_id"]): r["token_hits"] for r in hybrid_block(s1, pool, limits).where("token_hits > 0").collect()}
    want = {}
    for country in "AB":
        own = [r for r in right if r[2] == country]
        df = {w: sum(w in r[1].split() for r in own) for w in words}
        kept = {w for w in words if df[w] <= min(0.2 * len(own), 6)}
        for a, b in itertools.product([r for r in left if r[2] == country], own):
            if n := len(set(a[1].split()) & set(b[1].split()) & kept):
                want[(a[0], b[0])] = n
    assert got == want


def test_keys_of_empty_names(spark):
    rows = spark.createDataFrame([("S1-1", "", "", "A")], "entity_id string, name string, address string, country string")
    assert [key_table(rows, k).count() for k in ("token", "exact", "pair")] == [0, 0, 0]


def test_band_parameters():
    assert [lsh.best_bands(t) for t in (0.3, 0.4, 0.5)] == [(21, 3), (16, 4), (14, 4)]
    assert [round(lsh.hit_probability(s, 21, 3), 4) for s in (0.2, 0.3, 0.4, 0.5, 0.7)] == [0.1552, 0.4372, 0.7507, 0.9394, round(1 - (1 - 0.343) ** 21, 4)]
    assert [round(lsh.hit_probability(s, 21, 3, 2), 4) for s in (0.2, 0.3, 0.4)] == [0.0121, 0.1092, 0.3926]


def test_lsh_finds_equal_texts_and_skips_empty_ones(spark):
    make = lambda p: spark.createDataFrame([(f"{p}-1", "alpha beta", "gamma street", "A"), (f"{p}-2", "", "", "A"), (f"{p}-3", "zzz yyy", "qqq", "B")], "entity_id string, name string, address string, country string")
    rows = lsh.lsh_block(make("S1"), make("S2")).collect()
    assert {(r["s1_id"], r["cand_id"]): r["hits"] for r in rows} == {("S1-1", "S2-1"): 21, ("S1-3", "S2-3"): 21}


def test_knn_recall(spark):
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(400, 16))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    base = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)], "cand_id long, vector array<float>, part int")
    queries = base.where("cand_id % 20 = 0").withColumnRenamed("cand_id", "s1_id")
    exact = {(r["s1_id"], r["cand_id"]) for r in knn.flat_knn(queries, base, 10).collect()}
    scores = vectors @ vectors.T - 9 * np.eye(400)
    assert exact == {(q, int(c)) for q in range(0, 400, 20) for c in np.argsort(-scores[q])[:10]}
    near = {(r["s1_id"], r["cand_id"]) for r in knn.ivf_knn(queries, base, 10, cells=12, probes=9).collect()}
    assert len(near & exact) >= 0.9 * len(exact)


def test_knn_recall_with_the_defaults(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(3000, 32))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    base = spark.createDataFrame([(i, v.tolist(), "ab"[i % 3 == 0]) for i, v in enumerate(vectors)], "cand_id long, vector array<float>, part string").persist()
    queries = base.where("cand_id % 20 = 0").withColumnRenamed("cand_id", "s1_id").unionByName(spark.createDataFrame([(-1, vectors[0].tolist(), "c")], "s1_id long, vector array<float>, part string"))
    exact = {(r["s1_id"], r["cand_id"]) for r in knn.flat_knn(queries, base, 10).collect()}
    near = {(r["s1_id"], r["cand_id"]) for r in knn.ivf_knn(queries, base, 10).collect()}
    assert len(near & exact) >= 0.9 * len(exact)
    assert all((a % 3 == 0) == (b % 3 == 0) for a, b in near)


def test_registered_knn_recall(spark):
    from linkweave.catalog import QUERIES

    for sf in ("sf0.01", "sf0.1"):
        exact, near = ({(r["s1_id"], r["cand_id"]) for r in QUERIES[q](spark, f"/root/testdata/{sf}").collect()} for q in ("knn_topk", "ivf_knn"))
        assert len(near & exact) >= 0.9 * len(exact)


def test_encoder_is_unit_length_and_pluggable(spark):
    rows = spark.createDataFrame([("a", "some text here"), ("b", "")], "entity_id string, name string")
    got = {r["entity_id"]: np.array(r["vector"]) for r in knn.embed(rows, F.col("name")).collect()}
    assert np.linalg.norm(got["a"]) == pytest.approx(1, abs=1e-6)
    assert not got["b"].any()
