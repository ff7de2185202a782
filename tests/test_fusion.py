import pytest

from linkweave.operators import decide, fusion, metrics

FOLDED = "s1_id string, cand_id string, mask int, r1 int, r2 int, r3 int, p1 double, p2 double, p3 double"


def core(i):
    return ("q", f"c{i}", 1, i, None, None, 10.0 - i, None, None)


def only(i):
    return ("q", f"v{i}", 4, None, None, i, None, None, 1.0 - i / 10)


def ids(df):
    return [r["cand_id"] for r in df.orderBy("rank").collect()]


def test_rrf(spark):
    rows = spark.createDataFrame([("q", "a", 5, 1, None, 3, 1.0, None, 0.5), ("q", "b", 4, None, None, 1, None, None, 0.9)], FOLDED)
    got = {r["cand_id"]: r["s"] for r in rows.withColumn("s", fusion.rrf()).collect()}
    assert got["a"] == pytest.approx(0.042266458, abs=1e-8)
    assert got["b"] == pytest.approx(0.021393443, abs=1e-8)


@pytest.mark.parametrize(("n_core", "n_only", "want"), [(3, 5, (3, 1)), (6, 0, (4, 0)), (6, 5, (4, 0)), (1, 2, (1, 2)), (2, 5, (2, 2))])
def test_core_safe(spark, n_core, n_only, want):
    rows = spark.createDataFrame([*(core(i) for i in range(1, n_core + 1)), *(only(i) for i in range(1, n_only + 1))], FOLDED)
    got = ids(fusion.prune_core_safe(rows, 4, 0.10))
    assert (sum(c[0] == "c" for c in got), sum(c[0] == "v" for c in got)) == want


@pytest.mark.parametrize(("n_core", "n_only", "want"), [(6, 5, (3, 1)), (2, 5, (2, 1)), (2, 2, (2, 2)), (5, 0, (4, 0))])
def test_ranked_reserves_a_place(spark, n_core, n_only, want):
    rows = spark.createDataFrame([*(core(i) for i in range(1, n_core + 1)), *(only(i) for i in range(1, n_only + 1))], FOLDED)
    got = ids(fusion.prune_ranked(rows, 4, 0.10))
    assert (sum(c[0] == "c" for c in got), sum(c[0] == "v" for c in got)) == want


def test_core_first_fills_up(spark):
    rows = spark.createDataFrame([core(1), core(2), *(only(i) for i in range(1, 6))], FOLDED)
    assert set(ids(fusion.prune_core_first(rows, 4))) == {"c1", "c2", "v1", "v2"}


def test_agreement_protects_shared_candidates(spark):
    rows = spark.createDataFrame([("q", "z", 3, 9, 9, None, 1.0, 1.0, None), *(core(i) for i in range(1, 6)), *(only(i) for i in range(1, 4))], FOLDED)
    got = ids(fusion.prune_agreement(rows, 4, 0.30))
    assert got[0] == "z"
    assert len(got) == 4
    assert sum(c[0] == "v" for c in got) == 1


def test_ranks_do_not_depend_on_row_order(spark):
    rows = [("q", f"c{i}", 1.0) for i in range(5)]
    a = fusion.stack(spark.createDataFrame(rows, "s1_id string, cand_id string, score double"), None, None).collect()
    b = fusion.stack(spark.createDataFrame(rows[::-1], "s1_id string, cand_id string, score double").repartition(3), None, None).collect()
    assert sorted(a) == sorted(b)


SCORED = "s1_id string, cand_id string, rank int, score double"


def test_cap_and_exact(spark):
    scored = spark.createDataFrame([("q", "A", 1, 0.9), ("q", "B", 2, 0.4), ("q", "C", 3, 0.6)], SCORED)
    exact = spark.createDataFrame([("q", "D", 9)], "s1_id string, cand_id string, rank int")
    assert [r["cand_id"] for r in decide.decide(scored, 0.39, 2, exact=exact).orderBy("place").collect()] == ["D", "A"]


def test_gate_follows_the_first_rank(spark):
    scored = spark.createDataFrame([("q", "A", 1, 0.5), ("q", "B", 2, 0.9), ("q", "C", 3, 0.46), ("q", "D", 4, 0.44)], SCORED)
    assert [r["cand_id"] for r in decide.decide(scored, 0.39, 10, 0.9).orderBy("place").collect()] == ["A", "B", "C"]


@pytest.mark.parametrize(("tp", "n", "true", "want"), [(2, 3, 2, 0.714286), (0, 0, 0, 1), (0, 1, 0, 0), (0, 0, 2, 0), (0, 2, 2, 0), (1, 1, 2, 0.833333), (2, 2, 2, 1)])
def test_f_half(spark, tp, n, true, want):
    from pyspark.sql import functions as F

    assert spark.range(1).select(metrics.f_half(F.lit(tp), F.lit(n), F.lit(true))).first()[0] == pytest.approx(want, abs=1e-6)


def test_percentiles(spark):
    row = metrics.percentiles(spark.createDataFrame([(v,) for v in (0, 10, 20, 30, 40)], "v int"), "v").first()
    assert (row["nearest"], row["linear"], row["floored"]) == (40, 36.0, 30.0)


def test_percentiles_of_repeated_values(spark):
    values = [3, 1, 1, 7, 7, 7, 2, 9, 9, 4, 4, 4, 4]
    row = metrics.percentiles(spark.createDataFrame([(v,) for v in values] + [(None,)], "v int"), "v", 0.7).first()
    listed, at = sorted(values), 0.7 * (len(values) - 1)
    assert (row["nearest"], row["floored"]) == (listed[round(at)], listed[int(at)])
    assert metrics.percentiles(spark.createDataFrame([], "v int"), "v").first()["nearest"] is None


def test_policies_by_name(spark):
    p1 = spark.createDataFrame([("q", f"c{i}", float(9 - i)) for i in range(6)], "s1_id string, cand_id string, score double")
    p2 = p1.where("score < 6")
    for name in fusion.POLICIES:
        assert fusion.prune(name, p1, p2, p1.limit(2), 3, 0.3).count() == 3


def test_hits_come_before_token_scores(spark):
    rows = [("q", "a", 3, 1, 1, None, 150.0, 1.0, None), ("q", "b", 3, 2, 2, None, 120.0, 1.0, None), ("q", "c", 3, 3, 3, None, 1.0, 2.0, None)]
    folded = spark.createDataFrame(rows, "s1_id string, cand_id string, mask int, r1 int, r2 int, r3 int, p1 double, p2 double, p3 double")
    assert [r["cand_id"] for r in fusion.prune_by_hits(folded, 2).orderBy("rank").collect()] == ["c", "a"]
    assert [r["cand_id"] for r in fusion.prune_agreement(folded, 2).orderBy("rank").collect()] == ["c", "b"]  # 150 and 120 are both held at 100


def test_recall_report(spark):
    s1 = spark.createDataFrame([("S1-1", "India"), ("S1-2", "US"), ("S1-3", "France")], "entity_id string, country string")
    found = spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S3-1"), ("S1-2", "S3-3")], "s1_id string, cand_id string")
    truth = spark.createDataFrame([("S1-1", "S3-1"), ("S1-1", "S2-5"), ("S1-2", "S3-3"), ("S1-3", "S2-99")], "s1_id string, cand_id string")
    queries = metrics.per_query(s1, found, truth)
    row = metrics.recall_report(queries, 6).first()
    assert (row["true_pairs"], row["found_pairs"], row["pairwise_recall"], row["full_recall"]) == (4, 2, 0.5, pytest.approx(1 / 3))
    assert (row["mean_candidates"], row["reduction_ratio"]) == (1.0, pytest.approx(5 / 6))
    by = {r["country"]: r for r in metrics.recall_by_country(queries).collect()}
    assert (by["US"]["full_recall"], by["France"]["pairwise_recall"]) == (1.0, 0.0)


def test_grid_equals_single_decisions(spark):
    s1 = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x")], "entity_id string, country string")
    scored = spark.createDataFrame([("a", "1", 1, 0.9), ("a", "2", 2, 0.5), ("b", "3", 1, 0.6)], SCORED)
    truth = spark.createDataFrame([("a", "1"), ("a", "2")], "s1_id string, cand_id string")
    grid = decide.threshold_grid(s1, scored, truth, [0.4, 0.7], [1, 2], [1, 2])
    for r in grid.collect():
        own = decide.decide(scored.where(f"rank <= {r['rank_k']}"), r["threshold"], r["max_matches"])
        assert metrics.macro_f_half(s1, own, truth).first()["macro_f05"] == pytest.approx(r["macro_f05"])
    assert decide.best_setting(grid)["threshold"] == 0.7
