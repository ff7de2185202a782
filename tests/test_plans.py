"""What the physical plans must have at scale."""

import os

import pytest
from pyspark.sql import functions as F

from linkweave.catalog import QUERIES
from linkweave.operators import knn, metrics, validate
from linkweave.operators.features import sql_features
from linkweave.operators.token_block import Limits, hybrid_block
from linkweave.sources import derived

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@needs_data
def test_scans_read_only_what_is_used(spark):
    spark.catalog.clearCache()  # other tests keep the same records
    told = plan(derived.records(spark, DATA).where("country = 'fr'").select("entity_id"))
    assert "n_chars" not in told.split("ReadSchema")[1]
    assert "EqualTo(lang,fr)" in told


def test_top_k_is_limited_before_the_shuffle(spark):
    pairs = spark.range(100).select((F.col("id") % 5).alias("s1_id"), F.col("id").alias("cand_id"), F.rand(1).alias("score"))
    told = plan(knn.ranked(pairs, 3))
    assert told.count("WindowGroupLimit") >= 2


def test_blocking_has_no_cross_join_and_no_python(spark):
    rows = spark.createDataFrame([("S1-1", "a b", "", "X")], "entity_id string, name string, address string, country string")
    told = plan(hybrid_block(rows, rows, Limits()))
    assert "CartesianProduct" not in told
    assert "BroadcastNestedLoopJoin" not in told
    assert "Python" not in told


@needs_data
@pytest.mark.parametrize("name", ["prune_ranked", "rrf_fusion", "pair_features_sql", "threshold_grid", "recall_by_country"])
def test_no_query_has_a_cross_join(spark, name):
    told = plan(QUERIES[name](spark, DATA))
    assert "CartesianProduct" not in told
    assert "NestedLoopJoin" not in told


def test_rows_do_not_depend_on_partitioning(spark):
    make = lambda p: [(f"{p}-{i}", f"w{i % 7} w{i % 5} w{i % 3}", "", "AB"[i % 2]) for i in range(60)]
    schema = "entity_id string, name string, address string, country string"
    a, b = spark.createDataFrame(make("S1"), schema), spark.createDataFrame(make("S2"), schema)
    limits = Limits(token_share=0.5, fallback=10)
    want = sorted(hybrid_block(a, b, limits).collect())
    assert sorted(hybrid_block(a.repartition(7), b.orderBy(F.desc("entity_id")), limits).collect()) == want


def test_reports_have_no_task_with_all_rows(spark):
    s1 = spark.range(50).select(F.col("id").cast("string").alias("entity_id"), F.lit("x").alias("country"))
    pairs = spark.range(90).select((F.col("id") % 50).cast("string").alias("s1_id"), F.col("id").cast("string").alias("cand_id"))
    queries = metrics.per_query(s1, pairs, pairs)
    assert plan(queries).count("Range (0, 90") == 2  # candidates once, truth once
    told = plan(metrics.recall_report(queries))
    assert told.index("collect_list") < told.index("keys=[n_cand")  # over the counts of distinct numbers
    lists = pairs.select(F.col("s1_id").alias("source1_entity_id"), F.col("cand_id").alias("ids"))
    assert plan(validate.list_problems(lists, s1, s1)).count("WindowGroupLimit") >= 2


def test_missing_records_are_an_error(spark):
    rows = spark.createDataFrame([("S1-1", "a b", "", "X")], "entity_id string, name string, address string, country string")
    pairs = spark.createDataFrame([("S1-1", "S2-9", 1, 1)], "s1_id string, cand_id string, rank int, mask int")
    with pytest.raises(Exception, match="no record for S2-9"):
        sql_features(pairs, rows, rows).collect()
