"""Samples, splits, training pairs and the matcher model."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave.functions.text import match_category, match_count, portable_hash, source_coverage
from linkweave.operators.features import FEATURES


def draw(seed: int, *cols: str) -> Column:
    """A replayable random number for a row."""
    return portable_hash(F.concat_ws(":", F.lit(str(seed)), *cols))


def dev_sample(s1: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """Exactly n rows without replacement; ValueError if there are fewer."""
    if (have := s1.count()) < n:
        raise ValueError(f"{n} rows of {have}")
    return s1.withColumn("__draw", draw(seed, "entity_id")).orderBy("__draw", "entity_id").limit(n).drop("__draw")


def first_by_country(records: DataFrame, n: int) -> DataFrame:
    """At most n training rows of each country, by id."""
    return records.withColumn("__n", F.expr("row_number() OVER (PARTITION BY country ORDER BY entity_id)")).where(F.col("__n") <= n).drop("__n")


def with_truth(s1: DataFrame, lists: DataFrame) -> DataFrame:
    """s1 with match_count, match_category and source_coverage. lists: source1_entity_id, matched_entity_ids, one row for each S1 row."""
    if s1.count() != lists.count():
        raise ValueError("truth and source 1 differ in rows")
    rows = s1.join(lists, s1["entity_id"] == lists["source1_entity_id"], "left")
    if (missing := rows.where("source1_entity_id IS NULL").count()) > 0:
        raise ValueError(f"{missing} records have no truth row")
    return metadata(rows)


def metadata(rows: DataFrame) -> DataFrame:
    n = match_count(F.col("matched_entity_ids"))
    return rows.select("entity_id", "country", n.alias("match_count"), match_category(n).alias("match_category"), source_coverage(F.col("matched_entity_ids")).alias("source_coverage"))


def shares(meta: DataFrame, by: str) -> DataFrame:
    """by, n, share: how often each value of a column occurs."""
    n = meta.groupBy(by).agg(F.count("*").alias("n"))
    return n.select(by, "n", (F.col("n") / n.agg(F.sum("n")).scalar()).alias("share"))


def validation_split(meta: DataFrame, test_s1: DataFrame, share: float = 0.2, seed: int = 42) -> DataFrame:
    """meta with split: validation rows are stratified within a country, countries follow the test set.

    Only countries that both sets have count. Each country's target is shared out over its strata by
    largest remainders; rows of a stratum are drawn by hash.
    """
    test = test_s1.groupBy("country").agg(F.count("*").alias("n_test"))
    both = test.join(meta.select("country").distinct(), "country", "left_semi")
    total_test, total = both.agg(F.sum("n_test")).first()[0] or 0, meta.count()
    if not total_test:
        raise ValueError("no country is in both sets")
    targets = both.select("country", F.bround(F.lit(total * share) * F.col("n_test") / F.lit(total_test)).cast("long").alias("target"))
    strata = meta.groupBy("country", "match_category", "source_coverage").agg(F.count("*").alias("n")).join(targets, "country")
    strata = strata.withColumn("raw", F.col("n") / F.sum("n").over(_by("country")) * F.col("target")).withColumn("base", F.floor("raw"))
    strata = strata.withColumn("left", F.col("target") - F.sum("base").over(_by("country")))
    strata = strata.withColumn("place", F.expr("row_number() OVER (PARTITION BY country ORDER BY raw - base DESC, match_category, source_coverage)"))
    strata = strata.select("country", "match_category", "source_coverage", (F.col("base") + F.when(F.col("place") <= F.col("left"), 1).otherwise(0)).alias("take"))
    rows = meta.withColumn("__draw", draw(seed, "entity_id")).withColumn("__n", F.expr("row_number() OVER (PARTITION BY country, match_category, source_coverage ORDER BY __draw, entity_id)"))
    rows = rows.join(strata, ["country", "match_category", "source_coverage"], "left")
    return rows.withColumn("split", F.when(F.col("__n") <= F.col("take"), "validation").otherwise("train")).select(*meta.columns, "split")


def _by(c: str):
    from pyspark.sql import Window

    return Window.partitionBy(c)


def label_pairs(ranked: DataFrame, truth: DataFrame) -> DataFrame:
    """ranked with label 0 or 1."""
    return ranked.join(truth.distinct().withColumn("label", F.lit(1)), ["s1_id", "cand_id"], "left").withColumn("label", F.coalesce("label", F.lit(0)))


def hard_negatives(ranked: DataFrame, truth: DataFrame, scan: int = 160, tail: int = 32, seed: int = 42) -> DataFrame:
    """Training pairs: all positives, the first `scan` ranks, and up to `tail` drawn from what is behind them."""
    rows = label_pairs(ranked, truth).withColumn("near", (F.col("label") == 1) | (F.col("rank") <= scan)).withColumn("__draw", draw(seed, "s1_id", "cand_id"))
    rows = rows.withColumn("__n", F.expr("row_number() OVER (PARTITION BY s1_id, near ORDER BY __draw, cand_id)"))
    return rows.where(F.col("near") | (F.col("__n") <= tail)).drop("near", "__draw", "__n")


def random_negatives(ranked: DataFrame, truth: DataFrame, most: int = 100, seed: int = 42) -> DataFrame:
    """Up to `most` candidates drawn evenly, and all positives."""
    rows = label_pairs(ranked, truth).withColumn("__draw", draw(seed, "s1_id", "cand_id")).withColumn("__n", F.expr("row_number() OVER (PARTITION BY s1_id ORDER BY __draw, cand_id)"))
    return rows.where((F.col("label") == 1) | (F.col("__n") <= most)).drop("__draw", "__n", "rank")


def train(features: DataFrame, negative_weight: float = 8.0, rate: float = 0.06, rounds: int = 40, depth: int = 5, least: int = 40, seed: int = 42) -> PipelineModel:
    """Gradient-boosted trees over the 32 features and label; negatives weigh more."""
    if missing := [c for c in FEATURES if c not in features.columns]:
        raise ValueError(f"missing features: {missing}")
    rows = features.withColumn("weight", F.when(F.col("label") == 1, 1.0).otherwise(negative_weight)).withColumn("label", F.col("label").cast("double"))
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    model = GBTClassifier(stepSize=rate, maxIter=rounds, maxDepth=depth, minInstancesPerNode=least, weightCol="weight", seed=seed).fit(assembler.transform(rows))
    return PipelineModel([assembler, model])


def predict(model: PipelineModel, features: DataFrame) -> DataFrame:
    """features with score, the probability of a match."""
    return model.transform(features).withColumn("score", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def save_model(model: PipelineModel, path: str, settings: dict) -> None:
    model.write().overwrite().save(f"{path}/model")
    save_settings(path, settings)


def save_settings(path: str, settings: dict) -> None:
    spark = SparkSession.active()
    told = json.dumps({"features": list(FEATURES)} | settings)
    spark.createDataFrame([(told,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/settings")


def load_model(path: str) -> tuple[PipelineModel, dict]:
    """(model, settings); ValueError if it was trained on other features."""
    settings = json.loads(SparkSession.active().read.text(f"{path}/settings").first()[0])
    if settings["features"] != list(FEATURES):
        raise ValueError("the model has other features")
    return PipelineModel.load(f"{path}/model"), settings
