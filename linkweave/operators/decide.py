"""From scored pairs to matches: threshold, gate, cap, and the grid that tunes them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.operators.metrics import f_half


def exact_shortcut(pairs: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    """Pairs with equal name and equal address, neither empty: a match without a model."""
    key = lambda df, to: df.select(F.col("entity_id").alias(to), F.struct("name", "address").alias(f"{to}_key")).where("name <> '' AND address <> ''")
    both = pairs.join(key(s1, "s1_id"), "s1_id").join(key(pool, "cand_id"), "cand_id").where("s1_id_key = cand_id_key")
    return both.select(*pairs.columns)


def decide(scored: DataFrame, threshold: float = 0.39, most: int = 10, gate: float = 0.0, exact: DataFrame | None = None, model_ranks: int | None = None) -> DataFrame:
    """s1_id, cand_id, rank, score of the matches, with their place.

    scored: s1_id, cand_id, rank, score. A score must reach the threshold and `gate` times the score of
    the blocker's first candidate. Exact pairs score 1, whatever their rank. Only the `most` best stay,
    ties by rank; within the cap they stand in blocker order, beyond it in score order.
    """
    rows = scored if model_ranks is None else scored.where(F.col("rank") <= model_ranks)
    rows = rows.select("s1_id", "cand_id", "rank", "score", F.lit(False).alias("exact"))
    if exact is not None:
        own = exact.select("s1_id", "cand_id", "rank", F.lit(1.0).alias("score"), F.lit(True).alias("exact"))
        rows = rows.unionByName(own).groupBy("s1_id", "cand_id").agg(F.min("rank").alias("rank"), F.max("score").alias("score"), F.max("exact").alias("exact"))
    rows = rows.withColumn("first", F.expr("min_by(score, rank) OVER (PARTITION BY s1_id)"))
    kept = rows.where(F.col("exact") | (F.col("score") >= F.greatest(F.lit(threshold), F.col("first") * F.lit(gate))))
    kept = kept.withColumns({"n": F.expr("count(*) OVER (PARTITION BY s1_id)"), "best": F.expr("row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, rank)")}).where(F.col("best") <= most)
    place = F.expr(f"row_number() OVER (PARTITION BY s1_id ORDER BY CASE WHEN n > {int(most)} THEN best ELSE rank END)")
    return kept.withColumn("place", place).select("s1_id", "cand_id", "place", "rank", "score")


def threshold_grid(s1: DataFrame, scored: DataFrame, truth: DataFrame, thresholds: list[float], caps: list[int], ranks: list[int], gates: list[float] = [0.0]) -> DataFrame:  # noqa: B006
    """rank_k, threshold, max_matches, gate, macro_f05 for every setting, from pairs that are scored once.

    A query without pairs adds 1 if it has no truth and 0 otherwise, whatever the setting. The settings
    are a fixed small list, so each pair is repeated a fixed number of times.
    """
    labelled = scored.join(truth.distinct().withColumn("label", F.lit(1)), ["s1_id", "cand_id"], "left").withColumn("label", F.coalesce("label", F.lit(0)))
    n_true = truth.distinct().groupBy("s1_id").agg(F.count("*").alias("n_true"))
    settings = F.explode(F.array(*(F.struct(F.lit(k).alias("rank_k"), F.lit(float(t)).alias("threshold"), F.lit(float(g)).alias("gate")) for k in ranks for t in thresholds for g in gates)))
    rows = labelled.withColumn("first", F.expr("min_by(score, rank) OVER (PARTITION BY s1_id)")).withColumn("s", settings).select("s1_id", "label", "score", "rank", "first", "s.*")
    rows = rows.where((F.col("rank") <= F.col("rank_k")) & (F.col("score") >= F.greatest("threshold", F.col("first") * F.col("gate"))))
    rows = rows.withColumn("best", F.expr("row_number() OVER (PARTITION BY s1_id, rank_k, threshold, gate ORDER BY score DESC, rank)"))
    rows = rows.withColumn("max_matches", F.explode(F.array(*map(F.lit, caps)))).where(F.col("best") <= F.col("max_matches"))
    by_query = rows.groupBy("rank_k", "threshold", "gate", "max_matches", "s1_id").agg(F.count("*").alias("n"), F.sum("label").alias("tp"))
    every = s1.select(F.col("entity_id").alias("s1_id")).join(n_true, "s1_id", "left").select("s1_id", F.coalesce("n_true", F.lit(0)).alias("n_true"))
    n_queries, n_single = every.agg(F.count("*")).scalar(), every.agg(F.count_if(F.col("n_true") == 0)).scalar()
    scored_queries = by_query.join(every, "s1_id").groupBy("rank_k", "threshold", "gate", "max_matches").agg(F.sum(f_half(F.col("tp"), F.col("n"), F.col("n_true"))).alias("gain"), F.count_if(F.col("n_true") == 0).alias("spoilt"))
    listed = s1.sparkSession.range(1).select(F.explode(F.array(*(F.struct(F.lit(k).alias("rank_k"), F.lit(float(t)).alias("threshold"), F.lit(float(g)).alias("gate"), F.lit(m).alias("max_matches")) for k in ranks for t in thresholds for g in gates for m in caps))).alias("s")).select("s.*")
    out = listed.join(scored_queries, ["rank_k", "threshold", "gate", "max_matches"], "left")
    return out.select("rank_k", "threshold", "gate", "max_matches", ((F.coalesce("gain", F.lit(0.0)) + n_single - F.coalesce("spoilt", F.lit(0))) / n_queries).alias("macro_f05"))


def best_setting(grid: DataFrame) -> dict:
    """The best score, of equal ones the lowest rank_k, threshold, cap and gate."""
    row = grid.orderBy(F.desc("macro_f05"), "rank_k", "threshold", "max_matches", "gate").first()
    return row.asDict() if row else {}
