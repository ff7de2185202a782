"""The whole resolution: blocking by three blockers, fusion, features, model, decision, files."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.functions.text import normalize, record_text
from linkweave.operators.decide import best_setting, decide, exact_shortcut, threshold_grid
from linkweave.operators.features import pair_features
from linkweave.operators.fusion import prune
from linkweave.operators.knn import choose_knn, embed
from linkweave.operators.learn import hard_negatives, predict, train
from linkweave.operators.lsh import lsh_in_blocks
from linkweave.operators.token_block import Limits, TokenIndex, hybrid_in_blocks


@dataclass(frozen=True)
class Settings:
    limits: Limits = field(default_factory=Limits)
    lsh_threshold: float = 0.3
    lsh_hits: int = 2
    permutations: int = 64
    n_gram: int = 3
    neighbours: int = 500
    cap: int = 1500
    quota: float = 0.10
    policy: str = "ranked"
    rank_k: int = 192
    model_k: int = 192
    threshold: float = 0.39
    most: int = 10
    gate: float = 0.0


def normalized(records: DataFrame) -> DataFrame:
    """entity_id, name, address, country from records as read."""
    return records.select("entity_id", normalize(F.col("business_name")).alias("name"), normalize(F.col("business_address")).alias("address"), "country")


def candidates(s1: DataFrame, pool: DataFrame, settings: Settings = Settings(), vectors: bool = True, index: TokenIndex | None = None) -> DataFrame:
    """s1_id, cand_id, rank, mask, score: the ranked candidates of each S1 record. index: a stored token index of the pool."""
    p1 = hybrid_in_blocks(s1, index or pool, settings.limits)
    p2 = lsh_in_blocks(s1, pool, settings.lsh_threshold, settings.permutations, settings.n_gram, settings.lsh_hits).withColumnRenamed("hits", "score")
    p3 = None
    if vectors:
        text = record_text(F.col("name"), F.col("address"))
        rows = lambda df, to: embed(df.select(F.col("entity_id").alias(to), F.col("country").alias("part"), text.alias("text")), F.col("text")).drop("text")
        p3 = choose_knn(rows(s1, "s1_id"), rows(pool, "cand_id"), settings.neighbours)
    return prune(settings.policy, p1, p2, p3, settings.cap, settings.quota)


def matches(s1: DataFrame, pool: DataFrame, ranked: DataFrame, model: PipelineModel, settings: Settings = Settings()) -> DataFrame:
    """s1_id, cand_id, place, rank, score of the matches among ranked candidates."""
    within = ranked.where(F.col("rank") <= settings.rank_k)
    exact = exact_shortcut(within, s1, pool)
    features = pair_features(within.where(F.col("rank") <= settings.model_k), s1, pool)
    scored = predict(model, features).select("s1_id", "cand_id", "rank", "score")
    return decide(scored, settings.threshold, settings.most, settings.gate, exact)


def train_matcher(s1: DataFrame, pool: DataFrame, ranked: DataFrame, truth: DataFrame, scan: int = 160, tail: int = 32, seed: int = 42, **options) -> PipelineModel:
    """A model trained on all positives, hard negatives and some random ones of ranked candidates."""
    pairs = hard_negatives(ranked, truth, scan, tail, seed)
    rows = pair_features(pairs, s1, pool).join(pairs.select("s1_id", "cand_id", "label"), ["s1_id", "cand_id"])
    return train(rows.persist(), seed=seed, **options)


#: The coarse grid of thresholds, caps and ranks, and the steps around its best setting.
COARSE = {"thresholds": [round(0.05 + 0.005 * i, 4) for i in range(181)], "caps": [6, 8, 10, 12, 16], "ranks": [64, 128, 192, 256]}
FINE_STEP, FINE_STEPS, FINE_GATES = 0.0005, 20, [0.0, 0.9, 0.95]


def tune(s1: DataFrame, pool: DataFrame, ranked: DataFrame, truth: DataFrame, model: PipelineModel, max_rank: int = 256, coarse: dict | None = None) -> dict:
    """The best threshold, rank_k, max_matches and gate by macro F0.5. Pairs are scored once, up to max_rank."""
    features = pair_features(ranked.where(F.col("rank") <= max_rank), s1, pool)
    scored = predict(model, features).select("s1_id", "cand_id", "rank", "score").persist()
    grid = coarse or COARSE
    best = best_setting(threshold_grid(s1, scored, truth, **grid))
    near = [best["threshold"] + FINE_STEP * i for i in range(-FINE_STEPS, FINE_STEPS + 1)]
    fine = best_setting(threshold_grid(s1, scored, truth, near, sorted({best["max_matches"], *grid["caps"][-2:]}), [best["rank_k"]], FINE_GATES))
    scored.unpersist()
    return fine if fine["macro_f05"] > best["macro_f05"] else best
