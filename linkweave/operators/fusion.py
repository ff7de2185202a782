"""Fusion of blockers: ranks by source, reciprocal-rank fusion, and pruning under a budget.

Everything is a window by query over rows of ids and numbers; names and addresses join only after
pruning. Source bits: 1 token, 2 LSH, 4 vector. Rows of blockers that lie by `block` (operators.blocks) are ranked,
folded and pruned where they lie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave.operators.blocks import by_query, dealt, query_keys

BITS = {"p1": 1, "p2": 2, "p3": 4}
RRF_K, SOURCE_BONUS, P3_TIE = 60, 0.005, 0.0005
#: LSH candidates of a query that go into the ranked policy.
P2_MOST = 5000


def source_ranks(scored: DataFrame) -> DataFrame:
    """Adds rank: the place by query and source; ties by cand_id. scored: s1_id, cand_id, source, score."""
    return scored.withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY {by_query(scored)}, source ORDER BY score DESC, cand_id)"))


def stack(p1: DataFrame | None, p2: DataFrame | None, p3: DataFrame | None, p2_most: int | None = None) -> DataFrame:
    """Ranked rows of all blockers (s1_id, cand_id, score each); of the second the best p2_most only, if given."""
    out, blocked = None, any(df is not None and "block" in df.columns for df in (p1, p2, p3))
    for name, df in (("p1", p1), ("p2", p2), ("p3", p3)):
        if df is not None:
            df = dealt(df) if blocked and "block" not in df.columns else df
            rows = source_ranks(df.select(*query_keys(df), "cand_id", F.lit(name).alias("source"), F.col("score").cast("double").alias("score")))
            rows = rows.where(F.col("rank") <= p2_most) if name == "p2" and p2_most else rows
            out = rows if out is None else out.unionByName(rows)
    return out


def fold(ranked: DataFrame) -> DataFrame:
    """One row for each pair: mask, r1, r2, r3 (null where absent), p1, p2, p3 scores."""
    of = lambda s, c: F.min(F.when(F.col("source") == s, F.col(c)))
    best = lambda s: F.max(F.when(F.col("source") == s, F.col("score")))
    bit = F.when(F.col("source") == "p1", 1).when(F.col("source") == "p2", 2).otherwise(4)
    return ranked.groupBy(*query_keys(ranked), "cand_id").agg(F.bit_or(bit).alias("mask"), of("p1", "rank").alias("r1"), of("p2", "rank").alias("r2"), of("p3", "rank").alias("r3"), best("p1").alias("p1"), best("p2").alias("p2"), best("p3").alias("p3"))


def rrf(p3_weight: float = 1.0, k: int = RRF_K) -> Column:
    """The fusion score over columns r1, r2, r3 and mask."""
    term = lambda c, w: F.coalesce(F.lit(float(w)) / (F.lit(k) + F.col(c)), F.lit(0.0))
    return term("r1", 1) + term("r2", 1) + term("r3", p3_weight) + F.lit(SOURCE_BONUS) * F.bit_count("mask")


def _counted(folded: DataFrame) -> DataFrame:
    """Adds rrf, core, n (candidates of the query), n_core and n_two (those of two blockers or more) and n3; rows of operators.fused bring the numbers along."""
    rows, own = folded.withColumn("rrf", rrf()).withColumn("core", F.col("mask").bitwiseAND(3) > 0), by_query(folded)
    if "n" not in rows.columns:
        rows = rows.withColumns({"n": F.expr(f"count(*) OVER (PARTITION BY {own})"), "n_core": F.expr(f"count_if(core) OVER (PARTITION BY {own})"), "n_two": F.expr(f"count_if(bit_count(mask) >= 2) OVER (PARTITION BY {own})")})
    return rows.withColumn("n3", F.col("n") - F.col("n_core"))


def _numbered(folded: DataFrame) -> DataFrame:
    """_counted, with the places within the two classes."""
    own = by_query(folded)
    return _counted(folded).withColumns({
        "by_rrf": F.expr(f"row_number() OVER (PARTITION BY {own}, core ORDER BY rrf DESC, cand_id)"),
        "by_p3": F.expr(f"row_number() OVER (PARTITION BY {own}, core ORDER BY p3 DESC NULLS LAST, cand_id)"),
    })


def _final(kept: DataFrame, order: str = "score DESC, cand_id") -> DataFrame:
    score = F.col("rrf") + P3_TIE * F.coalesce("p3", F.lit(0.0))
    return kept.withColumn("score", score).withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY {by_query(kept)} ORDER BY {order})")).select("s1_id", "cand_id", "rank", "mask", "score")


def _slots(cap: int, quota: float) -> Column:
    return F.greatest(F.lit(1), F.bround(F.lit(cap * quota)).cast("int"))


def prune_ranked(folded: DataFrame, cap: int = 1500, quota: float = 0.10) -> DataFrame:
    """Some places are always reserved for vector-only candidates; the others go to the core by fusion score."""
    rows = _numbered(folded)
    slots = F.least(F.col("n3"), _slots(cap, quota))
    keep = (F.col("n") <= cap) | (F.col("core") & (F.col("by_rrf") <= cap - slots)) | (~F.col("core") & (F.col("by_p3") <= slots))
    return _final(rows.where(keep))


def prune_without_lsh(folded: DataFrame, cap: int = 1500, quota: float = 0.10) -> DataFrame:
    """The ranked policy over the token and vector blockers only."""
    return prune_ranked(folded.where(F.col("mask").bitwiseAND(5) > 0).withColumns({"mask": F.col("mask").bitwiseAND(5), "r2": F.lit(None).cast("int")}), cap, quota)


def prune_core_safe(folded: DataFrame, cap: int = 1500, quota: float = 0.10) -> DataFrame:
    """A core that fits stays whole, vector-only candidates get a quota of places and any others by fusion
    score; a core that doesn't fit is cut by fusion score and leaves no place."""
    rows = _numbered(folded)
    slots = F.least(F.greatest(cap - F.col("n_core"), F.lit(0)), _slots(cap, quota))
    rows = rows.withColumn("first", ~F.col("core") & (F.col("by_p3") <= slots))
    rows = rows.withColumn("left_rank", F.expr(f"row_number() OVER (PARTITION BY {by_query(rows)}, core OR first ORDER BY rrf DESC, cand_id)"))
    fits = F.col("n_core") <= cap
    taken = F.col("n_core") + F.least(F.col("n3"), slots)
    late = ~F.col("core") & ~F.col("first") & (F.col("left_rank") <= cap - taken)
    keep = (F.col("n") <= cap) | (fits & (F.col("core") | F.col("first") | late)) | (~fits & F.col("core") & (F.col("by_rrf") <= cap))
    return _final(rows.where(keep))


AGREEMENT = "bit_count(mask) DESC, coalesce(p2, 0) DESC, least(coalesce(p1, 0), 100) DESC, coalesce(p3, 0) DESC, cand_id DESC"
LEXICAL = "least(coalesce(p1, 0), 100) DESC, coalesce(p2, 0) DESC, coalesce(p3, 0) DESC, cand_id DESC"
EMBEDDING = "coalesce(p3, 0) DESC, coalesce(p2, 0) DESC, least(coalesce(p1, 0), 100) DESC, cand_id DESC"


#: The same classes in the older order: LSH hits, token score (not held at 100), vector score, then the smaller id.
LATER_AGREEMENT, LATER_LEXICAL = (f"{start}coalesce(p2, 0) DESC, coalesce(p1, 0) DESC, coalesce(p3, 0) DESC, cand_id" for start in ("bit_count(mask) DESC, ", ""))
LATER_EMBEDDING = "coalesce(p3, 0) DESC, coalesce(p2, 0) DESC, coalesce(p1, 0) DESC, cand_id"


def prune_by_hits(folded: DataFrame, cap: int = 1000, quota: float = 0.30) -> DataFrame:
    """prune_agreement by LSH hits before token scores in every class, ties by the smaller id."""
    return prune_agreement(folded, cap, quota, (LATER_AGREEMENT, LATER_LEXICAL, LATER_EMBEDDING))


def prune_agreement(folded: DataFrame, cap: int = 1000, quota: float = 0.30, orders: tuple[str, str, str] = (AGREEMENT, LEXICAL, EMBEDDING)) -> DataFrame:
    """Candidates of two or more blockers first; of the places left a quota for vector-only ones; unused places go to the others."""
    (agreement, lexical, embedding), own = orders, by_query(folded)
    rows = _counted(folded).withColumn("kind", F.when(F.bit_count("mask") >= 2, 0).when(F.col("mask") == 4, 2).otherwise(1))
    rows = rows.withColumn("place", F.expr(f"CASE kind WHEN 0 THEN row_number() OVER (PARTITION BY {own}, kind ORDER BY {agreement}) WHEN 1 THEN row_number() OVER (PARTITION BY {own}, kind ORDER BY {lexical}) ELSE row_number() OVER (PARTITION BY {own}, kind ORDER BY {embedding}) END"))
    free = F.greatest(cap - F.col("n_two"), F.lit(0))
    rows = rows.withColumn("p3_slots", F.least(F.col("n3"), F.bround(free * F.lit(float(quota))).cast("long"))).withColumn("p12_slots", free - F.col("p3_slots"))
    rows = rows.withColumn("first", (F.col("n") <= cap) | ((F.col("kind") == 0) & (F.col("place") <= cap)) | ((F.col("kind") == 1) & (F.col("place") <= F.col("p12_slots"))) | ((F.col("kind") == 2) & (F.col("place") <= F.col("p3_slots"))))
    rows = rows.withColumns({"n_first": F.expr(f"count_if(first) OVER (PARTITION BY {own})"), "later": F.expr(f"row_number() OVER (PARTITION BY {own}, first ORDER BY {agreement})")})
    kept = rows.where(F.col("first") | (F.col("later") <= cap - F.col("n_first")))
    return kept.withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY {own} ORDER BY {agreement})")).select("s1_id", "cand_id", "rank", "mask", F.col("rrf").alias("score"))


def prune_core_first(folded: DataFrame, cap: int = 1000) -> DataFrame:
    """The core stays if it fits and vector-only candidates fill up; otherwise the core is cut by agreement."""
    rows = _numbered(folded).withColumn("by_agreement", F.expr(f"row_number() OVER (PARTITION BY {by_query(folded)}, core ORDER BY bit_count(mask) DESC, coalesce(p2, 0) DESC, coalesce(p1, 0) DESC, coalesce(p3, 0) DESC, cand_id)"))
    keep = (F.col("core") & (F.col("by_agreement") <= cap)) | (~F.col("core") & (F.col("by_p3") <= cap - F.col("n_core")))
    return _final(rows.where(keep))


#: By name, for plans and the command line.
POLICIES = {"ranked": prune_ranked, "core_safe": prune_core_safe, "agreement": prune_agreement, "by_hits": prune_by_hits, "without_lsh": prune_without_lsh, "core_first": lambda folded, cap, quota: prune_core_first(folded, cap)}


def prune(policy: str, p1: DataFrame | None, p2: DataFrame | None, p3: DataFrame | None, cap: int, quota: float) -> DataFrame:
    """The ranked candidates of three blockers by a policy; only the ranked one cuts LSH candidates first."""
    return POLICIES[policy](fold(stack(p1, p2, p3, P2_MOST if policy == "ranked" else None)), cap, quota)
