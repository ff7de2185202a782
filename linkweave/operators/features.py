"""Pairwise similarity features: 32 columns in a fixed order.

Tokens and digit runs are derived once for each record, before the pair join. Ten features need fuzzy
scores; the other 22 are plain column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave.functions.fuzzy import fuzzy_scores
from linkweave.functions.text import country_key, digit_runs, tokens

FEATURES = (
    "name_levenshtein", "address_levenshtein", "name_token_set_ratio", "name_token_sort_ratio", "address_token_set_ratio", "address_token_sort_ratio",
    "name_partial_ratio", "address_partial_ratio", "name_wratio", "address_wratio", "name_jaccard", "address_jaccard", "name_token_overlap", "address_token_overlap",
    "name_exact", "address_exact", "name_length_ratio", "address_length_ratio", "name_digit_jaccard", "address_digit_jaccard", "address_number_match", "address_contains",
    "name_first_char_match", "country_match", "address_missing_query", "address_missing_candidate", "blocker_rank_score", "blocker_rank_log", "blocker_source_count", "blocker_p1_hit", "blocker_p2_hit", "blocker_p3_hit",
)


def prepare(records: DataFrame) -> DataFrame:
    """entity_id and one struct p of what the features need, for normalised records."""
    listed = lambda c: F.array_distinct(tokens(F.col(c)))
    return records.select("entity_id", F.struct(
        F.col("name").alias("n"), F.col("address").alias("a"), listed("name").alias("nt"), listed("address").alias("at"),
        digit_runs(F.col("name")).alias("nd"), digit_runs(F.col("address")).alias("ad"), country_key(F.col("country")).alias("c"),
    ).alias("p"))


def jaccard(x: Column, y: Column) -> Column:
    union = F.size(F.array_union(x, y))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(x, y)) / union)


def overlap(x: Column, y: Column) -> Column:
    least = F.least(F.size(x), F.size(y))
    return F.when(least == 0, 0.0).otherwise(F.size(F.array_intersect(x, y)) / least)


def length_ratio(x: Column, y: Column) -> Column:
    most = F.greatest(F.length(x), F.length(y))
    return F.when(most == 0, 1.0).otherwise(F.least(F.length(x), F.length(y)) / most)


def _flag(c: Column) -> Column:
    return F.when(c, 1.0).otherwise(0.0)


def plain_features(q: str = "q", c: str = "c") -> dict[str, Column]:
    """The features without fuzzy scores, over the structs q and c and the columns rank and mask."""
    x, y = (lambda f: F.col(f"{q}.{f}")), (lambda f: F.col(f"{c}.{f}"))
    rank, mask = F.col("rank"), F.col("mask")
    both = (x("a") != "") & (y("a") != "")
    return {
        "name_jaccard": jaccard(x("nt"), y("nt")),
        "address_jaccard": jaccard(x("at"), y("at")),
        "name_token_overlap": overlap(x("nt"), y("nt")),
        "address_token_overlap": overlap(x("at"), y("at")),
        "name_exact": _flag((x("n") != "") & (x("n") == y("n"))),
        "address_exact": _flag((x("a") != "") & (x("a") == y("a"))),
        "name_length_ratio": length_ratio(x("n"), y("n")),
        "address_length_ratio": length_ratio(x("a"), y("a")),
        "name_digit_jaccard": jaccard(x("nd"), y("nd")),
        "address_digit_jaccard": jaccard(x("ad"), y("ad")),
        "address_number_match": _flag(F.arrays_overlap(x("ad"), y("ad"))),
        "address_contains": _flag(both & (F.contains(x("a"), y("a")) | F.contains(y("a"), x("a")))),
        "name_first_char_match": _flag((x("n") != "") & (F.left(x("n"), F.lit(1)) == F.left(y("n"), F.lit(1)))),
        "country_match": _flag(x("c") == y("c")),
        "address_missing_query": _flag(x("a") == ""),
        "address_missing_candidate": _flag(y("a") == ""),
        "blocker_rank_score": F.when(rank > 0, 1.0 / (60 + rank)).otherwise(0.0),
        "blocker_rank_log": F.when(rank > 0, 1.0 / F.log2(2.0 + rank)).otherwise(0.0),
        "blocker_source_count": F.bit_count(mask).cast("double"),
        "blocker_p1_hit": _flag(mask.bitwiseAND(1) > 0),
        "blocker_p2_hit": _flag(mask.bitwiseAND(2) > 0),
        "blocker_p3_hit": _flag(mask.bitwiseAND(4) > 0),
    }


def paired(pairs: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    """pairs (s1_id, cand_id, rank, mask) with the structs q and c; a pair whose record is missing is an error when it is read."""
    q = prepare(s1).withColumnsRenamed({"entity_id": "s1_id", "p": "q"})
    c = prepare(pool).withColumnsRenamed({"entity_id": "cand_id", "p": "c"})
    there = lambda p, i: F.when(F.col(p).isNull(), F.raise_error(F.concat(F.lit("no record for "), i))).otherwise(F.col(p))
    return pairs.join(q, "s1_id", "left").join(c, "cand_id", "left").withColumns({"q": there("q", F.col("s1_id")), "c": there("c", F.col("cand_id"))})


def sql_features(pairs: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    return paired(pairs, s1, pool).select("s1_id", "cand_id", *(e.alias(n) for n, e in plain_features().items()))


def pair_features(pairs: DataFrame, s1: DataFrame, pool: DataFrame, sources: bool = True) -> DataFrame:
    """s1_id, cand_id, rank and all 32 features. sources=False leaves the four source features at 0."""
    rows = paired(pairs, s1, pool).withColumns({"fn": fuzzy_scores(F.col("q.n"), F.col("c.n")), "fa": fuzzy_scores(F.col("q.a"), F.col("c.a"))})
    found = plain_features()
    for field, s in (("name", "fn"), ("address", "fa")):
        found |= {f"{field}_levenshtein": F.col(f"{s}.ratio"), f"{field}_token_set_ratio": F.col(f"{s}.token_set"), f"{field}_token_sort_ratio": F.col(f"{s}.token_sort"), f"{field}_partial_ratio": F.col(f"{s}.partial"), f"{field}_wratio": F.col(f"{s}.weighted")}
    if not sources:
        found |= {n: F.lit(0.0) for n in FEATURES[-4:]}
    return rows.select("s1_id", "cand_id", "rank", *(found[n].cast("float").alias(n) for n in FEATURES))
