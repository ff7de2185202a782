"""Token blocking: S1 and pool records of one country meet on shared, not too common keys.

Three kinds of keys: name tokens, whole names, and pairs of name tokens. Only keys that occur on the
S1 side are counted (a semi-join before the first shuffle of postings), and keys over a document
frequency are dropped before any join, which bounds every join key's fan-out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave.functions.text import MAX_PAIR_TOKENS, token_pairs, token_set
from linkweave.operators.blocks import count_met, listed


@dataclass(frozen=True)
class Limits:
    """Shares of a country's records and absolute caps up to which keys are kept; 0 or less switches one off."""

    token_share: float = 0.001
    token_cap: int = 5000
    exact_share: float = 1.0
    exact_cap: int = 5000
    pair_share: float = 1.0
    pair_cap: int = 5000
    fallback: int = 50
    pair_tokens: int = MAX_PAIR_TOKENS


#: Kinds of keys, in the order of a TokenIndex.
KINDS = ("token", "exact", "pair")


def key_table(records: DataFrame, kind: str, limits: Limits = Limits()) -> DataFrame:
    """country, key, entity_id for records (entity_id, name, country)."""
    own = token_set(F.col("name"))
    keys = {"token": own, "exact": F.filter(F.array("name"), lambda x: x != ""), "pair": token_pairs(own, limits.pair_tokens)}[kind]
    return records.select("country", F.explode(keys).alias("key"), "entity_id")


def country_totals(records: DataFrame) -> DataFrame:
    return records.groupBy("country").agg(F.count("*").alias("n_records"))


def document_frequency(pool_keys: DataFrame, query_keys: DataFrame | None = None) -> DataFrame:
    """country, key, df over the pool, of keys that a query has, or of all."""
    if query_keys is not None:
        pool_keys = pool_keys.join(query_keys.select("country", "key").distinct(), ["country", "key"], "left_semi")
    return pool_keys.groupBy("country", "key").agg(F.count("*").alias("df"))


def limit(n: Column, share: float, cap: int) -> Column:
    by_share = n * F.lit(float(share))
    if share <= 0:
        return F.lit(float(cap))
    if cap <= 0:
        return by_share
    return F.when(by_share > 0, F.least(by_share, F.lit(float(cap)))).otherwise(F.lit(float(cap)))


def kept_keys(frequency: DataFrame, totals: DataFrame, share: float, cap: int) -> DataFrame:
    """country, key of frequencies within the limit."""
    return frequency.join(totals, "country").where(F.col("df") <= limit(F.col("n_records"), share, cap)).select("country", "key", "df")


def drop_covered_pairs(pairs: DataFrame, tokens: DataFrame) -> DataFrame:
    """Pair keys less those whose two tokens are both kept tokens: these add no candidate."""
    known = tokens.select("country", F.col("key").alias("token"), F.lit(True).alias("kept"))
    split = pairs.withColumns({"a": F.substring_index("key", " ", 1), "b": F.substring_index("key", " ", -1)})
    first = split.join(known.withColumnsRenamed({"token": "a", "kept": "kept_a"}), ["country", "a"], "left")
    both = first.join(known.withColumnsRenamed({"token": "b", "kept": "kept_b"}), ["country", "b"], "left")
    return both.where("NOT (coalesce(kept_a, false) AND coalesce(kept_b, false))").select(*pairs.columns)


@dataclass
class TokenIndex:
    """Postings (country, key, entity_id) of kept keys, by kind, and the limits they were kept by."""

    tokens: DataFrame
    exact: DataFrame
    pairs: DataFrame
    limits: Limits

    @classmethod
    def build(cls, s1: DataFrame | None, pool: DataFrame, limits: Limits = Limits()) -> TokenIndex:
        """Of the keys that s1 has; without s1 of all keys, for an index that is stored (sources.token_store)."""
        totals, kept, keys = country_totals(pool), {}, {}
        for kind, share, cap in (("token", limits.token_share, limits.token_cap), ("exact", limits.exact_share, limits.exact_cap), ("pair", limits.pair_share, limits.pair_cap)):
            keys[kind] = key_table(pool, kind, limits)
            kept[kind] = kept_keys(document_frequency(keys[kind], None if s1 is None else key_table(s1, kind, limits)), totals, share, cap)
        kept["pair"] = drop_covered_pairs(kept["pair"], kept["token"])
        return cls(*(keys[k].join(kept[k].select("country", "key"), ["country", "key"]) for k in KINDS), limits)


def lists_of(postings: DataFrame) -> DataFrame:
    return listed(postings.select("country", "key", "entity_id"), ["country", "key"])


def meet_in_blocks(query_keys: DataFrame, lists: DataFrame, count: str) -> DataFrame:
    """block, s1_id, cand_id and the number of keys they share."""
    return count_met(query_keys.select("country", "key", F.col("entity_id").alias("s1_id")), lists, ["country", "key"], count).withColumnRenamed("found", "cand_id")


def meet(query_keys: DataFrame, postings: DataFrame, count: str) -> DataFrame:
    """s1_id, cand_id and the number of keys they share."""
    return meet_in_blocks(query_keys, lists_of(postings), count).drop("block")


def few_candidates(s1: DataFrame, keys: DataFrame, lists: DataFrame, most: int) -> DataFrame:
    """S1 records that have at most `most` candidates, those without any included.

    A record with a longer list than that has more candidates, so only lists up to that length are met.
    """
    short = lists.select("country", "key", F.array_distinct("found").alias("found")).withColumn("long", F.size("found") > most)
    met = keys.select("country", "key", F.col("entity_id").alias("s1_id")).join(short.withColumn("found", F.when(~F.col("long"), F.col("found"))), ["country", "key"])
    n = met.groupBy("s1_id").agg(F.max("long").alias("many"), F.size(F.array_distinct(F.flatten(F.collect_list("found")))).alias("n"))
    many = n.where(F.col("many") | (F.col("n") > most)).select(F.col("s1_id").alias("entity_id"))
    return s1.join(many, "entity_id", "left_anti")


def hybrid_block(s1: DataFrame, pool: DataFrame | TokenIndex, limits: Limits = Limits()) -> DataFrame:
    """s1_id, cand_id, token_hits, exact, pair_hits, score.

    pool: records, or an index of them, whose own limits then count (but for the fallback). Names and pairs are looked up only for S1 records with few token candidates. The score is the
    number of shared tokens, at least 100 for an equal name, and 10 more for each shared pair.
    """
    return hybrid_in_blocks(s1, pool, limits).drop("block")


def hybrid_in_blocks(s1: DataFrame, pool: DataFrame | TokenIndex, limits: Limits = Limits()) -> DataFrame:
    """hybrid_block with the column block, by which the rows lie."""
    index = pool if isinstance(pool, TokenIndex) else TokenIndex.build(s1, pool, limits)
    keys, lists = key_table(s1, "token"), lists_of(index.tokens)
    hits = meet_in_blocks(keys, lists, "token_hits")
    few = few_candidates(s1, keys, lists, limits.fallback)
    exact = meet_in_blocks(key_table(few, "exact"), lists_of(index.exact), "exact")
    pairs = meet_in_blocks(key_table(few, "pair", index.limits), lists_of(index.pairs), "pair_hits")
    zero = F.lit(0).cast("long")
    parts = [hits.withColumns({"exact": zero, "pair_hits": zero}), exact.withColumns({"token_hits": zero, "pair_hits": zero}), pairs.withColumns({"token_hits": zero, "exact": zero})]
    merged = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("block", "s1_id", "cand_id").agg(*(F.sum(c).alias(c) for c in ("token_hits", "exact", "pair_hits")))
    score = F.greatest(F.col("token_hits"), F.when(F.col("exact") > 0, F.lit(100)).otherwise(F.lit(0))) + 10 * F.col("pair_hits")
    return merged.withColumn("score", score.cast("long"))
