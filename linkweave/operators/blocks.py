"""Pairs of queries and postings, made where their query is: postings move, pairs don't.

S1 records are dealt into blocks by a hash of their id. Each list of postings is sent once to every block that
has its key, however many S1 records of the block have it; pairs are joined, counted, ranked and pruned within
the block. So what is shuffled is at most BLOCKS times the postings, not one row for each pair. Rows keep the
column `block`, a function of s1_id: groupings and windows that name it need no other exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave.functions.text import let

BLOCKS = 64


def block(s1_id: Column) -> Column:
    return F.pmod(F.xxhash64(s1_id), F.lit(BLOCKS))


def dealt(rows: DataFrame) -> DataFrame:
    """rows with an s1_id, in their blocks."""
    return rows.withColumn("block", block(F.col("s1_id"))).repartition(BLOCKS, "block")


def query_keys(df: DataFrame) -> list[str]:
    """The columns that rows of one query share."""
    return ["block", "s1_id"] if "block" in df.columns else ["s1_id"]


def by_query(df: DataFrame) -> str:
    """query_keys for PARTITION BY."""
    return ", ".join(query_keys(df))


def listed(postings: DataFrame, on: list[str]) -> DataFrame:
    """One row for each key, with its postings as an array."""
    rest = [c for c in postings.columns if c not in on]
    return postings.groupBy(*on).agg(F.collect_list(rest[0] if len(rest) == 1 else F.struct(*rest)).alias("found"))


def _lists_by_query(queries: DataFrame, lists: DataFrame, on: list[str]) -> DataFrame:
    """block, the columns of queries (s1_id, the key, ...) less the key, and the list of each of their keys.

    Queries and lists meet in a grouping, as a join would deal both out anew by all of its keys.
    """
    own = [c for c in queries.columns if c not in on]
    at = queries.select(block(F.col("s1_id")).alias("block"), *on, F.struct(*own).alias("q"))
    sent = at.groupBy(*on).agg(F.collect_set("block").alias("blocks")).join(lists, on).select(F.explode("blocks").alias("block"), *on, "found")
    both = at.unionByName(sent, allowMissingColumns=True).repartition(BLOCKS, "block")
    met = both.groupBy("block", *on).agg(F.collect_list("q").alias("qs"), F.any_value("found", True).alias("found")).where("found IS NOT NULL")
    return met.select("block", F.explode("qs").alias("q"), "found").select("block", "q.*", "found")


def count_met(queries: DataFrame, lists: DataFrame, on: list[str], count: str) -> DataFrame:
    """block, the columns of queries less the key, found and how many keys they share.

    The lists of a query are gathered whole and sorted, and equal neighbours counted: an entry takes far less
    room in an array than as a row of a hash table, of which there would be one for each pair.
    """
    own = [c for c in queries.columns if c not in on]
    found = _lists_by_query(queries, lists, on)
    gathered = found.groupBy("block", *own).agg(F.sort_array(F.flatten(F.collect_list("found"))).alias("found"))
    return gathered.select("block", *own, F.explode(let(F.col("found"), _runs)).alias("run")).select("block", *own, F.col("run.found").alias("found"), F.col("run.n").alias(count))


def _runs(items: Column) -> Column:
    """Each distinct item of a sorted array and how often it is there."""
    starts = F.filter(F.sequence(F.lit(0), F.size(items) - 1), lambda i: (i == 0) | (F.get(items, i) != F.get(items, i - 1)))
    run = lambda at: F.transform(at, lambda p, j: F.struct(F.get(items, p).alias("found"), (F.coalesce(F.get(at, j + 1), F.size(items)) - p).cast("long").alias("n")))
    return let(starts, run)
