"""Connected components by alternating large-star and small-star steps.

Links stay in DataFrames; each step is a minimum by node (combined before the shuffle) joined back to
the links, and each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.llm.common import materialize


def _lowest(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m"))


def connected_components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for each node of links (u, v).

    Self-links and repeated links are fine; links with a null end are passed over. No links: no rows.
    """
    pairs = links.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    pairs, before = materialize(pairs), None
    while True:
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        # every larger neighbour of a node is linked to the smallest of the node and its neighbours
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _lowest(both).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # every smaller neighbour of a node, and the node, are linked to the smallest neighbour
        low = _lowest(large)
        small = large.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = materialize(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
