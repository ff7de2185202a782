"""A token index of a pool on disk, built once and used by many queries and micro-batches.

Each kind of postings is a Parquet table by country, sorted by key, so that a query reads the countries
it has and, in their files, the row groups that can hold its keys. A kind is complete when its job has
committed; a build that was interrupted goes on with the kinds that are left.
"""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave.operators.token_block import KINDS, Limits, TokenIndex
from linkweave.sources.shared import exists, remove

VERSION = 1


def _settings(limits: Limits) -> dict:
    """What an index depends on; the fallback is a matter of the query."""
    told = asdict(limits)
    del told["fallback"]
    return {"version": VERSION, "limits": told}


def _read_settings(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/settings").first()[0])


def write_postings(postings: DataFrame, path: str) -> None:
    """country, key, entity_id. The folder's name begins with a letter, so that an empty country differs from none, which meets nothing."""
    rows = postings.where("country IS NOT NULL").select(F.concat(F.lit("c"), "country").alias("part"), "key", "entity_id")
    rows.repartitionByRange("part", "key").sortWithinPartitions("part", "key").write.mode("overwrite").partitionBy("part").parquet(path)


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema("key string, entity_id string, part string").parquet(path)
    return rows.select(F.expr("substring(part, 2)").alias("country"), "key", "entity_id")


def save_index(pool: DataFrame, path: str, limits: Limits = Limits(), resume: bool = False) -> None:
    """Writes the postings of all keys of pool (entity_id, name, country) within the limits.

    resume: kinds that a former call with the same limits has finished stay as they are; the pool must
    be the same. Other limits than that call's raise ValueError. Without resume all is written anew.
    """
    spark = pool.sparkSession
    if resume and exists(spark, f"{path}/settings/_SUCCESS"):
        if _read_settings(spark, path) != _settings(limits):
            raise ValueError(f"{path} was begun with other limits")
    else:
        for kind in KINDS:
            remove(spark, f"{path}/{kind}")
        spark.createDataFrame([(json.dumps(_settings(limits)),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/settings")
    index = TokenIndex.build(None, pool, limits)
    for kind, postings in zip(KINDS, (index.tokens, index.exact, index.pairs), strict=True):
        if not exists(spark, f"{path}/{kind}/_SUCCESS"):
            write_postings(postings, f"{path}/{kind}")


def load_index(spark: SparkSession, path: str, limits: Limits | None = None) -> TokenIndex:
    """The index in path; ValueError if it isn't whole, or has another version or (where given) other limits."""
    told = _read_settings(spark, path)
    if told["version"] != VERSION:
        raise ValueError(f"{path} has version {told['version']}, not {VERSION}")
    if limits is not None and told != _settings(limits):
        raise ValueError(f"{path} was built with other limits: {told['limits']}")
    if missing := [k for k in KINDS if not exists(spark, f"{path}/{k}/_SUCCESS")]:
        raise ValueError(f"{path} isn't whole: {', '.join(missing)} missing")
    return TokenIndex(*(read_postings(spark, f"{path}/{k}") for k in KINDS), Limits(**told["limits"]))
