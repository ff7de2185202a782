"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave.sources import shared
from linkweave.sources.shared import shared_dir

#: Words are runs of anything but these ASCII white-space characters.
WORD_BREAK = r"[\x20\x09-\x0D]+"
#: A-Z only: lower() would also touch letters outside ASCII.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits that maybe_in sends to all tasks, at most.
FILTER_BITS = 1 << 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remove_shared(spark: SparkSession) -> None:
    """Remove all that the application's operators have written so far, once their results are read or saved."""
    shared.remove(spark, shared.base(spark))


def materialize(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def maybe_in(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """All rows of df whose column is among ids (one column of the same type), and maybe a few others, without a shuffle of df.

    What is broadcast is a set of bits of bounded size, so a join on the ids must follow where other rows matter.
    """
    slot = F.pmod(F.xxhash64(F.col(column)), F.lit(FILTER_BITS))
    slots = ids.select(F.pmod(F.xxhash64(F.col(ids.columns[0])), F.lit(FILTER_BITS)).alias("slot"))
    bits = slots.groupBy(F.shiftright("slot", 6).alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("_bits"))
    near = df.withColumn("_slot", slot).withColumn("_word", F.shiftright("_slot", 6)).join(F.broadcast(bits), "_word")
    return near.where(F.expr("getbit(_bits, cast(_slot & 63 as int)) = 1")).select(*df.columns)
