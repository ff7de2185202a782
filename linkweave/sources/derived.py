"""Entity records from the driver's documents: country is the language, the source follows from `source`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave.functions.text import normalize, tokens


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """src (1, 2 or 3), entity_id, name, address, country, text (whole and normalised), text_key (of that).

    A document stands for a business record of short fields: its first six words are the name, the next
    14 the address. Queries over texts read the whole text.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    n = F.substring("source", 4, 9).cast("int")
    src = F.when(n <= 6, 1).when(n <= 13, 2).otherwise(3)
    rows = docs.select("doc_id", src.alias("src"), F.col("lang").alias("country"), normalize(F.col("text")).alias("norm")).withColumn("t", tokens(F.col("norm")))
    return rows.select(
        "src",
        F.concat(F.lit("S"), F.col("src"), F.lit("-"), F.col("doc_id")).alias("entity_id"),
        F.array_join(F.slice("t", 1, 6), " ").alias("name"),
        F.array_join(F.slice("t", 7, 14), " ").alias("address"),
        "country",
        F.col("norm").alias("text"),
        F.md5(F.col("norm").cast("binary")).alias("text_key"),
    )


def sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(S1, the pool of S2 and S3). Records are thin beside their texts and each branch of a query reads them, so they are kept."""
    rows = records(spark, sf_dir).drop("text").persist()
    return rows.where("src = 1"), rows.where("src > 1")


def truth(s1: DataFrame, pool: DataFrame) -> DataFrame:
    """s1_id, cand_id with equal normalised texts."""
    return s1.select(F.col("entity_id").alias("s1_id"), "text_key").join(pool.select(F.col("entity_id").alias("cand_id"), "text_key"), "text_key").select("s1_id", "cand_id")


#: The same records in DuckDB.
RECORDS_SQL = r"""
rec AS (SELECT src, 'S' || src || '-' || doc_id AS entity_id, array_to_string(t[1:6], ' ') AS name, array_to_string(t[7:20], ' ') AS address, country, norm AS text, md5(norm) AS text_key
    FROM (SELECT *, list_filter(string_split(norm, ' '), lambda x: x <> '') AS t FROM (
        SELECT doc_id, lang AS country, CASE WHEN CAST(substr(source, 4) AS INT) <= 6 THEN 1 WHEN CAST(substr(source, 4) AS INT) <= 13 THEN 2 ELSE 3 END AS src,
               trim(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g')) AS norm FROM documents))),
s1 AS (SELECT * FROM rec WHERE src = 1),
pool AS (SELECT * FROM rec WHERE src > 1),
truth AS (SELECT s1.entity_id AS s1_id, pool.entity_id AS cand_id FROM s1 JOIN pool USING (text_key))"""
