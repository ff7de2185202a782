"""The training-data pipeline over documents: each stage works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave.llm.common import materialize, table
from linkweave.llm.decontaminate import decontaminate
from linkweave.llm.near_dedup import near_duplicates
from linkweave.llm.quality import keep_quality
from linkweave.llm.queries import piece_model
from linkweave.llm.sentencepieces import encode_documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject, row by row and as they are.

    Null, empty and blank texts are scored like any other text; a null doc_id has no label. Repeated rows
    get the same score and so stay or go together. Without usable labels all rows stay. Other columns are
    kept whatever their names; no rows give no rows.
    """
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near duplicates.

    Texts without words, and rows without doc_id, are in no group and stay. Rows that share a doc_id are
    one document: all of them stay or go. Very long texts are compared whole. Other columns are kept
    whatever their names; no rows give no rows.
    """
    gone = near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, row by row and as they are.

    Null and empty texts hold none and stay; a null or empty item is held by nothing. Very long texts are
    looked through whole. Repeated rows stay or go together. Other columns are kept whatever their names;
    no rows give no rows, and without items all rows stay.
    """
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, and the digest of what they decode to; one row for each row.

    Null and empty texts have no ids and decode to the empty text. A null doc_id stays null. Columns
    besides doc_id, lang and source are left out; no rows give no rows.
    """
    coded = encode_documents(docs, piece_model(), keep=("doc_id", "lang", "source"))
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontamination", benchmark_decontamination), ("sentencepiece", sentencepiece)]

#: Trained rules and spaced seeds aren't SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
