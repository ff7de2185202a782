"""The opN_ queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave.llm.chat import format_conversations, parse_conversations
from linkweave.llm.common import shared_dir, table
from linkweave.llm.decontaminate import find_leaks
from linkweave.llm.imatch import fingerprint_documents
from linkweave.llm.licenses import scan_licenses
from linkweave.llm.lm import score_texts
from linkweave.llm.near_dedup import near_duplicates
from linkweave.llm.quality import score_quality
from linkweave.llm.sentencepieces import encode_documents
from linkweave.llm.token_counts import count_tokens
from linkweave.llm.warc import base32_sha1, read_archives, write_archives


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_documents(table(spark, sf_dir, "documents"), piece_model())
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_quality(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), piece_model())


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path).select(
        "page_id",
        F.coalesce(F.length("payload").cast("long"), "declared_bytes").alias("payload_bytes"),
        F.coalesce(base32_sha1(F.col("payload")), "payload_digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    back = parse_conversations(format_conversations(rows.unionByName(extra)))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), piece_model())


QUERIES = {f.__name__: f for f in (op1_sentencepiece, op2_fingerprints, op3_license_scan, op4_decontaminate, op5_quality, op6_token_counts, op7_warc, op8_chat_format, op9_near_dedup, op10_lm_score)}
