"""The queries of this subpackage by name, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

import corpus_pipeline
from shopscope.llm import byte_pairs, conversations, decontamination, language_net, licenses, merkle_manifest, nearest, personal_data, token_alignment, token_files, toxicity, web_archives, weighted_dedup
from shopscope.sources.workspace import Workspace


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def op1_byte_pairs(spark: SparkSession, directory: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document, in no order."""
    docs = table(spark, directory, "documents")
    found = byte_pairs.digest(docs["text"], public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return docs.select("doc_id", found.alias("found")).select("doc_id", "found.*")


def op2_toxicity(spark: SparkSession, directory: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, in no order."""
    docs = table(spark, directory, "documents")
    grammar = toxicity.learn(docs, table(spark, directory, "labels"))
    scored = docs.select("doc_id", toxicity.held_out(docs["doc_id"]).alias("held_out"), toxicity.score(docs["text"], grammar).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= toxicity.TOXIC_FROM).cast("int"))


def op3_near_duplicates(spark: SparkSession, directory: str) -> DataFrame:
    """doc_id, class_id, class_size of every document, in no order."""
    return weighted_dedup.classified(table(spark, directory, "documents"))


def op4_licenses(spark: SparkSession, directory: str) -> DataFrame:
    """doc_id, license, dice, parts: a row a licence of a document, in no order."""
    return licenses.scan(table(spark, directory, "documents"))


def op5_web_archives(spark: SparkSession, directory: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, record_id, target_uri, date of every page, in no order."""
    records = web_archives.round_trip(spark, table(spark, directory, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "target_uri", "date")


def op6_conversations(spark: SparkSession, directory: str) -> DataFrame:
    """conv_id, turn, role, segment: a row a turn of the conversations that stay, in no order."""
    return conversations.rendered(table(spark, directory, "conversations"))


def op7_decontamination(spark: SparkSession, directory: str) -> DataFrame:
    """doc_id, item_id, shared, item_shingles, containment: a row a benchmark item in a document, in no order."""
    docs, benchmark = table(spark, directory, "documents"), table(spark, directory, "benchmark")
    return decontamination.find(docs, benchmark, Workspace(spark)).drop("body")


def op8_token_files(spark: SparkSession, directory: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document; by file in the order of doc_id."""
    docs = table(spark, directory, "documents")
    records = token_files.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"), added=True)
    return records.select(records["key"].alias("doc_id"), "start", "n_tokens", "ids_crc32")


def neighbours(embeddings: DataFrame) -> DataFrame:
    """Every vector whose id is divisible by 100 against all others."""
    vectors = embeddings.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("vector"))
    vectors = vectors.where(F.col("id").isNotNull() & nearest.valid(F.col("vector")))
    return nearest.search(vectors, vectors.where(F.col("id") % 100 == 0), Workspace(embeddings.sparkSession))


def op9_nearest(spark: SparkSession, directory: str) -> DataFrame:
    """query_id, rank, vec_id, score: up to ten rows a query, in no order."""
    return neighbours(table(spark, directory, "embeddings"))


def op10_personal_data(spark: SparkSession, directory: str) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every document, in no order."""
    docs = table(spark, directory, "documents")
    found = personal_data.spans(docs["text"], personal_data.learn(docs))
    return docs.select("doc_id", found.alias("found")).select("doc_id", "found.*")


def op11_merkle_manifest(spark: SparkSession, directory: str) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every document."""
    return merkle_manifest.verified(table(spark, directory, "documents"), Workspace(spark))


def op12_language_id(spark: SparkSession, directory: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    docs = table(spark, directory, "documents")
    found = language_net.detect(docs["text"], language_net.learn(docs))
    return docs.select("doc_id", language_net.held_out(docs["doc_id"]).alias("held_out"), found.alias("found")).select("doc_id", "held_out", "found.*")


def op13_token_alignment(spark: SparkSession, directory: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_alignment.align(table(spark, directory, "documents"), *files, Workspace(spark)).documents


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_pairs": op1_byte_pairs,
    "op2_toxicity": op2_toxicity,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_licenses": op4_licenses,
    "op5_web_archives": op5_web_archives,
    "op6_conversations": op6_conversations,
    "op7_decontamination": op7_decontamination,
    "op8_token_files": op8_token_files,
    "op9_nearest": op9_nearest,
    "op10_personal_data": op10_personal_data,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_language_id": op12_language_id,
    "op13_token_alignment": op13_token_alignment,
    "pipeline": corpus_pipeline.run,
}
SQL: dict[str, str] = {
    "op4_licenses": licenses.SQL,
    "op6_conversations": conversations.SQL,
    "op7_decontamination": decontamination.SQL,
    "op11_merkle_manifest": merkle_manifest.SQL,
}
