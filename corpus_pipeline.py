"""From raw documents to token ids: toxic documents go, one of each group of near duplicates stays, documents that hold
benchmark items go, personal data are masked, and the texts that are left are encoded.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the columns
of documents, whatever they are; rows with null or empty texts pass, but for copies of each other.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopscope.llm import byte_pairs, decontamination, personal_data, toxicity, weighted_dedup
from shopscope.sources.workspace import Workspace


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the limit, by a grammar learned from the labels of these documents."""
    grammar = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(toxicity.score(F.col("text"), grammar) < toxicity.TOXIC_FROM)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each class."""
    return weighted_dedup.without_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), Workspace(spark))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by their kind and lengths to match."""
    masked = docs.withColumn("text", personal_data.redact(F.col("text"), personal_data.learn(docs)))
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the bytes they decode to."""
    found = byte_pairs.digest(F.col("text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)
    return docs.select("doc_id", "lang", "source", "n_chars", found.alias("found")).select("doc_id", "lang", "source", "n_chars", "found.*")


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("byte_pairs", encoded),
]
#: No SQL: the stages learn, hash and tag.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    workspace, docs = Workspace(spark), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = workspace.store(name, stage(spark, docs, sf_dir))
    return docs
